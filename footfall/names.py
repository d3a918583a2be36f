"""Fixed values of the app's event data.

Event names, JSON keys, thresholds and lists below are given by the data itself
(including its spelling ``MapIteraction``), so they are stated as they are.
"""

# JSON property keys
KEY_TIME = "time"
KEY_USER = "distinct_id"
KEY_SESSION = "WNSessionNumber"
KEY_ACTIVATION = "WNTimeSinceActivation"
KEY_NETWORK = "WNNetworkAvailable"
KEY_LATITUDE = "WNUserLatitude"
KEY_LONGITUDE = "WNUserLongitude"
KEY_CITY = "WNCity"
KEY_COUNT = "WNCountValue"
KEY_STRING = "WNStringValue"
KEY_ADD_SOURCE = "WNItineraryChangeButton"
KEY_VARIANT = "WNAppVariant"
KEY_BRANCH = "WNAppVariantBranchFirstAddJumpsToItin"

# Places
LONDON = "London"
UNKNOWN = "UNKNOWN"
NO_LOCATION = "NOLOCATION"
REST_OF_WORLD = "ROW"
UNKNOWN_PLACES = ("UNKNOWN", "NOLOCATION")
LONDON_PREFIX = "lond"
# Wider London box, all bounds exclusive: (south, north, west, east)
LONDON_BOX = (51.041394, 51.951883, -0.812988, 0.60150)

# Event lists
IDLE_EVENTS = ("AppStartup", "MapModeEnd")
ACTIVATION_EVENTS = ("ItineraryAdd", "DetailsChecked")
# Offline runs in the retention report
RETENTION_RUN_EXCLUDED = (
    "AppStartup", "MapModeEnd", "ItineraryAdd2", "ItineraryRemove2",
    "RadarActivated", "RadarDeactivated", "OnboardingTutorialDone",
)
# Events that are no user action for the got-value detector
DETECTOR_EXCLUDED = (
    "MapModeEnd", "AppStartup", "ItineraryAdd2", "ItineraryRemove2",
    "SetStartingPointClose", "SetStartingPointSearchClose",
    "RadarDeactivated", "RadarActivated", "OnboardingTutorialDone",
)

# Thresholds
OFFLINE_SECONDS = 600
OFFLINE_MIN_EVENTS = 5
DAY_OFFLINE_MIN_EVENTS = 4
ADD_TO_DETAILS_RATIO = 3
SECONDS_PER_CHANGE = 10
MAX_REAL_POI = 10
MIN_CHANGES = 3
SESSION_LIMIT_SECONDS = 1800
DETECTOR_BATCH_DAYS = 30
INGEST_LAG_DAYS = 2
DOWNLOAD_BATCH_DAYS = 15
CONVERSION_DAYS = (7, 14, 21, 30, 60)
BOXPLOT_POINTS = (0.02, 0.25, 0.5, 0.75, 0.98)

# Column order of the exported histories
HISTORY_FIELDS = (
    "event", "string_value", "session", "activation_time", "network",
    "created_at", "count_value", "userid",
)
