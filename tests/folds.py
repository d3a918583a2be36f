"""Plain step-by-step versions of the detector rules, for small histories."""

EXCLUDED = {
    "MapModeEnd", "AppStartup", "ItineraryAdd2", "ItineraryRemove2", "SetStartingPointClose",
    "SetStartingPointSearchClose", "RadarDeactivated", "RadarActivated", "OnboardingTutorialDone",
}


def ordered(history):
    return sorted(history, key=lambda e: (e["at"], e["activation_time"], e["event_id"]))


def got_value(history):
    """event_id of the first got-value event, or None."""
    run = []
    for e in ordered(history):
        if e["event"] in EXCLUDED:
            continue
        if e["network"] is not False:
            run = []
            continue
        run.append(e)
        lasted = e["activation_time"] - run[0]["activation_time"]
        if len(run) > 1 and lasted >= 600 and (len(run) >= 5 or e["event"] == "MapIteraction"):
            return e["event_id"]
    return None


def experimental(history):
    flagged, current, counts = set(), object(), None
    for e in ordered(history):
        if e["session"] in flagged:
            continue
        if e["session"] != current:
            current, counts, began = e["session"], {}, e["activation_time"]
        counts[e["event"]] = counts.get(e["event"], 0) + 1
        adds, gone = counts.get("ItineraryAdd", 0), counts.get("ItineraryRemove", 0)
        changes, seconds = adds + gone, e["activation_time"] - began
        if (
            (changes >= 3 and seconds < changes * 10)
            or (adds >= 3 and adds > 3 * counts.get("DetailsChecked", 0))
            or (e["event"] == "ItineraryAdd" and e["poi"] > 10)
        ):
            flagged.add(e["session"])
    return flagged


def closest(history, compat):
    """event_id to place."""
    rows = ordered(history)
    known = [i for i, e in enumerate(rows) if e["city"] not in (None, "UNKNOWN", "NOLOCATION")]
    out = {}
    for i, e in enumerate(rows):
        before = [k for k in known if k < i]
        after = [k for k in known if k > i]
        if i in known:
            pick = i
        elif before and after:
            to_before = abs(e["activation_time"] - rows[before[-1]]["activation_time"])
            to_after = abs(rows[after[0]]["activation_time"] - e["activation_time"])
            first = to_before > to_after if compat else to_before < to_after
            pick = before[-1] if first else after[0]
        elif before or after:
            pick = (before[-1:] or after[:1])[0]
        else:
            pick = None
        out[e["event_id"]] = rows[pick]["city"] if pick is not None else "UNKNOWN"
    return out


def offline_runs(history, excluded):
    """Sorted (start, size) of every offline run."""
    runs, open_run = [], False
    for e in ordered(history):
        if e["event"] in excluded:
            continue
        if e["network"] is False:
            if open_run:
                runs[-1][1] += 1
            else:
                runs.append([e["at"], 1])
            open_run = True
        else:
            open_run = False
    return sorted(map(tuple, runs))
