import pytest
from pyspark.sql import SparkSession

from footfall import configure

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .appName("footfall-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "6g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield configure(session)
    session.stop()


LOG = (
    "userid string, event string, created_at timestamp, session int, network boolean, "
    "activation_time int, city string, properties string, event_id bigint"
)


@pytest.fixture(scope="session")
def make_log(spark):
    """Log rows from dicts; times count in seconds from 2024-01-01."""
    from datetime import datetime, timedelta, timezone

    zero = datetime(2024, 1, 1, tzinfo=timezone.utc)

    def make(rows):
        out = []
        for i, r in enumerate(rows):
            at = r.get("at", i)
            out.append((
                r.get("userid", "u"), r.get("event", "X"), zero + timedelta(seconds=at),
                r.get("session", 1), r.get("network", True), r.get("activation_time", at),
                r.get("city", "London"), r.get("properties", "{}"), r.get("event_id", i),
            ))
        return spark.createDataFrame(out, LOG)

    return make
