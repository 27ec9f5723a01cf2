"""Small event frames built by rule."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from clickcohort.operators.ingest import add_derived

EVENT_SCHEMA = (
    "row_id long, timestamp timestamp, site string, partner string, ip string, "
    "user_agent string, origin string, destination string, dep_date string, ret_date string, "
    "pax_config string, cabin string, stops string, session_id string, referrer string, "
    "cookie_present boolean, http_version string, status_code double"
)


def at(text: str) -> dt.datetime:
    return dt.datetime.fromisoformat(text).replace(tzinfo=dt.timezone.utc)


def events_from(spark: SparkSession, rows: list[dict], date: str = "2025-01-15",
                extra: str = "") -> DataFrame:
    """Events with defaults for whatever a row leaves out."""
    schema = EVENT_SCHEMA + (", " + extra if extra else "")
    names = [part.split()[0] for part in schema.split(", ")]
    default = {
        "site": "s", "partner": "p", "ip": "1.1.1.1", "user_agent": "ua", "origin": "AAA",
        "destination": "BBB", "dep_date": "2025-02-01", "pax_config": "1-0-0",
        "cabin": "economy", "stops": "0", "session_id": "x", "cookie_present": False,
        "http_version": "1.1", "status_code": 200.0, "timestamp": at("2025-01-15T10:00:00"),
    }
    full = [tuple({**default, "row_id": i, **row}.get(n) for n in names)
            for i, row in enumerate(rows)]
    return add_derived(spark.createDataFrame(full, schema), date)


def run(start: str, count: int, step: float, **fixed) -> list[dict]:
    """``count`` events ``step`` seconds apart; list values are taken in turn."""
    first = at(start)
    out = []
    for i in range(count):
        row = {"timestamp": first + dt.timedelta(seconds=i * step)}
        for name, value in fixed.items():
            row[name] = value[i] if isinstance(value, list) else value
        out.append(row)
    return out


def day(n: int) -> str:
    return (dt.date(2025, 1, 1) + dt.timedelta(days=n - 1)).isoformat()


def four_cohorts(spark: SparkSession) -> DataFrame:
    """A night crawler over three dates, a slow sweep, a burst at noon, a slow night visitor."""
    march = [f"2025-03-{n:02d}" for n in (1, 2, 3)]
    rows = [
        *run("2025-01-15T03:20:00", 12, 4, ip="a", dep_date=march * 4, http_version="1.1",
             cookie_present=False, referrer=None),
        *run("2025-01-15T14:45:00", 6, 600, ip="b",
             dep_date=[f"2025-04-{n:02d}" for n in range(1, 7)], http_version="2",
             cookie_present=True, referrer="r"),
        *run("2025-01-15T12:00:00", 15, 0.5, ip="c", dep_date="2025-05-09", http_version="2",
             cookie_present=False, referrer="r"),
        *run("2025-01-15T22:30:00", 5, 1200, ip="d",
             dep_date=[f"2025-06-{n}" for n in (10, 12, 14, 16, 18)], http_version="1.1",
             cookie_present=True, referrer=None),
    ]
    return events_from(spark, rows)
