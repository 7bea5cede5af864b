"""Small frames and plan text for tests."""

import random
from collections import Counter
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, Row, SparkSession

from trailmark import schemas


def rows_of(frame: DataFrame) -> list[tuple]:
    return [tuple(row) for row in frame.collect()]


def same_rows(one: DataFrame, other: DataFrame) -> None:
    assert one.columns == other.columns
    a, b = Counter(rows_of(one)), Counter(rows_of(other))
    assert a == b, f"only in first: {list((a - b).items())[:3]}, only in second: {list((b - a).items())[:3]}"
    assert a


def plan(frame: DataFrame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


def final_plan(frame: DataFrame) -> str:
    """The adaptive plan after a run."""
    execution = frame._jdf.queryExecution()
    execution.executedPlan().executeCollectPublic()
    return execution.executedPlan().toString()


def dimension(index: int, value: str | None) -> dict:
    return {"index": index, "value": value}


def hit(number: int, dimensions=(), category=None, action=None, label=None, time=0, interaction=True) -> dict:
    return {
        "type": "EVENT",
        "hitNumber": number,
        "time": time,
        "isInteraction": interaction,
        "eventInfo": {"eventCategory": category, "eventAction": action, "eventLabel": label},
        "customDimensions": [dimension(*d) for d in dimensions],
    }


def session(visitor="v1", visit=1, number=1, start=1704067200, hits=None, brand=None, channel="Direct", medium="cpc", **totals):
    hits = [hit(1)] if hits is None else hits
    day = datetime(1970, 1, 1) + timedelta(seconds=start)
    row = {
        "date": f"{day:%Y%m%d}",
        "fullVisitorId": visitor,
        "visitId": visit,
        "visitNumber": number,
        "channelGrouping": channel,
        "visitStartTime": start,
        "totals": {"visits": 1, "hits": len(hits) or None} | totals,
        "trafficSource": {"medium": medium},
        "device": {},
        "geoNetwork": {},
        "hits": hits,
    }
    return row if brand is None else {"brand": brand} | row


def session_frame(spark: SparkSession, rows: list[dict]) -> DataFrame:
    schema = schemas.SESSIONS
    if "brand" in rows[0]:
        schema = schemas.record(brand=schemas.STRING, **{f.name: f.dataType for f in schema})
    return spark.createDataFrame(rows, schema)


def random_hits(spark: SparkSession, n: int, seed: int = 1, people: int = 12) -> DataFrame:
    """Flat hits with missing members, visitors, sessions, categories and times, and ties."""
    chance = random.Random(seed)
    start = datetime(2024, 1, 1)
    sessions = []
    for number in range(max(1, n // 4)):
        sessions.append(
            {
                "brand": chance.choice(["01", "07", None]),
                "marsId": chance.choice([None, None] + [f"m{i}" for i in range(people)]),
                "fullVisitorId": f"v{chance.randrange(people * 2)}",
                "sessionId": chance.choice([None] + [f"s{number}"] * 9),
                "visitStartDateTime": start + timedelta(hours=chance.randrange(24 * 5)),
                "channelGrouping": chance.choice(["Direct", "Email", "(Other)", "Unlisted", None]),
                "medium": chance.choice(["cpc", "CPC", "organic", "peimpr", "odd", None]),
                "visits": chance.choice([1, 1, 1, None]),
                "timeOnSite": chance.choice([None, 10, 60, 301]),
                "pageviews": chance.choice([None, 1, 3]),
                "bounces": chance.choice([None, 1]),
            }
        )
    rows = []
    for _ in range(n):
        s = chance.choice(sessions)
        rows.append(
            Row(
                brand=s["brand"],
                marsId=s["marsId"],
                sessionId=s["sessionId"],
                fullVisitorId=s["fullVisitorId"],
                visitNumber=chance.randrange(1, 4),
                channelGrouping=s["channelGrouping"],
                visitStartDateTime=s["visitStartDateTime"],
                totals=Row(
                    visits=s["visits"],
                    hits=4,
                    pageviews=s["pageviews"],
                    timeOnSite=s["timeOnSite"],
                    transactions=chance.choice([None, 1]),
                    totalTransactionRevenue=chance.choice([None, 4000000]),
                    bounces=s["bounces"],
                ),
                trafficSource=Row(medium=s["medium"]),
                hit=Row(
                    hitNumber=chance.randrange(1, 9),
                    isInteraction=chance.choice([True, False, None]),
                    eventInfo=Row(
                        eventCategory=chance.choice(["Ecommerce", "ecommerce", "a virtual try on", "SHADE-finder", None]),
                        eventAction=chance.choice(["Purchase", "Checkout", "add to favorites", None]),
                        eventLabel=chance.choice(["l", None]),
                    ),
                ),
            )
        )
    t = schemas
    schema = t.record(
        brand=t.STRING,
        marsId=t.STRING,
        sessionId=t.STRING,
        fullVisitorId=t.STRING,
        visitNumber=t.BIGINT,
        channelGrouping=t.STRING,
        visitStartDateTime=t.T.TimestampNTZType(),
        totals=t.SESSIONS["totals"].dataType,
        trafficSource=t.texts("medium"),
        hit=t.record(
            hitNumber=t.BIGINT,
            isInteraction=t.BOOLEAN,
            eventInfo=t.texts("eventCategory eventAction eventLabel"),
        ),
    )
    return spark.createDataFrame(rows, schema)
