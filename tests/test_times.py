"""ISO-8601 texts of every shape against the standard library."""

import random
from datetime import date, datetime, timedelta, timezone

from pyspark.sql import functions as F

from eventlake.functions.times import parse_iso

EPOCH = datetime(1970, 1, 1, tzinfo=timezone.utc)
ODD = """20240101T10 2024-01-01T1030 2024-01-01T10:30:00,123456789 2024-01-01T24:00 2024-01-01x10:30 2024-01-01T10:30+05
2024-01-01T10:30+05:30:15.5 2024-01-01T10:30:00. 2024-W53 2020-W53 2020-W53-7 2024-W00 2024-W01-0 2024-W01-8 2024-1-1 2024-01-01T10:30z
2024-01-01T 2024 2024-01 2024-01-01T10:30-23:59:59 2024-01-01T10:30+19:00 2024W01T10 2024-W01T1030 2024-W01-1T10:30 0000-01-01 0001-01-01 9999-W53-7
9999-W52-7 2024-02-30 20240230 2023-02-29T00:00 2024-01-01T10:30:60 2024-01-01T1030:00 2024-01-01T10:3000 2024-01-01T10:30+053000 20240101-1030
2024-W0110 2024W0110:30 202401011030 2024-01-01T10Z 20240101T103000Z 2024-W10-5T10:00:00.5Z 2024-01-01T10:30+ 2024-13-01 20241301 -2024-01-01 ٢٠٢٤-01-01""".split()


def expected(text):
    try:
        found = datetime.fromisoformat(text)
    except ValueError:
        return None
    if found.tzinfo is None:
        found = found.replace(tzinfo=timezone.utc)
    try:
        return (found - EPOCH) // timedelta(microseconds=1)
    except OverflowError:
        return None


def generated(n):
    draw = random.Random(8)
    for _ in range(n):
        day = date(draw.choice([1, 1582, 1900, 1970, 2020, 2024, 2026, 9998]), draw.randrange(1, 13), draw.randrange(1, 29))
        year, week, weekday = day.isocalendar()
        text = draw.choice([day.isoformat(), day.strftime("%Y%m%d").zfill(8), f"{year:04}-W{week:02}-{weekday}", f"{year:04}W{week:02}{weekday}", f"{year:04}-W{week:02}"])
        if draw.random() < 0.85:
            colon = draw.choice([":", ""])
            clock = [f"{draw.randrange(24):02}", *(f"{draw.randrange(60):02}" for _ in range(draw.randrange(3)))]
            text += draw.choice(["T", " "]) + colon.join(clock)
            if len(clock) == 3 and draw.random() < 0.6:
                text += draw.choice(".,") + str(draw.randrange(10 ** draw.randrange(1, 12)))
            colon = draw.choice([":", ""])
            offset = [f"{draw.randrange(24):02}", *(f"{draw.randrange(60):02}" for _ in range(draw.randrange(3)))]
            text += draw.choice(["", "Z", draw.choice("+-") + colon.join(offset)])
        yield text


def test_every_shape_equals_the_standard_library(spark):
    texts = [*ODD, *generated(3000)]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", F.unix_micros(parse_iso(F.col("t"))).alias("us")).collect()
    differing = [(r.t, r.us, expected(r.t)) for r in rows if r.us != expected(r.t)]
    assert not differing, differing[:10]


def test_null_and_other_text(spark):
    rows = spark.createDataFrame([(None,), ("",), ("yesterday",), ("\n2024-01-01",)], "t string").select(parse_iso(F.col("t")).alias("x")).collect()
    assert [r.x for r in rows] == [None] * 4
