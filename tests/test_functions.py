import datetime as dt
import json
from decimal import Decimal

from pyspark.sql import functions as F

from eventlake.functions import json_safe, status_words, text, times
from eventlake.schemas import EVENT_COLUMNS, create_namespace_ddl, create_table_ddl
from eventlake.session import shuffle_width


def values(df, *columns):
    return tuple(df.select(*[c.alias(f"c{i}") for i, c in enumerate(columns)]).first())


def test_text(spark):
    one = spark.range(1)
    name = F.lit("\t Ada  Van　Dyke \n")
    got = values(
        one,
        text.strip(name),
        text.first_word(name),
        text.last_word(name),
        text.is_blank(F.lit(" \t")),
        text.is_empty(F.lit(" ")),
        text.is_empty(F.lit(None).cast("string")),
        text.preview(F.lit("abcdef"), 3),
        text.preview(F.lit("abc"), 3),
        text.head_preview(F.lit("abc"), 12),
        text.first_value(F.array().cast("array<string>")),
        text.bytes_to_text(F.unhex(F.lit("41FF42"))),
    )
    assert got == ("Ada  Van　Dyke", "Ada", "Dyke", True, False, True, "abc…", "abc", "abc…", "", "A�B")
    assert [text.clamp(v, 1, 100) for v in (-5, 1, 40, 1000)] == [1, 1, 40, 100]


def test_times(spark):
    good = {
        "2024-01-01T00:00:00Z": 0,
        "2024-01-01 00:00:01": 1_000_000,
        "2024-01-01T00:00:00.25+00:00": 250_000,
        "2024-01-01T02:00:00+02:00": 0,
        "2024-01-01": 0,
        "20240101T000000": 0,
        "2024-W01-1": 0,
    }
    bad = ["2024", "2024-01", "2024-13-01T00:00:00", "now", ""]
    df = spark.createDataFrame([(t,) for t in [*good, *bad]], "t string")
    got = {r.t: r.us for r in df.select("t", F.unix_micros(times.parse_iso(F.col("t"))).alias("us")).collect()}
    start = 1_704_067_200_000_000
    assert got == {**{t: start + us for t, us in good.items()}, **dict.fromkeys(bad)}
    whole, part = F.timestamp_micros(F.lit(start)), F.timestamp_micros(F.lit(start + 1500))
    assert values(spark.range(1), times.iso_text(whole), times.iso_text(part), times.event_time_text(whole)) == (
        "2024-01-01T00:00:00",
        "2024-01-01T00:00:00.001500",
        "2024-01-01T00:00:00.000000+00:00",
    )


def test_status_words(spark):
    words = ["Success", "running", "ERROR", "queued", "done", "", None]
    df = spark.createDataFrame([(w,) for w in words], "w string")
    got = [r.s for r in df.select(status_words.normalized_status(F.col("w")).alias("s")).collect()]
    assert got == ["completed", "processing", "failed", "waiting", "unknown", "unknown", "unknown"]


def test_json_rows(spark):
    row = (
        dt.date(2024, 5, 1),
        Decimal("1.50"),
        float("nan"),
        [1.0, float("inf"), None],
        {7: dt.datetime(2024, 5, 1, 12)},
        (b"\xff", None),
        None,
        9007199254740993,
        "한글",
    )
    schema = (
        "d date, n decimal(5,2), x double, xs array<double>, m map<int,timestamp>, s struct<b: binary, y: float>, "
        "empty struct<a: int>, big long, t string"
    )
    value = json_safe.json_rows(spark.createDataFrame([row], schema)).first().value
    assert json.loads(value, parse_constant=lambda _: 1 / 0) == {
        "d": "2024-05-01",
        "n": 1.5,
        "x": None,
        "xs": [1.0, None, None],
        "m": {"7": "2024-05-01T12:00:00"},
        "s": {"b": "�", "y": None},
        "empty": None,
        "big": 9007199254740993,
        "t": "한글",
    }
    assert "한글" in value


def test_shuffle_width_follows_the_input():
    assert shuffle_width(1) == 200
    assert shuffle_width(10 * 1024**4) == 81_920
    assert shuffle_width(100 * 1024**4) == 819_200
    assert shuffle_width(100 * 1024**4, 1024**3) == 102_400


def test_ddl_follows_the_schema(spark):
    ddl = create_table_ddl("lake.usage.events")
    assert ddl.startswith("CREATE TABLE IF NOT EXISTS lake.usage.events (`event_id` STRING,")
    assert "`quantity` INT" in ddl and ddl.endswith("USING iceberg") and len(EVENT_COLUMNS) == 8
    assert create_namespace_ddl("lake.usage.events") == "CREATE NAMESPACE IF NOT EXISTS lake.usage"
