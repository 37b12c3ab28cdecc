import re
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from hostpulse.config import TIME_FORMATS
from hostpulse.config import BOT_MARKERS, LOG_COLUMNS
from hostpulse.functions.text import MONTHS, WHITE_SPACE, _full_width, contains_any, lenient_int, parse_time, strip
from hostpulse.operators.cleaning import clean, drop_invalid, keep_first, type_columns

ORDER = ["_source_file", "_row_id"]
SCHEMA = ", ".join(f"{c} string" for c in LOG_COLUMNS) + ", _source_file string, _row_id long"
GOOD = dict(
    host="1.1.1.1", datetime="05/Feb/2018 06:25:05", method="get", resource="/", protocol="HTTP/1.1", status="200",
    bytes="7", referrer=None, user_agent="Mozilla", _source_file="a.csv", _row_id=0,
)


def log(spark, *rows):
    return spark.createDataFrame([tuple({**GOOD, **r}[c] for c in [*LOG_COLUMNS, *ORDER]) for r in rows], SCHEMA)


def values(df, column="x"):
    return [r[column] for r in df.collect()]


def test_strip_removes_all_unicode_white_space(spark):
    texts = ["a", " a b ", "\ta\r\n", " a ", "　", "", None, "é ", " ż", "~", "a\x00"]
    df = spark.createDataFrame([(t,) for t in texts], "x string").select(strip("x").alias("x"))
    assert values(df) == [t if t is None else t.strip(WHITE_SPACE) for t in texts]


@pytest.mark.parametrize("agent, expected", [
    ("Googlebot/2.1", True), ("PYTHON-requests", True), ("Mozilla/5.0", False), ("", False), (None, None),
    ("archive.org_bot", True), ("Java/1.8", True), ("javascript", False), ("Go-http-client", True),
    ("ſpider", True), ("pıthon spıder", False), ("wGet", True),
])
def test_bot_markers(spark, agent, expected):
    df = spark.createDataFrame([(agent,)], "x string").select(contains_any("x", BOT_MARKERS).alias("x"))
    assert values(df) == [expected]


def test_bot_markers_equal_the_alternation_regex(spark):
    agents = [f"x{m.upper()}y" for m in BOT_MARKERS] + [m[:-1] for m in BOT_MARKERS] + ["", "opera", "BO t", "archiveXorg_boat"]
    pattern = re.compile("|".join(re.escape(m) for m in BOT_MARKERS), re.IGNORECASE)
    df = spark.createDataFrame([(a,) for a in agents], "x string").select(contains_any("x", BOT_MARKERS).alias("x"))
    assert values(df) == [bool(pattern.search(a)) for a in agents]


def test_lenient_numbers(spark):
    texts = ["-", "", None, " 12 ", "x", "12.0", "70000", "-5", " - "]
    df = spark.createDataFrame([(t,) for t in texts], "x string")
    assert values(df.select(lenient_int("x", "smallint").alias("x"))) == [None, None, None, 12, None, None, None, -5, None]


def test_times(spark):
    texts = ["05/Feb/2018 06:25:05", " 05/feb/2018 06:25:05\t", "31/Feb/2018 00:00:00", None, "2018-02-05 06:25:05"]
    df = spark.createDataFrame([(t,) for t in texts], "x string")
    good = datetime(2018, 2, 5, 6, 25, 5)
    assert values(df.select(parse_time("x", ["dd/MMM/yyyy HH:mm:ss"]).alias("x"))) == [good, good, None, None, None]
    both = parse_time("x", ["dd/MMM/yyyy HH:mm:ss", "yyyy-MM-dd HH:mm:ss"])
    assert values(df.select(both.alias("x")))[-1] == good


def test_typed_columns_see_the_raw_values(spark):
    row = type_columns(log(spark, {"host": " h ", "method": " post ", "bytes": "-", "user_agent": " curl "})).first()
    assert (row.host, row.method, row.bytes, row.user_agent, row.is_bot_ua) == ("h", "POST", 0, "curl", 1)
    assert type_columns(log(spark, {"user_agent": None})).first().is_bot_ua == 0


def test_invalid_rows_are_dropped(spark):
    statuses = ["99", "100", "599", "600", "70000", "abc", None]
    rows = [{"status": s} for s in statuses] + [{"host": ""}, {"host": " \t"}, {"host": None}, {"datetime": "31/Feb/2018 00:00:00"}]
    kept = drop_invalid(type_columns(log(spark, *rows)))
    assert sorted(values(kept, "status")) == [100, 599]


def test_bytes_default_to_zero(spark):
    rows = [{"bytes": b, "_row_id": i} for i, b in enumerate(["-", "", None, " 12 ", "x"])]
    assert values(type_columns(log(spark, *rows)).orderBy("_row_id"), "bytes") == [0, 0, 0, 12, 0]


@pytest.mark.parametrize("partitions", [1, 5])
def test_first_copy_survives(spark, partitions):
    rows = [
        {"bytes": "3", "_source_file": "b.csv", "_row_id": 0}, {"bytes": "1", "_source_file": "a.csv", "_row_id": 4},
        {"bytes": "2", "_source_file": "a.csv", "_row_id": 9}, {"resource": None, "_row_id": 1}, {"resource": None, "_row_id": 2},
    ]
    kept = clean(log(spark, *rows).repartition(partitions), ORDER)
    assert sorted((r.resource or "", r.bytes) for r in kept.collect()) == [("", 7), ("/", 1)]


def test_copies_are_reduced_before_the_shuffle(spark):
    df = spark.range(1000).selectExpr("id % 3 as k", "id as pos", "cast(id as string) as text")
    plan = keep_first(df, ["k"], ["pos"])._jdf.queryExecution().sparkPlan().toString()
    assert "partial_min" in plan
    assert sorted(tuple(r) for r in keep_first(df, ["k"], ["pos"]).collect()) == [(0, 0, "0"), (1, 1, "1"), (2, 2, "2")]


def test_each_time_is_parsed_once(spark):
    plan = clean(log(spark, {}), ORDER)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("gettimestamp") == 1


def test_order_and_partitions_do_not_matter(spark):
    rows = [{"host": f"h{i % 5}", "resource": f"/{i % 3}", "bytes": str(i), "_row_id": i} for i in range(60)]
    expected = sorted(clean(log(spark, *rows), ORDER).select("host", "resource", F.col("bytes")).collect())
    shuffled = clean(log(spark, *reversed(rows)).repartition(7), ORDER).select("host", "resource", "bytes").collect()
    assert sorted(shuffled) == expected


def test_times_keep_their_clock_in_any_session_zone_and_width(spark):
    df = spark.createDataFrame([("25/Mar/2018 02:30:00",), ("5/Feb/2018 6:25:05",), ("28/Oct/2018 02:30:00",)], "x string")
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Europe/Warsaw")
        found = values(df.select(parse_time("x", TIME_FORMATS).alias("x")))
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert found == [datetime(2018, 3, 25, 2, 30), datetime(2018, 2, 5, 6, 25, 5), datetime(2018, 10, 28, 2, 30)]


def test_full_width_times_equal_the_format(spark):
    """Texts that are cut by position give what the format gives, and the rest is left to the format."""
    usual = [f"{d:02d}/{m}/{y} {h}" for d in (1, 28, 29, 30, 31) for m in MONTHS for y in (1000, 1582, 1900, 2023, 2024, 9999) for h in ("00:00:00", "23:59:59")]
    odd = [
        "1/Jan/2024 1:2:3", "01/jan/2024 00:00:00", "01/JAN/2024 00:00:00", "01/Jan/0024 00:00:00", "01/Jan/0000 00:00:00", "00/Jan/2024 00:00:00",
        "01/Jan/2024 24:00:00", "01/Jan/2024 23:59:60", "01/Jan/2024 23:60:00", "01/Jan/2024 12:30:5Z", "01/Jan/2024 12:30:+5", "01/Jan/2024 12:30:.5",
        "01/Jan/2024 12:3 :05", "1 /Jan/2024 12:30:05", " 1/Jan/2024 12:30:05", "01/Jan/2024 1 :30:05", "01/Jan/2024T12:30:05", "01/Jan/+024 12:30:05",
        "01/Jan/-024 12:30:05", "-1/Jan/2024 12:30:05", "01/Jan/2024 -1:30:05", "01/Jan/2024 1::30:05", "01/Jan/2024 12:30:05 ", "\t01/Jan/2024 12:30:05",
        "01/Jan/2024  2:30:05", "01/anF/2024 12:30:05", "01-Jan-2024 12:30:05", "01/Jän/2024 12:30:5", "٠١/Jan/2024 12:30:05", "32/Foo/2024 00:00:00", "", "-", None,
    ]
    rows = spark.createDataFrame([(t,) for t in usual + odd], "t string")
    slow = F.try_to_timestamp(F.concat(strip("t"), F.lit(" +0000")), F.lit("d/MMM/yyyy H:m:s Z"))
    want = F.timestamp_add("MICROSECOND", F.unix_micros(slow), F.lit("1970-01-01").cast("timestamp_ntz"))
    wrong = rows.select("t", parse_time("t", TIME_FORMATS).alias("got"), want.alias("want"), _full_width(F.col("t")).alias("cut"))
    assert wrong.where("not got <=> want").collect() == []
    assert wrong.where("cut is not null").count() > 600 and wrong.where("want is null").count() > 20
