import statistics
from datetime import datetime

import pytest

from hostpulse.operators.windows import build_features

SCHEMA = "host string, ts timestamp_ntz, resource string, user_agent string, status short, bytes long, is_bot_ua byte"


def windows(spark, rows, seconds=60):
    return build_features(spark.createDataFrame(rows, SCHEMA), seconds).orderBy("host", "window_start").collect()


def test_windows_are_left_closed_and_labelled_by_start(spark):
    rows = [("h", datetime(2018, 2, 5, 6, 25, 59, 999999), "/", "u", 200, 1, 0), ("h", datetime(2018, 2, 5, 6, 26), "/", "u", 200, 1, 0)]
    assert [r.window_start for r in windows(spark, rows)] == [datetime(2018, 2, 5, 6, 25), datetime(2018, 2, 5, 6, 26)]


def test_single_row_window(spark):
    (row,) = windows(spark, [("h", datetime(2018, 2, 5), "/", None, 404, 7, 1)])
    assert row.asDict() == {
        "host": "h", "window_start": datetime(2018, 2, 5), "req_count": 1, "unique_urls": 1, "unique_ua": 1,
        "error_4xx_rate": 1.0, "error_5xx_rate": 0.0, "avg_bytes": 7.0, "total_bytes": 7, "bytes_std": 0.0, "bot_ua_rate": 1.0,
    }


def test_null_counts_as_one_value_and_rates_cover_the_ends(spark):
    at = datetime(2018, 2, 5)
    rows = [
        ("h", at, None, None, 399, 0, 0), ("h", at, None, "a", 400, 2, 0), ("h", at, "/x", "a", 499, 4, 0),
        ("h", at, "/x", "b", 500, 6, 1), ("h", at, "/y", None, 599, 8, 0),
    ]
    (row,) = windows(spark, rows)
    assert (row.req_count, row.unique_urls, row.unique_ua) == (5, 3, 3)
    assert (row.error_4xx_rate, row.error_5xx_rate, row.bot_ua_rate) == (0.4, 0.4, 0.2)
    assert row.avg_bytes == 4 and row.total_bytes == 20 and row.bytes_std == pytest.approx(10**0.5)


def test_a_flooded_window_is_combined_before_each_shuffle(spark):
    df = spark.range(2000).selectExpr(
        "'h' as host", "timestamp_ntz'2018-02-05 00:00:01' as ts", "concat('/', id % 7) as resource",
        "cast(id % 3 as string) as user_agent", "cast(200 as short) as status", "id as bytes", "cast(0 as byte) as is_bot_ua")
    built = build_features(df)
    (row,) = built.collect()
    assert (row.req_count, row.unique_urls, row.unique_ua) == (2000, 7, 3)
    plan = built._jdf.queryExecution().executedPlan().toString()
    assert plan.count("partial_") >= 2


@pytest.mark.parametrize("sizes", [
    [12_345_678] * 300, [2**31 - d for d in range(4)], [0, 0], [7, None, 9], [None, None], [5, 2**31, 2**31 - 1],
    [10**12 + d for d in (0, 1, 2)], [9_000_000_000_000_000_000, 1], [4 * 10**18, 4 * 10**18 + 1024],
])
def test_deviation_is_exact_where_floats_cancel(spark, sizes):
    rows = [("h", datetime(2018, 2, 5), f"/{i % 4}", "u", 200, b, 0) for i, b in enumerate(sizes)]
    (row,) = windows(spark, rows)
    known = [b for b in sizes if b is not None]
    expected = statistics.stdev(known) if len(known) > 1 else 0.0
    wide = max(known, default=0) > 2**31
    assert row.bytes_std == pytest.approx(expected, rel=1e-12, abs=1e-7 * max(known) if wide else 1e-9)
    assert row.avg_bytes == pytest.approx(statistics.mean(known) if known else 0.0)
    assert row.total_bytes == sum(known)
