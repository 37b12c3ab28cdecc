from hostpulse.config import BOT, FLOOD, HIGH_VOLUME, LOW_VOLUME, NORMAL, SCAN, SCRAPER
from hostpulse.operators.labels import union_label, union_vs_intersection
from hostpulse.operators.scaling import moments, scaler_table, standardise
from hostpulse.operators.threats import classify, normal_percentiles, thresholds
from pyspark.sql import Row, functions as F
import pytest

LIMITS = Row(bot_ua_rate=0.5, error_4xx_rate=0.5, req_count_ddos=100.0, unique_urls_scraper=50.0, req_count_highvol=60.0)
SCHEMA = "label_combined byte, req_count long, unique_urls long, error_4xx_rate double, bot_ua_rate double"
CASES = [
    ((-1, 10, 5, 0.0, 0.6), BOT), ((-1, 10, 5, 0.6, 0.0), SCAN), ((-1, 200, 2, 0.0, 0.0), FLOOD),
    ((-1, 200, 60, 0.0, 0.0), SCRAPER), ((-1, 10, 7, 0.0, 0.0), SCRAPER), ((-1, 80, 10, 0.0, 0.0), HIGH_VOLUME),
    ((-1, 10, 5, 0.0, 0.0), LOW_VOLUME), ((-1, 200, 2, 0.6, 0.6), BOT), ((1, 200, 2, 0.6, 0.6), NORMAL),
    ((-1, 0, 0, 0.0, 0.0), LOW_VOLUME), ((-1, 10, 5, 0.5, 0.5), LOW_VOLUME),
]


@pytest.mark.parametrize("as_table", [False, True])
def test_rules_in_order(spark, as_table):
    df = spark.createDataFrame([(i, *c) for i, (c, _) in enumerate(CASES)], "id int, " + SCHEMA)
    limits = spark.createDataFrame([LIMITS]) if as_table else LIMITS
    assert [r.anomaly_type for r in classify(df, limits).orderBy("id").collect()] == [t for _, t in CASES]


def limits_of(spark, data):
    return thresholds(spark.createDataFrame(data, SCHEMA)).first()


def test_threshold_without_any_positive_value(spark):
    row = limits_of(spark, [(1, 0, 0, 0.0, 0.0)] * 50)
    assert row.bot_ua_rate == row.error_4xx_rate == row.req_count_ddos == 0.005
    assert row.req_count_highvol == 0.005


def test_threshold_from_the_smallest_positive_value(spark):
    rows = [(1, 4, 2, 0.0, 1.0)] * 4999 + [(1, 4, 2, 0.2, 1.0), (-1, 9999, 9999, 0.01, 0.01)]
    row = limits_of(spark, rows)
    assert row.error_4xx_rate == 0.1
    assert row.bot_ua_rate == 0.9
    assert (row.req_count_ddos, row.unique_urls_scraper, row.req_count_highvol) == (5.0, 2.5, 3.0)


def test_no_normal_rows_gives_no_quantile(spark):
    row = limits_of(spark, [(-1, 4, 2, 0.0, 1.0)])
    assert row.req_count_ddos is None


def test_union_and_overlap(spark):
    pairs = [(-1, -1)] + [(-1, 1)] * 2 + [(1, -1)] * 3 + [(1, 1)] * 4
    df = spark.createDataFrame(pairs, "label_if byte, label_secondary byte")
    row = union_vs_intersection(df).first()
    assert (row.n, row.only_if, row.only_secondary, row.intersection, row.union) == (10, 2, 3, 1, 6)
    assert row.lost_by_intersection_pct == 50.0
    assert df.filter(union_label() == -1).count() == 6
    empty = union_vs_intersection(df.filter(F.lit(False))).first()
    assert empty.n == 0 and empty.union_pct is None


def test_scaler_uses_the_population_deviation_and_keeps_constants_finite(spark):
    df = spark.createDataFrame([(1.0, 5), (3.0, 5)], "a double, b int")
    fitted = moments(df, ["a", "b"])
    for model in (fitted, fitted.first()):
        assert [tuple(r) for r in standardise(df, ["a", "b"], model).select("z_a", "z_b").collect()] == [(-1.0, 0.0), (1.0, 0.0)]
    assert sorted(tuple(r) for r in scaler_table(fitted, ["a", "b"]).collect()) == [("a", 2.0, 1.0), ("b", 5.0, 1.0)]


def test_percentiles_equal_the_aggregate(spark):
    df = spark.range(500).selectExpr(
        "cast(1 as byte) as label_combined", "id % 37 as req_count", "id % 11 as unique_urls",
        "(id % 13) / 13.0D as error_4xx_rate", "0.0D as bot_ua_rate")
    for row in normal_percentiles(df).collect():
        exact = df.agg(F.percentile(row.feature, F.array(*map(F.lit, (0.5, 0.9, 0.99, 0.999))))).first()[0]
        assert tuple(row)[1:] == pytest.approx(exact)
