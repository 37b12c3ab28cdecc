import pytest
from pyspark.sql import functions as F

from hostpulse.operators.rollups import RELATIVE_ERROR, hourly, roll_up


@pytest.fixture(scope="module")
def log(spark):
    """200,000 requests of 3 hosts over 2 days, one host with a third of all rows and 60,000 resources; some NULLs."""
    return spark.range(200_000).selectExpr(
        "concat('h', least(id % 3, 1)) as host", "timestamp_seconds(1704067200 + id % 172800) as ts",
        "if(id % 1000 = 0, null, concat('/', (id * 7919) % 60000)) as resource", "if(id % 3 = 0, null, concat('ua', id % 5)) as user_agent",
    )


@pytest.mark.parametrize("keys", [["host"], ["day"], []])
def test_estimates_are_within_four_deviations_of_the_exact_counts(log, keys):
    day = F.to_date("hour").alias("day")
    by = [day if k == "day" else k for k in keys]
    exact = log.withColumn("hour", F.date_trunc("hour", "ts")).groupBy(*by).agg(
        F.count("*").alias("requests"),
        *[(F.count_distinct(c) + F.max(F.col(c).isNull().cast("int"))).alias(f"{c}_distinct") for c in ("resource", "user_agent")],
    )
    found = {tuple(r[k] for k in keys): r for r in roll_up(hourly(log), by).collect()}
    rows = exact.collect()
    assert len(found) == len(rows) > 0
    for r in rows:
        ours = found[tuple(r[k] for k in keys)]
        assert ours.requests == r.requests and ours.user_agent_distinct == r.user_agent_distinct
        assert abs(ours.resource_distinct - r.resource_distinct) <= 4 * RELATIVE_ERROR * r.resource_distinct


def test_only_nulls_and_no_rows(log):
    row = roll_up(hourly(log.where("user_agent is null").limit(5)), []).first()
    assert row.user_agent_distinct == 1 and row.requests == 5
    assert roll_up(hourly(log.limit(0)), ["host"]).collect() == []


def test_a_sketch_is_bounded(log):
    assert hourly(log.withColumn("ts", F.lit("2024-01-01").cast("timestamp"))).agg(F.max(F.length("resource_sketch"))).first()[0] < 5000
