"""Exact top-k counts of a column with a shuffle bounded by summaries, whatever the number of distinct values.

Every task keeps a summary of at most `counters` values (Misra and Gries's, which counts like Space-Saving less its minimum): a count
in it falls short by no more than the task's error. Summaries merge by adding counts and errors, so the true count of a value lies in
[n, n + error], with n = 0 for values in no summary. The k-th largest n is a bound that every value of the top k reaches; the values
that can reach it are counted again, exactly. Where the error is not below that bound a value in no summary could belong to the
top k, and where too many values can reach it they are no small table: both cases count all values instead.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from hostpulse.session import materialise

#: Values a task's summary keeps; its error is at most its rows / (COUNTERS + 1).
COUNTERS = 10_000
#: Values that are counted again by a broadcast join; with more of them all values are counted.
MOST_CANDIDATES = 100_000


def _cut(counts: pa.Table, keep: int) -> tuple[pa.Table, int]:
    """The `keep` largest counts, all less the largest one that is left out; and that count."""
    if len(counts) <= keep:
        return counts, 0
    n = counts["n"].to_numpy()
    lost = int(np.partition(n, len(n) - keep - 1)[len(n) - keep - 1])
    stays = n > lost
    return pa.table({"value": counts["value"].filter(pa.array(stays)), "n": n[stays] - lost}), lost


def summaries(df: DataFrame, key: str, counters: int = COUNTERS) -> DataFrame:
    """(value, n, error) of every task; `error` stands in one row per task, whose n is 0. NULL is a value like any other."""
    schema = T.StructType([T.StructField("value", df.schema[key].dataType), T.StructField("n", T.LongType()), T.StructField("error", T.LongType())])

    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept, error = None, 0
        for batch in batches:
            new = pa.table({"value": batch.column(0)}).group_by("value").aggregate([([], "count_all")]).rename_columns(["value", "n"])
            both = new if kept is None else pa.concat_tables([kept, new]).group_by("value").aggregate([("n", "sum")]).rename_columns(["value", "n"])
            # Cut at twice the size, so that cutting costs little beside counting.
            kept, lost = _cut(both, counters) if len(both) > 2 * counters else (both, 0)
            error += lost
        if kept is not None:
            kept, lost = _cut(kept, counters)
            error += lost
            yield from kept.append_column("error", pa.array(np.zeros(len(kept), dtype=np.int64))).to_batches()
            yield pa.record_batch({"value": pa.nulls(1, kept["value"].type), "n": pa.array([0]), "error": pa.array([error])})

    return df.select(F.col(key).alias("value")).mapInArrow(summarise, schema)


def _counted(df: DataFrame, key: str, name: str) -> DataFrame:
    return df.groupBy(key).agg(F.count(F.lit(1)).alias(name))


def _first(counts: DataFrame, key: str, k: int, name: str) -> DataFrame:
    return counts.orderBy(F.desc(name), F.asc_nulls_last(key)).limit(k)


def top_k(
    df: DataFrame, key: str, k: int, name: str = "n", counters: int = COUNTERS, most_candidates: int = MOST_CANDIDATES,
) -> DataFrame:
    """The k most frequent values of `key` with their exact counts; ties by value, NULL last. An empty table gives no rows.

    `df` is read twice and should be a written table.
    """
    found = materialise(summaries(df, key, counters), "heavy")
    error = found.agg(F.coalesce(F.sum("error"), F.lit(0))).first()[0]
    counts = found.where("n > 0").groupBy("value").agg(F.sum("n").alias("n"))
    largest = [r["n"] for r in counts.orderBy(F.desc("n")).limit(k).select("n").collect()]
    if error == 0:
        return _first(counts.select(F.col("value").alias(key), F.col("n").alias(name)), key, k, name)
    bound = largest[-1] if len(largest) == k else 0
    if error < bound:
        candidates = counts.where(F.col("n") + error >= bound).select("value")
        if candidates.count() <= most_candidates:
            again = df.select(key).join(F.broadcast(candidates), F.col(key).eqNullSafe(F.col("value")), "left_semi")
            return _first(_counted(again, key, name), key, k, name)
    return _first(_counted(df, key, name), key, k, name)
