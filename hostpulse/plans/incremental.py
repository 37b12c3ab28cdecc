"""Runs that read new files only: cleaned rows and window features, kept per day and committed as a whole.

The state folder holds the cleaned rows of each day in parts, a Bloom filter of each part's keys, each day's features, the list of
files read, and numbered manifests that name what belongs together. A run writes beside what is there and then puts its manifest in
place by one rename, so a reader or a run that starts after a failure sees the last complete state; folders that no manifest names
are left for the cluster's retention.

A new row whose key no filter knows is appended without looking at older rows. The others are compared with the older rows of their
day. The copy that comes first by file name stays, as in a full run; if that is the new one, its day is written anew.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from hostpulse.config import DEDUP_KEYS, WINDOW_SECONDS
from hostpulse.operators.cleaning import drop_invalid, keep_first, type_columns
from hostpulse.operators.known_keys import KEYS_PER_BUCKET, bucket_bits, filters, possibly_known
from hostpulse.operators.windows import build_features
from hostpulse.session import materialise
from hostpulse.sources.csv_logs import FILE_ORDER, parse_lines, scan_folder
from hostpulse.sources.tables import read_table, write_table

DAY_SECONDS = 86_400
#: Parts of a day after which its next change writes it anew as one part.
MOST_PARTS = 8
#: Possibly known keys up to which they are broadcast to the new rows.
BROADCAST_KEYS = 200_000


@dataclass
class State:
    """What a manifest names. `days`: per day its parts, as path and bucket bits of its keys, and its features."""

    version: int = 0
    window_seconds: int = WINDOW_SECONDS
    files: list[str] = field(default_factory=list)
    filters: list[str] = field(default_factory=list)
    days: dict[str, dict] = field(default_factory=dict)


def _manifests(spark: SparkSession, folder: str):
    jvm = spark._jvm.org.apache.hadoop.fs
    path = jvm.Path(f"{folder}/manifests")
    return jvm, path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def load_state(spark: SparkSession, folder: str) -> State:
    """The last committed state; an empty one for a new folder."""
    _, path, system = _manifests(spark, folder)
    if not system.exists(path):
        return State()
    names = sorted(s.getPath().getName() for s in system.listStatus(path) if s.getPath().getName().endswith(".json"))
    if not names:
        return State()
    text = "".join(r.value for r in spark.read.option("wholetext", True).text(f"{folder}/manifests/{names[-1]}").collect())
    return State(**json.loads(text))


def _commit(spark: SparkSession, folder: str, state: State) -> None:
    jvm, path, system = _manifests(spark, folder)
    system.mkdirs(path)
    draft = jvm.Path(path, f".{uuid.uuid4().hex}.draft")
    out = system.create(draft)
    out.write(bytearray(json.dumps(vars(state)).encode()))
    out.close()
    # A rename that fails if the name is taken: of two runs from the same state one commits.
    options = spark._sc._gateway.new_array(jvm.Options.Rename, 1)
    options[0] = jvm.Options.Rename.NONE
    context = jvm.FileContext.getFileContext(system.getUri(), spark._jsc.hadoopConfiguration())
    context.rename(system.makeQualified(draft), system.makeQualified(jvm.Path(path, f"{state.version:08d}.json")), options)


def _new_files(spark: SparkSession, raw_folder: str, state: State) -> list[str] | str | None:
    """What is to be read: the folder in a first run, later the paths of new files (those only pass through the driver)."""
    if not state.files:
        return raw_folder
    listed = spark.read.format("binaryFile").option("pathGlobFilter", "*.csv").load(raw_folder)
    listed = listed.where("length > 0").select(F.col("_metadata.file_path").alias("path"), "length")
    known = read_table(spark, state.files[0]) if len(state.files) == 1 else spark.read.parquet(*state.files)
    both = listed.join(known.select("path", F.col("length").alias("known")), "path", "left")
    found = both.where("known is null or known <> length").collect()
    changed = sorted(r["path"] for r in found if r["known"] is not None)
    if changed:
        raise ValueError(f"{len(changed)} files changed after they were read, as {changed[0]}; start a new state folder")
    return [r["path"] for r in found] or None


def _same_key(a: str, b: str) -> Column:
    same = F.col(f"{a}._key") == F.col(f"{b}._key")
    for c in DEDUP_KEYS:
        same &= F.col(f"{a}.{c}").eqNullSafe(F.col(f"{b}.{c}"))
    return same


def _order(side: str) -> Column:
    return F.struct(*[F.col(f"{side}.{c}") for c in FILE_ORDER])


def _day() -> Column:
    return F.date_format("ts", "yyyy-MM-dd")


def _rows(spark: SparkSession, days: dict[str, dict], like: DataFrame) -> DataFrame:
    """All rows of the given days."""
    paths = [p["path"] for d in days.values() for p in d["parts"]]
    if not paths:
        return like.limit(0)
    return spark.read.schema(like.drop("_day").schema).parquet(*paths).withColumn("_day", _day()).select(*like.columns)


def _compared(spark: SparkSession, new: DataFrame, counts: dict[str, int], state: State) -> DataFrame:
    """New rows to insert, with `_replaces`: whether an older copy has to go."""
    old = {d: state.days[d] for d in counts if d in state.days}
    if not old:
        return new.withColumn("_replaces", F.lit(False))
    # Every key that is asked carries its part, so parts go by number instead of by path.
    named = [(d, p["path"], p["bits"]) for d, of in old.items() for p in of["parts"]]
    parts = spark.createDataFrame(
        [(d, str(i), bits, 1 + counts[d] // (KEYS_PER_BUCKET << bits)) for i, (d, _, bits) in enumerate(named)],
        "_day string, part string, bits int, split int",
    )
    paths = spark.createDataFrame([(path, str(i)) for i, (_, path, _) in enumerate(named)], "path string, part string")
    asked = new.join(F.broadcast(parts), "_day").select("part", "bits", "split", F.col("_key").alias("key"))
    made = spark.read.parquet(*state.filters).withColumnRenamed("part", "path")
    made = made.join(F.broadcast(paths), "path").select("part", "bucket", "bits")
    known = materialise(possibly_known(asked, made).select(F.col("key").alias("_key")), "possibly-known")
    # By a counted number of keys, as files of keys and rows are small for what they hold.
    known = F.broadcast(known) if known.count() <= BROADCAST_KEYS else known.hint("merge")
    maybe = new.join(known, "_key", "left_semi").select(new.columns)
    fresh = new.join(known, "_key", "left_anti").select(new.columns)
    # The older rows of the touched days meet the few rows that may be copies, by hash and then by key.
    twins = maybe.alias("n").join(_rows(spark, old, new).hint("merge").alias("o"), _same_key("n", "o"), "left")
    kept = twins.where(F.col("o._key").isNull() | (_order("n") < _order("o")))
    return fresh.withColumn("_replaces", F.lit(False)).unionByName(
        kept.select("n.*", F.col("o._key").isNotNull().alias("_replaces"))
    )


def update(spark: SparkSession, raw_folder: str, folder: str, window_seconds: int = WINDOW_SECONDS) -> State:
    """Read the files of `raw_folder` that are new and bring the state folder up to date. Nothing new: nothing is written.

    Files that left `raw_folder` keep their rows; a file that changed is an error. Windows must divide a day.
    """
    if DAY_SECONDS % window_seconds:
        raise ValueError(f"windows of {window_seconds} seconds do not divide a day")
    state = load_state(spark, folder)
    if state.version and state.window_seconds != window_seconds:
        raise ValueError(f"the state has windows of {state.window_seconds} seconds")
    source = _new_files(spark, raw_folder, state)
    if source is None:
        return state
    version = state.version + 1
    stem = f"v{version:08d}-{uuid.uuid4().hex}"
    lines, files = scan_folder(spark, source)
    files_path = f"{folder}/files/{stem}"
    write_table(files.select("path", "file", "length", "lines", "reason"), files_path)
    next_state = State(version, window_seconds, [*state.files, files_path], list(state.filters), dict(state.days))
    if not files.where("reason is null").isEmpty():
        # Written first: parsing lines and typing columns in one stage is more than generated code can hold.
        raw = materialise(parse_lines(lines, files), "new-lines")
        typed = keep_first(drop_invalid(type_columns(raw)), DEDUP_KEYS, FILE_ORDER)
        new = materialise(typed.withColumns({"_key": F.xxhash64(*DEDUP_KEYS), "_day": _day()}), "new-rows")
        counts = {r["_day"]: r["count"] for r in new.groupBy("_day").count().collect()}
        _merge(spark, folder, stem, new, counts, state, next_state)
    _commit(spark, folder, next_state)
    return next_state


def _merge(spark: SparkSession, folder: str, stem: str, new: DataFrame, counts: dict[str, int], state: State, result: State) -> None:
    """Write the parts, filters and features of the days that change, and enter them in `result`."""
    insert = materialise(_compared(spark, new, counts, state), "insert")
    changes = {r["_day"]: r["replaced"] for r in insert.groupBy("_day").agg(F.max("_replaces").alias("replaced")).collect()}
    if not changes:
        return
    anew = {d: state.days[d] for d, replaced in changes.items() if d in state.days and (replaced or len(state.days[d]["parts"]) >= MOST_PARTS)}
    gone = insert.where("_replaces")
    stay = _rows(spark, anew, new).alias("o").join(gone.alias("n"), _same_key("o", "n"), "left_anti")
    written = insert.drop("_replaces").unionByName(stay)
    # By ranges of day and time: a long day is cut into several files, and short ones do not give a file per task.
    written.repartitionByRange("_day", "ts").sortWithinPartitions("_day", "ts").write.partitionBy("_day").option("compression", "zstd").parquet(
        f"{folder}/clean/{stem}"
    )
    part = {d: f"{folder}/clean/{stem}/_day={d}" for d in changes}
    fields = new.drop("_day").schema
    made = spark.read.schema(fields).parquet(*part.values()).withColumn("_day", _day())
    rows = {r["_day"]: r["count"] for r in made.groupBy("_day").count().collect()}
    for d in changes:
        earlier = [] if d in anew or d not in state.days else state.days[d]["parts"]
        result.days[d] = {"parts": [*earlier, {"path": part[d], "bits": bucket_bits(rows[d])}], "features": f"{folder}/features/{stem}/_day={d}"}
    table = F.broadcast(spark.createDataFrame([(d, part[d], bucket_bits(rows[d])) for d in changes], "_day string, path string, wide int"))
    filters_path = f"{folder}/filters/{stem}"
    # Keys go to their filters by day; the path of a day's part is entered afterwards.
    keys = made.join(table.drop("path"), "_day").select(F.col("_day").alias("part"), F.col("wide").alias("bits"), F.col("_key").alias("key"))
    by_day = filters(keys).join(table, F.col("part") == F.col("_day"))
    write_table(by_day.select(F.col("path").alias("part"), "bucket", "bits"), filters_path)
    result.filters.append(filters_path)
    changed = _rows(spark, {d: result.days[d] for d in changes}, new)
    features = build_features(changed, result.window_seconds).withColumn("_day", F.date_format("window_start", "yyyy-MM-dd"))
    features.repartitionByRange("_day", "host").sortWithinPartitions("_day", "host", "window_start").write.partitionBy("_day").option(
        "compression", "zstd"
    ).parquet(f"{folder}/features/{stem}")


def cleaned(spark: SparkSession, folder: str) -> DataFrame:
    """Cleaned rows of the last committed state."""
    state = load_state(spark, folder)
    paths = [p["path"] for d in state.days.values() for p in d["parts"]]
    return spark.read.parquet(*paths).drop("_key", "_block_start", "_row_id")


def features(spark: SparkSession, folder: str) -> DataFrame:
    """Window features of the last committed state."""
    return spark.read.parquet(*[d["features"] for d in load_state(spark, folder).days.values()])
