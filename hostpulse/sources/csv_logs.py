"""Folders of delimited log files with unknown separator and encoding -> one all-string table.

The raw files are scanned once. The scan writes every line with the few numbers that decide its file's dialect (bytes, quotes,
kind of text, separator), so that the next step reads numbers only. One row per file then holds its dialect and whether it was
read whole; rows are parsed by joining the lines with that table. No list of files is gathered in a task or on the driver.

Records that hold quoted line breaks are put together by parity: a line begins inside quotes if the number of quotes before it in
its file is odd. Each run of lines sums its own quotes, runs take the parity of those before them from the sums, and put their records
together on their own. Only what a border cuts is gathered, by the line on which its record starts, wherever the splits were cut.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from hostpulse.config import LOG_COLUMNS, SEPARATORS
from hostpulse.functions.text import strip
from hostpulse.session import materialise
from hostpulse.sources.encodings import SINGLE_BYTE, decode_single_byte, likelihood, most_likely, upper_bytes

# Defines "first" among copies: file name, then position in the file. A bare row id is not enough,
# because Spark packs file splits into partitions by size.
FILE_ORDER = ["_source_file", "_block_start", "_row_id"]
_SCHEMA = ", ".join(f"{c} string" for c in LOG_COLUMNS)
#: Files up to which the table of dialects is broadcast to the lines (about 100 bytes a file).
BROADCAST_FILES = 500_000
#: Lines of a run, as a power of two: the row numbers of a split are cut into stretches of so many.
RUN_BITS = 15
ASCII, UTF8, OTHER = 0, 1, 2
BOM_BYTES = 3


def _separator_code(line: Column, width: int) -> Column:
    """Index of the first separator that splits the line into `width` fields, or the count of separators."""
    code = F.lit(len(SEPARATORS))
    for i, separator in reversed(list(enumerate(SEPARATORS))):
        cuts = F.octet_length(line) - F.octet_length(F.replace(line, F.lit(separator), F.lit("")))
        code = F.when(cuts == width - 1, i).otherwise(code)
    return code


def scan_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Every line of the folder's *.csv files as bytes, with its place and what it tells about its file. Written, so one scan.

    A file that breaks while it is read gives the lines up to there; `scan_files` finds it by its missing bytes.
    """
    line = F.col("value")
    kind = (
        F.when(~F.is_valid_utf8(line), OTHER).when(F.octet_length(line) == F.length(line), ASCII).otherwise(UTF8).cast("byte")
    )
    raw = (
        spark.read.option("pathGlobFilter", "*.csv").option("lineSep", "\n")
        .option("ignoreCorruptFiles", True).option("ignoreMissingFiles", True).text(folder)
    )
    lines = raw.select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
        line.cast("binary").alias("value"),
        F.octet_length(line).alias("bytes"),
        kind.alias("kind"),
        ((F.octet_length(line) - F.octet_length(F.replace(line, F.lit('"'), F.lit("")))) % 2).cast("byte").alias("odd"),
        F.when(strip(line) != "", _separator_code(line, len(LOG_COLUMNS))).cast("byte").alias("code"),
    )
    return materialise(lines, "lines")


def _listing(spark: SparkSession, folder: str) -> DataFrame:
    """Path, name and length of every *.csv file; contents are not opened."""
    listed = spark.read.format("binaryFile").option("pathGlobFilter", "*.csv").load(folder)
    return listed.select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_name").alias("file"), F.col("length")
    )


def _splits(lines: DataFrame) -> DataFrame:
    """Numbers of each file split; hashed, never sorted."""
    base = len(SEPARATORS) + 1
    return lines.groupBy("path", "block").agg(
        F.min(F.when(F.col("code").isNotNull(), F.col("row") * base + F.col("code"))).alias("head"),
        F.count(F.lit(1)).alias("lines"), F.sum("bytes").alias("bytes"), F.sum("odd").alias("odds"),
        F.max("kind").alias("kind"),
    )


def _encodings(lines: DataFrame, files: DataFrame) -> DataFrame:
    """(path, encoding) of the files that are not UTF-8, by the likelihood of their upper bytes."""
    wanted = files.where(F.col("kind") == OTHER).select("path")
    counts = (
        lines.where(F.col("kind") != ASCII).join(wanted, "path", "left_semi")
        .select("path", F.explode(upper_bytes(F.col("value"))).alias("byte")).groupBy("path", "byte").agg(F.count(F.lit(1)).alias("n"))
    )
    totals = counts.groupBy("path").agg(*[F.sum(F.col("n") * likelihood(F.col("byte"), e)).alias(e) for e in SINGLE_BYTE])
    return totals.select("path", most_likely({e: F.col(f"`{e}`") for e in SINGLE_BYTE}).alias("likely"))


def scan_files(spark: SparkSession, folder: str, lines: DataFrame | None = None) -> DataFrame:
    """One row per file: path, file, length, lines, code (of the separator), encoding, multi_line, where its header is, reason.

    `reason` says why a file is left out, NULL if it is read. The first non-blank line decides the separator, all lines decide the
    encoding. A file of which fewer bytes came than it has was not read whole and is left out; only a byte order mark, which the
    reader takes off, may be missing.
    """
    lines = scan_lines(spark, folder) if lines is None else lines
    base = len(SEPARATORS) + 1
    at = F.when(F.col("head").isNotNull(), F.col("block"))
    files = _splits(lines).groupBy("path").agg(
        F.min_by("head", at).alias("head"), F.min(at).alias("head_block"), F.sum("lines").alias("lines"), F.sum("bytes").alias("bytes"),
        F.sum("odds").alias("odds"), F.max("kind").alias("kind"),
    )
    files = _listing(spark, folder).join(files, "path", "left")
    files = materialise(files.where("length > 0"), "file-scan")
    # The last line may end without a line break: one byte fewer than counted.
    missing = F.col("length") - F.coalesce(F.col("bytes") + F.col("lines"), F.lit(0))
    mark = missing.isin(BOM_BYTES, BOM_BYTES - 1)
    whole = missing.isin(0, -1) | mark
    code = F.coalesce((F.col("head") % base).cast("int"), F.lit(len(SEPARATORS)))
    reason = (
        F.when(~whole, F.concat(F.lit("broke off after "), F.coalesce("bytes", F.lit(0)), F.lit(" of "), F.col("length"), F.lit(" bytes")))
        .when(code >= len(SEPARATORS), f"no header of {len(LOG_COLUMNS)} fields")
    )
    encoding = F.when(F.col("kind") == OTHER, F.col("likely")).when(mark, "utf-8-sig").otherwise("utf-8")
    found = files.join(_encodings(lines, files), "path", "left").select(
        "path", "file", "length", F.coalesce("lines", F.lit(0)).alias("lines"), code.alias("code"), encoding.alias("encoding"),
        ((F.col("odds") > 0) & (F.col("odds") % 2 == 0)).alias("multi_line"),
        "head_block", F.floor(F.col("head") / base).alias("head_row"), reason.alias("reason"),
    )
    return materialise(found, "files")


def detect_dialects(spark: SparkSession, folder: str) -> DataFrame:
    """One row per file that is read: path, file, lines, separator, encoding, multi_line."""
    return scan_files(spark, folder).where("reason is null").select(
        "path", "file", "lines", F.array(*map(F.lit, SEPARATORS))[F.col("code")].alias("separator"), "encoding", "multi_line"
    )


def rejected(files: DataFrame) -> DataFrame:
    """One row per scanned file that is left out: path, file, lines, reason. Files without a byte hold no rows and are not listed."""
    return files.where("reason is not null").select("path", "file", "lines", "reason")


def rejected_files(spark: SparkSession, folder: str) -> DataFrame:
    return rejected(scan_files(spark, folder))


def _text() -> Column:
    text = F.when(F.col("encoding").isin(*SINGLE_BYTE), decode_single_byte(F.col("value"), F.col("encoding")))
    return text.otherwise(F.col("value").cast("string"))


_RECORD = ["file", "code", "block", "row", "text"]


def _runs(lines: DataFrame, files: DataFrame) -> DataFrame:
    """Runs of neighbouring lines of one split, with their file's columns and whether they begin inside quotes.

    Row numbers rise through a split, so a run is a stretch of them. `run` is its first row, which no other run has.
    """
    runs = lines.join(files.select("path"), "path", "left_semi").groupBy("path", "block", "stretch").agg(
        F.min("row").alias("run"), F.sum("odd").alias("odds")
    )
    earlier = Window.partitionBy("path").orderBy("block", "run").rowsBetween(Window.unboundedPreceding, -1)
    inside = (F.coalesce(F.sum("odds").over(earlier), F.lit(0)) % 2 == 1).alias("inside")
    return materialise(runs.select("path", "block", "stretch", "run", inside).join(files, "path"), "quoted-runs")


def _pieces_of_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records of lines in the order of their rows, each run's lines together: (run, row, start, part, value).

    What a batch or a run cuts comes out in parts, so nothing is held from one batch to the next but the start of the open record.
    A part that begins inside quotes with its run does not know its start.
    """
    run, inside, start = None, False, None
    for batch in batches:
        runs, rows, odd, filled, begins = (
            batch.column(c).to_numpy(zero_copy_only=False) for c in ("run", "row", "odd", "filled", "inside")
        )
        borders = [0, *(np.flatnonzero(np.diff(runs)) + 1).tolist(), len(runs)]
        for first, end in itertools.pairwise(borders):
            if first == end:
                continue
            if runs[first] != run:
                run, inside, start = runs[first], bool(begins[first]), None
            odds = odd[first:end].astype(np.int64)
            quoted = (inside + np.cumsum(odds) - odds) % 2 == 1
            kept = np.flatnonzero(filled[first:end] | quoted | (odds == 1))
            inside = bool((inside + odds.sum()) % 2)
            if not len(kept):
                continue
            row, opens = rows[first:end][kept], ~quoted[kept]
            heads = np.flatnonzero(opens | (np.arange(len(kept)) == 0))
            starts = pa.array(row[heads], pa.int64())
            part = np.zeros(len(heads), dtype=bool)
            if not opens[0]:
                part[0] = True
                starts = pa.concat_arrays([pa.array([start], pa.int64()), starts[1:]])
            part[-1] |= inside
            start = starts[-1].as_py()
            values = batch.column("value").slice(first, end - first).take(pa.array(kept))
            lists = pa.ListArray.from_arrays(pa.array([*heads.tolist(), len(kept)], pa.int32()), values)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(heads), run), pa.int64()), pa.array(row[heads], pa.int64()), starts, pa.array(part),
                 pc.binary_join(lists, pa.scalar(b"\n", values.type))],
                names=["run", "row", "start", "part", "value"],
            )


def _stitched(lines: DataFrame, files: DataFrame) -> DataFrame:
    """Records of files with quoted line breaks, put together over line, batch and split borders.

    Lines are dealt out by runs of bounded length and put in order by their row number alone; a run's own records need no further
    shuffle. Only records that a border cuts, at most one at each, are gathered by the line on which they start.
    """
    lines = lines.withColumn("stretch", F.shiftright("row", RUN_BITS))
    runs = _runs(lines, files)
    few = runs.count() <= BROADCAST_FILES

    def of(rows: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
        some = runs.select(*keys, *[c for c in columns if c not in keys])
        return rows.join(F.broadcast(some) if few else some, keys)

    placed = of(lines, ["path", "block", "stretch"], ["run", "inside"]).select(
        "run", "row", "odd", F.col("own_code").isNotNull().alias("filled"), "inside", "value"
    )
    pieces = placed.repartition("run").sortWithinPartitions("row").mapInArrow(
        _pieces_of_runs, "run long, row long, start long, part boolean, value binary"
    )
    pieces = materialise(pieces, "quoted-records")
    whole = of(pieces.where("not part"), ["run"], ["file", "code", "encoding", "block", "head_block", "head_row"])
    parts = of(pieces.where("part"), ["run"], ["path", "file", "code", "encoding", "block", "head_block", "head_row"])
    # A part without a start belongs to the last record that an earlier part of its file starts.
    so_far = Window.partitionBy("path").orderBy("block", "row").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    own = F.when(F.col("start").isNotNull(), F.struct("block", "start"))
    owners = parts.select("path", "block", "row", "start").select("row", F.last(own, ignorenulls=True).over(so_far).alias("owner"))
    joined = parts.drop("start").withColumn("text", _text()).join(owners, "row").groupBy("path", "owner").agg(
        F.any_value("file").alias("file"), F.any_value("code").alias("code"), F.any_value("head_block").alias("head_block"),
        F.any_value("head_row").alias("head_row"), F.array_sort(F.collect_list(F.struct("block", "row", "text"))).alias("parts"),
    ).select(
        "file", "code", "head_block", "head_row", F.col("owner.block").alias("block"), F.col("owner.start").alias("row"),
        F.array_join(F.transform("parts", lambda p: p["text"]), "\n").alias("text"),
    )
    columns = [*_RECORD, "head_block", "head_row"]
    return whole.withColumn("text", _text()).select(columns).unionByName(joined.select(columns))


def _parsed(records: DataFrame) -> DataFrame:
    """Fields of each record by its file's separator; short records are filled with NULL, long ones cut.

    A record without a quote that has all its fields is only cut at its separators; the others go through the CSV parser.
    """
    # Without multiLine, line ends inside quotes would be rewritten. The carriage return of a record's end is not part of it.
    options = {"mode": "PERMISSIVE", "quote": '"', "escape": '"', "multiLine": "true"}
    record, cuts = F.col("record"), F.col("cuts")

    def by_separator(made: Callable[[str], Column]) -> Column:
        return reduce(lambda rest, i: F.when(F.col("code") == i, made(SEPARATORS[i])).otherwise(rest), range(len(SEPARATORS)), F.lit(None))

    plain = ~(F.contains(record, F.lit('"')) | F.contains(record, F.lit("\r")) | F.startswith(record, F.lit("\0")))
    as_cut = F.struct(*[F.nullif(cuts[i], F.lit("")).alias(c) for i, c in enumerate(LOG_COLUMNS)])
    read = by_separator(lambda s: F.from_csv(record, _SCHEMA, {**options, "sep": s}))
    # Trimming walks the whole text, so only those that end so are trimmed.
    ended = F.when(F.endswith("text", F.lit("\r")), F.rtrim("text", F.lit("\r"))).otherwise(F.col("text"))
    cut = records.withColumn("record", ended).withColumn("cuts", F.when(plain, by_separator(lambda s: F.split(record, re.escape(s)))))
    return cut.withColumn("fields", F.when(F.size(cuts) == len(LOG_COLUMNS), as_cut).otherwise(read)).select(
        *[F.col(f"fields.{c}").alias(c) for c in LOG_COLUMNS],
        F.col("file").alias("_source_file"), F.col("block").alias("_block_start"), F.col("row").alias("_row_id"),
    )


def read_log_folder(spark: SparkSession, folder: str) -> DataFrame:
    """Raw table: the nine log columns as strings, the source file, and the position in it.

    Files that have no header of nine fields, or that break while they are read, are left out whole; `rejected_files` lists them.
    """
    return parse_lines(*scan_folder(spark, folder), folder)


def scan_folder(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """The scanned lines of a folder and its files with their dialects: all that is ever read of the raw files."""
    if _listing(spark, folder).isEmpty():
        raise FileNotFoundError(f"no *.csv file in {folder}")
    lines = scan_lines(spark, folder)
    return lines, scan_files(spark, folder, lines)


def parse_lines(lines: DataFrame, files: DataFrame, folder: str = "the folder") -> DataFrame:
    """Rows of the scanned lines by the dialects of their files."""
    used = files.where("reason is null").select("path", "file", "code", "encoding", "multi_line", "head_block", "head_row")
    n = used.count()
    if not n:
        raise RuntimeError(f"no file in {folder} has a usable header")

    def of(some: DataFrame, rows: DataFrame) -> DataFrame:
        return rows.join(F.broadcast(some) if n <= BROADCAST_FILES else some, "path")

    lines = lines.select("path", "block", "row", "value", "odd", F.col("code").alias("own_code"))
    calm = of(used.where("not multi_line"), lines).where("own_code is not null").withColumn("text", _text())
    columns = [*_RECORD, "head_block", "head_row"]
    records = calm.select(columns)
    if not used.where("multi_line").isEmpty():
        records = records.unionByName(_stitched(lines, used.where("multi_line")))
    header = (F.col("block") == F.col("head_block")) & (F.col("row") == F.col("head_row"))
    return _parsed(records.where(~header).select(*_RECORD))
