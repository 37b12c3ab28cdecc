"""The given `events` table rewritten as an access log, with every cleaning case planted."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from hostpulse.config import FEATURES, LOG_COLUMNS, RAW_HEADER
from hostpulse.operators.forest import Forest
from hostpulse.operators.labels import label_if, risk_score, union_label
from hostpulse.session import spread_small

ROW_ORDER = ["_source_file", "_row_id"]


def raw_log(spark: SparkSession, sf_dir: str, with_kind: bool = False) -> DataFrame:
    """All-string log rows: every event once (a.csv) and every purchase delivered again (b.csv).

    The second delivery differs in `bytes`, so de-duplication shows which copy it kept.
    """
    events = spread_small(spark.read.parquet(f"{sf_dir}/events.parquet"))
    event_id, user, kind = F.col("event_id"), F.col("user_id"), F.col("event_type")
    plain_host = F.concat(F.lit("10.0.0."), user)
    first = events.select(
        F.when(event_id % 211 == 0, "").when(user % 7 == 0, F.concat(F.lit(" "), plain_host, F.lit(" ")))
        .otherwise(plain_host).alias("host"),
        F.when(event_id % 101 == 0, "32/Foo/2024 00:00:00")
        .otherwise(F.date_format("ts", "dd/MMM/yyyy HH:mm:ss")).alias("datetime"),
        F.when(kind == "signup", "post").otherwise(" get").alias("method"),
        F.when(user == 3, "/index")
        .otherwise(F.concat(F.lit("/"), kind, F.lit("/"), F.get_json_object("props", "$.k"))).alias("resource"),
        F.lit("HTTP/1.1").alias("protocol"),
        F.when(event_id % 307 == 0, "999")
        .when(kind == "error", F.when(user % 5 == 0, "404").when(user % 2 == 0, "500").otherwise("403"))
        .otherwise("200").alias("status"),
        F.when(event_id % 10 == 0, "-").when(event_id % 53 == 0, "")
        .otherwise(F.floor(F.col("value") * 100).cast("string")).alias("bytes"),
        F.lit(None).cast("string").alias("referrer"),
        F.when(user % 20 == 1, "Googlebot/2.1").when(event_id % 97 == 0, None)
        .when(event_id % 2 == 0, "Mozilla/5.0 (X11)").otherwise("Mozilla/5.0 (Mac)").alias("user_agent"),
        F.lit("a.csv").alias("_source_file"),
        event_id.alias("_row_id"),
        kind.alias("_kind"),
    )
    again = first.filter(F.col("_kind") == "purchase").withColumns(
        {"bytes": F.lit("7"), "_source_file": F.lit("b.csv")}
    )
    both = first.unionByName(again)
    return both if with_kind else both.drop("_kind")


# File name, which rows, separator, written encoding, mark before the header, referrer. Referrers of single-byte files are the bytes
# of text in their code page written one byte per character: windows-1250, a byte no code page knows, cp1252.
DIALECTS = [
    ("click", "_kind = 'click'", "\t", "UTF-8", "", None),
    ("view", "_kind = 'view'", "\t", "UTF-8", "\ufeff", None),
    ("purchase", "_kind = 'purchase'", ";", "UTF-8", "", 'first line\n"second"; line'),
    ("error", "_kind = 'error'", ",", "ISO-8859-1", "", "żółw".encode("cp1250").decode("latin-1")),
    ("signup", "_kind = 'signup' and _row_id % 2 = 0", "|", "ISO-8859-1", "", "é\x81"),
    ("western", "_kind = 'signup' and _row_id % 2 = 1", "|", "ISO-8859-1", "", "“naïve” – œuvre".encode("cp1252").decode("latin-1")),
]


def _take(spark: SparkSession, parts: str, folder: str, name: str) -> None:
    """Move the written part files to `folder` as <name>-<number>.csv."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    source = path(f"{parts}/part-*")
    files = source.getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(path(folder))
    for i, part in enumerate(files.globStatus(source)):
        files.rename(part.getPath(), path(f"{folder}/{name}-{i:05d}.csv"))


def write_delivery(spark: SparkSession, sf_dir: str, delivery: str, folder: str) -> str:
    """One delivery ("a" or "b") of the raw log as CSV files, cut and named in the order of its rows."""
    rows = raw_log(spark, sf_dir).where(F.col("_source_file") == f"{delivery}.csv").orderBy("_row_id")
    parts = f"{folder}-parts"
    rows.select(*[F.col(c).alias(h) for c, h in zip(LOG_COLUMNS, RAW_HEADER)]).write.option("header", True).option("escape", '"').option(
        "emptyValue", ""
    ).option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(parts)
    _take(spark, parts, folder, delivery)
    return folder


def write_mixed_csv(spark: SparkSession, sf_dir: str, folder: str) -> str:
    """The raw log as CSV files of four separators and five encodings in one folder, some with quoted line breaks."""
    raw = raw_log(spark, sf_dir, with_kind=True)

    def write(rows: DataFrame, name: str, separator: str, encoding: str, empty: str = "") -> None:
        parts = f"{folder}-parts/{name}"
        (
            rows.write.option("header", True).option("sep", separator).option("encoding", encoding).option("escape", '"')
            .option("emptyValue", empty).option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
            .csv(parts)
        )
        _take(spark, parts, folder, name)

    for name, wanted, separator, encoding, mark, referrer in DIALECTS:
        rows = raw.where(wanted).withColumn("referrer", F.lit(referrer).cast("string"))
        header = [mark + RAW_HEADER[0], *RAW_HEADER[1:]]
        write(rows.select(*[F.col(c).alias(h) for c, h in zip(LOG_COLUMNS, header)]), name, separator, encoding)
    # Files without a usable header: a single column.
    write(raw.where("_kind = 'click'").select("host"), "narrow", ",", "UTF-8", '""')
    return folder


def stand_in_scores(features: DataFrame) -> DataFrame:
    """Deterministic scores and labels, so that everything after the models has an exact SQL twin."""
    req, score = F.col("req_count"), F.col("anomaly_score_if")
    odd = (
        (F.col("total_bytes") > 60000)
        | ((req >= 4) & (F.col("error_5xx_rate") >= 0.5))
        | ((req >= 4) & (F.col("unique_urls") == 1))
        | ((F.col("bot_ua_rate") > 0) & (req >= 5))
    )
    raw_score = F.lit(0.3) + 0.02 * req + 0.3 * F.col("error_4xx_rate") + 0.05 * F.col("unique_ua")
    return (
        features.withColumn("anomaly_score_if", -F.least(F.lit(1.0), raw_score))
        .withColumns({"label_if": label_if(score < -0.6), "label_secondary": label_if(odd), "risk_score_100": risk_score()})
        .withColumn("label_combined", union_label())
    )


#: Weights of an SVM that is not fitted, so that its labels have an exact SQL twin.
SVM_WEIGHTS = {f"z_{c}": -(1.0 + i) / 8 for i, c in enumerate(sorted(FEATURES))}


#: Offset of that SVM where it is stored as a model, cut-off of the given forest, and rule limits.
SVM_OFFSET, FOREST_CUT = -4.0, -0.5
LIMITS = {"bot_ua_rate": 0.4, "error_4xx_rate": 0.45, "req_count_ddos": 4.0, "unique_urls_scraper": 5.0, "req_count_highvol": 2.0}
#: Three trees that are not grown, as (tree, node, feature, threshold, rows); nodes are numbered as in a heap, leaves have no feature.
FOREST = [
    (0, 0, "z_req_count", 0.5, 256), (0, 1, None, None, 200), (0, 2, "z_total_bytes", 1.0, 56), (0, 5, None, None, 50), (0, 6, None, None, 6),
    (1, 0, "z_error_4xx_rate", 0.25, 256), (1, 1, "z_avg_bytes", -0.5, 220), (1, 2, None, None, 36), (1, 3, None, None, 100),
    (1, 4, None, None, 120), (2, 0, "z_unique_urls", 1.5, 256), (2, 1, None, None, 255), (2, 2, None, None, 1),
]


def given_forest() -> Forest:
    names = [f"z_{c}" for c in FEATURES]
    rows = [
        (tree, node, -1 if column is None else names.index(column), threshold, -1 if column is None else 2 * node + 1,
         -1 if column is None else 2 * node + 2, (node + 1).bit_length() - 1, n)
        for tree, node, column, threshold, n in FOREST
    ]
    nodes = pd.DataFrame(rows, columns=["tree", "node", "feature", "threshold", "left", "right", "depth", "n"])
    return Forest(nodes.astype({"threshold": float}), 256, 3, 0)
