"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Every query is run BENCH_RUNS times (3 unless set) and its median is reported; the very first run, which
pays for the JVM and code generation, is listed apart. BENCH_REPLICAS > 1 repeats the events table under
other hosts, to reach the row count of the published baseline.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from pyspark.sql import DataFrame, functions as F

from hostpulse import adapters
from hostpulse.config import FEATURES, WINDOW_SECONDS
from hostpulse.operators.cleaning import clean
from hostpulse.operators.scaling import moments, standardise
from hostpulse.operators.forest import add_scores, fit_forest
from hostpulse.operators.windows import build_features
from hostpulse.plans import eda, report
from hostpulse.plans.scoring import KEYS, Z, fit_and_score
from hostpulse.session import build_session, materialise

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))
REPLICAS = int(os.environ.get("BENCH_REPLICAS", "1"))


def consume(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    spark = build_session("bench", f"local[{CPUS}]", **{
        "spark.sql.shuffle.partitions": CPUS, "spark.driver.memory": "16g", "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    })
    spark.sparkContext.setLogLevel("ERROR")
    raw = adapters.raw_log(spark, SF_DIR)
    if REPLICAS > 1:
        copy = F.explode(F.sequence(F.lit(1), F.lit(REPLICAS)))
        raw = raw.withColumn("_copy", copy).withColumn(
            "host", F.when(F.col("host") == "", "").otherwise(F.concat(F.trim("host"), F.lit("."), "_copy"))
        ).drop("_copy")
    raw = materialise(raw, "bench-raw")
    cleaned = materialise(clean(raw, adapters.ROW_ORDER), "bench-clean")
    features = materialise(build_features(cleaned, WINDOW_SECONDS), "bench-features")
    scored = materialise(fit_and_score(features, run_sensitivity=False).scored, "bench-scored")

    def forest() -> None:
        model = moments(features, FEATURES).first()
        z = standardise(features, FEATURES, model)
        consume(add_scores(z, fit_forest(z, Z, KEYS, model["n"]), Z))

    def end_to_end() -> None:
        table = materialise(clean(raw, adapters.ROW_ORDER), "bench-clean")
        windows = materialise(build_features(table, WINDOW_SECONDS), "bench-features")
        consume(fit_and_score(windows, run_sensitivity=False).scored)

    work = {
        "clean": lambda: consume(clean(raw, adapters.ROW_ORDER)),
        "features_60s": lambda: consume(build_features(cleaned, 60)),
        "features_1d": lambda: consume(build_features(cleaned, 86_400)),
        "eda_overview": lambda: consume(eda.overview(cleaned)),
        "eda_top_hosts": lambda: consume(eda.top_hosts(cleaned)),
        "eda_top_user_agents": lambda: consume(eda.top_user_agents(cleaned)),
        "eda_hourly_load": lambda: consume(eda.hourly_load(cleaned)),
        "isolation_forest": forest,
        "fit_and_score": lambda: consume(fit_and_score(features, run_sensitivity=False).scored),
        "sensitivity": lambda: fit_and_score(features).sensitivity,
        "report_top_hosts": lambda: consume(report.top_hosts(scored)),
        "anomaly_report": lambda: consume(report.anomaly_report(scored)),
        "end_to_end": end_to_end,
    }
    seconds, first = {}, {}
    for name, run in work.items():
        times = []
        for _ in range(RUNS):
            start = time.perf_counter()
            run()
            times.append(time.perf_counter() - start)
        seconds[name], first[name] = round(statistics.median(times), 3), round(times[0], 3)
    print(json.dumps({
        "metric": "access-log cleaning, features and anomaly scoring, end to end", "value": seconds["end_to_end"],
        "unit": "sec", "queries": seconds, "first_run": first, "sf": os.path.basename(SF_DIR.rstrip("/")),
        "log_rows": raw.count(), "windows": features.count(), "cpus": int(CPUS), "runs": RUNS,
    }))


if __name__ == "__main__":
    main()
