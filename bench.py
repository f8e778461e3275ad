"""Wall time of the headline queries; prints one JSON line.

Reads ``$BENCH_SF_DIR`` (default sf0.1) on ``local[$BENCH_CPUS]``. Every query
runs to completion into a sink that keeps nothing.
"""

from __future__ import annotations

import json
import os
import time

from check import local_session
from doctag.plans.catalog import QUERIES
from pyspark.sql import functions as F

HEADLINE = (
    "clean_parity",
    "all_ngrams",
    "tokenized_documents",
    "term_frequency",
    "document_frequency",
    "top_vocabulary",
    "vocabulary",
    "rule_tags",
    "outcome_report",
    "sample_of_a_third",
    "training_set",
    "train_test_split",
    "stratified_folds",
    "inverse_document_frequency",
    "tfidf_weights",
    "bayes_predictions",
    "bayes_classifier",
)


def run(query, spark, sf_dir: str) -> float:
    start = time.perf_counter()
    query.run(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"))
    spark.sparkContext.setLogLevel("ERROR")
    # Start the workers and code paths before the clock.
    spark.read.parquet(f"{sf_dir}/documents.parquet").agg(F.sum(F.length("text"))).collect()
    times = {}
    for name in HEADLINE:
        times[name] = round(run(QUERIES[name], spark, sf_dir), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(
        json.dumps(
            {
                "metric": "doctag_headline_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
            }
        )
    )


if __name__ == "__main__":
    main()
