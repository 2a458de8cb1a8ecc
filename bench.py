"""Time the headline queries: best of five runs each, the full result collected as Arrow.

BENCH_SF_DIR names the folder of sample tables, BENCH_CPUS the number of local threads. Prints one
line of JSON.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402

from pyspark.sql import functions as F  # noqa: E402

from tillroll.operators import retrieval  # noqa: E402
from tillroll.plans.sample_queries import Sample, sample_queries  # noqa: E402

HEADLINES = (
    "fct_transactions",
    "mart_customer_performance",
    "top_products",
    "aov_by_region",
    "cancellation_hotspots",
    "order_totals",
    "kpi_summary",
    "revenue_by_region_top5",
    "revenue_by_month",
    "dim_date",
    "dq_report",
    "parse_enrichment",
    "pending_embeddings",
    "retrieve_topk",
    "bronze_load",
    "enrich_reviews_rules",
    "build_embeddings",
    "sql_guard",
)
RUNS = 5
QUESTIONS = 100_000


def retrieve_100k_questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As many questions as QUESTIONS, made of the stored vectors by moving one of their numbers."""
    s = Sample(spark, sf_dir)
    copies = -(-QUESTIONS // s.index.count())
    turned = F.transform("embedding", lambda x, i: x + F.when(i == F.col("copy") % F.size("embedding"), 0.1).otherwise(0.0))
    asked = s.index.select("review_id", "embedding", F.explode(F.sequence(F.lit(1), F.lit(copies))).alias("copy"))
    questions = asked.select(F.xxhash64("review_id", "copy").alias("question_id"), turned.cast("array<float>").alias("question"))
    return retrieval.retrieve(questions, s.index, s.stg("reviews")).select("question_id", "rank", "review_id", "score")


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", os.cpu_count() or 8))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("tillroll-bench")
        .config("spark.sql.shuffle.partitions", str(2 * cpus))
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="tillroll-bench-"))
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = sample_queries()
    queries["retrieve_100k_questions"] = retrieve_100k_questions
    seconds: dict[str, float] = {}
    for name in (*HEADLINES, "retrieve_100k_questions"):
        times = []
        for _ in range(RUNS if name in HEADLINES else 1):
            start = time.perf_counter()
            queries[name](spark, sf_dir).toArrow()
            times.append(time.perf_counter() - start)
        seconds[name] = round(min(times), 3)
    spark.stop()
    result = {
        "metric": "headline_queries_total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": Path(sf_dir).name.removeprefix("sf"),
        "cpus": cpus,
        "runs": RUNS,
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
