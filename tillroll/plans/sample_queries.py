"""Every operator as a query over the sample star schema: name -> (spark, folder) -> DataFrame."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll import schemas
from tillroll.functions.numbers import round_half_up
from tillroll.functions.text import capitalized, fill_template, singular
from tillroll.functions.vectors import cosine
from tillroll.operators import (
    checks,
    enrichment,
    guarded_sql,
    kpis,
    lines,
    marts,
    retrieval,
    running_checks,
)
from tillroll.plans import pipeline
from tillroll.plans.models import build_gold, build_staging
from tillroll.session import fit_partitions, scratch_path, tune
from tillroll.sources import landing, layouts, tables
from tillroll.sources.star_views import star_view
from tillroll.streaming.incremental import append_new, embed_pending, enrich_pending, failures, finish, pending, stage_new

# The day the reports look back from: the last order day of the sample.
AS_OF = dt.date(2001, 8, 1)

Query = Callable[[SparkSession, str], DataFrame]


class Sample:
    """Lazy access to the relations over one folder of sample tables."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = tune(spark)
        fit_partitions(spark, tables.path_bytes(spark, sf_dir))
        self.sf_dir = sf_dir
        self._raw: dict[str, DataFrame] = {}

    def raw(self, entity: str) -> DataFrame:
        if entity not in self._raw:
            self._raw[entity] = star_view(self.spark, self.sf_dir, f"raw_{entity}")
        return self._raw[entity]

    def view(self, name: str) -> DataFrame:
        return star_view(self.spark, self.sf_dir, name)

    def stg(self, entity: str) -> DataFrame:
        return build_staging({entity: self.raw(entity)})[f"stg_{entity}"]

    @property
    def fct(self) -> DataFrame:
        return marts.fct_transactions(self.stg("order_items"), self.stg("orders"))

    @property
    def mart(self) -> DataFrame:
        return marts.mart_customer_performance(self.dim_customer, self.stg("orders"), AS_OF)

    @property
    def dim_customer(self) -> DataFrame:
        return marts.dim_customer(self.stg("customers"))

    @property
    def dim_product(self) -> DataFrame:
        return marts.dim_product(self.stg("products"))

    @property
    def enrichment(self) -> DataFrame:
        return enrichment.parse_enrichment(self.view("model_responses"))

    @property
    def index(self) -> DataFrame:
        return self.view("raw_review_embeddings")

    @property
    def retrieved(self) -> DataFrame:
        return retrieval.retrieve(self.view("question_vectors"), self.index, self.stg("reviews"))


# --- landing and raw tables -------------------------------------------------------------------


def _bronze_orders_csv(s: Sample) -> DataFrame:
    root = scratch_path(s.spark, "landing")
    landing.land_raw(s.raw("orders"), root, "orders", AS_OF)
    return landing.read_raw(s.spark, root, "orders").drop("dt")


def _bronze_reviews_csv(s: Sample) -> DataFrame:
    root = scratch_path(s.spark, "landing")
    landing.land_raw(s.raw("reviews"), root, "reviews", AS_OF)
    return landing.read_raw(s.spark, root, "reviews").drop("dt", "true_issue_type")


def _bronze_products_csv(s: Sample) -> DataFrame:
    root = scratch_path(s.spark, "landing")
    landing.land_raw(s.raw("products"), root, "products", AS_OF)
    return landing.read_raw(s.spark, root, "products").drop("dt")


def _bronze_rejects(s: Sample) -> DataFrame:
    """Rows of a landing whose keys are no numbers: the load fails and keeps their text."""
    landed, warehouse = scratch_path(s.spark, "landing"), scratch_path(s.spark, "warehouse")
    key = F.when(F.col("order_id") % 97 == 5, F.concat(F.lit("X"), F.col("order_id")))
    orders = s.raw("orders").withColumn("order_id", F.coalesce(key, F.col("order_id").cast("string")))
    landing.land_raw(orders, landed, "orders", AS_OF)
    try:
        landing.load_bronze(s.spark, landed, warehouse)
    except landing.RejectedRows:
        pass
    fields = F.split(landing.REJECTED, ",")
    return tables.read_table(s.spark, warehouse, "rejects", "orders").select(
        fields[0].alias("order_id"), fields[3].alias("status")
    )


def _two_landings(s: Sample) -> str:
    """The later day's landing is written first, so newest by date and by file time differ."""
    root = scratch_path(s.spark, "landing")
    orders = s.raw("orders")
    landing.land_raw(orders, root, "orders", AS_OF)
    day_before = orders.withColumn("status", F.lit("pending"))
    landing.land_raw(day_before, root, "orders", AS_OF - dt.timedelta(days=1))
    return root


def _latest_partition(s: Sample) -> DataFrame:
    return landing.latest_partition(s.spark, _two_landings(s), "orders")


def _latest_partition_by_mtime(s: Sample) -> DataFrame:
    return landing.latest_partition(s.spark, _two_landings(s), "orders", by="mtime")


def _bronze_load(s: Sample) -> DataFrame:
    landed, warehouse = scratch_path(s.spark, "landing"), scratch_path(s.spark, "warehouse")
    landing.land_raw(s.raw("products"), landed, "products", AS_OF)
    landing.land_raw(s.raw("order_items"), landed, "order_items", AS_OF)
    loaded = landing.load_bronze(s.spark, landed, warehouse)
    return tables.load_audit(loaded.tables)


def _bronze_customers(s: Sample) -> DataFrame:
    return tables.write_table(s.raw("customers"), scratch_path(s.spark, "raw"), "raw", "customers")


def _load_audit(s: Sample) -> DataFrame:
    return tables.load_audit({e: s.raw(e) for e in schemas.RAW_ENTITIES})


def _revenue_by_month_stored(s: Sample) -> DataFrame:
    """Revenue per month from lines stored by month."""
    stored = layouts.write_by_month(s.fct, scratch_path(s.spark, "gold"), "gold", "fct_transactions", "order_date")
    return kpis.revenue_by_stored_month(stored, layouts.MONTH)


def _mart_stored(s: Sample) -> DataFrame:
    """The mart from orders and customers in the same buckets: grouped and joined without a shuffle."""
    root = scratch_path(s.spark, "silver")
    orders, customers = (
        layouts.write_bucketed(df, root, "silver", name, "customer_id", 16)
        for name, df in (("orders", s.stg("orders")), ("customers", s.dim_customer))
    )
    return marts.mart_customer_performance(customers, orders, AS_OF)


def _append_new(s: Sample) -> DataFrame:
    path = scratch_path(s.spark, "enrichment")
    schema = schemas.REVIEW_ENRICHMENT
    append_new(s.enrichment, path, schema, "review_id")
    return append_new(enrichment.enrich_reviews(s.stg("reviews")), path, schema, "review_id")


def _append_conflict(s: Sample) -> DataFrame:
    """Two writers that start from the same empty table; the later one leaves out what the first has stored."""
    path, schema = scratch_path(s.spark, "enrichment"), schemas.REVIEW_ENRICHMENT
    first = stage_new(s.enrichment, path, schema, "review_id")
    second = stage_new(enrichment.enrich_reviews(s.stg("reviews")), path, schema, "review_id")
    finish(first, s.spark)
    return finish(second, s.spark)


def _published_versions(s: Sample) -> DataFrame:
    """Rows per table of two versions of gold: completed transactions alone, then all; both can be read."""
    root = scratch_path(s.spark, "warehouse")
    kept = [c for c in checks.GOLD_CHECKS if c.test == "not_null" and c.column in ("date_day", "order_item_id")]
    dates = marts.dim_date(s.stg("orders"))
    for run, fct in {"first": kpis.completed_transactions(s.fct), "second": s.fct}.items():
        pipeline.publish_checked({"dim_date": dates, "fct_transactions": fct}, root, run, kept)
    audits = [
        tables.load_audit(pipeline.read_gold(s.spark, root, v.number)).select(
            F.lit(v.number).cast("bigint").alias("version"), F.lit(v.note["run_id"]).alias("run_id"), "table", "rows"
        )
        for v in pipeline.published_versions(s.spark, root)
    ]
    return reduce(DataFrame.unionByName, audits)


# --- language-model jobs ----------------------------------------------------------------------


def _pending_reviews(s: Sample) -> DataFrame:
    return pending(s.stg("reviews"), s.enrichment, "review_id").select("review_id", "review_text")


def _pending_reviews_batch(s: Sample) -> DataFrame:
    reviews = s.stg("reviews").select("review_id", "review_text")
    return pending(reviews, s.enrichment, "review_id", limit=50)


def _pending_embeddings(s: Sample) -> DataFrame:
    rest = pending(retrieval.complaints(s.stg("reviews")), s.index, "review_id")
    return rest.select("review_id", "review_text")


def _build_embeddings(s: Sample) -> DataFrame:
    vectors = retrieval.build_embeddings(retrieval.complaints(s.stg("reviews")))
    # The outer form, since Spark would push a size check of the plain one, and with it the
    # embedding itself, down to the scan and so compute every vector twice.
    entries = vectors.select(
        "review_id", F.posexplode_outer("embedding").alias("position", "weight")
    )
    return entries.where(F.col("weight") != 0).select(
        "review_id",
        F.col("position").cast("bigint").alias("position"),
        F.col("weight").cast("double").alias("weight"),
    )


def _cosine_scores(s: Sample) -> DataFrame:
    """Every stored vector against one question, which joins no table: it is a scalar subquery."""
    question = s.index.agg(F.min_by("embedding", "review_id")).scalar()
    pairs = s.index.select("review_id", "embedding", question.alias("question"))
    scored = pairs.select(
        "review_id", cosine(F.col("embedding"), F.col("question")).alias("cosine")
    )
    return scored.select("review_id", round_half_up("cosine", 6).alias("score"))


def _retrieve_topk(s: Sample) -> DataFrame:
    return s.retrieved.select(
        F.col("question_id").cast("bigint").alias("question_id"),
        F.col("rank").cast("bigint").alias("rank"),
        "review_id",
        F.col("rating").cast("bigint").alias("rating"),
        "review_text",
        "score",
    )


def _rag_context(s: Sample) -> DataFrame:
    return retrieval.rag_context(s.retrieved).select(
        F.col("question_id").cast("bigint").alias("question_id"), "context"
    )


def _rag_prompt(s: Sample) -> DataFrame:
    questions = s.view("question_vectors").select(
        "question_id", F.concat(F.lit("What is wrong with product "), F.col("question_id"), F.lit("?")).alias("question_text")
    )
    prompts = retrieval.rag_prompt(retrieval.rag_context(s.retrieved), questions)
    return prompts.select(F.col("question_id").cast("bigint").alias("question_id"), "prompt")


# Texts of which length the stand-in models below cannot read, by its remainder.
UNREADABLE = (50, 7)


def _readable(texts: list[str]) -> list[int]:
    sizes = [len(t) for t in texts]
    if any(n % UNREADABLE[0] == UNREADABLE[1] for n in sizes):
        raise ValueError("cannot read this")
    return sizes


def _stand_in_scorer():
    """Answers by the length of a text, in prose around the JSON; fails on some texts."""
    names = ("negative", "neutral", "positive")
    return lambda texts: [
        f'Here it is: {{"sentiment": "{names[n % 3]}", "urgency": "{"high" if n % 2 else "low"}"}}' for n in _readable(texts)
    ]


def _stand_in_embedder():
    """Two numbers of a text's length; fails on some texts."""
    return lambda texts: [[float(n % 11), float(n % 13)] for n in _readable(texts)]


def _enrich_reviews_model(s: Sample) -> DataFrame:
    """A model that fails on some texts, asked in three parts: its answers to all others."""
    path = scratch_path(s.spark, "enrichment")
    return enrich_pending(s.stg("reviews"), path, _stand_in_scorer, parts=3)


def _embed_reviews_model(s: Sample) -> DataFrame:
    """Vectors of a model that fails on some texts, next to the rows it failed on (without a vector)."""
    path = scratch_path(s.spark, "index")
    index = embed_pending(s.stg("reviews"), path, _stand_in_embedder, width=2, parts=3)
    numbers = [F.col("embedding")[i].cast("double").alias(n) for i, n in enumerate(("first", "second"))]
    missing = [F.lit(None).cast("double").alias(n) for n in ("first", "second")]
    failed = failures(s.spark, path).select("review_id", *missing, "error")
    return index.select("review_id", *numbers, F.lit(None).cast("string").alias("error")).unionByName(failed)


def _faultless(s: Sample) -> dict[str, DataFrame]:
    """The raw relations without the faults that would stop a run: keys once, lines and orders with their parents.

    Parents are looked up by their raw keys, of which missing ones match nothing. The orders with a customer are
    stored, as `one_per_key` reads them more than once.
    """
    orders = s.raw("orders").join(s.raw("customers").select("customer_id"), "customer_id", "left_semi")
    items = s.raw("order_items").join(s.raw("products").select("product_id"), "product_id", "left_semi")
    orders = tables.write_table(orders.select(*s.raw("orders").columns), scratch_path(s.spark, "faultless"), None, "orders")
    return {
        "customers": tables.one_per_key(s.raw("customers"), "customer_id"),
        "products": tables.one_per_key(s.raw("products"), "product_id"),
        "orders": tables.one_per_key(orders, "order_id"),
        "order_items": items.select(*s.raw("order_items").columns),
        "reviews": s.raw("reviews"),
    }


def _pipeline_published(s: Sample) -> DataFrame:
    """What a whole run did: landed, loaded, checked, published, enriched and embedded."""
    run = pipeline.run_pipeline(s.spark, scratch_path(s.spark, "run"), _faultless(s), AS_OF, AS_OF)
    return pipeline.run_report(run)


def _pipeline_skips(s: Sample) -> DataFrame:
    """A run without landed reviews: they are skipped, and nothing is asked of a model."""
    sources = {entity: df for entity, df in _faultless(s).items() if entity != "reviews"}
    run = pipeline.run_pipeline(s.spark, scratch_path(s.spark, "run"), sources, AS_OF, AS_OF)
    return pipeline.run_report(run).where("stage in ('load', 'skip', 'model')")


def _review_drafts(s: Sample) -> DataFrame:
    """Template texts filled per order, dated some days after it."""
    orders = lines.order_first_product(s.stg("orders"), s.stg("order_items"), s.dim_product)
    days = F.col("order_id") % 12 + 3
    draft = fill_template(
        F.lit("{product} came {days} days late; {days} days!"),
        product=F.concat(capitalized(F.col("product_name")), F.lit(" "), singular(F.lit("Toys"))),
        days=days,
    )
    return orders.select(
        "order_id",
        F.date_add("order_date", days.cast("int")).alias("review_date"),
        draft.alias("review_text"),
    )


def _sql_response_clean(s: Sample) -> DataFrame:
    return guarded_sql.clean_sql(s.view("model_sql"), "raw_sql").withColumnRenamed("raw_sql", "sql")


def _sql_guard(s: Sample) -> DataFrame:
    cleaned = _sql_response_clean(s)
    return guarded_sql.guard_sql(cleaned, "sql").select(
        "conv_id", "turn", "allowed", F.coalesce("reason", F.lit("")).alias("reason")
    )


def _guarded_sql_revenue(s: Sample) -> DataFrame:
    root = scratch_path(s.spark, "gold")
    paths = {}
    for name, df in {"fct_transactions": s.fct, "dim_customer": s.dim_customer}.items():
        tables.write_table(df, root, "gold", name)
        paths[name] = tables.table_path(root, "gold", name)
    session = guarded_sql.readonly_session(s.spark, paths)
    return guarded_sql.run_readonly_sql(
        session,
        """```sql
        SELECT c.segment, cast(sum(cast(f.line_amount AS decimal(18, 2))) AS double) AS revenue
        FROM fct_transactions f JOIN dim_customer c ON f.customer_id = c.customer_id
        WHERE f.status = 'completed' GROUP BY c.segment
        ```""",
    )


def _gold_schema(s: Sample) -> DataFrame:
    """Columns of the gold tables, next to how many rows each holds."""
    entities = ("customers", "products", "orders", "order_items")
    gold = build_gold({f"stg_{e}": s.stg(e) for e in entities}, AS_OF)
    described = guarded_sql.describe_tables(gold)
    return described.join(
        tables.load_audit(gold).withColumnRenamed("table", "table_name"), "table_name"
    )


# --- data quality -----------------------------------------------------------------------------


def _dq_report(s: Sample) -> DataFrame:
    stg = {f"stg_{e}": s.stg(e) for e in schemas.RAW_ENTITIES}
    return checks.run_checks({**stg, **build_gold(stg, AS_OF)})


# What landed tables are held against each other for, next to the staging checks.
LANDING_CHECKS = [
    *checks.STAGING_CHECKS,
    checks.Check("relationships", "stg_orders", "customer_id", "stg_customers", "customer_id"),
    checks.Check("relationships", "stg_order_items", "order_id", "stg_orders", "order_id"),
    checks.Check("relationships", "stg_order_items", "product_id", "stg_products", "product_id"),
]


def _dq_report_landings(s: Sample) -> DataFrame:
    """The staging rows in two landings, each counted once and merged into the stored counts."""
    root = scratch_path(s.spark, "key-counts")
    stg = {f"stg_{e}": s.stg(e) for e in schemas.RAW_ENTITIES}
    for landing_no in range(2):
        part = {t: df.where(F.pmod(F.xxhash64(df.columns[0]), F.lit(2)) == landing_no) for t, df in stg.items()}
        running_checks.add_landing(s.spark, root, part, LANDING_CHECKS)
    return running_checks.report(s.spark, root, LANDING_CHECKS)


def _relationships_customer(s: Sample) -> DataFrame:
    return checks.relationships(s.fct, "customer_id", s.dim_customer, "customer_id")


def _relationships_product(s: Sample) -> DataFrame:
    return checks.relationships(s.fct, "product_id", s.dim_product, "product_id")


_BY_SAMPLE: dict[str, Callable[[Sample], DataFrame]] = {
    "bronze_orders_csv": _bronze_orders_csv,
    "bronze_reviews_csv": _bronze_reviews_csv,
    "bronze_products_csv": _bronze_products_csv,
    "bronze_rejects": _bronze_rejects,
    "bronze_customers": _bronze_customers,
    "bronze_load": _bronze_load,
    "latest_partition": _latest_partition,
    "latest_partition_by_mtime": _latest_partition_by_mtime,
    "load_audit": _load_audit,
    "append_new": _append_new,
    "append_conflict": _append_conflict,
    "published_versions": _published_versions,
    "stg_customers": lambda s: s.stg("customers"),
    "stg_products": lambda s: s.stg("products"),
    "stg_orders": lambda s: s.stg("orders"),
    "stg_order_items": lambda s: s.stg("order_items"),
    "stg_reviews": lambda s: s.stg("reviews"),
    "dim_customer": lambda s: s.dim_customer,
    "dim_product": lambda s: s.dim_product,
    "dim_date": lambda s: marts.dim_date(s.stg("orders")),
    "fct_transactions": lambda s: s.fct,
    "mart_customer_performance": lambda s: s.mart,
    "completed_transactions": lambda s: kpis.completed_transactions(s.fct),
    "complaint_reviews": lambda s: retrieval.complaints(s.stg("reviews")),
    "orders_per_customer": lambda s: marts.orders_per_customer(s.stg("orders")),
    "orders_by_status_per_customer": lambda s: marts.orders_by_status(s.stg("orders")),
    "revenue_per_customer": lambda s: marts.revenue_by(s.stg("orders")),
    "order_date_range_per_customer": lambda s: marts.order_date_range_by(s.stg("orders")),
    "order_date_bounds": lambda s: marts.date_bounds(s.stg("orders")),
    "order_totals": lambda s: lines.order_totals(s.stg("order_items")),
    "first_item_per_order": lambda s: lines.first_item_per_order(s.stg("order_items")),
    "order_first_product": lambda s: lines.order_first_product(
        s.stg("orders"), s.stg("order_items"), s.dim_product
    ),
    "review_candidates": lambda s: lines.review_candidates(s.stg("orders")),
    "kpi_total_revenue": lambda s: kpis.kpi_total_revenue(s.fct),
    "kpi_aov": lambda s: kpis.kpi_aov(s.raw("orders")),
    "kpi_cancellation_rate": lambda s: kpis.kpi_cancellation_rate(s.mart),
    "order_cancellation_rate": lambda s: kpis.order_cancellation_rate(s.stg("orders")),
    "kpi_active_customers": lambda s: kpis.kpi_active_customers(s.mart),
    "kpi_summary": lambda s: kpis.kpi_summary(s.fct, s.raw("orders"), s.mart),
    "top_products": lambda s: kpis.top_products(s.fct, s.dim_product),
    "revenue_by_product": lambda s: kpis.revenue_by_product(s.fct, s.dim_product),
    "revenue_by_product_id": lambda s: kpis.revenue_by_product_id(s.fct, s.dim_product),
    "revenue_by_region_top5": lambda s: kpis.revenue_by_region(s.fct, s.dim_customer),
    "revenue_by_month": lambda s: kpis.revenue_by_month(s.fct),
    "revenue_by_month_stored": _revenue_by_month_stored,
    "mart_customer_performance_stored": _mart_stored,
    "revenue_last_month": lambda s: kpis.revenue_last_month(s.fct, AS_OF),
    "aov_by_region": lambda s: kpis.aov_by_region(s.mart),
    "cancellation_hotspots": lambda s: kpis.cancellation_hotspots(s.mart),
    "complaints_by_issue": lambda s: kpis.complaints_by_issue(s.enrichment),
    "dq_not_null_violations": lambda s: checks.not_null(s.fct, "customer_id"),
    "dq_unique_violations": lambda s: checks.unique(s.fct, "order_item_id"),
    "dq_relationships_customer": _relationships_customer,
    "dq_relationships_product": _relationships_product,
    "dq_report": _dq_report,
    "dq_report_landings": _dq_report_landings,
    "pending_reviews": _pending_reviews,
    "pending_reviews_batch": _pending_reviews_batch,
    "pending_embeddings": _pending_embeddings,
    "enrich_reviews_rules": lambda s: enrichment.enrich_reviews(s.stg("reviews")),
    "parse_enrichment": lambda s: s.enrichment,
    "build_embeddings": _build_embeddings,
    "cosine_scores": _cosine_scores,
    "retrieve_topk": _retrieve_topk,
    "rag_context": _rag_context,
    "rag_prompt": _rag_prompt,
    "enrich_reviews_model": _enrich_reviews_model,
    "embed_reviews_model": _embed_reviews_model,
    "pipeline_published": _pipeline_published,
    "pipeline_skips": _pipeline_skips,
    "review_drafts": _review_drafts,
    "sql_response_clean": _sql_response_clean,
    "sql_guard": _sql_guard,
    "guarded_sql_revenue": _guarded_sql_revenue,
    "gold_schema": _gold_schema,
}


def sample_queries() -> dict[str, Query]:
    def bind(build: Callable[[Sample], DataFrame]) -> Query:
        return lambda spark, sf_dir: build(Sample(spark, sf_dir))

    return {name: bind(build) for name, build in _BY_SAMPLE.items()}
