"""The result every query is held against, as SQL for DuckDB over the same sample tables."""

from __future__ import annotations

from tillroll.operators.checks import SUITE
from tillroll.operators.enrichment import (
    ISSUE_WORDS,
    NEGATIVE_WORDS,
    POSITIVE_WORDS,
    URGENT_WORDS,
)
from tillroll.sources.star_views import with_clause, with_inputs

AS_OF = "date '2001-08-01'"


def _with(names: list[str], ctes: dict[str, str], body: str) -> str:
    """A query over the sample views `names` and further common tables."""
    parts = {**with_inputs(*names), **ctes}
    return with_clause(parts) + body


def _cents(value: str) -> str:
    return f"sum(cast(round({value} * 100) as bigint))"


def _mean(value: str, scale: int) -> str:
    return (
        f"round(sum(cast(round({value} * {scale}) as bigint)) / count({value})) / {scale}"
    )


STG = {
    "stg_customers": """select customer_id, trim(first_name) as first_name,
        trim(last_name) as last_name, lower(trim(email)) as email, signup_date, region, segment
        from raw_customers where customer_id is not null""",
    "stg_products": """select product_id, trim(product_name) as product_name, category, cost, price,
        round((price - cost) * 100) / 100 as margin
        from raw_products where product_id is not null""",
    "stg_orders": """select order_id, customer_id, order_date, status, order_total
        from raw_orders where order_id is not null""",
    "stg_order_items": """select order_item_id, order_id, product_id, quantity, unit_price,
        round(quantity * unit_price * 100) / 100 as line_amount
        from raw_order_items where order_item_id is not null""",
    "stg_reviews": """select review_id, order_id, customer_id, product_id, review_date, rating,
        trim(review_text) as review_text
        from raw_reviews where review_id is not null""",
}
FCT = """select i.order_item_id, i.order_id, o.customer_id, i.product_id, o.order_date, o.status,
        i.quantity, i.unit_price, i.line_amount
        from stg_order_items i join stg_orders o on i.order_id = o.order_id"""
ORDER_FACTS = f"""select customer_id, count(distinct order_id) as total_orders,
        count(distinct case when status = 'completed' then order_id end) as completed_orders,
        count(distinct case when status = 'cancelled' then order_id end) as cancelled_orders,
        count(distinct case when status = 'returned' then order_id end) as returned_orders,
        {_cents("case when status = 'completed' then order_total else 0 end")} / 100
          as total_revenue,
        min(order_date) as first_order_date, max(order_date) as last_order_date
        from stg_orders group by customer_id"""
MART = f"""select c.customer_id, c.first_name, c.last_name, c.region, c.segment,
        coalesce(f.total_orders, 0) as total_orders,
        coalesce(f.completed_orders, 0) as completed_orders,
        coalesce(f.cancelled_orders, 0) as cancelled_orders,
        coalesce(f.returned_orders, 0) as returned_orders,
        coalesce(f.total_revenue, 0.0::double) as total_revenue,
        case when f.completed_orders > 0
             then round(f.total_revenue / f.completed_orders * 100) / 100
             else 0.0::double end as avg_order_value,
        case when f.total_orders > 0
             then round(f.cancelled_orders / f.total_orders * 10000) / 10000
             else 0.0::double end as cancellation_rate,
        f.first_order_date, f.last_order_date,
        coalesce(f.last_order_date >= {AS_OF} - 180, false) as is_active_customer
        from stg_customers c left join order_facts f on c.customer_id = f.customer_id"""
DIM_DATE = """select cast(d as date) as date_day, extract(year from d) as year,
        extract(month from d) as month, extract(day from d) as day,
        extract(dow from d) as day_of_week, strftime(d, '%Y-%m') as year_month
        from (select unnest(generate_series(min(order_date), max(order_date), interval 1 day)) as d
              from stg_orders)"""
ENRICHMENT = """select review_id,
          coalesce(json_extract_string(answer, '$.sentiment'), 'neutral') as sentiment,
          case when json_extract_string(answer, '$.issue_type') in
                 ('shipping_delay', 'product_quality', 'wrong_item', 'customer_service',
                  'packaging_damage', 'none')
               then json_extract_string(answer, '$.issue_type') else 'none' end as issue_type,
          coalesce(json_extract_string(answer, '$.urgency'), 'low') as urgency
        from (select review_id, case when json_valid(body) then body end as answer
              from (select review_id, regexp_extract(raw, '(?s)\\{.*\\}') as body
                    from model_responses))"""


# What may stand next to a whole word: anything but letters, digits and the underscore.
EDGE = r"[^\p{L}\p{N}_]"


def _words(words: tuple[str, ...]) -> str:
    return rf"regexp_matches(lower(review_text), '(^|{EDGE})({'|'.join(words)})($|{EDGE})')"


RULES = (
    "select review_id, case"
    + "".join(f"\n          when {_words(words)} then '{issue}'" for issue, words in ISSUE_WORDS.items())
    + "\n          else 'none' end as issue_type,\n"
    + f"""          coalesce({_words(NEGATIVE_WORDS)}, false) as bad,
          coalesce({_words(POSITIVE_WORDS)}, false) as good,
          coalesce({_words(URGENT_WORDS)}, false) as urgent
        from stg_reviews"""
)
RULE_ENRICHMENT = """select review_id,
          case when bad or issue_type <> 'none' then 'negative'
               when good then 'positive' else 'neutral' end as sentiment,
          issue_type,
          case when not (bad or issue_type <> 'none') then 'low'
               when urgent then 'high' else 'medium' end as urgency
        from rules"""
SCORES = """select e.review_id, q.question_id,
          round(list_cosine_similarity(cast(e.embedding as double[]), cast(q.question as double[]))
                * 1000000000) / 1000000000 as score
        from raw_review_embeddings e cross join question_vectors q"""
RETRIEVED = """select question_id, rank, review_id, rating, review_text, score
        from (select s.question_id, s.review_id, r.rating, r.review_text, s.score,
                     row_number() over (partition by s.question_id
                                        order by s.score desc nulls last, s.review_id,
                                                 r.rating, r.review_text) as rank
              from scores s join stg_reviews r on s.review_id = r.review_id)
        where rank <= 5"""
CLEAN_SQL = r"""select conv_id, turn, regexp_replace(regexp_replace(regexp_replace(regexp_replace(
          regexp_replace(raw_sql, '^\s+|\s+$', '', 'g'), '^```(sql)?', ''), '^\s+|\s+$', '', 'g'),
          '```$', ''), '^\s+|\s+$', '', 'g') as sql
        from model_sql"""
GUARDED = rf"""select conv_id, turn,
          case when sql is null or not regexp_matches(sql, '(?is)^\s*select') then 'not a select'
               when regexp_matches(lower(sql), '(^|{EDGE})(insert|update|delete|drop|alter|create|'
                      || 'attach|copy|pragma|call|export|import)($|{EDGE})') then 'forbidden keyword'
               else '' end as reason
        from clean_sql"""


def _model(*names: str) -> tuple[list[str], dict[str, str]]:
    """Sample views and common tables that the named relations stand on."""
    views: list[str] = []
    ctes: dict[str, str] = {}

    def need(name: str) -> None:
        if name in STG:
            views.append(name.replace("stg_", "raw_"))
            ctes.setdefault(name, STG[name])
            return
        uses = {
            "fct": ("stg_order_items", "stg_orders"),
            "order_facts": ("stg_orders",),
            "mart": ("stg_customers", "order_facts"),
            "dates": ("stg_orders",),
            "rules": ("stg_reviews",),
            "rule_enrichment": ("rules",),
            "scores": (),
            "retrieved": ("scores", "stg_reviews"),
            "enrichment": (),
            "clean_sql": (),
            "guarded": ("clean_sql",),
        }[name]
        views.extend(
            {
                "scores": ["raw_review_embeddings", "question_vectors"],
                "enrichment": ["model_responses"],
                "clean_sql": ["model_sql"],
            }.get(name, [])
        )
        for used in uses:
            need(used)
        ctes.setdefault(
            name,
            {
                "fct": FCT, "order_facts": ORDER_FACTS, "mart": MART, "dates": DIM_DATE,
                "rules": RULES, "rule_enrichment": RULE_ENRICHMENT, "scores": SCORES,
                "retrieved": RETRIEVED, "enrichment": ENRICHMENT, "clean_sql": CLEAN_SQL,
                "guarded": GUARDED,
            }[name],
        )

    for name in names:
        need(name)
    return views, ctes


def _over(names: str, body: str) -> str:
    views, ctes = _model(*names.split())
    return _with(views, ctes, body)


def _gold_counts() -> str:
    return " union all ".join(
        f"select '{shown}' as table_name, '{columns}' as columns, count(*) as rows from {relation}"
        for shown, relation, columns in (
            ("dim_customer", "stg_customers",
             "customer_id, first_name, last_name, email, signup_date, region, segment"),
            ("dim_product", "stg_products",
             "product_id, product_name, category, cost, price, margin"),
            ("dim_date", "dates", "date_day, year, month, day, day_of_week, year_month"),
            ("fct_transactions", "fct",
             "order_item_id, order_id, customer_id, product_id, order_date, status, quantity, "
             "unit_price, line_amount"),
            ("mart_customer_performance", "mart",
             "customer_id, first_name, last_name, region, segment, total_orders, "
             "completed_orders, cancelled_orders, returned_orders, total_revenue, "
             "avg_order_value, cancellation_rate, first_order_date, last_order_date, "
             "is_active_customer"),
        )
    )


def _dq_report() -> str:
    keys = [
        ("stg_customers", "stg_customers", "customer_id"),
        ("stg_products", "stg_products", "product_id"),
        ("stg_orders", "stg_orders", "order_id"),
        ("stg_order_items", "stg_order_items", "order_item_id"),
        ("stg_reviews", "stg_reviews", "review_id"),
        ("dim_customer", "stg_customers", "customer_id"),
        ("dim_product", "stg_products", "product_id"),
        ("dim_date", "dates", "date_day"),
        ("fct_transactions", "fct", "order_item_id"),
        ("mart_customer_performance", "mart", "customer_id"),
    ]
    selects = []
    for shown, relation, key in keys:
        selects.append(
            f"select 'unique' as test, '{shown}' as \"table\", '{key}' as \"column\", "
            f"(select count(*) from (select {key} from {relation} where {key} is not null "
            f"group by {key} having count(*) > 1)) as failures"
        )
    nullable = [*keys, ("fct_transactions", "fct", "customer_id"),
                ("fct_transactions", "fct", "product_id")]
    for shown, relation, key in nullable:
        selects.append(
            f"select 'not_null', '{shown}', '{key}', "
            f"(select count(*) from {relation} where {key} is null)"
        )
    for key, parent in (("customer_id", "stg_customers"), ("product_id", "stg_products")):
        selects.append(
            f"select 'relationships', 'fct_transactions', '{key}', (select count(*) from fct "
            f"where {key} is not null and {key} not in (select {key} from {parent}))"
        )
    return _over(
        "stg_customers stg_products stg_orders stg_order_items stg_reviews dates fct mart",
        " union all ".join(selects),
    )


def _dq_report_landings() -> str:
    keys = {"stg_customers": "customer_id", "stg_products": "product_id", "stg_orders": "order_id",
            "stg_order_items": "order_item_id", "stg_reviews": "review_id"}
    selects = [
        f"""select 'unique' as test, '{t}' as "table", '{k}' as "column",
              (select count(*) from (select {k} from {t} group by {k} having count(*) > 1)) as failures
            union all select 'not_null', '{t}', '{k}', (select count(*) from {t} where {k} is null)"""
        for t, k in keys.items()
    ]
    for child, key, parent in (("stg_orders", "customer_id", "stg_customers"), ("stg_order_items", "order_id", "stg_orders"),
                               ("stg_order_items", "product_id", "stg_products")):
        selects.append(
            f"select 'relationships', '{child}', '{key}', (select count(*) from {child} "
            f"where {key} is not null and {key} not in (select {key} from {parent}))"
        )
    return _over(" ".join(keys), " union all ".join(selects))


UNREADABLE = "length(coalesce(review_text, '')) % 50 = 7"
FAULTLESS = {
    "good_customers": "select distinct customer_id from raw_customers where customer_id is not null",
    "good_products": "select distinct product_id from raw_products where product_id is not null",
    "good_orders": """select order_id, min(order_date) as order_date from raw_orders
        where order_id is not null and customer_id in (select customer_id from good_customers) group by order_id""",
    "good_items": "select * from raw_order_items where product_id in (select product_id from good_products)",
    "good_fct": "select * from good_items where order_id in (select order_id from good_orders)",
}


def _run_rows(reviews: bool) -> str:
    loaded = {"customers": "good_customers", "products": "good_products", "orders": "good_orders",
              "order_items": "good_items"} | ({"reviews": "raw_reviews"} if reviews else {})
    selects = [f"select 'load' as stage, '{name}' as item, count(*) as value from {rel}" for name, rel in loaded.items()]
    if not reviews:
        selects.append("select 'skip', 'reviews', null")
        return _with(["raw_customers", "raw_products", "raw_orders", "raw_order_items"], FAULTLESS, " union all ".join(selects))
    gold = {"dim_customer": "good_customers", "dim_product": "good_products", "fct_transactions": "good_fct",
            "mart_customer_performance": "good_customers"}
    selects += [f"select 'gold', '{name}', count(*) from {rel}" for name, rel in gold.items()]
    selects.append("select 'gold', 'dim_date', date_diff('day', min(order_date), max(order_date)) + 1 from good_orders")
    selects.append("select 'model', 'review_enrichment', count(*) from raw_reviews")
    selects.append("select 'model', 'review_embeddings', count(*) from raw_reviews where rating <= 3")
    selects += [f"select 'check', '{c.test}({c.table}.{c.column})', 0" for c in SUITE]
    return _with(["raw_customers", "raw_products", "raw_orders", "raw_order_items", "raw_reviews"], FAULTLESS, " union all ".join(selects))


def all_oracles() -> dict[str, str]:
    completed = "where status = 'completed'"
    revenue = f"coalesce({_cents('line_amount')} / 100, 0)"
    product_revenue = f"""select p.product_name, p.category, {_cents("f.line_amount")} / 100 as revenue
        from fct f join stg_products p on f.product_id = p.product_id
        where f.status = 'completed' group by p.product_name, p.category"""
    orphans = """select f.* from fct f left join {parent} p on f.{key} = p.{key}
        where f.{key} is not null and p.{key} is null"""
    pending = """select r.review_id, r.review_text from stg_reviews r
        left join {done} e on r.review_id = e.review_id where e.review_id is null"""
    oracles = {
        "bronze_orders_csv": _with(["raw_orders"], {}, "select * from raw_orders"),
        "bronze_reviews_csv": _with(
            ["raw_reviews"], {}, "select * exclude (true_issue_type) from raw_reviews"
        ),
        "bronze_products_csv": _with(["raw_products"], {}, "select * from raw_products"),
        "bronze_rejects": _with(
            ["raw_orders"], {},
            "select 'X' || order_id as order_id, status from raw_orders where order_id % 97 = 5",
        ),
        "bronze_customers": _with(["raw_customers"], {}, "select * from raw_customers"),
        "bronze_load": """select 'products' as "table", count(*) as rows from part
            union all select 'order_items', count(*) from lineitem""",
        "latest_partition": _with(
            ["raw_orders"], {}, f"select *, {AS_OF} as dt from raw_orders"
        ),
        "latest_partition_by_mtime": _with(
            ["raw_orders"], {},
            f"select * replace ('pending' as status), cast({AS_OF} - 1 as date) as dt from raw_orders",
        ),
        "load_audit": _with(
            ["raw_reviews"], {},
            """select 'customers' as "table", count(*) as rows from customer
            union all select 'products', count(*) from part
            union all select 'orders', count(*) from orders
            union all select 'order_items', count(*) from lineitem
            union all select 'reviews', count(*) from raw_reviews""",
        ),
        "append_new": _over(
            "enrichment rule_enrichment",
            """select review_id, sentiment, issue_type, urgency from enrichment
            union all
            select review_id, sentiment, issue_type, urgency from (
              select *, row_number() over (partition by review_id
                                           order by sentiment, issue_type, urgency) as n
              from rule_enrichment) where n = 1 and review_id not in (select review_id from enrichment)""",
        ),
        "append_conflict": _over(
            "enrichment rule_enrichment",
            """select review_id, sentiment, issue_type, urgency from enrichment
            union all
            select review_id, sentiment, issue_type, urgency from (
              select *, row_number() over (partition by review_id
                                           order by sentiment, issue_type, urgency) as n
              from rule_enrichment) where n = 1 and review_id not in (select review_id from enrichment)""",
        ),
        "published_versions": _over(
            "dates fct",
            """select cast(1 as bigint) as version, 'first' as run_id, 'dim_date' as "table", count(*) as rows from dates
            union all select 1, 'first', 'fct_transactions', count(*) from fct where status = 'completed'
            union all select 2, 'second', 'dim_date', count(*) from dates
            union all select 2, 'second', 'fct_transactions', count(*) from fct""",
        ),
        **{name: _over(name, f"select * from {name}") for name in STG},
        "dim_customer": _over("stg_customers", "select * from stg_customers"),
        "dim_product": _over("stg_products", "select * from stg_products"),
        "dim_date": _over("dates", "select * from dates"),
        "fct_transactions": _over("fct", "select * from fct"),
        "mart_customer_performance": _over("mart", "select * from mart"),
        "mart_customer_performance_stored": _over("mart", "select * from mart"),
        "completed_transactions": _over("fct", f"select * from fct {completed}"),
        "complaint_reviews": _over("stg_reviews", "select * from stg_reviews where rating <= 3"),
        "orders_per_customer": _over(
            "order_facts", "select customer_id, total_orders from order_facts"
        ),
        "orders_by_status_per_customer": _over(
            "order_facts",
            "select customer_id, completed_orders, cancelled_orders, returned_orders from order_facts",
        ),
        "revenue_per_customer": _over(
            "order_facts", "select customer_id, total_revenue from order_facts"
        ),
        "order_date_range_per_customer": _over(
            "order_facts", "select customer_id, first_order_date, last_order_date from order_facts"
        ),
        "order_date_bounds": _over(
            "stg_orders", "select min(order_date) as min_date, max(order_date) as max_date from stg_orders"
        ),
        "order_totals": _over(
            "stg_order_items",
            f"select order_id, {_cents('quantity * unit_price')} / 100 as order_total "
            "from stg_order_items group by order_id",
        ),
        "first_item_per_order": _over(
            "stg_order_items",
            """select order_id, product_id from (select order_id, product_id, row_number() over (
                 partition by order_id order by order_item_id) as n from stg_order_items) where n = 1""",
        ),
        "order_first_product": _over(
            "stg_orders stg_order_items stg_products",
            """select o.order_id, o.customer_id, o.order_date, p.product_id, p.product_name
            from stg_orders o
            join (select order_id, product_id, row_number() over (
                    partition by order_id order by order_item_id) as n from stg_order_items) i
              on i.order_id = o.order_id and n = 1
            join stg_products p on p.product_id = i.product_id""",
        ),
        "review_candidates": _over(
            "stg_orders",
            """select * from stg_orders where status <> 'cancelled'
            order by md5(concat('42:', cast(order_id as varchar))), order_id limit 800""",
        ),
        "kpi_total_revenue": _over("fct", f"select {revenue} as total_revenue from fct {completed}"),
        "kpi_aov": _with(
            ["raw_orders"], {},
            f"select coalesce({_mean('order_total', 100)}, 0) as avg_order_value "
            f"from raw_orders {completed}",
        ),
        "kpi_cancellation_rate": _over(
            "mart",
            f"select coalesce({_mean('cancellation_rate', 10000)}, 0) as cancellation_rate from mart",
        ),
        "order_cancellation_rate": _over(
            "stg_orders",
            """select round(count(*) filter (status = 'cancelled') / count(*) * 10000) / 10000
              as cancellation_rate from stg_orders""",
        ),
        "kpi_active_customers": _over(
            "mart", "select count(*) as active_customers from mart where is_active_customer"
        ),
        "kpi_summary": _over(
            "fct mart",
            f"""select *, '$' || format('{{:,}}', cast(round(total_revenue) as bigint))
                     as total_revenue_text,
                   '$' || format('{{:,.2f}}', avg_order_value) as avg_order_value_text,
                   format('{{:.1f}}', cancellation_rate * 100) || '%' as cancellation_rate_text,
                   format('{{:,}}', active_customers) as active_customers_text
            from (select
              (select {revenue} from fct {completed}) as total_revenue,
              (select coalesce({_mean('order_total', 100)}, 0) from raw_orders {completed})
                as avg_order_value,
              (select coalesce({_mean('cancellation_rate', 10000)}, 0) from mart)
                as cancellation_rate,
              (select count(*) from mart where is_active_customer) as active_customers)""",
        ),
        "top_products": _over(
            "fct stg_products",
            product_revenue + " order by revenue desc, product_name, category limit 10",
        ),
        "revenue_by_product": _over("fct stg_products", product_revenue),
        "revenue_by_product_id": _over(
            "fct stg_products",
            f"""select p.product_id, p.product_name, p.category, {_cents("f.line_amount")} / 100 as revenue
            from fct f join stg_products p on f.product_id = p.product_id
            where f.status = 'completed' group by p.product_id, p.product_name, p.category""",
        ),
        "revenue_by_region_top5": _over(
            "fct stg_customers",
            f"""select c.region, {_cents("f.line_amount")} / 100 as revenue
            from fct f join stg_customers c on f.customer_id = c.customer_id
            where f.status = 'completed' group by c.region order by revenue desc, region limit 5""",
        ),
        "revenue_by_month": _over(
            "fct dates",
            f"""select d.year_month, {_cents("f.line_amount")} / 100 as revenue
            from fct f join dates d on f.order_date = d.date_day
            where f.status = 'completed' group by d.year_month""",
        ),
        "revenue_by_month_stored": _over(
            "fct dates",
            f"""select d.year_month, {_cents("f.line_amount")} / 100 as revenue
            from fct f join dates d on f.order_date = d.date_day
            where f.status = 'completed' group by d.year_month""",
        ),
        "revenue_last_month": _over(
            "fct dates",
            f"""select '2001-07' as year_month, coalesce({_cents("f.line_amount")} / 100, 0) as revenue
            from fct f join dates d on f.order_date = d.date_day
            where f.status = 'completed' and d.year_month = '2001-07'""",
        ),
        "aov_by_region": _over(
            "mart",
            f"select region, {_mean('avg_order_value', 100)} as avg_order_value from mart group by region",
        ),
        "cancellation_hotspots": _over(
            "mart",
            f"select region, segment, {_mean('cancellation_rate', 10000)} as cancellation_rate "
            "from mart group by region, segment",
        ),
        "complaints_by_issue": _over(
            "enrichment", "select issue_type, count(*) as reviews from enrichment group by issue_type"
        ),
        "dq_not_null_violations": _over("fct", "select * from fct where customer_id is null"),
        "dq_unique_violations": _over(
            "fct",
            """select order_item_id, count(*) as rows from fct where order_item_id is not null
            group by order_item_id having count(*) > 1""",
        ),
        "dq_relationships_customer": _over(
            "fct stg_customers", orphans.format(parent="stg_customers", key="customer_id")
        ),
        "dq_relationships_product": _over(
            "fct stg_products", orphans.format(parent="stg_products", key="product_id")
        ),
        "dq_report": _dq_report(),
        "dq_report_landings": _dq_report_landings(),
        "pending_reviews": _over("stg_reviews enrichment", pending.format(done="enrichment")),
        "pending_reviews_batch": _over(
            "stg_reviews enrichment",
            pending.format(done="enrichment") + " order by r.review_id, r.review_text limit 50",
        ),
        "pending_embeddings": _with(
            ["raw_review_embeddings", "raw_reviews"], {"stg_reviews": STG["stg_reviews"]},
            pending.format(done="raw_review_embeddings") + " and r.rating <= 3",
        ),
        "enrich_reviews_rules": _over(
            "rule_enrichment",
            "select review_id, sentiment, issue_type, urgency from rule_enrichment",
        ),
        "parse_enrichment": _over("enrichment", "select * from enrichment"),
        "build_embeddings": _over(
            "stg_reviews",
            r"""select review_id, bucket as position,
              cast(cast(n / sqrt(sum(n * n) over (partition by text_no)) as float) as double) as weight
            from (select review_id, text_no, bucket, count(*) as n
                  from (select review_id, text_no,
                               cast('0x' || substr(md5(word), 1, 8) as bigint) % 768 as bucket
                        from (select review_id, row_number() over () as text_no,
                                     unnest(regexp_split_to_array(lower(review_text),
                                                                  '[ \t\r\n]+')) as word
                              from stg_reviews where rating <= 3)
                        where word <> '')
                  group by review_id, text_no, bucket)""",
        ),
        "cosine_scores": """select vec_id as review_id,
              round(list_cosine_similarity(cast(embedding as double[]), cast(question as double[]))
                    * 1000000) / 1000000 as score
            from embeddings, (select min_by(embedding, vec_id) as question from embeddings)""",
        "retrieve_topk": _over(
            "retrieved",
            """select cast(question_id as bigint) as question_id, rank, review_id,
              cast(rating as bigint) as rating, review_text, score from retrieved""",
        ),
        "rag_context": _over(
            "retrieved",
            """select cast(question_id as bigint) as question_id,
              string_agg('[review ' || review_id || '] (rating ' || rating || '/5): ' || review_text,
                         chr(10) order by rank) as context
            from retrieved group by question_id""",
        ),
        "rag_prompt": _over(
            "retrieved",
            """select cast(q.question_id as bigint) as question_id,
              'Question: What is wrong with product ' || q.question_id || '?' || chr(10) || chr(10)
                || 'Review excerpts:' || chr(10) || coalesce(c.context, '') as prompt
            from question_vectors q left join (
              select question_id, string_agg('[review ' || review_id || '] (rating ' || rating || '/5): '
                || review_text, chr(10) order by rank) as context from retrieved group by question_id) c
            on c.question_id = q.question_id""",
        ),
        "enrich_reviews_model": _over(
            "stg_reviews",
            f"""select review_id, case length(coalesce(review_text, '')) % 3 when 0 then 'negative'
                     when 1 then 'neutral' else 'positive' end as sentiment, 'none' as issue_type,
                   case when length(coalesce(review_text, '')) % 2 = 1 then 'high' else 'low' end as urgency
            from stg_reviews where not {UNREADABLE}""",
        ),
        "embed_reviews_model": _over(
            "stg_reviews",
            f"""select review_id, case when not {UNREADABLE} then length(coalesce(review_text, '')) % 11 end::double as first,
                   case when not {UNREADABLE} then length(coalesce(review_text, '')) % 13 end::double as second,
                   case when {UNREADABLE} then 'ValueError: cannot read this' end as error
            from stg_reviews where rating <= 3""",
        ),
        "pipeline_published": _run_rows(reviews=True),
        "pipeline_skips": _run_rows(reviews=False),
        "review_drafts": _over(
            "stg_orders stg_order_items stg_products",
            """select o.order_id,
              cast(o.order_date + cast(o.order_id % 12 + 3 as int) as date) as review_date,
              concat(upper(p.product_name[1]), lower(p.product_name[2:]), ' Toy came ',
                     o.order_id % 12 + 3, ' days late; ', o.order_id % 12 + 3, ' days!') as review_text
            from stg_orders o
            join (select order_id, product_id, row_number() over (
                    partition by order_id order by order_item_id) as n from stg_order_items) i
              on i.order_id = o.order_id and n = 1
            join stg_products p on p.product_id = i.product_id""",
        ),
        "sql_response_clean": _over("clean_sql", "select * from clean_sql"),
        "sql_guard": _over(
            "guarded", "select conv_id, turn, reason = '' as allowed, reason from guarded"
        ),
        "guarded_sql_revenue": _over(
            "fct stg_customers",
            f"""select c.segment, {_cents("f.line_amount")} / 100 as revenue
            from fct f join stg_customers c on f.customer_id = c.customer_id
            where f.status = 'completed' group by c.segment""",
        ),
        "gold_schema": _over("stg_customers stg_products dates fct mart", _gold_counts()),
    }
    return oracles
