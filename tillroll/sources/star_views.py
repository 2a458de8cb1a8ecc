"""The sample star schema seen as the five raw retail entities and the model-written tables.

Each view is one SELECT that Spark and DuckDB both take as it stands. Every view covers its whole
source tables. Faults are planted by value, never by leaving rows out: missing and repeated keys,
customers without orders, lines without an order, orders without a customer or a date.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

# The sample tables that the views use, with their columns.
SAMPLE_TABLES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
    "c_mktsegment string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
    "p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "labels": "doc_id bigint, quality int, toxic int",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}

VIEWS: dict[str, str] = {
    # Padded and mixed-case on purpose, so that trim and lower have work to do.
    "raw_customers": """
        select case c_custkey % 500 when 13 then null when 21 then c_custkey - 1 else c_custkey end
                 as customer_id,
               concat(' ', split_part(c_name, '#', 1), ' ') as first_name,
               concat(split_part(c_name, '#', 2), ' ') as last_name,
               concat(' C', cast(c_custkey as varchar(20)), '@Example.COM') as email,
               date '1992-01-01' + cast(c_custkey % 1000 as int) as signup_date,
               r_name as region, c_mktsegment as segment
        from customer join nation on c_nationkey = n_nationkey
                      join region on n_regionkey = r_regionkey""",
    "raw_products": """
        select case p_partkey % 500 when 13 then null else p_partkey end as product_id,
               concat(p_name, ' ') as product_name, p_type as category,
               floor(p_retailprice * 60 + 0.5) / 100 as cost, p_retailprice as price
        from part""",
    # One customer in ten leaves its orders to another one.
    "raw_orders": """
        select case o_orderkey % 1000 when 999 then null when 500 then o_orderkey - 1
                    else o_orderkey end as order_id,
               case when o_custkey % 100 = 99 then null
                    when o_custkey % 10 = 7 then o_custkey - 7 else o_custkey end as customer_id,
               case when o_orderkey % 1000 = 77 then null
                    else cast(o_orderdate as date) end as order_date,
               case o_orderstatus when 'F' then 'completed' when 'O' then 'cancelled'
                    else 'returned' end as status,
               o_totalprice as order_total
        from orders""",
    # The source has no line key, so its fields are packed into one number (2^33 keeps it in range).
    # It is never NULL, which lets a query that does not use it leave those fields unread.
    "raw_order_items": """
        select coalesce(
                 ((((l_orderkey % 8589934592) * 10 + l_linenumber) * 1024 + l_partkey % 1024) * 1024
                   + l_suppkey % 1024) * 64 + cast(l_quantity as bigint) % 64, 0) as order_item_id,
               l_orderkey as order_id, l_partkey as product_id, cast(l_quantity as int) as quantity,
               floor(l_extendedprice / l_quantity * 100 + 0.5) / 100 as unit_price
        from lineitem""",
    "first_item": """
        select order_id, min_by(product_id, order_item_id) as product_id
        from raw_order_items group by order_id""",
    # Document text as review text, order number = document number.
    "raw_reviews": """
        select d.doc_id as review_id, o.order_id, o.customer_id, f.product_id,
               o.order_date + cast(2 + d.doc_id % 29 as int) as review_date,
               cast(1 + d.doc_id % 5 as int) as rating, concat(' ', d.text, ' ') as review_text,
               'none' as true_issue_type
        from documents d
        left join (select order_id, min(customer_id) as customer_id, min(order_date) as order_date
                   from raw_orders group by order_id) o on d.doc_id = o.order_id
        left join first_item f on f.order_id = d.doc_id""",
    "raw_review_embeddings": "select vec_id as review_id, embedding from embeddings",
    # One question vector per label: the vector with the label's lowest id.
    "question_vectors": """
        select label as question_id, min_by(embedding, vec_id) as question
        from embeddings group by label""",
    # Clean JSON, JSON in prose with missing keys, no JSON, a value outside the list, a second
    # object behind the first, single quotes, no closing brace, a number as value, explicit null.
    "model_responses": """
        select doc_id as review_id, case doc_id % 9
                 when 0 then concat('{"sentiment":"',
                                    case when toxic = 1 then 'negative' else 'positive' end,
                                    '","issue_type":"wrong_item","urgency":"high"}')
                 when 1 then concat('Sure! {"sentiment":"',
                                    case when quality = 1 then 'positive' else 'neutral' end,
                                    '"} Done.')
                 when 2 then 'no json here'
                 when 3 then '{"sentiment":"negative","issue_type":"bogus","urgency":"low"}'
                 when 4 then '{"sentiment":"negative"} or {"sentiment":"positive"}'
                 when 5 then '{''sentiment'':''negative'',''urgency'':''high''}'
                 when 6 then '{"sentiment":"negative","urgency":"high"'
                 when 7 then '{"sentiment":"negative","urgency":3}'
                 else '{"sentiment":null,"issue_type":"packaging_damage"}' end as raw
        from labels""",
    # SQL as a model might write it, with a turn's whole text as a literal.
    "model_sql": """
        select conv_id, turn, case turn % 4
                 when 0 then concat('```sql\nSELECT ''', replace(text, '''', ''), ''' AS t\n```')
                 when 1 then concat('  select * from t where c = ''', replace(text, '''', ''), ''' ')
                 when 2 then concat('with w as (select 1) select ''', replace(text, '''', ''), '''')
                 else concat('```\nselect 1; Drop table t -- ', text, '```') end as raw_sql
        from conversations""",
}

_VIEW_INPUTS = {
    "first_item": ["raw_order_items"],
    "raw_reviews": ["raw_orders", "first_item"],
}


def _tables_of(sql: str) -> list[str]:
    return [t for t in SAMPLE_TABLES if re.search(rf"\b(from|join)\s+{t}\b", sql)]


def read_sample(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    return spark.read.schema(SAMPLE_TABLES[name]).parquet(path)


def with_inputs(*names: str) -> dict[str, str]:
    """The named views and the views they use, as name -> SELECT, each after what it uses."""
    listed: dict[str, str] = {}
    for name in names:
        listed |= with_inputs(*_VIEW_INPUTS.get(name, [])) | {name: VIEWS[name]}
    return listed


def with_clause(selects: dict[str, str]) -> str:
    listed = ",\n".join(f"{name} as ({sql})" for name, sql in selects.items())
    return f"with {listed}\n"


def star_view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the views above over the Parquet tables of a folder."""
    selects = with_inputs(name)
    used = _tables_of(" ".join(selects.values()))
    # Tables are passed to the one statement, so nothing is registered in the caller's session.
    text = (with_clause(selects) + f"select * from {name}").replace("{", "{{").replace("}", "}}")
    for table in used:
        text = re.sub(rf"\b(from|join)\s+{table}\b", rf"\1 {{{table}}}", text)
    return spark.sql(text, **{table: read_sample(spark, sf_dir, table) for table in used})
