"""The operators of this folder as queries over the sample tables, and SQL for those that SQL can express."""

from __future__ import annotations

import zlib
from collections.abc import Callable

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.llm import ann, bpe, exact_dedup, merkle, mixing, ngram_join, periodic, quality, secrets, sharding, token_files, toxicity, url_filters
from tillroll.llm.common import table

# Parameters of the registered queries.
SHARDS = [f"shard-{i:03d}" for i in range(64)]
RANKS = "byte_bpe_50k.tiktoken"
MIX = {"clean": 0.90, "low": 0.06, "toxic": 0.04}
TOKENIZER, VOCABULARY, END_ID = "byte_bpe_50k.json", 50_257, 2


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return sharding.assign(documents.select("doc_id"), F.col("doc_id"), SHARDS)


def op2_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op3_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.groups(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    model = toxicity.fit(documents, table(spark, sf_dir, "labels"))
    scored = toxicity.score(documents, model, ["doc_id"])
    return scored.select(
        "doc_id",
        toxicity.held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        "offending",
    )


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    mixed = mixing.mix(documents, labels, MIX, ["doc_id"])
    shares = [F.col("p")[i].alias(f"p_{name}") for i, name in enumerate(mixing.DOMAINS)]
    return mixed.select("doc_id", "n_tokens", *shares, "rate")


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    found = secrets.find(documents, secrets.fit(documents), ["doc_id"])
    base = F.filter("spans", lambda s: s["kind"] != "model")

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"])), ",")

    def count(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", *map(count, ("assign", "access", "hex")), F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(table(spark, sf_dir, "documents"), ["doc_id"])


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path(RANKS))


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    folder = token_files.write_documents(documents, public_tokenizers.path(TOKENIZER), VOCABULARY, END_ID)
    return token_files.read(spark, folder)


def page_outcomes(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """(host, bad) of the pages whose address carries the number of a labelled document."""
    number = F.regexp_extract(url_filters.path_of(F.col("url")), "^/[^/]*/([0-9]{1,18})", 1)
    numbered = pages.select(
        url_filters.host_of(F.col("url")).alias("host"),
        F.when(number != "", number.cast("long")).alias("number"),
    )
    bad = ((F.col("quality") == 0) | (F.col("toxic") == 1)).cast("int")
    marks = labels.select(F.col("doc_id").alias("number"), bad.alias("bad"))
    return numbered.where("number is not null").join(marks, "number").select("host", "bad")


def op10_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    outcomes = page_outcomes(pages, table(spark, sf_dir, "labels"))
    return url_filters.judge(pages, outcomes).drop("bound")


LEAF_FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    fields = {name: F.col(name) for name in LEAF_FIELDS}
    lowered = F.translate("text", url_filters.UPPER, url_filters.LOWER)
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    seen = F.when(tampered, merkle.leaf_digest((fields | {"text": lowered}).values()))
    leaves = documents.select(
        F.col("lang").alias("tree"),
        merkle.leaf_digest(fields.values()).alias("digest"),
        F.struct("doc_id", seen.alias("seen")).alias("own"),
    )
    found = merkle.manifest(leaves).select(
        F.col("own.doc_id").alias("doc_id"),
        merkle.hex_text(F.col("digest")).alias("leaf"),
        merkle.hex_text(F.col("subroot")).alias("subroot"),
        merkle.hex_text(F.col("root")).alias("root"),
        merkle.proof_digest(F.col("witness")).alias("proof_sha256"),
        merkle.folded(F.coalesce("own.seen", "digest"), F.col("witness")).alias("folded_root"),
    )
    return found.withColumn("verified", F.col("folded_root") == F.col("root"))


def repeats_of(keys: pa.Array, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The documents that are to repeat, by a checksum of the id: from which word, and with which period."""
    crc = np.array([zlib.crc32(str(k).encode()) if k is not None else 1 for k in keys.to_pylist()], np.int64)
    first = crc // 10 % np.maximum(counts, 1)
    period = 1 + (counts - first) // (3 + crc // 10 % 8)
    return first, np.where(crc % 10 == 0, period, 0)


def op12_periodic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.digest(table(spark, sf_dir, "documents"), ["doc_id"], key_col="doc_id", rewrite=repeats_of)


def op13_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact_dedup.dedup(table(spark, sf_dir, "documents"))
    return found.select(
        F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256")
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_sharding": op1_sharding,
    "op2_ann": op2_ann,
    "op3_ngram_join": op3_ngram_join,
    "op4_toxicity": op4_toxicity,
    "op5_mixing": op5_mixing,
    "op6_secrets": op6_secrets,
    "op7_quality": op7_quality,
    "op8_bpe": op8_bpe,
    "op9_token_files": op9_token_files,
    "op10_url_filters": op10_url_filters,
    "op11_merkle": op11_merkle,
    "op12_periodic": op12_periodic,
    "op13_exact_dedup": op13_exact_dedup,
}


def _level(key: str, parent: str) -> str:
    """CTEs of one level: prior strength per parent, then each key's posterior."""
    return f"""
{key}_sums as (
  select {parent}, sum(n)::double as total, sum(bad)::double as bads, sum((bad * bad)::double / n) as squares,
         sum((n * n)::double) as sizes, count(*)::double as kids
  from {key}_counts group by {parent}),
{key}_prior as (
  select {parent}, case when spread > 0 then least({url_filters.MOST_STRENGTH}::double,
           greatest({url_filters.LEAST_STRENGTH}::double, noise / spread - 1))
         else {url_filters.MOST_STRENGTH}::double end as strength
  from (select *, case when kids > 1 and total > kids
                       then (squares - bads * (bads / total) - (kids - 1) * noise) / (total - sizes / total) end as spread
        from (select *, (bads / total) * (1 - bads / total) as noise from {key}_sums))),
{key}_rates as (
  select c.{key}, (c.bad + p.strength * a.mean) / (c.n + p.strength) as mean, c.n + p.strength as weight
  from {key}_counts c join {key}_prior p using ({parent}) join {parent}_rates a using ({parent}))"""


_LISTED = ", ".join(f"'{s}'" for s in url_filters.SUFFIXES)


def _bound(name: str) -> str:
    return f"{name}.mean - {url_filters.BOUND_SDS}::double * sqrt({name}.mean * (1 - {name}.mean) / ({name}.weight + 1))"


def _rule_cases(column: str) -> str:
    ranked = sorted(url_filters.RULES, key=lambda r: (-len(r[1] + r[2]), r[1] + r[2]))
    value = {"rule": lambda v, h, p: h + p, "verdict": lambda v, h, p: v}[column]
    return "case " + " ".join(
        f"when (host = '{h}' or ends_with(host, '.{h}')) and starts_with(path, '{p}') then '{value(v, h, p)}'"
        for v, h, p in ranked
    ) + " end"


# Levels that the SQL of op11 writes out: enough for 8**7 documents of one language.
SQL_LEVELS = 7
SQL_CRC = """xor(list_reduce(list_transform(string_split(cast(doc_id as varchar), ''), lambda x: ascii(x)::bigint),
    lambda c, b: list_reduce(range(8), lambda x, i: xor(x >> 1, 3988292384 * (x & 1)), xor(c, b)), 4294967295::bigint),
    4294967295::bigint)"""


def _sql_field(name: str) -> str:
    text = f"cast({name} as varchar)"
    return f"coalesce(strlen({text}) || ':' || {text}, '-')"


def _sql_tree(start: str, part: str, tag: str) -> str:
    """CTEs of one kind of tree: `{tag}0` holds (part, node, h); afterwards `{tag}_root` has each tree's root and
    `{tag}_path` every leaf's siblings of all levels."""
    ctes = [f"{tag}0 as ({start})"]
    for k in range(SQL_LEVELS):
        runs = f"partition by {part}, node // 8 order by node rows between unbounded preceding and"
        ctes.append(f"""{tag}{k}_full as (select *, max(node) over (partition by {part}) as last,
  coalesce(string_agg(h, '') over ({runs} 1 preceding), '') as left_,
  coalesce(string_agg(h, '') over (partition by {part}, node // 8 order by node rows between 1 following and unbounded following), '') as right_
  from {tag}{k})""")
        ctes.append(f"""{tag}{k + 1} as (select {part}, node // 8 as node,
  case when max(last) = 0 then min(h) else sha256(string_agg(h, '' order by node)) end as h
  from {tag}{k}_full group by {part}, node // 8)""")
    ctes.append(f"{tag}_root as (select {part}, h as root from {tag}{SQL_LEVELS})")
    return ",\n".join(ctes)


def _sql_climb(tag: str, part: str, own: str, levels: str) -> tuple[str, str, str]:
    """Joins, the siblings of all levels end to end, and the root that `own` leads to."""
    joins, path, fold = "", [], own
    for k in range(SQL_LEVELS):
        joins += f" join {tag}{k}_full {tag}f{k} on {tag}f{k}.{part} is not distinct from {levels}.{part} and {tag}f{k}.node = {levels}.{tag}_node // {8**k}"
        path.append(f"{tag}f{k}.left_ || {tag}f{k}.right_")
        fold = f"case when {tag}f{k}.last = 0 then {fold} else sha256({tag}f{k}.left_ || {fold} || {tag}f{k}.right_) end"
    return joins, " || ".join(path), fold


def _merkle_sql() -> str:
    leaf = "sha256(" + " || ".join(map(_sql_field, LEAF_FIELDS)) + ")"
    seen = "sha256(" + " || ".join(_sql_field(n) for n in LEAF_FIELDS[:-1]) + " || " + _sql_field(
        f"translate(text, '{url_filters.UPPER}', '{url_filters.LOWER}')") + ")"
    up_joins, up_path, up_fold = _sql_climb("d", "lang", "l.seen", "l")
    top_joins, top_path, top_fold = _sql_climb("r", "one", "s.folded", "s")
    return f"""
with hashed as (
  select doc_id, lang, {leaf} as leaf, case when {SQL_CRC} % 3 = 0 then {seen} else {leaf} end as seen from documents),
l as (select *, row_number() over (partition by lang order by doc_id nulls first, leaf) - 1 as d_node from hashed),
{_sql_tree("select lang, d_node as node, leaf as h from l", "lang", "d")},
names as (select 1 as one, lang, root as subroot, row_number() over (order by lang nulls first) - 1 as r_node from d_root),
{_sql_tree("select one, r_node as node, subroot as h from names", "one", "r")},
s as (
  select l.doc_id, l.leaf, l.lang, n.one, n.r_node, n.subroot, {up_path} as path, {up_fold} as folded
  from l join names n on n.lang is not distinct from l.lang{up_joins}),
t as (
  select s.doc_id, s.leaf, s.subroot, rr.root, sha256(s.path || {top_path}) as proof_sha256, {top_fold} as folded_root
  from s join r_root rr on rr.one = s.one{top_joins})
select *, folded_root = root as verified from t
"""


ORACLES: dict[str, str] = {
    "op11_merkle": _merkle_sql(),
    "op13_exact_dedup": """
select doc_id, max(doc_id) over same as keep_id, count(*) over same as group_size,
       doc_id = max(doc_id) over same as kept, sha256(coalesce(text, '')) as text_sha256
from documents window same as (partition by coalesce(text, ''))
""",
    "op10_url_filters": rf"""
with rests as (
  select page_id, case when strpos(url, '://') > 0 then substr(url, strpos(url, '://') + 3) else '' end as rest from pages),
seen as (
  select page_id, translate(regexp_extract(rest, '^[^/?#]*'), '{url_filters.UPPER}', '{url_filters.LOWER}') as host,
         regexp_extract(regexp_extract(rest, '^[^?#]*'), '/[\s\S]*$') as path
  from rests),
named as (
  select *, regexp_replace(host, ':[0-9]*$', '') as name from seen),
cut as (
  select *, regexp_extract(name, '[^.]*$') as one, case when strpos(name, '.') > 0 then regexp_extract(name, '[^.]*\.[^.]*$') else name end as two,
         regexp_matches(name, '{url_filters.ADDRESS}') as address
  from named),
parts as (
  select page_id, host, path,
         case when address then name when two not in ({_LISTED}) then two
              when two = name then name else regexp_extract(name, '[^.]*\.[^.]*\.[^.]*$') end as domain,
         case when address then 'address' when two in ({_LISTED}) then two else one end as suffix
  from cut),
outcomes as (
  select p.host, p.domain, p.suffix, case when l.quality = 0 or l.toxic = 1 then 1 else 0 end as bad
  from parts p join labels l on l.doc_id = try_cast(regexp_extract(p.path, '^/[^/]*/([0-9]{{1,18}})', 1) as bigint)),
host_counts as (select host, domain, suffix, count(*) as n, sum(bad)::bigint as bad from outcomes group by all),
domain_counts as (select domain, suffix, sum(n)::bigint as n, sum(bad)::bigint as bad from host_counts group by all),
suffix_counts as (select suffix, 1 as every_, sum(n)::bigint as n, sum(bad)::bigint as bad from domain_counts group by all),
every__rates as (select every_, sum(bad)::double / sum(n) as mean, sum(n)::double as weight from suffix_counts group by every_),
{_level("suffix", "every_")},
{_level("domain", "suffix")},
{_level("host", "domain")}
select page_id, host, path, {_rule_cases("rule")} as rule,
       coalesce({_rule_cases("verdict")},
                case when coalesce({_bound("h")}, {_bound("d")}, {_bound("s")}, {_bound("e")}, 0) > {url_filters.LIMIT}
                     then 'block' else 'allow' end) as verdict
from parts left join host_rates h using (host) left join domain_rates d using (domain)
     left join suffix_rates s using (suffix) left join every__rates e on true
""",
}
