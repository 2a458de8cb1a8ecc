"""Mixing to target weights over soft domains.

A table of labelled documents teaches a naive Bayes classifier over the beginnings of words; it gives every
document a probability for each domain. A document then stands for its tokens in every domain in proportion.
Rates, one per document and not negative, are fitted so that the expected tokens of all domains meet their
targets: projected gradient descent on the squared misses, each domain weighed by its size. One step needs
the domain totals alone, a handful of sums over all documents; a document's rate follows from its own
probabilities and the misses of the steps so far, so no state is kept for it between steps.

Null and empty texts have no tokens; their probabilities are the shares of the labels. A document labelled
twice counts as the worse domain; null labels are left out. Repeated rows each have a rate, and equal rows
equal ones. Without documents or labels the result is empty, or every document belongs to all domains alike.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import stored

DOMAINS = ("clean", "low", "toxic")
# Labelled documents that the classifier learns from, at most: those whose hashed ids are least.
SAMPLE = 6000
BUCKETS = 4096
# A long text weighs as so many words; otherwise one domain would take nearly all of every document.
EVIDENCE_WORDS = 60.0
SIGNS = "!%#$*&|<>?~^@"
SPACE = "[ \\t\\n\\x0B\\f\\r]+"
STEPS, CLOSE = 25, 1e-4


def words(text: Column) -> Column:
    """Words of a text; no empty ones."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE), lambda w: w != "")


def bucket(word: Column) -> Column:
    """Hash of a word's first four characters, or of its last one if that is a sign."""
    last = F.substring(word, -1, 1)
    return F.pmod(F.hash(F.when(F.instr(F.lit(SIGNS), last) > 0, last).otherwise(F.substring(word, 1, 4))), F.lit(BUCKETS))


def domain_of(quality: Column, toxic: Column) -> Column:
    """Index of the domain of a label."""
    return F.when(toxic == 1, 2).when(quality == 0, 1).when((quality == 1) & (toxic == 0), 0)


def _literal(values: list[float]) -> Column:
    """A constant array, parsed at once and folded by the optimizer."""
    return F.expr("array(" + ",".join(f"{v!r}D" for v in values) + ")")


def classifier(documents: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> tuple[list[float], list[list[float]]]:
    """Log shares of the domains, and each domain's log share of every bucket (a table of fixed size)."""
    marks = labels.select(F.col("doc_id").alias("__id"), domain_of(F.col("quality"), F.col("toxic")).alias("d"))
    marks = marks.where("d is not null and __id is not null").groupBy("__id").agg(F.max("d").alias("d"))
    shares = {r["d"]: r["count"] for r in marks.groupBy("d").count().collect()}
    prior = [math.log((shares.get(d, 0) + 1) / (sum(shares.values()) + len(DOMAINS))) for d in range(len(DOMAINS))]
    few = marks.orderBy(F.xxhash64("__id"), "__id").limit(sample)
    texts = documents.select(F.col("doc_id").alias("__doc"), F.col("text").alias("__text"))
    found = texts.join(F.broadcast(few), F.col("__doc") == F.col("__id"))
    counted = (
        found.select("d", F.explode(words(F.col("__text"))).alias("w"))
        .groupBy(bucket(F.col("w")).alias("b"), "d").count().collect()
    )
    counts = [[1.0] * BUCKETS for _ in DOMAINS]
    for row in counted:
        counts[row["d"]][row["b"]] += row["count"]
    return prior, [[math.log(c / sum(own)) for c in own] for own in counts]


def posteriors(documents: DataFrame, prior: list[float], tables: list[list[float]], keep: list[str], text_col: str = "text") -> DataFrame:
    """The columns `keep`, `n_tokens`, and `p` with one probability per domain, of every whole text."""
    # Against the first domain, so one table fewer is read per word.
    logs = [_literal([a - b for a, b in zip(own, tables[0])]) for own in tables[1:]]
    hashed = documents.select(*keep, F.transform(words(F.col(text_col)), bucket).alias("__b"))
    n = F.size("__b")
    weight = F.when(n > 0, F.least(n.cast("double"), F.lit(EVIDENCE_WORDS)) / n).otherwise(0.0)

    def evidence(table: Column) -> Column:
        return F.aggregate("__b", F.lit(0.0), lambda total, b: total + F.element_at(table, b + 1))

    scores = [F.lit(0.0)] + [F.lit(prior[d] - prior[0]) + weight * evidence(logs[d - 1]) for d in range(1, len(DOMAINS))]
    scored = hashed.select(*keep, n.cast("long").alias("n_tokens"), F.array(*scores).alias("__s"))
    powers = F.transform("__s", lambda s: F.exp(s - F.array_max("__s")))
    scored = scored.select(*keep, "n_tokens", powers.alias("__e"))
    total = F.aggregate("__e", F.lit(0.0), lambda a, x: a + x)
    return scored.select(*keep, "n_tokens", F.transform("__e", lambda x: x / total).alias("p"))


def _rate(misses: list[list[float]], most: float | None) -> Column:
    """A document's rate after the steps whose misses are given."""
    rate = F.lit(1.0)
    for own in misses:
        move = sum((F.col("p")[d] * float(miss) for d, miss in enumerate(own)), F.lit(0.0))
        rate = F.greatest(F.lit(0.0), rate - move)
        if most is not None:
            rate = F.least(F.lit(float(most)), rate)
    return rate


def fit_rates(members: DataFrame, targets: dict[str, float], most: float | None = None, steps: int = STEPS) -> list[list[float]]:
    """Misses of every step, from which `_rate` makes the rates.

    `targets` are weights of the domains. They are met at the tokens that the table has. Where rates are
    bounded by `most`, the total is what the first domain allows; a domain that is scarcer than its target
    keeps all it has.
    """
    masses = [F.col("p")[d] * F.col("n_tokens") for d in range(len(DOMAINS))]

    def totals(misses: list[list[float]]) -> list[float]:
        rate = _rate(misses, most)
        row = members.agg(*[F.sum(rate * mass) for mass in masses]).first()
        return [x or 0.0 for x in row]

    sizes = totals([])
    weights = [max(0.0, targets[d]) for d in DOMAINS]
    if not sum(sizes) or not sum(weights):
        return []
    whole = sum(sizes)
    if most is not None:
        whole = most * sizes[0] * sum(weights) / weights[0] if weights[0] else whole
    wanted = [whole * w / sum(weights) for w in weights]
    misses: list[list[float]] = []
    now = sizes
    for _ in range(steps):
        # Probabilities are at most one, so with each domain weighed by its size a full step is safe.
        misses.append([(have - want) / size if size else 0.0 for have, want, size in zip(now, wanted, sizes)])
        now = totals(misses)
        missing = [have - want if most is None else max(0.0, have - want) for have, want in zip(now, wanted)]
        if max(map(abs, missing)) <= CLOSE * whole:
            break
    return misses


def mix(
    documents: DataFrame, labels: DataFrame, targets: dict[str, float], keep: list[str],
    most: float | None = None, sample: int = SAMPLE,
) -> DataFrame:
    """The columns `keep`, `n_tokens`, `p` and `rate` of every document."""
    prior, tables = classifier(documents, labels, sample)
    members = stored(posteriors(documents, prior, tables, keep), "mixing")
    return members.withColumn("rate", _rate(fit_rates(members, targets, most), most))


def chosen(key: Column, rate: Column) -> Column:
    """Whether a document is taken at a rate of at most one, by a hash of its key."""
    return F.pmod(F.xxhash64(key), F.lit(1_000_000)) < rate * 1_000_000
