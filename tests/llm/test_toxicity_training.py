"""The parts of the toxicity training against plain versions."""

from __future__ import annotations

import itertools
import re
from collections import Counter

import numpy as np
import pytest
from helpers import documents, edge_texts, prose
from pyspark.sql import functions as F

from tillroll.llm import toxicity


def plain_stems(word: str) -> set[str]:
    own = re.sub(r"^[\W_]+|[\W_]+$", "", word).lower()
    if not own:
        return set()
    return (
        {f"={own}"} | {f"^{own[:n]}" for n in (3, 4, 5, 6, 7, 8) if n < len(own)} | {f"{own[-n:]}$" for n in (3, 4, 5, 6) if n < len(own)}
    )


def test_every_stem_is_a_feature():
    for word in ["a", "Vile!", "--", "unmentionablewords", "été", "x" * 40, ""]:
        assert set(toxicity.stems(word)) == plain_stems(word)
        found = toxicity.features(word)
        assert len(found) == toxicity.N_FEATURES and sum(f > 0 for f in found) == 2 + len(toxicity.stems(word))


def test_gradient_is_the_slope_of_the_likelihood():
    rng = np.random.default_rng(3)
    lengths = np.array([4, 1, 3])
    words = rng.integers(1, 9, (3, 4, 2))
    tags = rng.integers(0, 2, (3, 4)) * (np.arange(4) < lengths[:, None])

    def likelihood(weights, moves):
        total = 0.0
        for k, n in enumerate(lengths):
            scores = {}
            for path in itertools.product((0, 1), repeat=int(n)):
                own = sum(weights[words[k, t]].sum() for t in range(n) if path[t])
                scores[path] = own + sum(moves[a, b] for a, b in itertools.pairwise(path))
            total += scores[tuple(tags[k, :n])] - np.logaddexp.reduce(list(scores.values()))
        return total

    weights, moves = np.zeros(toxicity.BUCKETS), rng.normal(size=(2, 2))
    weights[1:9] = rng.normal(size=8)
    on_weights, on_moves = toxicity.gradient(weights, moves, words, tags, lengths)
    step = 1e-5
    for i in range(1, 9):
        up, down = weights.copy(), weights.copy()
        up[i] += step
        down[i] -= step
        assert on_weights[i] == pytest.approx((likelihood(up, moves) - likelihood(down, moves)) / (2 * step), abs=1e-5)
    for a, b in itertools.product((0, 1), repeat=2):
        up, down = moves.copy(), moves.copy()
        up[a, b] += step
        down[a, b] -= step
        assert on_moves[a, b] == pytest.approx((likelihood(weights, up) - likelihood(weights, down)) / (2 * step), abs=1e-5)


def test_stems_and_windows_equal_plain_ones(spark):
    texts = [(prose(i, 70) + f" vile{i % 7}ness", 1) for i in range(60)] + [(prose(100 + i, 70), 0) for i in range(90)]
    sample = spark.createDataFrame(texts, "text string, toxic int")
    counts = [Counter(), Counter()]
    for text, toxic in texts:
        counts[toxic].update(set().union(*map(plain_stems, text.split())))
    expected, share = set(), 60 / 150
    for stem in counts[0] | counts[1]:
        t, c = counts[1][stem], counts[0][stem]
        ratio = ((t + 0.5) / 61) / ((c + 0.5) / 91)
        if ratio >= 6 and (t - share * (t + c)) / np.sqrt(share * (1 - share) * (t + c)) >= 4.5:
            expected.add(stem)
    lexicon = toxicity.toxic_stems(sample, 60, 90)
    assert set(lexicon) == expected and "^vile" in expected
    rows = toxicity.windows_of(sample, lexicon).collect()
    assert sum(r["length"] for r in rows) == sum(len(t.split()) for t, _ in texts)
    tagged = sum(bool(toxic) and not expected.isdisjoint(plain_stems(w)) for t, toxic in texts for w in t.split())
    assert sum(sum(r["tags"]) for r in rows) == tagged >= 60
    assert all(len(r["words"]) == 4 * toxicity.SPAN * toxicity.N_FEATURES and len(r["tags"]) == toxicity.SPAN for r in rows)


def test_the_sample_is_bounded_by_rows(spark):
    """An id that stands on many rows gives one of them."""
    hot = spark.range(3000).select(F.lit(1).cast("long").alias("doc_id"), F.concat(F.lit("text "), "id").alias("text"))
    other = spark.range(2, 60).select(F.col("id").alias("doc_id"), F.lit("other").alias("text"))
    labels = spark.range(60).selectExpr("id as doc_id", "1 as quality", "cast(id % 2 as int) as toxic")
    found = toxicity.training_documents(hot.unionByName(other), labels, 10)
    assert found.groupBy("toxic").count().where("count > 10").count() == 0
    everything = toxicity.training_documents(hot.unionByName(other), labels, 1000)
    assert everything.count() == labels.where(~toxicity.held_out(F.col("doc_id"))).where("doc_id > 0").count()


def test_nothing_to_learn_from(spark):
    labels = spark.createDataFrame([(i, 1, i % 2) for i in range(40)], "doc_id long, quality int, toxic int")
    assert toxicity.fit(documents(spark, [""] * 40), labels) is None
    docs = documents(spark, edge_texts(), clashing=True)
    assert toxicity.score(docs, toxicity.fit(docs, labels), ["doc_id", "kept"]).count() == docs.count()
