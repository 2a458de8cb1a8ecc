from __future__ import annotations

import hashlib
import json
import math

import numpy as np
import pytest
from pyspark.sql import functions as F
from conftest import rows

from tillroll import schemas
from tillroll.operators import enrichment, model_calls, retrieval
from tillroll.streaming import incremental


def texts(spark, *values):
    return spark.createDataFrame(list(enumerate(values, 1)), "review_id long, review_text string")


@pytest.mark.parametrize(
    ("raw", "answer"),
    [
        ('{"sentiment":"negative","issue_type":"wrong_item","urgency":"high"}',
         ("negative", "wrong_item", "high")),
        ('Sure: {"sentiment":"positive"} done', ("positive", "none", "low")),
        ('{"sentiment":"negative","issue_type":"bogus"}', ("negative", "none", "low")),
        ('{"sentiment":null,"urgency":"high"}', ("neutral", "none", "high")),
        ('{"sentiment":"negative"} {"sentiment":"positive"}', ("neutral", "none", "low")),
        ('{"sentiment":"negative"}, {"sentiment":"positive"}', ("neutral", "none", "low")),
        ('{"sentiment":"negative"', ("neutral", "none", "low")),
        ("no json", ("neutral", "none", "low")),
        ("{'sentiment':'negative','issue_type':'wrong_item'}", ("neutral", "none", "low")),
        ('{"sentiment":"negative",}', ("neutral", "none", "low")),
        ("}{", ("neutral", "none", "low")),
        ("", ("neutral", "none", "low")),
        (None, ("neutral", "none", "low")),
        ('line one\n{"sentiment":\n"mixed"}\n', ("mixed", "none", "low")),
        ('{"sentiment":"odd","issue_type":["none"],"urgency":5}', ("odd", "none", "5")),
    ],
)
def test_parse_answers(spark, raw, answer):
    df = spark.createDataFrame([(1, raw)], "review_id long, raw string")
    assert tuple(enrichment.parse_enrichment(df).first())[1:] == answer


def test_rules(spark):
    reviews = texts(
        spark,
        "It came LATE.",
        "The box was crushed and it came late, I want a refund",
        "Really happy with it",
        "Plate is fine",
        "",
        None,
    )
    assert rows(enrichment.enrich_reviews(reviews)) == [
        (1, "negative", "shipping_delay", "medium"),
        (2, "negative", "packaging_damage", "high"),
        (3, "positive", "none", "low"),
        (4, "neutral", "none", "low"),
        (5, "neutral", "none", "low"),
        (6, "neutral", "none", "low"),
    ]


def test_model_is_asked_in_batches(spark):
    def make_scorer():
        def score(batch):
            return [json.dumps({"sentiment": "negative" if "bad" in t else "positive"}) for t in batch]

        return score

    got = rows(enrichment.enrich_reviews(texts(spark, "bad one", "fine", None), make_scorer))
    assert [r[1] for r in got] == ["negative", "positive", "positive"]


def test_pending(spark):
    reviews = spark.createDataFrame([(3, "c"), (1, "a"), (2, "b"), (None, "n")], "review_id long, t string")
    done = spark.createDataFrame([(2,), (None,)], "review_id long")
    assert rows(incremental.pending(reviews, done, "review_id")) == [(1, "a"), (3, "c"), (None, "n")]
    assert rows(incremental.pending(reviews, done, "review_id", 1)) == [(1, "a")]
    assert len(rows(incremental.pending(reviews, done, "review_id", 10))) == 3
    assert rows(incremental.pending(reviews, done, "review_id", 0)) == []


def test_enrichment_goes_on_where_it_stopped(spark, tmp_path):
    reviews = texts(spark, *["late"] * 5).union(texts(spark, "happy"))
    path = str(tmp_path / "enriched")
    assert incremental.enrich_pending(reviews, path, limit=2).count() == 2
    assert incremental.enrich_pending(reviews, path, limit=2).count() == 4
    assert incremental.enrich_pending(reviews, path).count() == 5
    again = incremental.enrich_pending(reviews, path)
    assert [r[0] for r in rows(again.select("review_id"))] == [1, 2, 3, 4, 5]


def hashed(text, width):
    vector = np.zeros(width)
    for word in text.lower().split():
        vector[int(hashlib.md5(word.encode()).hexdigest()[:8], 16) % width] += 1
    length = math.sqrt((vector**2).sum())
    return vector / length if length else vector


def test_built_in_embedding(spark):
    values = ["One two two", "ÉTÉ chaud\n\tété", "", "x " * 3000]
    for width in (768, 16):
        got = retrieval.build_embeddings(texts(spark, *values), width=width)
        for r in got.collect():
            want = hashed(values[r["review_id"] - 1], width).astype(np.float32)
            assert np.array_equal(np.array(r["embedding"], dtype=np.float32), want)


def test_built_in_jobs_go_through_a_text_once(spark):
    reviews = texts(spark, "Came late, and broken", None)
    for job in (enrichment.classify_by_rules, retrieval.build_embeddings):
        plan = job(reviews)._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("lower(") == 1 and "split(" not in plan and "Contains(lower" not in plan
    rules = enrichment.classify_by_rules(reviews)._jdf.queryExecution().optimizedPlan().toString()
    assert rules.count("regexp_extract_all(") == 1
    assert rows(enrichment.classify_by_rules(reviews)) == [
        (1, "negative", "shipping_delay", "medium"), (2, "neutral", "none", "low"),
    ]


def test_embedding_by_a_model_and_only_complaints(spark, tmp_path):
    reviews = spark.createDataFrame(
        [(i, 1, 1, 1, None, rating, "t" * i, "none") for i, rating in enumerate((1, 3, 4, None), 1)],
        schemas.REVIEWS,
    )

    def make_embedder():
        return lambda batch: [[float(len(t)), 1.0] for t in batch]

    path = str(tmp_path / "index")
    index = incremental.embed_pending(reviews, path, make_embedder, width=2)
    assert rows(index) == [(1, [1.0, 1.0]), (2, [2.0, 1.0])]
    assert incremental.embed_pending(reviews, path, make_embedder, width=2).count() == 2


def test_model_vector_of_wrong_width_is_an_error(spark):
    with pytest.raises(Exception, match="expected 3 values, got 2"):
        retrieval.build_embeddings(
            texts(spark, "a"), lambda: lambda batch: [[1.0, 2.0] for _ in batch], width=3
        ).collect()


def flaky(log):
    """A scorer that fails now and then, and always on some texts."""

    def make_scorer():
        calls = []

        def answer(batch):
            calls.append(len(batch))
            with open(log, "a") as out:
                out.write("".join(f"{t}\n" for t in batch))
            if len(calls) % 5 == 1:
                raise TimeoutError("now and then")
            if any(t.endswith("7") for t in batch):
                raise ValueError("cannot read this")
            return ['{"sentiment": "negative"}' for _ in batch]

        return answer

    return make_scorer


def test_a_failing_model_loses_no_answer(spark, tmp_path):
    reviews = spark.range(200).selectExpr("id as review_id", "concat('text ', id) as review_text")
    path, log = str(tmp_path / "enrichment"), str(tmp_path / "log")
    stored = incremental.enrich_pending(reviews, path, flaky(log), parts=3)
    bad = {i for i in range(200) if i % 10 == 7}
    assert {r["review_id"] for r in stored.collect()} == set(range(200)) - bad
    aside = incremental.failures(spark, path).collect()
    assert {r["review_id"] for r in aside} == bad and all("cannot read this" in r["error"] for r in aside)
    asked = len(open(log).read().split("\n"))
    assert incremental.enrich_pending(reviews, path, flaky(log), parts=3).count() == 180
    assert len(open(log).read().split("\n")) == asked  # neither done nor put aside is asked again
    mended = incremental.enrich_pending(reviews, path, lambda: lambda b: ["{}"] * len(b), retry_failed=True)
    assert mended.count() == 200


def test_parts_that_are_done_stay_done(spark, tmp_path, monkeypatch):
    reviews = spark.range(90).selectExpr("id as review_id", "concat('text ', id) as review_text")
    path, answers, seen = str(tmp_path / "enrichment"), incremental.model_answers, []

    def dies(rows, make_scorer):
        seen.append(1)
        if len(seen) == 3:
            raise RuntimeError("the driver is gone")
        return answers(rows, make_scorer)

    monkeypatch.setattr(incremental, "model_answers", dies)
    with pytest.raises(RuntimeError):
        incremental.enrich_pending(reviews, path, lambda: lambda b: ["{}"] * len(b), parts=4)
    first = incremental.read_table_version(spark, path, schemas.REVIEW_ENRICHMENT).count()
    assert 0 < first < 90
    assert incremental.enrich_pending(reviews, path, lambda: lambda b: ["{}"] * len(b), parts=4).count() == 90


def test_vectors_of_wrong_width_are_put_aside(spark, tmp_path):
    reviews = spark.range(20).selectExpr("id as review_id", "2 as rating", "repeat('t', cast(id as int)) as review_text")
    path = str(tmp_path / "index")
    index = incremental.embed_pending(reviews, path, lambda: lambda b: [[1.0] * (3 if len(t) == 5 else 2) for t in b], width=2, parts=2)
    assert index.count() == 19
    assert [tuple(r) for r in incremental.failures(spark, path).collect()] == [(5, "expected 2 values, got 3")]


def test_a_model_that_answers_too_little_fails(spark):
    with pytest.raises(Exception, match="0 answers to 1 texts"):
        enrichment.enrich_reviews(texts(spark, "a"), lambda: lambda batch: []).collect()


def brute_force(questions, index, reviews, k):
    """Exact top-k in plain Python, joined with the reviews before the limit."""
    found = []
    for qid, q in questions:
        scored = []
        for rid, v in index:
            for review_id, rating, text in reviews:
                if review_id != rid:
                    continue
                length = np.linalg.norm(v if v else 0) * np.linalg.norm(q)
                score = round(float(np.dot(v, q) / length), 9) if v and length else None
                scored.append((score is None, -(score or 0), rid, rating, text))
        for rank, (missing, minus, rid, rating, text) in enumerate(sorted(scored)[:k], 1):
            found.append((qid, rank, rid, rating, text, None if missing else -minus))
    return sorted(found)


@pytest.mark.parametrize("orphans", [3, 100])
@pytest.mark.parametrize(("block_rows", "question_bytes"), [(2, 0), (1024, 0), (3, 1 << 20)])
def test_retrieval_equals_brute_force(spark, monkeypatch, block_rows, question_bytes, orphans):
    monkeypatch.setattr(retrieval, "BLOCK_ROWS", block_rows)
    monkeypatch.setattr(retrieval, "QUESTION_BYTES", question_bytes)
    monkeypatch.setattr(retrieval, "SLICE_ROWS", 10)
    monkeypatch.setattr(retrieval, "ORPHANS", orphans)
    monkeypatch.setattr(retrieval, "HELD_HITS", 9)
    monkeypatch.setattr(retrieval, "BROADCAST_HITS", 10 if block_rows == 2 else 100_000)
    rng = np.random.default_rng(1)
    index = [(i, rng.integers(-3, 4, 4).astype(float).tolist()) for i in range(60)]
    index += [(60, [0.0] * 4), (61, None)]
    reviews = [(i, 1 + i % 5, f"text {i}") for i in range(0, 62, 2)]
    reviews += [(4, 1, "second text"), (61, 1, "no vector")]
    questions = [(i, rng.integers(-3, 4, 4).astype(float).tolist()) for i in range(5)]
    got = retrieval.retrieve(
        spark.createDataFrame(questions, "question_id long, question array<float>"),
        spark.createDataFrame(index, "review_id long, embedding array<float>").repartition(4),
        spark.createDataFrame(reviews, "review_id long, rating int, review_text string"),
        k=7,
    )
    assert sorted(tuple(r) for r in got.collect()) == brute_force(questions, index, reviews, 7)


@pytest.mark.parametrize("seed", range(5))
def test_best_hits_merge_in_any_order(seed):
    rng = np.random.default_rng(seed)
    asked, vectors = rng.integers(-2, 3, (9, 3)).astype(float), rng.integers(-2, 3, (80, 3)).astype(float)
    ids = rng.permutation(80).astype(np.int64)
    whole = retrieval.tile_best(asked, ids, vectors, 6)
    held, cuts = retrieval.NO_HITS, np.sort(rng.choice(80, 5, replace=False))
    parts = [p for p in np.split(rng.permutation(80), cuts) if len(p)]
    for part in parts:  # ties among the copies are common with so few different vectors
        held = retrieval.merge_best(retrieval.tile_best(asked, ids[part], vectors[part], 6), held, 6)
    assert [x.tolist() for x in held] == [x.tolist() for x in whole]
    for q in range(9):
        with np.errstate(divide="ignore", invalid="ignore"):
            score = np.round(vectors @ asked[q] / np.linalg.norm(vectors, axis=1) / np.linalg.norm(asked[q]), 9)
        score = np.where(np.isfinite(score), score, -np.inf)
        expected = sorted(zip(-score, ids.tolist()))[:6]
        assert whole[1][whole[0] == q].tolist() == [i for _, i in expected]


def test_many_questions_stay_distributed(spark, monkeypatch):
    """More questions than may be broadcast: each finds itself first, and no step collects them."""
    monkeypatch.setattr(retrieval, "QUESTION_BYTES", 1000)
    monkeypatch.setattr(retrieval, "SLICE_ROWS", 1500)
    vectors = spark.range(5000).selectExpr("id", "array(cast(id % 71 as float), cast(id % 73 as float), 1f) as v")
    index = vectors.select(F.col("id").alias("review_id"), F.col("v").alias("embedding"))
    reviews = spark.range(5000).selectExpr("id as review_id", "1 as rating", "'t' as review_text")
    questions = vectors.select(F.col("id").alias("question_id"), F.col("v").alias("question"))
    collect, sizes = type(questions).collect, []

    def counted(df):
        rows = collect(df)
        sizes.append(len(rows))
        return rows

    with monkeypatch.context() as patch:
        patch.setattr(type(questions), "collect", counted)
        found = retrieval.retrieve(questions, index, reviews, 2)
    assert max(sizes) <= 1
    assert found.where("rank = 1 and question_id = review_id and score = 1").count() == 5000
    assert found.count() == 10_000


def test_copies_of_one_vector_are_ranked_by_id(spark):
    index = spark.range(30_000, numPartitions=3).selectExpr(
        "29999 - id as review_id",
        "if(id % 3 = 0, array(1f, 1f), array(cast(id as float), -1f)) as embedding",
    )
    reviews = spark.range(30_000).selectExpr("id as review_id", "1 as rating", "'t' as review_text")
    questions = spark.createDataFrame([(0, [2.0, 2.0])], "question_id long, question array<float>")
    got = retrieval.retrieve(questions, index, reviews, 4).orderBy("rank")
    assert [(r["review_id"], r["score"]) for r in got.collect()] == [
        (2, 1.0), (5, 1.0), (8, 1.0), (11, 1.0),
    ]


def test_vectors_without_length_come_last(spark):
    index = spark.createDataFrame(
        [(1, [0.0, 0.0]), (2, [-1.0, 0.0]), (3, None)], "review_id long, embedding array<float>"
    )
    reviews = spark.range(1, 4).selectExpr("id as review_id", "1 as rating", "'t' as review_text")
    questions = spark.createDataFrame([(0, [1.0, 0.0])], "question_id long, question array<float>")
    got = retrieval.retrieve(questions, index, reviews, 5)
    assert [(r["review_id"], r["score"]) for r in got.orderBy("rank").collect()] == [
        (2, -1.0), (1, None), (3, None),
    ]


def test_stored_vector_of_wrong_width_is_an_error(spark):
    index = spark.createDataFrame([(1, [1.0, 2.0, 3.0])], "review_id long, embedding array<float>")
    reviews = spark.createDataFrame([(1, 1, "t")], "review_id long, rating int, review_text string")
    questions = spark.createDataFrame([(0, [1.0, 0.0])], "question_id long, question array<float>")
    with pytest.raises(Exception, match="expected 2 values, got 3"):
        retrieval.retrieve(questions, index, reviews).collect()


def test_repeated_question_ids_are_an_error(spark):
    questions = spark.createDataFrame([(0, [1.0]), (0, [2.0])], "question_id long, question array<float>")
    index = spark.createDataFrame([(1, [1.0])], "review_id long, embedding array<float>")
    reviews = spark.createDataFrame([(1, 1, "t")], "review_id long, rating int, review_text string")
    with pytest.raises(ValueError, match="more than one question"):
        retrieval.retrieve(questions, index, reviews)


def test_question_vectors_of_two_widths_are_an_error(spark):
    index = spark.createDataFrame([(1, [1.0])], "review_id long, embedding array<float>")
    reviews = spark.createDataFrame([(1, 1, "t")], "review_id long, rating int, review_text string")
    for vectors in ([[1.0], [1.0, 2.0]], [[1.0], None], [[], []]):
        questions = spark.createDataFrame(list(enumerate(vectors)), "question_id long, question array<float>")
        with pytest.raises(ValueError, match="one width"):
            retrieval.retrieve(questions, index, reviews)


def test_no_questions(spark):
    questions = spark.createDataFrame([], "question_id long, question array<float>")
    index = spark.createDataFrame([(1, [1.0])], "review_id long, embedding array<float>")
    reviews = spark.createDataFrame([(1, 1, "t")], "review_id long, rating int, review_text string")
    assert retrieval.retrieve(questions, index, reviews).collect() == []


def test_prompt_lines(spark):
    hits = spark.createDataFrame(
        [(0, 2, 8, 1, "late", 0.5), (0, 1, 7, 2, "broke\nsoon", 0.9), (1, 1, 7, 2, "x", 0.1)],
        "question_id long, rank int, review_id long, rating int, review_text string, score double",
    )
    assert rows(retrieval.rag_context(hits)) == [
        (0, "[review 7] (rating 2/5): broke\nsoon\n[review 8] (rating 1/5): late"),
        (1, "[review 7] (rating 2/5): x"),
    ]


def test_prompt_with_its_question(spark):
    contexts = spark.createDataFrame([(1, "[review 7] (rating 2/5): late")], "question_id long, context string")
    questions = spark.createDataFrame([(1, "why?", "x"), (2, "who?", "y")], "question_id long, question_text string, more string")
    assert rows(retrieval.rag_prompt(contexts, questions)) == [
        (1, "Question: why?\n\nReview excerpts:\n[review 7] (rating 2/5): late"),
        (2, "Question: who?\n\nReview excerpts:\n"),
    ]


def test_top_k_of_one_list(spark):
    df = spark.createDataFrame([(1, 0.5), (2, None), (3, 0.9), (0, 0.5)], "id long, score double")
    assert [r["id"] for r in retrieval.top_k(df, "score", 3, ties=["id"]).collect()] == [3, 0, 1]
    assert [r["id"] for r in retrieval.top_k(df, "score", 9, ties=["id"]).collect()] == [3, 0, 1, 2]


def test_calls_that_fail_share_the_wait(monkeypatch):
    waits, tried = [], []
    monkeypatch.setattr(model_calls.time, "sleep", waits.append)

    def call(texts):
        tried.append(tuple(texts))
        if "bad" in texts:
            raise ValueError("cannot read this")
        return [t.upper() for t in texts]

    def given(n_bad):
        texts = ["bad" if i % 50 == 7 and i < 50 * n_bad else f"t{i}" for i in range(2000)]
        waits.clear(), tried.clear()
        found = model_calls.answers_of(call, texts, 3, 0.1, 64)
        assert found == [(None, "ValueError: cannot read this") if t == "bad" else (t.upper(), None) for t in texts]
        assert tried.count(("bad",)) == 3 * n_bad
        return sum(waits)

    assert given(40) == pytest.approx(given(1)) == pytest.approx(7 * 0.3)
    # A model that answers nothing gets as much time as calls one by one would give it.
    waits.clear()
    assert [e for _, e in model_calls.answers_of(call, ["bad"] * 4, 3, 0.1, 2)] == ["ValueError: cannot read this"] * 4
    assert sum(waits) == pytest.approx((2 + 4) * 0.3)


def test_an_outage_between_two_tries_loses_nothing():
    n_calls = 0

    def call(texts):
        nonlocal n_calls
        n_calls += 1
        if 3 <= n_calls <= 6:
            raise ConnectionError("away")
        return [t.upper() for t in texts]

    texts = [f"t{i}" for i in range(40)]
    assert model_calls.answers_of(call, texts, 3, 0.0, 8) == [(t.upper(), None) for t in texts]
