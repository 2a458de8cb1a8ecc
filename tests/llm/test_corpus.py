"""Similarity join, nearest neighbours, mixing and the pipeline against plain versions of themselves."""

from __future__ import annotations

import random
import time
from pathlib import Path

import duckdb
import numpy as np
import pytest
from helpers import DOCUMENTS, FOLD, WORD, documents, edge_texts, empty_documents, found, prose
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from tillroll.llm import ann, components, mixing, ngram_join, quality
from tillroll.llm.common import stored

SAMPLE = Path("/root/testdata/sf0.001")


def plain_set(text: str | None) -> frozenset:
    words = WORD.findall((text or "").translate(FOLD))
    if len(words) < 5:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def plain_groups(rows) -> dict:
    """id -> (shingles, smallest id of the group), all pairs compared."""
    ids = [i for i, _ in rows]
    sets = [plain_set(t) for _, t in rows]
    label = list(range(len(rows)))

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * both >= 75 * len(sets[a] | sets[b]):
                label[root(a)] = root(b)
    low: dict[int, int] = {}
    for x in range(len(rows)):
        if ids[x] is not None:
            low[root(x)] = min(low.get(root(x), ids[x]), ids[x])
    return {ids[x]: (len(sets[x]), low.get(root(x)) if sets[x] else ids[x]) for x in range(len(rows))}


def near_copies(seed: int, n: int, words: int, changes: int) -> list[str]:
    rng = random.Random(seed)
    base = prose(seed, words, 10_000).split()
    texts = []
    for _ in range(n):
        own = list(base)
        for _ in range(rng.randrange(changes + 1)):
            own[rng.randrange(len(own))] = f"new{rng.randrange(10**6)}"
        texts.append(" ".join(own))
    return texts


@pytest.mark.parametrize("block", [1_500_000, 900])
def test_groups_equal_comparing_all_pairs(spark, monkeypatch, block):
    monkeypatch.setattr(ngram_join, "BLOCK", block)
    texts = near_copies(1, 60, 90, 7) + near_copies(2, 30, 200, 12) + near_copies(3, 12, 12, 1)
    passage = prose(99, 55, 10_000)
    texts += [prose(i, 60, 10_000) + " " + passage for i in range(20, 40)] + [texts[0].upper(), texts[0]]
    docs = documents(spark, texts + edge_texts(), clashing=True)
    got = {r["id"]: (r["n_shingles"], r["component_id"]) for r in ngram_join.groups(docs).collect()}
    assert got == plain_groups([(r["doc_id"], r["text"]) for r in docs.collect()])
    assert ngram_join.groups(docs).count() == docs.count()


@pytest.mark.parametrize("block", [250_000, 700])
def test_all_links_are_counted(spark, monkeypatch, block):
    monkeypatch.setattr(ngram_join, "COUNT_BLOCK", block)
    texts = near_copies(1, 40, 90, 9) + near_copies(2, 20, 200, 12) + near_copies(4, 2, 90, 3) + ["", prose(77, 60, 10_000)]
    shared = [f"s{i}" for i in range(10)]  # a chain: the ends do not link
    texts += [" ".join(shared + ["x"]), " ".join(shared), " ".join(["y"] + shared)]
    docs = documents(spark, texts)
    sets = {plain_set(r["text"]) for r in docs.collect()} - {frozenset()}
    expected = {a: sum(a != b and 100 * len(a & b) >= 75 * len(a | b) for b in sets) for a in sets} | {frozenset(): 0}
    got = {(r["id"], r["n_links"]) for r in ngram_join.groups(docs).collect()}
    assert got == {(r["doc_id"], expected[plain_set(r["text"])]) for r in docs.collect()}
    assert 0 in expected.values() and max(expected.values()) > 2


def test_links_at_the_border(spark):
    shared = [f"s{i}" for i in range(10)]
    # 6 shared shingles; 8 in the union link (0.75), 9 do not.
    a, b, c = shared + ["x"], ["y"] + shared, ["y", "z"] + shared
    docs = documents(spark, [" ".join(a), " ".join(b), " ".join(c)])
    got = {r["id"]: r["component_id"] for r in ngram_join.groups(docs).collect()}
    expected = plain_groups([(r["doc_id"], r["text"]) for r in docs.collect()])
    assert got == {k: v[1] for k, v in expected.items()}
    assert ngram_join.groups(empty_documents(spark)).count() == 0
    assert ngram_join.groups(documents(spark, [None, ""])).count() == 4


def test_signatures_never_lose_a_link():
    rng = np.random.default_rng(1)
    for _ in range(300):
        a = np.unique(rng.integers(0, 1 << 63, rng.integers(1, 300)).astype(np.uint64))
        b = np.unique(np.concatenate((a[rng.random(len(a)) < 0.9], rng.integers(0, 1 << 63, rng.integers(0, 20)).astype(np.uint64))))
        if not len(b):
            continue
        both, every = len(np.intersect1d(a, b)), len(np.union1d(a, b))
        assert ngram_join.links(a, b) == (100 * both >= 75 * every)
        x, y = ngram_join.signature(a), ngram_join.signature(b)
        size = min(len(x), len(y))
        if ngram_join.links(a, b):
            assert ngram_join.may_link(np.int64(len(a)), ngram_join._folded(x, size), np.int64(len(b)), ngram_join._folded(y, size))


def test_copies_are_read_once(spark):
    """Of copies one text goes on; all texts do that stand alone, and rows alike in id and text."""
    texts = [prose(i, 40, 10_000) for i in range(50)]
    rows = [(i, texts[i % 40], "en", "s", 1) for i in range(1200)] + [(2000 + i, t, "en", "s", 1) for i, t in enumerate(texts[40:])]
    rows += [(None, texts[0], None, None, None), (2000, texts[40], "de", "t", 2), (3000, None, None, None, None), (3001, " ", None, None, None)]
    docs = spark.createDataFrame(rows, DOCUMENTS)
    members = ngram_join.membership(docs, "doc_id", "text")
    first, shingles = ngram_join.first_texts(docs, members, "doc_id", "text")
    got = [r["text"] for r in first.collect()]
    assert set(got) >= set(texts) and len(got) < len(rows) / 4
    assert shingles == 50 * 36


def test_shingles_are_sent_in_few_bytes():
    rng = np.random.default_rng(5)
    for size in (0, 1, 2, 3300):
        numbers = np.sort(rng.integers(0, 1 << 32, size, dtype=np.uint32))
        data = ngram_join.packed(numbers)
        assert (ngram_join.unpacked(data, size) == numbers).all() and len(data) < 3.1 * size + 40
    assert [ngram_join.table_bits(n) for n in (0, 10**8, 3 * 10**8, 10**12)] == [27, 27, 29, 29]


def test_bitmaps_of_any_width(spark):
    slots = spark.createDataFrame([(1, 5), (1, 40_000), (2, 5), (1, 5)], "level int, slot long")
    one, two = ngram_join.bitmaps(slots, (17, 16))
    assert (len(one), len(two)) == (1 << 14, 1 << 13)
    grams = np.array([5, 6, 40_000], np.uint64)
    assert ngram_join._in_table(one, grams << np.uint64(47)).tolist() == [True, False, True]
    assert ngram_join._in_table(two, grams << np.uint64(48)).tolist() == [True, False, False]


def test_sets_that_come_twice_are_one(spark, monkeypatch):
    texts = near_copies(11, 12, 60, 3)
    docs = documents(spark, texts + edge_texts())
    docs = docs.unionByName(docs)
    expected = plain_groups([(r["doc_id"], r["text"]) for r in docs.collect()])
    monkeypatch.setattr(ngram_join, "REPEATED_KEYS", 2)
    assert {r["id"]: (r["n_shingles"], r["component_id"]) for r in ngram_join.groups(docs).collect()} == expected


def test_stored_steps_leave_no_shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffled() -> set[str]:
        return {name for name in files.getAllFiles().mkString("\n").split() if "/shuffle_" in name}

    before, key = shuffled(), "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    held = spark.conf.get(key)
    made = stored(spark.range(1000).withColumn("x", F.xxhash64("id")).repartition(3, "x"), "test")
    more = stored(made.groupBy((F.col("x") % 7).alias("k")).count(), "test")
    end = time.monotonic() + 20  # files go in the background
    while shuffled() - before and time.monotonic() < end:
        time.sleep(0.2)
    assert not shuffled() - before
    assert spark.conf.get(key) == held
    assert made.count() == 1000 and more.count() == 13


def test_join_leaves_little_to_the_driver(spark):
    """The result itself is a small plan, and no table of a past step is still broadcast."""
    context = spark.sparkContext
    made, broadcast = [], context.broadcast
    docs = documents(spark, near_copies(7, 12, 60, 3) + edge_texts())
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(type(context), "broadcast", lambda self, value: made.append(broadcast(value)) or made[-1])
        result = ngram_join.groups(docs)
    assert len(made) == 2
    for one in made:
        assert not Path(one._path).exists()
    context.setJobGroup("join-result", "the last query")
    try:
        assert result.count() == docs.count()
        assert {r["n_links"] for r in result.collect()} > {0}
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    status = context.statusTracker()
    jobs = [status.getJobInfo(job) for job in status.getJobIdsForGroup("join-result")]
    assert jobs and len({stage for job in jobs for stage in job.stageIds}) <= 14


def test_components(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 130)] + [(7, 7)]
    links = spark.createDataFrame(chain, "a long, b long")
    labels = dict(map(tuple, components.components(links).collect()))
    assert labels == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 130)}}


def test_nearest_neighbours(spark):
    rng = np.random.default_rng(4)
    vectors = rng.normal(size=(1500, 16)).astype(np.float32)
    vectors[200:260] = vectors[40]  # copies, queries among them
    rows = [(i, v.tolist(), 1) for i, v in enumerate(vectors)]
    rows += [(9001, None, 1), (9002, [], 1), (9003, [0.0] * 16, 1), (9004, [float("nan")] + [1.0] * 15, 1),
             (9005, [float("inf")] + [1.0] * 15, 1), (9006, [None] + [1.0] * 15, 1), (9020, [1.0] * 3, 1),
             (None, vectors[1].tolist(), 1), rows[5]]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, class int")
    got = ann.nearest(df, F.col("vec_id") % 20 == 0).collect()
    exact = vectors.astype(float) @ vectors.astype(float).T
    hits: dict[int, list] = {}
    for row in sorted(got, key=lambda r: (r["query_id"], r["rank"])):
        hits.setdefault(row["query_id"], []).append((row["vec_id"], row["score"]))
        assert abs(row["score"] - exact[row["query_id"], row["vec_id"]]) < 1e-9 and row["query_id"] != row["vec_id"]
    assert sorted(hits) == list(range(0, 1500, 20))
    right = 0
    for query, own in hits.items():
        assert len(own) == 20 == len({i for i, _ in own})
        assert own == sorted(own, key=lambda h: (-h[1], h[0]))
        order = sorted((i for i in range(1500) if i != query), key=lambda i: (-exact[query, i], i))[:20]
        right += len({i for i, _ in own} & set(order))
    assert right / (20 * len(hits)) >= 0.9
    assert [i for i, _ in hits[40]] == list(range(200, 220))
    assert ann.nearest(df.limit(0), F.lit(True)).count() == 0
    assert ann.nearest(df.where("vec_id < 5"), F.col("vec_id") == 0).count() == 4


def plain_rates(p, n, targets, most, steps=mixing.STEPS):
    rate = np.ones(len(n))
    size = (p * n[:, None]).sum(axis=0)
    weight = np.array(targets) / sum(targets)
    whole = size.sum() if most is None else most * size[0] / weight[0]
    for _ in range(steps):
        now = (p * (n * rate)[:, None]).sum(axis=0)
        miss = now - whole * weight
        if _ and np.abs(miss if most is None else np.maximum(miss, 0)).max() <= mixing.CLOSE * whole:
            break
        rate = np.maximum(0, rate - p @ ((now - whole * weight) / size))
        if most is not None:
            rate = np.minimum(most, rate)
    return rate


def mixing_tables(spark):
    texts = [prose(i, 80) for i in range(60)] + [" ".join(f"BUY{j}!!" for j in range(40)) for _ in range(30)]
    texts += [prose(i, 40) + " vile vile vile" * 8 for i in range(200, 220)]
    labels = [(i, 1, 0) for i in range(40)] + [(i, 0, 0) for i in range(60, 85)] + [(i, 1, 1) for i in range(90, 105)]
    return documents(spark, texts + edge_texts(), clashing=True), spark.createDataFrame(labels + [(3, None, 0)], "doc_id long, quality int, toxic int")


@pytest.mark.parametrize("most", [None, 1.0])
def test_mixing_rates(spark, most):
    docs, labels = mixing_tables(spark)
    targets = {"clean": 0.8, "low": 0.15, "toxic": 0.05}
    rows = mixing.mix(docs, labels, targets, ["doc_id"], most).collect()
    assert len(rows) == docs.count()
    p, n = np.array([r["p"] for r in rows]), np.array([r["n_tokens"] for r in rows])
    assert np.allclose(p.sum(axis=1), 1) and (p >= 0).all()
    rates = np.array([r["rate"] for r in rows])
    assert np.allclose(rates, plain_rates(p, n, list(targets.values()), most), atol=1e-6)
    assert (rates >= 0).all() and (most is None or (rates <= most).all())
    if most is None:
        got = (p * (n * rates)[:, None]).sum(axis=0)
        assert np.allclose(got / n.sum(), list(targets.values()), atol=2e-3)
    by_id = {r["doc_id"]: r for r in rows}
    assert by_id[50]["p"][0] > 0.9 and by_id[88]["p"][1] > 0.9
    assert mixing.mix(empty_documents(spark), labels, targets, ["doc_id"]).count() == 0
    assert mixing.mix(docs, labels.limit(0), targets, ["doc_id"]).count() == docs.count()


@pytest.fixture()
def folder(spark, tmp_path):
    block = prose(70, 70)
    texts = [prose(i, 150) for i in range(30)] + near_copies(5, 8, 150, 2) + [block + " " + block, prose(3, 150)]
    texts += [prose(40 + i, 90) + f' token = "{i:02d}beb58b8af68854f0e01b4ad40cdbb6ae7f578ae" ' + prose(80 + i, 30) for i in range(12)]
    texts += [f"{prose(500 + i, 90)} unhyphenatedlongword{'abcdefghij'[i % 10] * 6} end" for i in range(12)]
    docs = documents(spark, texts + edge_texts(), clashing=True)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(i, 1, 0) for i in range(20)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    return str(tmp_path)


def test_pipeline_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = corpus_pipeline.quality_stage(spark, docs, folder)
    ours = docs.select("doc_id", "text")
    verdicts = quality.judge(ours, ours.columns).where("kept").select(ours.columns)
    assert kept.columns == docs.columns and found(kept.select(ours.columns)) == found(verdicts)
    single = corpus_pipeline.near_duplicates_stage(spark, kept, folder)
    rows = [(r["doc_id"], r["text"]) for r in kept.collect()]
    groups = plain_groups(rows)
    expected = {i for i in groups if i is None or groups[i][1] == i}
    assert single.columns == docs.columns and sorted(map(repr, expected)) == sorted(repr(r["doc_id"]) for r in single.collect())
    clean = corpus_pipeline.secrets_stage(spark, single, folder)
    assert clean.columns == docs.columns and clean.count() == single.count()
    for row in clean.collect():
        assert "beb58b8af68854" not in row["text"] and "hunter22" not in row["text"]
        assert row["n_chars"] is None or row["n_chars"] == len(row["text"])
    mixed = corpus_pipeline.mixing_stage(spark, clean, folder)
    assert mixed.columns == docs.columns
    assert {r["doc_id"] for r in clean.collect() if r["doc_id"] is not None and r["doc_id"] < 20} <= {r["doc_id"] for r in mixed.collect()}
    coded = corpus_pipeline.tokens_stage(spark, mixed, folder)
    assert coded.count() == mixed.count()
    assert coded.columns == [c for c in docs.columns if c != "text"] + ["token_ids_", "n_tokens_"]
    own = ["doc_id", "n_words", "kept", "base_failed", "n_tokens", "token_ids", "score", "rate", "p"]
    assert found(coded.select(own)) == found(mixed.select(own))
    assert coded.select(own[1:-1]).distinct().collect() == [("mine",) * 7]
    assert coded.where("n_tokens_ != size(token_ids_)").count() == 0
    plain = corpus_pipeline.tokens_stage(spark, mixed.drop("n_tokens", "token_ids"), folder)
    assert plain.columns[-2:] == ["token_ids", "n_tokens"]


def test_mixing_decides_each_row(spark, tmp_path):
    """Clean rows stay that share an id, or have none, with rows that go."""
    spark.createDataFrame(
        [(i, 1, 0) for i in range(40)] + [(i, 0, 0) for i in range(60, 85)], "doc_id long, quality int, toxic int"
    ).write.parquet(str(tmp_path / "labels.parquet"))
    clean = [prose(i, 80) for i in range(60)]
    junk = [" ".join(f"BUY{j}!!" for j in range(40 + i)) for i in range(60)]
    rows = list(enumerate(clean + junk))
    rows += [(None, prose(700 + i, 80)) for i in range(20)] + [(None, junk[0] + f" BUY{i}!!") for i in range(40)]
    rows += [(900, prose(800 + i, 80)) for i in range(5)] + [(900, junk[1] + f" BUY{i}!!") for i in range(40)]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = [(r["doc_id"], r["text"]) for r in corpus_pipeline.mixing_stage(spark, docs, str(tmp_path)).collect()]
    assert [r for r in rows if "BUY" not in r[1]] == [r for r in rows if r in got and "BUY" not in r[1]]
    assert sum("BUY" in t for _, t in got) < 20


def test_near_duplicates_are_decided_by_row(spark, tmp_path):
    a, b, c, d, e = (prose(600 + i, 90, 10_000) for i in range(5))

    def near(text, word):
        return text.rsplit(" ", 1)[0] + f" {word}"

    rows = [(1, a), (7, near(a, "x")), (7, b), (9, c), (9, near(c, "y")), (9, near(c, "z")), (None, d), (None, near(d, "x")),
            (None, near(b, "x")), (None, e), (None, e), (11, near(e, "x")), (12, ""), (13, None), (1, a), (14, a.upper())]
    docs = spark.createDataFrame([(i, t, "en", "src0", None) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = [(r["doc_id"], r["text"]) for r in corpus_pipeline.near_duplicates_stage(spark, docs, "").collect()]
    kept = sorted(((i, t) for i, t in got if i is not None and i != 9), key=repr)
    assert kept == sorted([(1, a), (7, b), (11, near(e, "x")), (12, ""), (13, None)], key=repr)
    assert [t[:40] for i, t in got if i == 9] == [c[:40]]
    assert [t[:40] for i, t in got if i is None] == [d[:40]]


def test_pipeline_runs_and_takes_empty_tables(spark, folder):
    assert corpus_pipeline.run(spark, folder).count() > 30
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, folder).count() == 0


@pytest.mark.skipif(not SAMPLE.exists(), reason="sample tables are not here")
def test_oracles(spark):
    con = duckdb.connect()
    for file in SAMPLE.glob("*.parquet"):
        con.execute(f"create view {file.stem} as select * from '{file}'")
    from tillroll.llm.queries import ORACLES

    for name, sql in ORACLES.items():
        ours = entry.queries()[name](spark, str(SAMPLE))
        theirs = con.execute(sql)
        columns = [d[0] for d in theirs.description]
        assert sorted(columns) == sorted(ours.columns)
        assert found(ours.select(columns)) == sorted(map(tuple, theirs.fetchall()), key=repr)


@pytest.mark.skipif(not SAMPLE.exists(), reason="sample tables are not here")
def test_every_operator_is_registered():
    names = entry.queries()
    assert all(sum(n.startswith(f"op{k}_") for n in names) == 1 for k in range(1, 14)) and "pipeline" in names
