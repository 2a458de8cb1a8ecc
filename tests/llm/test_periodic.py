"""Periodic runs against trying every start and period."""

from __future__ import annotations

import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
import pytest
from helpers import WORD, documents, edge_texts, empty_documents, prose

import __spark_entry__ as entry
from tillroll.llm import periodic


def plain_runs(words: list) -> list[tuple[int, int, int]]:
    found, n = [], len(words)
    for q in range(1, n // 3 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j + q - i
            if length >= max(24, 3 * q):
                own = words[i : i + length]
                if not any(own[d:] == own[:-d] for d in range(1, q)):
                    found.append((i, length, q))
            i = j
    return sorted(found, key=lambda r: (r[0], r[2]))


def got(words, short=periodic.SHORT) -> list[tuple]:
    codes = {w: i for i, w in enumerate(dict.fromkeys(words))}
    return list(zip(*(x.tolist() for x in periodic.runs_of(np.array([codes[w] for w in words], np.int64), None, short))))


def strings(seed: int):
    rng = random.Random(seed)
    letters = rng.choice([1, 2, 3, 50])
    yield [rng.randrange(letters) for _ in range(rng.randrange(120))]
    parts = []
    for _ in range(rng.randrange(1, 6)):
        unit = [rng.randrange(letters) for _ in range(rng.randrange(1, 60))]
        if rng.random() < 0.4:  # a repetition inside the period
            unit = unit[:7] * rng.randrange(2, 9) + unit
        parts += (unit * 8)[: rng.randrange(len(unit), 8 * len(unit))]
        parts += [rng.randrange(letters) for _ in range(rng.randrange(4))]
    yield parts[:900]
    a, b = [0], [0, 1]
    while len(b) < 400:  # Fibonacci words, full of repetitions
        a, b = b, b + a
    yield b[rng.randrange(50) :] * rng.randrange(1, 3)
    thue = [bin(i).count("1") % 2 for i in range(256)]
    yield thue[rng.randrange(64) :] * 4


@pytest.mark.parametrize("seed", range(40))
def test_all_runs_are_found(seed):
    for words in strings(seed):
        expected = plain_runs(words)
        for short in (1, 3, 16):
            assert got(words, short) == expected


def test_long_periods():
    rng = random.Random(5)
    for period in (17, 25, 26, 38, 39, 100, 333, 1000, 1999):
        unit = [rng.randrange(10**6) for _ in range(period)]
        body = [-1, *(unit * 4)[: 3 * period + rng.randrange(3)], -2]
        assert got(body) == [(1, len(body) - 2, period)]


def rewritten(doc_id, words: list[str]) -> list[str]:
    h = None if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h is None or h % 10 or not words:
        return words
    n, g = len(words), h // 10
    a, p = g % n, 1 + (n - g % n) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def plain_row(doc_id, text) -> tuple:
    words = rewritten(doc_id, WORD.findall(text or ""))
    runs = plain_runs(words)
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if runs else (None, None, None)
    gone = {i for s, n, p in runs for i in range(s + p, s + n)}
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    lines = "".join(f"{s},{n},{p}\n" for s, n, p in runs)
    shas = [hashlib.sha256(x.encode()).hexdigest() for x in (lines, kept)]
    return (doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None, *shas)


def query(spark, docs, folder):
    docs.write.mode("overwrite").parquet(str(folder / "documents.parquet"))
    return sorted((tuple(r) for r in entry.queries()["op12_periodic"](spark, str(folder)).collect()), key=repr)


def test_query_equal_to_plain(spark, tmp_path):
    texts = [t for t in edge_texts() if t is None or len(t) < 20_000]
    texts += [(prose(i, 5 + i) + " ") * (1 + i % 7) for i in range(120)] + [prose(7, 500, 30)] + ["a " * 60 + "b " * 60]
    docs = documents(spark, texts, clashing=True).repartition(3)
    got = query(spark, docs, tmp_path)
    assert got == sorted((plain_row(r["doc_id"], r["text"]) for r in docs.collect()), key=repr)
    assert sum(r[1] > 0 for r in got) > 30


def test_small_tables(spark, tmp_path):
    assert query(spark, empty_documents(spark), tmp_path) == []
    docs = documents(spark, [None, "", "one"])
    assert query(spark, docs, tmp_path / "few") == sorted((plain_row(r["doc_id"], r["text"]) for r in docs.collect()), key=repr)


def test_runs_and_texts(spark):
    docs = documents(spark, ["x y z " * 10 + "end", "no runs here", None], clashing=True).where("doc_id is not null")
    found = periodic.find(docs, docs.columns)
    assert found.columns == [*docs.columns, "runs", "collapsed"]
    rows = {r["doc_id"]: ([tuple(x) for x in r["runs"]], r["collapsed"]) for r in found.collect()}
    assert rows == {0: ([(0, 30, 3)], "x y z end"), 1: ([], "no runs here"), 2: ([], "")}


def test_a_long_text_of_few_words(spark):
    words = np.array([0] * 300_000 + [1, 2] * 100_000 + list(range(3, 5000)) * 20, np.int64)
    runs = list(zip(*(x.tolist() for x in periodic.runs_of(words))))
    assert runs == [(0, 300_000, 1), (300_000, 200_000, 2), (500_000, 20 * 4997, 4997)]
