"""Small tables with everything that a row may hold, and plain versions of what the operators compute."""

from __future__ import annotations

import random
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"
# Columns named like those that the operators use inside.
CLASHING = (
    ", key string, id string, p string, n string, label string, spans string, slot long, n_words string, kept string, "
    "base_failed string, n_tokens string, token_ids string, score string, rate string"
)


def prose(seed: int, n: int, words: int = 400) -> str:
    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(words)}" for _ in range(n))


def edge_texts() -> list[str | None]:
    base = prose(1, 120)
    return [
        base, base, base.replace("w1 ", "x1 ", 1), None, "", " \n\t ", "one", "one two three four",
        "one two three four", "a b c d e", "line of words here\n" * 30, prose(2, 60) + " 'tis it's l'été “q” \x1c\x85 x",
        prose(3, 30_000, 20_000), "\U0001f600 é ß 中文   end", "x" * 5000, "é" * 4000,
        prose(4, 80) + ' password = "hunter22" ' + prose(5, 20), prose(6, 80) + " AKIA" + "Q7" * 10 + " end",
    ]


def documents(spark, texts=None, clashing: bool = False):
    texts = edge_texts() if texts is None else texts
    rows = [(i, t, "en", "src0", None if t is None else len(t)) for i, t in enumerate(texts)]
    rows.append((None, "a row without an id " * 20, None, None, None))
    if texts:
        rows.append(rows[0])
    schema = DOCUMENTS
    if clashing:
        schema += CLASHING
        rows = [r + ("k", "i", "p", "n", "l", "s", 7, "mine", "mine", "mine", "mine", "mine", "mine", "mine") for r in rows]
    return spark.createDataFrame(rows, schema)


def empty_documents(spark):
    return spark.createDataFrame([], DOCUMENTS)


def found(df):
    """Rows as sorted tuples."""
    return sorted((tuple(r) for r in df.collect()), key=repr)
