"""Quality rules on repetition inside a text, from suffix arrays over words.

The words of a piece of the column form one string in which every text has symbols of its own, so no repeat
crosses texts. Its suffixes are sorted by doubling: each round sorts those that still tie by twice as many
words. The longest common prefixes of neighbours are then read off the words in one pass, with no ranks of
earlier rounds kept. Intervals of the prefix lengths are the repeated passages that cannot be made longer to the right;
those whose occurrences have different words before them are the maximal repeats. A text fails when the
union of its repeats covers too much of it, or when the longest one is too long a part of it.

A text is judged whole in one task, which takes at most some 120 bytes a word, also where all words are equal;
pieces of several texts hold about 4 MB. Null and empty texts have no words, and fail by the base rule. Repeated rows are judged alike, each for
itself. Nothing is looked at across rows, so columns and clashing names do not matter.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import ASCII_SPACE, freed_pieces, schema_with, text_pieces, words_of

# Base rule: too few words, or too many of them in repeated windows of three.
LEAST_WORDS, WINDOW, WINDOW_PERCENT = 50, 3, 50
# Method: repeats of at least so many words count; limits for covered and longest share, and for a
# longest repeat that is short in words nothing is said.
REPEAT_WORDS, COVERED_SHARE, LONGEST_SHARE, LONGEST_WORDS = 5, 0.40, 0.25, 30
# Symbols compared at a time for the common prefixes.
COMPARED = 1 << 18


def suffix_array(symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes in order, and the length of the common prefix of each with the one before it."""
    n = len(symbols)
    order = np.argsort(symbols, kind="stable").astype(np.int32)
    sorted_symbols = symbols[order]
    fresh = np.ones(n, bool)
    fresh[1:] = sorted_symbols[1:] != sorted_symbols[:-1]
    rank = np.empty(n, np.int32)
    rank[order] = np.maximum.accumulate(np.where(fresh, np.arange(n, dtype=np.int32), 0))
    letters = rank.copy()  # equal where the symbols are
    del symbols, sorted_symbols
    width = 1
    places = np.flatnonzero(~fresh | ~np.append(fresh[1:], True)).astype(np.int32)  # where the tying suffixes stand in the order
    while len(places):
        own = order[places]
        key = rank[own] * np.int64(n + 1)
        inside = np.flatnonzero(own < n - width)
        key[inside] += rank[own[inside] + width] + 1
        by_key = np.argsort(key, kind="stable").astype(np.int32)
        own, key = own[by_key], key[by_key]
        order[places] = own
        fresh = np.ones(len(own), bool)
        fresh[1:] = key[1:] != key[:-1]
        del inside, key, by_key
        rank[own] = places[np.maximum.accumulate(np.where(fresh, np.arange(len(own), dtype=np.int32), 0))]
        width *= 2
        places = places[~fresh | ~np.append(fresh[1:], True)]
    return order, common_prefixes(letters, order)


def common_prefixes(symbols: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Length of the common prefix of each suffix in `order` with the one before it.

    Where a suffix and its neighbour have the same symbol before them, the two suffixes one place earlier are
    neighbours too and share one symbol more. Only the others are compared, and their prefixes sum up to no
    more than 2 n log n symbols.
    """
    n = len(symbols)
    neighbour = np.full(n, -1, np.int32)
    neighbour[order[1:]] = order[:-1]
    own = neighbour <= 0
    own[0] = True
    own[1:] |= symbols[:-1] != symbols[neighbour[1:] - 1]
    length = np.zeros(n, np.int32)
    ended = np.append(symbols, np.int32(-1))
    left = np.flatnonzero(own & (neighbour >= 0)).astype(np.int32)
    stride = 1
    while len(left):
        steps = np.arange(stride)
        met = np.empty(len(left), np.int32)
        some = max(1, COMPARED // stride)
        for low in range(0, len(left), some):
            begin = left[low : low + some]
            at = (begin + length[begin])[:, None] + steps
            to = (neighbour[begin] + length[begin])[:, None] + steps
            parted = ended[np.minimum(at, n)] != ended[np.minimum(to, n)]
            met[low : low + some] = np.where(parted.any(axis=1), parted.argmax(axis=1), stride)
        length[left] += met
        left = left[met == stride]
        stride = min(2 * stride, COMPARED)
    at = np.arange(n, dtype=np.int32)
    base = np.maximum.accumulate(np.where(own, at, 0))
    return (length[base] - (at - base))[order]


def maximal_repeats(
    symbols: np.ndarray, order: np.ndarray, lcp: np.ndarray, least: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Length, first place in the suffix order and number of occurrences of every maximal repeat of at
    least `least` symbols."""
    at = np.flatnonzero(lcp >= least).astype(np.int32)
    empty = np.zeros(0, np.int64)
    if not len(at):
        return empty, empty, empty
    # Entries that are next to each other stand in one block; between blocks lies a shorter prefix.
    pos = np.arange(1, len(at) + 1, dtype=np.int32)
    pos[1:] += np.cumsum(np.diff(at) > 1, dtype=np.int32)
    height = np.full(pos[-1] + 2, -1, np.int32)
    height[pos] = lcp[at]
    low = np.arange(len(height), dtype=np.int32) - 1  # nearest to the left that is not higher
    high = np.arange(len(height), dtype=np.int32) + 1  # nearest to the right that is lower
    todo = pos
    while len(todo := todo[height[low[todo]] > height[todo]]):
        low[todo] = low[low[todo]]
    todo = pos
    while len(todo := todo[height[high[todo]] >= height[todo]]):
        high[todo] = high[high[todo]]
    own = pos[height[low[pos]] < height[pos]]  # the first of its interval
    back = np.zeros(len(height), np.int32)
    back[pos] = at
    first = back[own] - (own - low[own] - 1) - 1
    count = high[own] - low[own]
    # The word before differs somewhere in the interval.
    before = np.where(order > 0, symbols[order - 1], -1)
    changes = np.concatenate(([0], np.cumsum(before[1:] != before[:-1], dtype=np.int32)))
    varied = changes[first + count - 1] > changes[first]
    return height[own][varied], first[varied], count[varied]


def measures(texts: pa.Array) -> dict[str, np.ndarray]:
    """One value per text of all figures that the rules use."""
    n_texts = len(texts)
    words, counts = words_of(texts)
    owner = np.repeat(np.arange(n_texts), counts)
    ends = np.cumsum(counts)

    def per_text(values: np.ndarray) -> np.ndarray:
        sums = np.concatenate(([0], np.cumsum(values, dtype=np.int64)))
        return sums[ends] - sums[ends - counts]

    chars = pc.utf8_length(words).to_numpy(zero_copy_only=False)
    found = {"n_words": counts, "word_chars": per_text(chars)}
    found["n_symbols"] = pc.count_substring_regex(texts, "[#*$%&|<>]").to_numpy(zero_copy_only=False).astype(np.int64)

    lists = pc.split_pattern(texts, "\n")
    lines = lists.flatten()
    line_owner = np.repeat(np.arange(n_texts), pc.list_value_length(lists).to_numpy(zero_copy_only=False))
    filled = pc.greater(pc.binary_length(pc.ascii_trim(lines, ASCII_SPACE)), 0).to_numpy(zero_copy_only=False)
    codes = lines.dictionary_encode().indices.to_numpy()[filled].astype(np.int64)
    line_owner = line_owner[filled]
    distinct = np.unique(line_owner * (len(lines) + 1) + codes) // (len(lines) + 1)
    found["n_dup_lines"] = np.bincount(line_owner, minlength=n_texts) - np.bincount(distinct, minlength=n_texts)

    n = len(words)
    zeros = np.zeros(n_texts, np.int64)
    if not n:
        return found | {k: zeros for k in ("n_repeat_words", "covered_words", "longest_repeat", "n_repeats")}
    symbols = owner * n
    symbols += words.dictionary_encode().indices.to_numpy()
    del words, chars, lists, lines, codes, line_owner
    order, lcp = suffix_array(symbols)
    longest = np.zeros(n, np.int32)  # longest passage that begins here and stands elsewhere too
    longest[order] = np.maximum(lcp, np.append(lcp[1:], 0))

    def covered(begin: np.ndarray, length: np.ndarray) -> np.ndarray:
        edges = np.bincount(begin, minlength=n + 1)
        edges -= np.bincount(begin + length, minlength=n + 1)
        return per_text(np.cumsum(edges, out=edges)[:n] > 0)

    windows = np.flatnonzero(longest >= WINDOW)
    found["n_repeat_words"] = covered(windows, np.full(len(windows), WINDOW))
    # Every repeat lies inside a maximal one, so the union of what begins anywhere is that of the maximal ones.
    begin = np.flatnonzero(longest >= REPEAT_WORDS)
    found["covered_words"] = covered(begin, longest[begin])
    length, first, _ = maximal_repeats(symbols, order, lcp, REPEAT_WORDS)
    text_of = owner[order[first]]
    most = zeros.copy()
    np.maximum.at(most, text_of, length)
    found["longest_repeat"] = most
    found["n_repeats"] = np.bincount(text_of, minlength=n_texts)
    return found


MEASURES = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
    "covered_words", "longest_repeat", "n_repeats",
)


def measure(df: DataFrame, keep: list[str], text_col: str = "text") -> DataFrame:
    """The columns `keep` and all figures of every row's whole text."""

    def run(batches):
        for batch in batches:
            *kept, texts = batch.columns
            for first, piece in text_pieces(texts):
                found = measures(piece)
                rows = [c.slice(first, len(piece)) for c in kept]
                rows += [pa.array(found[m].astype(np.int64)) for m in MEASURES]
                yield pa.RecordBatch.from_arrays(rows, [*keep, *MEASURES])

    schema = schema_with(df, keep, ", ".join(f"{name} long" for name in MEASURES))
    return df.select(*keep, F.col(text_col).alias("__text")).mapInArrow(run, schema)


def rules(of: Callable[[str], Column] = F.col) -> tuple[Column, Column]:
    """Whether the base rule rejects a text, and whether the text is kept, by its figures."""
    few = of("n_words") < LEAST_WORDS
    base = few | (100 * of("n_repeat_words") > WINDOW_PERCENT * of("n_words"))
    spread = of("covered_words") > COVERED_SHARE * of("n_words")
    long = (of("longest_repeat") > LONGEST_WORDS) & (of("longest_repeat") > LONGEST_SHARE * of("n_words"))
    return base, ~(base | spread | long)


def verdict(measured: DataFrame) -> DataFrame:
    """Adds `base_failed` and `kept`."""
    base, kept = rules()
    return measured.withColumn("base_failed", base).withColumn("kept", kept)


def passing(df: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows whose text is kept, with their own columns as they are, whatever these are called.

    Texts go to Python once and only figures come back; the rows stay in the JVM.
    """

    def run(texts: pa.Array) -> pa.Array:
        found = [measures(piece) for _, piece in freed_pieces(texts)]
        columns = [np.concatenate([f[m] for f in found] or [np.zeros(0, np.int64)]) for m in MEASURES]
        return pa.StructArray.from_arrays([pa.array(c.astype(np.int64)) for c in columns], list(MEASURES))

    figures = F.arrow_udf(run, ", ".join(f"{name} long" for name in MEASURES))
    measured = df.withColumn("__figures", figures(F.col(text_col)))
    return measured.where(rules(F.col("__figures").getField)[1]).drop("__figures")


def judge(df: DataFrame, keep: list[str], text_col: str = "text") -> DataFrame:
    return verdict(measure(df, keep, text_col))
