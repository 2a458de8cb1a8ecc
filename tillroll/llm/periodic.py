"""Periodic runs in texts: stretches of words that repeat with a period, three times or more.

A run of period q is a longest stretch in which words q apart are alike, with q its least period and at least
three periods and LEAST_WORDS words long. All runs of a piece of the column are found together; words of
different texts never count as alike.

* Short periods, up to SHORT: the words are held against themselves at every lag.
* Longer ones by scales. A scale looks for periods from `low` to `high` = 1.5 low in grams of `high` words. Grams
  are named exactly, by doubling: two grams have one name if their halves do, and only grams that stand
  twice in a text are followed to the next length. In every window of grams the least of the (mixed) names is
  marked. Windows a period apart hold the same grams, so inside a run the marks repeat at period distance;
  and a gram no shorter than the period stands nowhere between. So two marks of one name, next to each other and a
  period of the scale apart, seed every run. Each seed is extended word by word as far as the period holds.

A piece is about 4 MB of text, or one longer text; a worker needs some hundred bytes a word of it. Null and empty
texts have no words and no runs. Repeated rows are read each for itself. Other columns than the text are passed
through, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import freed_pieces, schema_with, words_of

# A run has at least so many words, and so many periods.
LEAST_WORDS, LEAST_PERIODS = 24, 3
# Periods up to this one are found by lag.
SHORT = 16

Runs = tuple[np.ndarray, np.ndarray, np.ndarray]  # start, length, period

# Given the keys and numbers of words of some texts: per text the word from which it is to repeat, and the period
# with which it does; a period of 0 leaves the text as it is.
Rewrite = Callable[[pa.Array, np.ndarray], tuple[np.ndarray, np.ndarray]]


def _stretches(alike: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begin and length of each stretch of trues."""
    at = np.flatnonzero(alike)
    if not len(at):
        return at, at
    breaks = np.flatnonzero(np.diff(at) > 1)
    first, last = np.concatenate(([0], breaks + 1)), np.concatenate((breaks, [len(at) - 1]))
    return at[first], at[last] - at[first] + 1


def _short_runs(words: np.ndarray, short: int) -> Iterator[tuple[int, int, int]]:
    for period in range(1, min(short, len(words) - 1) + 1):
        begin, length = _stretches(words[:-period] == words[period:])
        long = length + period >= max(LEAST_WORDS, LEAST_PERIODS * period)
        yield from ((int(b), int(n) + period, period) for b, n in zip(begin[long], length[long]))


def _repeated(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which keys stand more than once, and names of these from 0 up in order."""
    order = np.argsort(keys, kind="stable")
    sorted_keys = keys[order]
    fresh = np.ones(len(keys), bool)
    fresh[1:] = sorted_keys[1:] != sorted_keys[:-1]
    names = np.empty(len(keys), np.int64)
    names[order] = np.cumsum(fresh) - 1
    return np.bincount(names, minlength=1)[names] > 1, names


def _paired(names: np.ndarray, places: np.ndarray, shift: int, most: int) -> tuple[np.ndarray, np.ndarray]:
    """(places, names) of the grams made of a gram and the one `shift` words on, of those that stand twice.
    `names` has -1 where a gram stands once only."""
    places = places[places + shift < len(names)]
    ahead = names[places + shift]
    places, ahead = places[ahead >= 0], ahead[ahead >= 0]
    if not len(places):
        return places, ahead
    twice, own = _repeated(names[places] * most + ahead)
    return places[twice], own[twice]


def _mixed(names: np.ndarray) -> np.ndarray:
    """The names in another order, one to one, so that neighbours in the order are not neighbours in texts."""
    x = names.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)


def _slid(values: np.ndarray, width: int, join: np.ufunc) -> np.ndarray:
    """`join` of every `width` neighbouring values."""
    span, out = 1, values
    while 2 * span <= width:
        out = join(out[:-span], out[span:])
        span *= 2
    return join(out[: len(out) - (width - span)], out[width - span :]) if width > span else out


def _marked(places: np.ndarray, names: np.ndarray, window: int) -> np.ndarray:
    """Which of the places hold the least gram of some window of `window` places; places without a gram
    are never the least."""
    if not len(places):
        return np.zeros(0, bool)
    # Places more than a window apart never meet; the gaps between are cut short.
    gaps = np.minimum(np.diff(places), window)
    at = np.concatenate(([0], np.cumsum(gaps))) + window
    most = np.iinfo(np.uint64).max
    row = np.full(int(at[-1]) + window + 1, most)
    row[at] = np.minimum(_mixed(names), most - np.uint64(1))
    least = _slid(row, window, np.minimum)
    # A place is the least of some window if the largest of the least values of its windows is its own.
    return _slid(least, window, np.maximum)[at - window + 1] == row[at]


def _extended(words: np.ndarray, at: int, period: int) -> tuple[int, int]:
    """Begin and end of the stretch with this period around `at`, where words[at] is words[at + period]."""
    begin, step = at, 64
    while begin:
        low = max(0, begin - step)
        unlike = np.flatnonzero(words[low:begin] != words[low + period : begin + period])
        if len(unlike):
            begin = low + int(unlike[-1]) + 1
            break
        begin, step = low, 2 * step
    end, step = at + period, 64
    while end < len(words):
        high = min(len(words), end + step)
        unlike = np.flatnonzero(words[end:high] != words[end - period : high - period])
        if len(unlike):
            end += int(unlike[0])
            break
        end, step = high, 2 * step
    return begin, end


def _scales(longest: int, short: int) -> Iterator[tuple[int, int]]:
    low = short + 1
    while LEAST_PERIODS * low <= longest:
        yield low, low + low // 2
        low += low // 2 + 1


def _long_runs(words: np.ndarray, longest: int, short: int) -> Iterator[tuple[int, int, int]]:
    twice, names = _repeated(words)
    grams, size = np.where(twice, names, -1), 1
    places = np.flatnonzero(twice)
    most = len(words) + 1
    for low, high in _scales(longest, short):
        while 2 * size <= high and len(places):
            places, own = _paired(grams, places, size, most)
            grams = np.full(len(words), -1)
            grams[places] = own
            size *= 2
        if not len(places):
            return
        if size < high:
            of_scale, own = _paired(grams, places, high - size, most)
        else:
            of_scale, own = places, grams[places]
        marked = _marked(of_scale, own, 2 * low - high + 1)
        at, own = of_scale[marked], own[marked]
        order = np.lexsort((at, own))
        at, own = at[order], own[order]
        apart = np.diff(at)
        seeds = np.flatnonzero((own[1:] == own[:-1]) & (apart >= low) & (apart <= high))
        done: dict[int, int] = {}  # per period the end of the last stretch
        for period, place in sorted(zip(apart[seeds].tolist(), at[seeds].tolist())):
            if place + period < done.get(period, 0):
                continue
            begin, end = _extended(words, place, period)
            done[period] = end
            if end - begin >= max(LEAST_WORDS, LEAST_PERIODS * period):
                yield begin, end - begin, period


def _prime_factors(n: int) -> list[int]:
    found, p = [], 2
    while p * p <= n:
        if n % p == 0:
            found.append(p)
            while n % p == 0:
                n //= p
        p += 1
    return [*found, n] if n > 1 else found


def runs_of(words: np.ndarray, longest: int | None = None, short: int = SHORT) -> Runs:
    """All runs of a string of numbers, by start and then period. No stretch longer than `longest` has a period."""
    found = set(_short_runs(words, short))
    found.update(_long_runs(words, len(words) if longest is None else longest, short))
    # A shorter period of a stretch of three periods divides its period.
    least = [
        (begin, length, period) for begin, length, period in found
        if not any(
            np.array_equal(words[begin : begin + period], words[begin + period // p : begin + period + period // p])
            for p in _prime_factors(period)
        )
    ]
    columns = np.array(sorted(least, key=lambda r: (r[0], r[2])), np.int64).reshape(-1, 3).T
    return columns[0], columns[1], columns[2]


# --- over columns of texts ------------------------------------------------------------------------------------


class _Piece:
    """Words of some texts, with their runs."""

    def __init__(self, texts: pa.Array, keys: pa.Array, rewrite: Rewrite | None):
        self.words, self.counts = words_of(texts)
        self.ends = np.cumsum(self.counts)
        self.begins = self.ends - self.counts
        if rewrite is not None:
            self._rewrite(*rewrite(keys, self.counts))
        owner = np.repeat(np.arange(len(self.counts)), self.counts)
        codes = self.words.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
        longest = int(self.counts.max()) if len(self.counts) else 0
        self.start, self.length, self.period = runs_of(owner * (len(codes) + 1) + codes, longest)
        self.text = np.searchsorted(self.ends, self.start, side="right")
        self.first = np.searchsorted(self.text, np.arange(len(self.counts) + 1))  # of each text's runs

    def _rewrite(self, first: np.ndarray, period: np.ndarray) -> None:
        changed = np.flatnonzero((period > 0) & (self.counts > 0))
        source = np.arange(len(self.words))
        for i in changed:
            first_word, last = self.begins[i] + first[i], self.ends[i]
            source[first_word:last] = first_word + np.arange(last - first_word) % period[i]
        if len(changed):
            self.words = self.words.take(pa.array(source))

    def collapsed(self) -> pa.Array:
        """The texts' words joined by one space, each run cut to its first period."""
        n = len(self.words)
        edges = np.bincount(self.start + self.period, minlength=n + 1) - np.bincount(self.start + self.length, minlength=n + 1)
        dropped = np.cumsum(edges)[:n] > 0
        kept = ~dropped
        sums = np.concatenate(([0], np.cumsum(kept)))
        offsets = np.concatenate(([0], sums[self.ends])).astype(np.int32)
        words = self.words if not dropped.any() else self.words.filter(pa.array(kept))
        return pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets), words), " ")

    def runs(self, i: int) -> list[tuple[int, int, int]]:
        part = slice(self.first[i], self.first[i + 1])
        return list(zip((self.start[part] - self.begins[i]).tolist(), self.length[part].tolist(), self.period[part].tolist()))


def _over(df: DataFrame, keep: list[str], text_col: str, key_col: str | None, rewrite: Rewrite | None, made: str, of_piece) -> DataFrame:
    def run(batches):
        for batch in batches:
            keys, texts, *kept = batch.columns
            for first, piece in freed_pieces(texts):
                found = of_piece(_Piece(piece, keys.slice(first, len(piece)), rewrite))
                yield pa.RecordBatch.from_arrays([c.slice(first, len(piece)) for c in kept] + found, [str(i) for i in range(len(kept) + len(found))])

    schema = schema_with(df, keep, made)
    numbered = schema_with(df, keep, made)
    for i, field in enumerate(numbered.fields):
        field.name = str(i)
    numbered.names = [f.name for f in numbered.fields]
    key = F.col(key_col) if key_col else F.lit(None).cast("long")
    rows = df.select(key.alias("__key"), F.col(text_col).alias("__text"), *keep)
    return rows.mapInArrow(run, numbered).toDF(*schema.fieldNames())


RUN = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def find(
    df: DataFrame, keep: list[str], text_col: str = "text", key_col: str | None = None, rewrite: Rewrite | None = None
) -> DataFrame:
    """The columns `keep`, `runs` as array<struct<start, length, period>> in words, by start and then period, and
    `collapsed`, the words joined by single spaces with every run cut to its first period."""

    def of_piece(piece: _Piece) -> list[pa.Array]:
        own = [[dict(zip(("start", "length", "period"), r)) for r in piece.runs(i)] for i in range(len(piece.counts))]
        return [pa.array(own, RUN), piece.collapsed()]

    made = "runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string"
    return _over(df, keep, text_col, key_col, rewrite, made, of_piece)


def digest(
    df: DataFrame, keep: list[str], text_col: str = "text", key_col: str | None = None, rewrite: Rewrite | None = None
) -> DataFrame:
    """As `find`, but in place of the runs their number, the one with most periods (ties: least start, then period)
    and SHA-256 of all of them, and in place of the collapsed text its SHA-256; so no text leaves the worker."""

    def of_piece(piece: _Piece) -> list[pa.Array]:
        rows = []
        for i, text in enumerate(piece.collapsed().to_pylist()):
            own = piece.runs(i)
            best = min(own, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if own else (None, None, None)
            exponent = 1000 * best[1] // best[2] if own else None
            lines = "".join(f"{s},{n},{p}\n" for s, n, p in own)
            rows.append((len(own), *best, exponent, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()))
        kinds = [pa.int64()] * 5 + [pa.string()] * 2
        return [pa.array(column, kind) for column, kind in zip(zip(*rows), kinds)]

    made = "n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string"
    return _over(df, keep, text_col, key_col, rewrite, made, of_piece)
