"""Cutting texts by the public pattern of byte-level tokenizers, for a whole column at once.

The pattern is `'s|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+`. Each
match depends only on runs of letters, numbers, white space and the rest, so the cuts are found with
array operations on the classes of the code points.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa

OTHER, LETTER, NUMBER, SPACE = 0, 1, 2, 3
CONTRACTIONS = ("s", "t", "re", "ve", "m", "ll", "d")


@functools.cache
def _class_table() -> np.ndarray:
    import regex

    table = np.zeros(0x110000, np.uint8)
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    every = "".join(map(chr, points))
    at = np.array(points)
    for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (SPACE, r"\p{White_Space}+")):
        for found in regex.finditer(pattern, every):
            table[at[found.start() : found.end()]] = kind
    return table


def cut(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All matches of the pattern in order, and the number of matches in each text (nulls filled before)."""
    offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1]
    low, high = int(offsets[0]), int(offsets[-1])
    if low == high:
        return pa.array([], pa.string()), np.zeros(len(texts), np.int64)
    raw = texts.buffers()[2].slice(low, high - low)
    points = np.frombuffer(raw.to_pybytes().decode().encode("utf-32-le"), np.uint32)
    n = len(points)
    width = 1 + (points >= 0x80).astype(np.int32) + (points >= 0x800) + (points >= 0x10000)
    at_byte = np.zeros(n + 1, np.int32)
    np.cumsum(width, out=at_byte[1:])
    text_starts = np.searchsorted(at_byte, (offsets - low).astype(np.int32))

    kinds = _class_table()[points]
    first = np.zeros(n + 1, bool)  # a text begins here
    first[text_starts] = True
    run = first.copy()
    run[1:n] |= kinds[1:] != kinds[:-1]
    run[n] = True
    starts = np.flatnonzero(run)
    begin, end = starts[:-1], starts[1:]
    token = run.copy()

    # White space before something: its last character stands apart, or joins what follows if a blank.
    led = (kinds[begin] == SPACE) & ~first[end]
    last = end[led] - 1
    token[last] = True
    blank = points[last] == 0x20
    token[last[blank] + 1] = False

    # A lone apostrophe that begins a match, and letters after it.
    quote = (points[begin] == 0x27) & (end - begin == 1) & token[begin] & ~first[end]
    for a in np.flatnonzero(quote):
        if a + 1 < len(begin) and kinds[begin[a + 1]] == LETTER:
            b, e = begin[a + 1], end[a + 1]
            after = "".join(map(chr, points[b : min(e, b + 2)]))
            for ending in CONTRACTIONS:
                if after.startswith(ending):
                    token[b] = False
                    token[b + len(ending)] = True
                    # A blank that would have led a token still does: only cuts inside the run are new.
                    break

    cuts = np.flatnonzero(token[:n])
    counts = np.diff(np.searchsorted(cuts, text_starts))
    places = np.append(at_byte[cuts], at_byte[n]).astype(np.int32)
    found = pa.StringArray.from_buffers(len(cuts), pa.py_buffer(places.tobytes()), raw)
    return found, counts.astype(np.int64)
