"""Vector expressions over arrays of floats."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

SCORE_DIGITS = 9

# Longer texts are gone through word by word.
SPLIT_BYTES = 1024 * 1024


def as_vector(values: Column, width: int) -> Column:
    """Cast to array<float>; a vector of another width is an error, a missing one stays NULL."""
    message = F.concat(F.lit(f"expected {width} values, got "), F.size(values).cast("string"))
    return (
        F.when(values.isNull(), F.lit(None))
        .when(F.size(values) == width, values)
        .otherwise(F.raise_error(message))
        .cast("array<float>")
    )


def dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda total, x: total + x)


def cosine(a: Column, b: Column) -> Column:
    """Cosine similarity in double precision; NULL if either vector has no length."""
    return F.try_divide(dot(a, b), F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)))


def hashed_word_counts(text: bytes, width: int) -> np.ndarray:
    """Counts of a text's words by hash bucket, scaled to length 1; zeros without words. White space is blank, tab, CR and LF."""
    # Two characters are letters here, but white space to split(), which also lists all words of a text at once.
    plain = len(text) <= SPLIT_BYTES and b"\x0b" not in text and b"\x0c" not in text
    words = Counter(text.split() if plain else (found[0] for found in re.finditer(rb"[^ \t\r\n]+", text)))
    digests = b"".join([hashlib.md5(word, usedforsecurity=False).digest() for word in words])
    buckets = np.frombuffer(digests, ">u4")[::4] % width  # the first four of a digest's sixteen bytes
    counts = np.bincount(buckets, np.fromiter(words.values(), np.float64, len(words)), width)
    length = math.sqrt(counts @ counts)
    return (counts / length if length else counts).astype(np.float32)
