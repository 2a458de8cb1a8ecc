"""Byte-level BPE as a lazily determinised transducer, and streaming decoding.

The merges define one encoding for every byte string, and every prefix of an encoding is the encoding of
its own bytes. So bytes can be read left to right: after each one, the last token of what has been read is
the one vocabulary entry that ends there and can stand beside the token before it. The state is the
longest end of the text that opens a token; states and moves are made when a text first needs them, and
which tokens can stand beside each other is worked out once per pair. A token is sent out once it is
common to the encodings of all positions at which a later token may still begin, which is after a
lookahead of about the longest token.

Nulls are encoded as empty texts; an empty text has no tokens. Repeated rows and ids stay as they are.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import struct
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm import pretokens
from tillroll.llm.common import freed_pieces, ragged, schema_with

# What a worker keeps at most, and works out anew beyond that: pairs of tokens, and bytes of encoded pieces of
# text with what Python needs to hold one.
MAX_PAIRS = 200_000
CACHE_BYTES, ENTRY_BYTES = 64_000_000, 200
# Text that is encoded at once, and the size from which a pre-token is encoded by bounded lookahead.
ENCODED_AT_ONCE, LONG_PIECE = 1_000_000, 4096


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


class _State:
    """The longest end of what was read that opens a token, with all tokens and openings that end here."""

    __slots__ = ("tail", "ends", "live", "moves")

    def __init__(self, tail: bytes, ranks: dict[bytes, int], openings: set[bytes]):
        self.tail = tail
        tails = [(n, tail[len(tail) - n :]) for n in range(len(tail), 0, -1)]
        self.ends = tuple((n, ranks[t]) for n, t in tails if t in ranks)
        self.live = tuple(n for n, t in tails if t in openings)
        self.moves: dict[int, _State] = {}


class Transducer:
    """Tokens of byte strings, with one move of a finite automaton per byte."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.bytes_of = {i: b for b, i in ranks.items()}
        self.size_of = {i: len(b) for b, i in ranks.items()}
        self.openings = {token[:n] for token in ranks for n in range(1, len(token))}
        self.halves: dict[int, tuple[int, ...] | None] = {}
        self.apart: dict[int, bool] = {}
        # There are no more states than beginnings of tokens.
        self.states: dict[bytes, _State] = {}
        self.start = self._state(b"")

    def merged(self, data: bytes, below: int = 1 << 30) -> list[bytes]:
        """The parts that the merges of ranks under `below` leave, lowest rank first."""
        parts = [data[i : i + 1] for i in range(len(data))]
        while len(parts) > 1:
            rank, at = min((self.ranks.get(a + b, below), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
            if rank >= below:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def _halves(self, token: int) -> tuple[int, ...] | None:
        """The two tokens whose merge made this one; None for single bytes."""
        if token not in self.halves:
            parts = self.merged(self.bytes_of[token], below=token)
            self.halves[token] = tuple(self.ranks[p] for p in parts) if len(parts) == 2 else None
        return self.halves[token]

    def _fit(self, left: int, right: int) -> bool:
        """Whether the two tokens stay apart when their bytes are merged together.

        Merges run in order of rank, so going back in time from the finished tokens, the younger of the
        two beside the border falls into its halves. They are joined if some pair that meets at the border
        has a merge that comes before either of them is taken up; of equal ranks, the left one goes first.
        """
        taken_left = taken_right = len(self.ranks)
        while True:
            joined = self.ranks.get(self.bytes_of[left] + self.bytes_of[right])
            if joined is not None and joined < taken_left and joined <= taken_right:
                return False
            of_left, of_right = self._halves(left), self._halves(right)
            if of_left and (not of_right or left > right):
                taken_left, left = left, of_left[1]
            elif of_right:
                taken_right, right = right, of_right[0]
            else:
                return True

    def _state(self, tail: bytes) -> _State:
        while tail and tail not in self.openings and tail not in self.ranks:
            tail = tail[1:]
        state = self.states.get(tail)
        if state is None:
            state = self.states[tail] = _State(tail, self.ranks, self.openings)
        return state

    def _read(self, state: _State, byte: int, last: list[int], to: _State | None = None) -> _State:
        """One move; appends the last token of the encoding of all that has been read."""
        to = to or state.moves.get(byte)
        if to is None:
            to = state.moves[byte] = self._state(state.tail + bytes((byte,)))
        for size, token in to.ends:
            left = last[-size]
            if left < 0:
                left = -2 - left  # already sent out
                if left < 0:
                    break
            pair = left << 20 | token
            fit = self.apart.get(pair)
            if fit is None:
                if len(self.apart) > MAX_PAIRS:
                    self.apart.clear()
                fit = self.apart[pair] = self._fit(left, token)
            if fit:
                break
        else:
            raise ValueError("the vocabulary lacks single bytes")
        last.append(token)
        return to

    def _back(self, last: list[int], at: int) -> list[int]:
        tokens = []
        while at and last[at] >= 0:
            tokens.append(last[at])
            at -= self.size_of[last[at]]
        return tokens[::-1]

    def encode(self, data: bytes) -> list[int]:
        state, last, apart = self.start, [-1], self.apart
        for byte in data:  # as in _read, without the call
            to = state.moves.get(byte)
            if to is None:
                to = state.moves[byte] = self._state(state.tail + bytes((byte,)))
            state = to
            for size, token in state.ends:
                left = last[-size]
                if left < 0 or apart.get(left << 20 | token):
                    last.append(token)
                    break
            else:
                self._read(state, byte, last, to)
        return self._back(last, len(last) - 1)

    def stream(self, data: Iterable[int]) -> Iterator[int]:
        """Tokens as soon as they are certain: those that the encodings of all positions at which a later
        token may begin have in common. Only what is still open is kept."""
        state, last = self.start, [-1]
        for byte in data:
            state = self._read(state, byte, last)
            chains = [self._back(last, len(last) - 1)]
            chains += [self._back(last, len(last) - 1 - n) for n in state.live]
            sure = 0
            while all(len(c) > sure for c in chains) and len({c[sure] for c in chains}) == 1:
                sure += 1
            if sure:
                yield from chains[0][:sure]
                gone = sum(self.size_of[t] for t in chains[0][:sure])
                first = last[gone]
                last = last[gone:]
                last[0] = -2 - first
        yield from self._back(last, len(last) - 1)


class Utf8Stream:
    """Text of bytes that come in pieces; up to three bytes of an unfinished character are held back.

    Bytes that are no UTF-8 become U+FFFD, as in one call over the whole.
    """

    def __init__(self) -> None:
        self.held = b""

    def feed(self, data: bytes) -> str:
        data = self.held + data
        keep = 0
        for back in range(1, min(3, len(data)) + 1):
            byte = data[-back]
            if byte >= 0xC0:
                needs = 2 if byte < 0xE0 else 3 if byte < 0xF0 else 4
                keep = back if needs > back else 0
                break
            if byte < 0x80:
                break
        self.held = data[len(data) - keep :]
        return data[: len(data) - keep].decode("utf-8", "replace")

    def close(self) -> str:
        held, self.held = self.held, b""
        return held.decode("utf-8", "replace")


class ColumnEncoder:
    """Token ids of a text column: each distinct piece of text is encoded once and looked up after that."""

    def __init__(self, encode_pieces: Callable[[list[bytes]], list[list[int]]]):
        self.encode_pieces = encode_pieces
        self.known: dict[bytes, bytes] = {}
        self.earlier: dict[bytes, bytes] = {}
        self.size = 0

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids in order, and the number of ids of each text."""
        found, counts = pretokens.cut(texts)
        if not len(found):
            return np.zeros(0, np.uint32), counts
        coded = found.dictionary_encode()
        _, places, data = coded.dictionary.buffers()
        raw, places = data.to_pybytes(), np.frombuffer(places, np.int32)[: len(coded.dictionary) + 1].tolist()
        pieces = [raw[a:b] for a, b in zip(places, places[1:])]
        if self.size > CACHE_BYTES // 2:  # what is in use comes back from the earlier half
            self.earlier, self.known, self.size = self.known, {}, 0
        ids = list(map(self.known.get, pieces))
        lacking = [i for i, data in enumerate(ids) if data is None]
        for i in lacking:
            ids[i] = self.earlier.get(pieces[i])
        new = [i for i in lacking if ids[i] is None]
        for i, own in zip(new, self.encode_pieces([pieces[i] for i in new])):
            ids[i] = struct.pack(f"<{len(own)}I", *own)
        for i in lacking:
            cost = ENTRY_BYTES + len(pieces[i]) + len(ids[i])
            if cost < CACHE_BYTES // 8:
                self.known[pieces[i]] = ids[i]
                self.size += cost
        lengths = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        flat = np.frombuffer(b"".join(ids), np.uint32)
        begins = np.cumsum(lengths) - lengths
        codes = coded.indices.to_numpy()
        per_piece = lengths[codes]
        sums = np.concatenate(([0], np.cumsum(per_piece)))
        text_ends = np.concatenate(([0], np.cumsum(counts)))
        return flat[ragged(begins[codes], per_piece)], np.diff(sums[text_ends])


@functools.cache
def _transducer(path: str) -> Transducer:
    return Transducer(read_ranks(path))


@functools.cache
def _rank_encoder(path: str) -> ColumnEncoder:
    transducer = _transducer(path)

    def encode(piece: bytes) -> list[int]:
        return transducer.encode(piece) if len(piece) < LONG_PIECE else list(transducer.stream(piece))

    return ColumnEncoder(lambda pieces: [encode(p) for p in pieces])


@functools.cache
def _vocabulary(path: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of all tokens end to end, and where each begins and how long it is."""
    ranks = read_ranks(path)
    size = max(ranks.values()) + 1
    by_id = [b""] * size
    for token, i in ranks.items():
        by_id[i] = token
    lengths = np.fromiter(map(len, by_id), np.int64, size)
    return np.frombuffer(b"".join(by_id), np.uint8), np.cumsum(lengths) - lengths, lengths


def decoded(ids: np.ndarray, path: str, step: int = 65_536) -> Iterator[str]:
    """Text of token ids, piece by piece."""
    data, begins, lengths = _vocabulary(path)
    stream = Utf8Stream()
    for low in range(0, len(ids), step):
        part = ids[low : low + step]
        yield stream.feed(data[ragged(begins[part], lengths[part])].tobytes())
    yield stream.close()


def encode(
    df: DataFrame, ranks_path: str, keep: list[str], text_col: str = "text",
    names: tuple[str, str] = ("token_ids", "n_tokens"),
) -> DataFrame:
    """The columns `keep`, then the ids, array<int>, and their number, under `names`, of every row's whole text."""

    def run(batches):
        encoder = _rank_encoder(ranks_path)
        for batch in batches:
            *kept, texts = batch.columns
            for first, piece in freed_pieces(texts, ENCODED_AT_ONCE):
                ids, counts = encoder.encode(piece)
                offsets = np.concatenate(([0], np.cumsum(counts))).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids.astype(np.int32)))
                rows = [c.slice(first, len(piece)) for c in kept]
                yield pa.RecordBatch.from_arrays([*rows, lists, pa.array(counts)], [*keep, *names])

    schema = schema_with(df, keep, f"`{names[0]}` array<int>, `{names[1]}` long")
    return df.select(*keep, F.col(text_col).alias("__text")).mapInArrow(run, schema)


def decode(df: DataFrame, ranks_path: str, keep: list[str], ids_col: str = "token_ids") -> DataFrame:
    """The columns `keep` and the `text` that the ids stand for; null ids give an empty text."""

    def run(batches):
        for batch in batches:
            *kept, lists = batch.columns
            texts = [
                "".join(decoded(np.array(ids.values if ids.is_valid else [], np.int64), ranks_path)) for ids in lists
            ]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(texts, pa.string())], [*keep, "text"])

    schema = schema_with(df, keep, "text string")
    return df.select(*keep, F.col(ids_col).alias("__ids")).mapInArrow(run, schema)


def round_trip(df: DataFrame, ranks_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: the id, `n_tokens`, and SHA-256 of the ids (little-endian, 32 bits each) and of the decoded
    bytes. Encoding and decoding happen in one pass, so no token leaves the worker."""

    def run(batches):
        encoder = _rank_encoder(ranks_path)
        for batch in batches:
            keys, texts = batch.columns
            for first, piece in freed_pieces(texts, ENCODED_AT_ONCE):
                ids, counts = encoder.encode(piece)
                ends = np.cumsum(counts)
                of_ids, of_text = [], []
                for low, high in zip(ends - counts, ends):
                    own = ids[low:high]
                    of_ids.append(hashlib.sha256(own.astype("<u4").tobytes()).hexdigest())
                    digest = hashlib.sha256()
                    for part in decoded(own, ranks_path):
                        digest.update(part.encode())
                    of_text.append(digest.hexdigest())
                yield pa.RecordBatch.from_arrays(
                    [keys.slice(first, len(piece)), pa.array(counts), pa.array(of_ids), pa.array(of_text)],
                    [id_col, "n_tokens", "ids_sha256", "decoded_sha256"],
                )

    schema = schema_with(df, [id_col], "n_tokens long, ids_sha256 string, decoded_sha256 string")
    return df.select(id_col, F.col(text_col).alias("__text")).mapInArrow(run, schema)
