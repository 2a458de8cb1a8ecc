"""Finding secrets: fixed patterns, and a character convolutional network over everything that looks like a key.

Every run of sixteen or more key characters is a candidate. The network reads windows that overlap and
together hold all of its characters with those around them; the largest score counts. Where patterns found a
part of a run, each of its other parts is scored for itself, however short. The network is trained on all distinct
windows, labelled by whether a pattern found them: dealt to shards by their hashes, where each is trained on for some
steps, then averaged, and so on. As patterns know secrets by their names and
alphabets, every secret is also learned where another candidate stands, and there with other letters and digits
and shorter, so that shape alone is recognised. The threshold is the highest that still keeps the wanted share of
the secrets as found, and of all these forms together, in the fourth of the windows that training did not see, however
low that is. Spans of the patterns always stay; the network adds spans beside them.

Null and empty texts have no spans. With less than four secrets or other candidates nothing is
added. Repeated rows are treated alike, each for itself; no row is moved.
"""

from __future__ import annotations

import re
import string
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import freed_pieces, schema_with, stored, text_pieces

# Fixed patterns of the job.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
LEAST = {"assign": 6, "access": 20, "hex": 24}
KINDS = ("assign", "access", "hex", "model")

# Texts without this have no assignment; it lets the slow pattern skip them.
ASSIGN_HINT = r"(?i)(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]"
LEAST_RUN = 16
CANDIDATE = re.compile(rf"[A-Za-z0-9+/_=-]{{{LEAST_RUN},}}")

# What the network reads: characters before, in and after a place in a candidate, and from one place to the next.
BEFORE, INSIDE, AFTER = 20, 32, 8
WINDOW = BEFORE + INSIDE + AFTER
STRIDE = 16
# Windows scored at a time.
SCORED = 2048
# Distinct labelled windows of the larger class in a shard, about; one in four is for the threshold.
SHARD = 3000
# Training steps of every shard, and how often the shards' networks are averaged in between.
STEPS, ROUNDS = 300, 10
# As many states of training, of 45 KB each, are added up at a time.
FAN = 64
SEED = 7
# The shards are read again in every round, from this many files at most.
MOST_FILES = 2048
RECALL = 0.99

Span = tuple[str, int, int]


def base_spans(text: str, runs: list[re.Match], may_assign: bool) -> list[Span]:
    """Spans of the fixed patterns. Access keys and hex strings that are long enough lie within runs."""
    found = []
    if may_assign:
        for m in ASSIGN.finditer(text):
            if m.end(2) - m.start(2) >= LEAST["assign"]:
                found.append(("assign", m.start(), m.end()))
    for run in runs:
        size = run.end() - run.start()
        for kind, pattern in (("access", ACCESS), ("hex", HEX)):
            if size >= LEAST[kind]:
                for m in pattern.finditer(text, run.start(), run.end()):
                    if m.end() - m.start() >= LEAST[kind]:
                        found.append((kind, m.start(), m.end()))
    return found


def window(text: str, start: int, end: int) -> str:
    """As much of text[start:end] as a window holds, between what stands around that, filled up with blanks."""
    before = text[max(0, start - BEFORE) : start].rjust(BEFORE)
    stop = min(end, start + INSIDE)
    return before + text[start:stop].ljust(INSIDE) + text[stop : stop + AFTER].ljust(AFTER)


def places(start: int, end: int) -> range:
    """Where the windows of text[start:end] begin; their insides cover it."""
    return range(start, max(start + 1, end - INSIDE + STRIDE), STRIDE)


def open_parts(run: tuple[int, int], base: list[Span]) -> list[tuple[int, int]]:
    """The parts of a run that no base span covers; the whole run where none touches it."""
    parts, at = [], run[0]
    for start, stop in sorted((start, stop) for _, start, stop in base if start < run[1] and run[0] < stop):
        if start > at:
            parts.append((at, start))
        at = max(at, stop)
    return [*parts, (at, run[1])] if at < run[1] else parts


def labelled(text: str, base: list[Span], runs: list[tuple[int, int]]) -> Iterator[tuple[str, int]]:
    """(window, label) for training: of each base span in a run the window that holds most of it, as a secret,
    and all windows that touch no base span, as none. A secret's score is thus no less than its window's."""
    for start, end in runs:
        own = places(start, end)
        touched, best = set(), set()
        for _, a, b in base:
            if a < end and start < b:
                a, b = max(a, start) - start, min(b, end) - start
                touched.update(range(max(0, (a - INSIDE) // STRIDE + 1), (b - 1) // STRIDE + 1))
                near = [min(a // STRIDE + i, len(own) - 1) for i in (0, 1)]
                best.add(max(near, key=lambda i: min(b, i * STRIDE + INSIDE) - max(a, i * STRIDE)))
        for i, at in enumerate(own):
            if i in best or i not in touched:
                yield window(text, at, end), int(i in best)


def _scan(texts: pa.Array):
    """(text, base spans, candidate spans) of every text."""
    hints = pc.match_substring_regex(texts, ASSIGN_HINT).to_pylist()
    for text, hint in zip(texts.to_pylist(), hints):
        runs = list(CANDIDATE.finditer(text))
        yield text, (base_spans(text, runs, hint) if runs or hint else []), [m.span() for m in runs]


def _codes(windows: list[str]) -> np.ndarray:
    """Printable ASCII by character, all others as one."""
    points = np.frombuffer("".join(windows).encode("utf-32-le"), np.uint32).reshape(-1, WINDOW)
    return np.where((points >= 32) & (points < 127), points - 31, 0).astype(np.int64)


# Codes of a blank, and of letters and digits.
BLANK = 1
KEY_CODES = np.array([ord(c) - 31 for c in string.ascii_letters + string.digits], np.int64)


@dataclass
class Network:
    """Embedding, one convolution, the largest response of each filter, one output."""

    embedding: np.ndarray
    filters: np.ndarray
    offsets: np.ndarray
    output: np.ndarray
    slope: float = 1.0
    shift: float = 0.0
    threshold: float = 2.0

    WIDTH = 5

    @property
    def weights(self) -> list[np.ndarray]:
        return [self.embedding, self.filters, self.offsets, self.output]

    @classmethod
    def fresh(cls, rng: np.random.Generator, size: int = 8, n_filters: int = 24) -> Network:
        return cls(
            rng.normal(0, 0.3, (96, size)),
            rng.normal(0, 0.2, (cls.WIDTH * (size + 1), n_filters)),
            np.zeros(n_filters),
            rng.normal(0, 0.2, n_filters + 1),
        )

    def _columns(self, codes: np.ndarray) -> np.ndarray:
        inside = np.zeros((*codes.shape, 1))
        inside[:, BEFORE : BEFORE + INSIDE] = (codes[:, BEFORE : BEFORE + INSIDE] > BLANK)[..., None]
        letters = np.concatenate((self.embedding[codes], inside), axis=2)
        steps = WINDOW - self.WIDTH + 1
        return np.concatenate([letters[:, i : i + steps] for i in range(self.WIDTH)], axis=2)

    def _forward(self, codes: np.ndarray):
        columns = self._columns(codes)
        response = columns @ self.filters + self.offsets
        best = response.argmax(axis=1)
        pooled = np.maximum(np.take_along_axis(response, best[:, None], 1)[:, 0], 0)
        return columns, best, pooled, pooled @ self.output[:-1] + self.output[-1]

    def logits(self, codes: np.ndarray) -> np.ndarray:
        return self._forward(codes)[-1]

    def gradients(self, codes: np.ndarray, labels: np.ndarray) -> list[np.ndarray]:
        columns, best, pooled, logit = self._forward(codes)
        error = (1 / (1 + np.exp(-np.clip(logit, -30, 30))) - labels) / len(labels)
        on_output = np.append(error @ pooled, error.sum())
        on_pooled = np.outer(error, self.output[:-1]) * (pooled > 0)
        rows = np.arange(len(codes))[:, None]
        at_best = columns[rows, best]  # example, filter, column
        on_filters = np.einsum("ef,efc->cf", on_pooled, at_best)
        on_columns = on_pooled[:, :, None] * self.filters.T[None]
        size = self.embedding.shape[1]
        on_embedding = np.zeros_like(self.embedding)
        for i in range(self.WIDTH):
            part = on_columns[:, :, i * (size + 1) : i * (size + 1) + size]
            np.add.at(on_embedding, codes[rows, best + i], part)
        return [on_embedding, on_filters, on_pooled.sum(axis=0), on_output]

    def probabilities(self, windows: list[str]) -> np.ndarray:
        if not windows:
            return np.zeros(0)
        logits = np.concatenate([self.logits(_codes(windows[i : i + SCORED])) for i in range(0, len(windows), SCORED)])
        return self.calibrated(logits)

    def calibrated(self, logits: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * logits + self.shift, -30, 30)))


def _hash(text: str) -> int:
    return xxhash.xxh64_intdigest(text)


def distinct(windows: list[str], labels: np.ndarray) -> tuple[list[str], np.ndarray, np.ndarray]:
    """The distinct windows by hash, their labels, and which are held out: every fourth of either class. A
    window that stands as a secret anywhere is one."""
    label_of: dict[str, int] = {}
    for one, label in zip(windows, np.asarray(labels).tolist()):
        label_of[one] = max(int(label), label_of.get(one, 0))
    own = sorted(label_of, key=lambda w: (_hash(w), w))
    marks = np.array([label_of[w] for w in own], int)
    held = np.zeros(len(own), bool)
    for side in (0, 1):
        held[np.flatnonzero(marks == side)[3::4]] = True
    return own, marks, held


def disguised(codes: np.ndarray, labels: np.ndarray, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """The examples, and every secret twice more: where another candidate stands, without the name that gave it
    away, and there also with other letters and digits and cut to other lengths, as keys of other makers have them."""
    secret, clean = codes[labels == 1], codes[labels == 0]
    moved = secret.copy()
    inside = slice(BEFORE, BEFORE + INSIDE)
    around = np.r_[:BEFORE, BEFORE + INSIDE : WINDOW]
    moved[:, around] = clean[rng.integers(0, len(clean), len(secret))][:, around]
    drawn = moved.copy()
    drawn[:, inside] = np.where(
        np.isin(moved[:, inside], KEY_CODES), KEY_CODES[rng.integers(0, len(KEY_CODES), (len(secret), INSIDE))], moved[:, inside]
    )
    length = rng.integers(LEAST_RUN, INSIDE + 1, len(secret))
    drawn[:, inside][np.arange(INSIDE) >= length[:, None]] = BLANK
    return np.concatenate((codes, moved, drawn)), np.concatenate((labels, np.ones(2 * len(secret), int)))


@dataclass
class Training:
    """A network on its way, with the running means and squares of its gradients, and the examples it learns from."""

    network: Network
    means: list[np.ndarray]
    squares: list[np.ndarray]
    rng: np.random.Generator
    codes: np.ndarray
    labels: np.ndarray
    kept_codes: np.ndarray
    truth: np.ndarray
    n_held: int  # of the kept examples, those that stand as found; the disguised ones come after

    @classmethod
    def begun(cls, windows: list[str], labels: np.ndarray, seed: int) -> Training:
        """Three of four distinct examples to learn from, the fourth to calibrate and set the threshold on."""
        windows, labels, held = distinct(windows, labels)
        codes = _codes(windows)
        rng = np.random.default_rng(seed)
        network = Network.fresh(rng)
        kept_codes, truth = disguised(codes[held], labels[held], rng)
        codes, labels = disguised(codes[~held], labels[~held], rng)
        means, squares = ([np.zeros_like(w) for w in network.weights] for _ in range(2))
        return cls(network, means, squares, rng, codes, labels, kept_codes, truth, int(held.sum()))

    def go(self, first: int, last: int) -> None:
        """Steps `first` to `last`, counted from 1, on the examples that all steps from 1 on would draw."""
        sides = [np.flatnonzero(self.labels == side) for side in (0, 1)]
        for step in range(1, last + 1):
            batch = np.concatenate([self.rng.choice(side, 64) for side in sides])
            if step < first:
                continue
            gradients = self.network.gradients(self.codes[batch], self.labels[batch])
            for weight, mean, square, gradient in zip(self.network.weights, self.means, self.squares, gradients):
                mean += 0.1 * (gradient - mean)
                square += 0.01 * (gradient**2 - square)
                weight -= 0.01 * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-8)

    def held_logits(self) -> np.ndarray:
        n = len(self.truth)
        return np.concatenate([self.network.logits(self.kept_codes[i : i + SCORED]) for i in range(0, n, SCORED)])

    @property
    def state(self) -> np.ndarray:
        return np.concatenate([one.ravel() for one in (*self.network.weights, *self.means, *self.squares)])

    @state.setter
    def state(self, values: np.ndarray) -> None:
        at = 0
        for one in (*self.network.weights, *self.means, *self.squares):
            one[...] = values[at : at + one.size].reshape(one.shape)
            at += one.size


def calibration(logits: np.ndarray, truth: np.ndarray, counts: np.ndarray | None = None) -> tuple[float, float]:
    """(slope, shift) of a logistic calibration, slightly held towards the network's own scale."""
    slope, shift = 1.0, 0.0
    for _ in range(300):
        error = 1 / (1 + np.exp(-np.clip(slope * logits + shift, -30, 30))) - truth
        slope -= 0.05 * (np.average(error * logits, weights=counts) + 0.01 * (slope - 1))
        shift -= 0.05 * np.average(error, weights=counts)
    return float(slope), float(shift)


def train(windows: list[str], labels: np.ndarray, steps: int = STEPS, seed: int = SEED) -> Network | None:
    """Fit on three of four distinct examples; calibrate and set the threshold on the fourth."""
    marks = distinct(windows, labels)[1]
    if min((marks == 0).sum(), (marks == 1).sum()) < 4:
        return None
    training = Training.begun(windows, labels, seed)
    training.go(1, steps)
    network, logits, truth = training.network, training.held_logits(), training.truth
    network.slope, network.shift = calibration(logits, truth)
    scores = network.calibrated(logits[truth == 1])
    as_found = scores[: len(scores) // 3]  # the disguised ones come after
    network.threshold = min(recall_threshold(as_found), recall_threshold(scores))
    return network


def recall_threshold(scores: np.ndarray, recall: float = RECALL) -> float:
    """The highest threshold that `recall` of the scores reach."""
    return float(np.sort(scores)[lost_of(len(scores), recall)])


def lost_of(n: int, recall: float = RECALL) -> int:
    """How many of n may be lost."""
    return int((1 - recall) * n + 1e-9)


def kth_least(values: DataFrame, k: int) -> float:
    """The value before which k of the column `value` stand in order, found by counting in ever finer bins."""
    low, high = values.agg(F.min("value"), F.max("value")).first()
    while low < high:
        at = F.floor((F.col("value") - low) / (high - low) * 4096).alias("at")
        bins = values.where(F.col("value").between(low, high)).groupBy(at).agg(
            F.count("*").alias("n"), F.min("value").alias("low"), F.max("value").alias("high")
        )
        for one in bins.orderBy("at").collect():  # at most 4,097 rows
            if k < one["n"]:
                low, high = one["low"], one["high"]
                break
            k -= one["n"]
    return low


def labelled_windows(df: DataFrame, text_col: str = "text", sample: int = SHARD) -> DataFrame:
    """(h, window, label) over all candidates; the label says whether a fixed pattern found it. A task sends what it
    has found, without repeats, whenever that are more than `sample` windows of a class."""

    def sent(label: int, own: dict[str, int]) -> pa.RecordBatch:
        columns = [pa.array([h - (1 << 63) for h in own.values()], pa.int64()), pa.array(list(own), pa.string()),
                   pa.array([label] * len(own), pa.int32())]
        return pa.RecordBatch.from_arrays(columns, ["h", "window", "label"])

    def run(batches):
        held: tuple[dict[str, int], dict[str, int]] = ({}, {})  # window -> hash
        for batch in batches:
            for _, piece in text_pieces(batch.column(0)):
                for found in _scan(piece):
                    for one, label in labelled(*found):
                        if one not in held[label]:
                            held[label][one] = _hash(one)
                            if len(held[label]) > sample:
                                yield sent(label, held[label])
                                held[label].clear()
        for label, own in enumerate(held):
            yield sent(label, own)

    return df.select(F.col(text_col).alias("__text")).mapInArrow(run, "h long, window string, label int")


def shards_of(windows: DataFrame, sizes: dict[int, int], shard: int) -> tuple[DataFrame, int, list[int]]:
    """(shard, windows, labels) of shards that hold about `shard` windows of the larger class; how many they are; and
    of either class, in how many of them, from the first, stand different windows. A class too small
    for all shards is dealt to some, and again to the next ones."""
    n_shards = -(-max(sizes.values()) // shard)
    parts = [min(n_shards, max(1, sizes[side] // max(64, shard // 4))) for side in (0, 1)]

    def dealt(side: int) -> DataFrame:
        every = F.sequence(F.pmod("h", F.lit(parts[side])), F.lit(n_shards - 1).cast("long"), F.lit(parts[side]).cast("long"))
        return windows.where(F.col("label") == side).select(F.explode(every).alias("shard"), "window", "label")

    rows = dealt(0).unionByName(dealt(1)).groupBy("shard").agg(F.collect_list(F.struct("window", "label")).alias("rows"))
    return rows.select("shard", F.col("rows.window").alias("windows"), F.col("rows.label").alias("labels")), n_shards, parts


def _summed(states: DataFrame, n: int) -> np.ndarray:
    """The sum of the states (node, state) of nodes 0 to n - 1, added in their order, so that it is always the same."""

    def total(table: pa.Table) -> np.ndarray:
        own = sorted(zip(table["node"].to_pylist(), table["state"].to_pylist()))
        return sum(np.frombuffer(state) for _, state in own)

    def merge(table: pa.Table) -> pa.Table:
        up = table["node"][0].as_py() // FAN
        return pa.table({"node": pa.array([up], pa.int64()), "state": pa.array([total(table).tobytes()], pa.binary())})

    while n > FAN:
        up = F.floor(F.col("node") / FAN).alias("up")
        states, n = states.groupBy(up).applyInArrow(merge, "node long, state binary"), -(-n // FAN)
    return total(states.toArrow())  # at most FAN rows


def _trained(shards: DataFrame, state: np.ndarray, first: int, last: int) -> DataFrame:
    """(node, state) of every shard after the steps `first` to `last` from the given state."""

    def run(batches):
        for batch in batches:
            for one in batch.to_pylist():
                training = Training.begun(one["windows"], np.array(one["labels"]), SEED)
                training.state = state
                training.go(first, last)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([one["shard"]], pa.int64()), pa.array([training.state.tobytes()], pa.binary())], ["node", "state"]
                )

    return shards.mapInArrow(run, "node long, state binary")


def _held_logits(shards: DataFrame, state: np.ndarray, parts: list[int]) -> DataFrame:
    """(truth, as_found, logit) of all examples that are held out, each of them once."""

    def run(batches):
        for batch in batches:
            for one in batch.to_pylist():
                training = Training.begun(one["windows"], np.array(one["labels"]), SEED)
                training.state = state
                truth = training.truth
                new = np.array([one["shard"] < n for n in parts])[truth]
                as_found = np.arange(len(truth)) < training.n_held
                columns = [pa.array(c[new]) for c in (truth.astype(np.int32), as_found, training.held_logits())]
                yield pa.RecordBatch.from_arrays(columns, ["truth", "as_found", "logit"])

    return shards.mapInArrow(run, "truth int, as_found boolean, logit double")


def fit(df: DataFrame, text_col: str = "text", shard: int = SHARD) -> Network | None:
    """Train on all distinct labelled windows, in shards of about `shard` windows of the larger class.

    All shards start from the same network; after some steps each on its own windows their networks (and the running
    means of their gradients) are averaged, and go on from there. Calibration counts the held-out logits of all
    shards in hundredths; the threshold is exact over all of them. What fits into one shard is trained by `train`.
    """
    every = labelled_windows(df, text_col, shard).groupBy("h", "window").agg(F.max("label").alias("label"))
    every = stored(every, "labelled-windows")
    sizes = {0: 0, 1: 0} | {r["label"]: r["count"] for r in every.groupBy("label").count().collect()}
    if min(sizes.values()) < 4:
        return None
    if max(sizes.values()) <= shard:
        rows = every.collect()  # one shard
        return train([r["window"] for r in rows], np.array([r["label"] for r in rows]))
    shards, n_shards, parts = shards_of(every, sizes, shard)
    shards = stored(shards.repartition(min(n_shards, MOST_FILES)), "window-shards")
    network = Network.fresh(np.random.default_rng(SEED))
    size = sum(w.size for w in network.weights)
    state = np.zeros(3 * size)
    state[:size] = np.concatenate([w.ravel() for w in network.weights])
    for turn in range(ROUNDS):
        first, last = turn * STEPS // ROUNDS + 1, (turn + 1) * STEPS // ROUNDS
        state = _summed(_trained(shards, state, first, last), n_shards) / n_shards
    at = 0
    for weight in network.weights:
        weight[...] = state[at : at + weight.size].reshape(weight.shape)
        at += weight.size

    held = stored(_held_logits(shards, state, parts), "held-out-logits")
    place = F.floor(F.greatest(F.least("logit", F.lit(60.0)), F.lit(-60.0)) * 100).alias("place")
    bins = held.groupBy("truth", place).count().orderBy("truth", "place").collect()  # at most 24,002 rows
    truth, places, counts = (np.array([r[i] for r in bins], float) for i in range(3))
    network.slope, network.shift = calibration((places + 0.5) / 100, truth, counts)
    sign = 1.0 if network.slope >= 0 else -1.0
    found = held.where("truth = 1").select((sign * F.col("logit")).alias("value"), "as_found")
    least = [kth_least(own, lost_of(own.count())) for own in (found.where("as_found"), found)]
    network.threshold = float(network.calibrated(sign * np.array(least)).min())
    return network


def _spans(piece: pa.Array, network: Network | None) -> list[tuple[str, list[Span]]]:
    found = list(_scan(piece))
    if network is not None:
        parts = [(i, part) for i, (_, base, runs) in enumerate(found) for run in runs for part in open_parts(run, base)]
        scores = np.zeros(len(parts))
        every = ((k, window(found[i][0], at, part[1])) for k, (i, part) in enumerate(parts) for at in places(*part))
        while some := list(islice(every, SCORED)):
            owners, windows = zip(*some)
            np.maximum.at(scores, np.array(owners), network.probabilities(list(windows)))
        for (i, part), score in zip(parts, scores):
            if score >= network.threshold:
                found[i][1].append(("model", *part))
    return [(text, sorted(spans, key=lambda s: (s[1], KINDS.index(s[0])))) for text, spans, _ in found]


def find(df: DataFrame, network: Network | None, keep: list[str], text_col: str = "text") -> DataFrame:
    """The columns `keep` and `spans`, array<struct<kind, start, stop>> in order, of every row's whole text.

    Places are code points, `stop` exclusive.
    """
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("stop", pa.int64())]))

    def run(batches):
        for batch in batches:
            *kept, texts = batch.columns
            for first, piece in text_pieces(texts):
                spans = [[dict(zip(("kind", "start", "stop"), s)) for s in own] for _, own in _spans(piece, network)]
                rows = [c.slice(first, len(piece)) for c in kept]
                yield pa.RecordBatch.from_arrays([*rows, pa.array(spans, kind)], [*keep, "spans"])

    schema = schema_with(df, keep, "spans array<struct<kind:string,start:bigint,stop:bigint>>")
    return df.select(*keep, F.col(text_col).alias("__text")).mapInArrow(run, schema)


def redact(df: DataFrame, network: Network | None, text_col: str = "text", mark: str = "[REDACTED]") -> DataFrame:
    """All rows and columns, with every span of the texts replaced; overlapping spans become one mark.

    Null texts stay null. Only texts go to Python and back; the rows stay in the JVM.
    """
    def run(texts: pa.Array) -> pa.Array:
        clean = []
        for first, piece in freed_pieces(texts):
            for (text, spans), valid in zip(_spans(piece, network), texts.slice(first, len(piece)).is_valid().to_pylist()):
                parts, done = [], 0
                for _, start, stop in spans:
                    if start >= done:
                        parts += [text[done:start], mark]
                    done = max(done, stop)
                clean.append("".join([*parts, text[done:]]) if valid else None)
        return pa.array(clean, pa.string())

    return df.withColumn(text_col, F.arrow_udf(run, "string")(F.col(text_col)))
