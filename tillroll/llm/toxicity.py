"""Toxic spans and scores from a linear-chain conditional random field over words.

Labels stand on documents only, so training tokens are labelled from them: a word whose form, beginning or
end a bounded sample of training documents shows mostly in toxic ones is a toxic token there; all tokens of
clean documents are clean. The field has two states; a word's features are its form without outer signs, its beginnings
and ends, and its case. Forward and backward messages give each token's probability of being toxic. A
document's score is a logistic function of their sum and their largest, fitted on the same sample.

The field is trained by full gradient steps over all windows of the sampled documents. They stay
in a stored table; each step is a job whose tasks add up the gradient of their windows, so that one vector of
fixed size per task comes back, however long the texts are.

Null and empty texts have no tokens: they get the score of a document without any hit. Repeated rows are
scored alike, each for itself; of rows that share a labelled id, training reads the one whose text has the least
hash, so that the bound on the sample holds for rows. Very long texts are read whole, in training and in scoring, which
needs some hundred bytes a word of one text. Without labels of both classes nothing is learnt and every
score is 0. Columns other than those named are passed through, whatever their names.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import schema_with, stored, text_pieces, words_of

# Labelled documents of either class that training reads, at most; those whose hashed ids are least.
SAMPLE = 1500
FOLDS = 5
# A form, beginning or end of words counts as toxic from so much higher a share of the toxic documents, and
# so many standard deviations above chance.
LEAST_RATIO, LEAST_SDS = 6.0, 4.5
# Training windows: the words of a sampled document, so many at a time. Steps of the training, and windows whose
# messages a worker works out at once.
SPAN, STEPS, AT_ONCE = 20, 40, 4096
BUCKETS = 1 << 16
MAX_WORDS = 300_000
# Text scored at a time: messages take a step per word of the longest text, whatever the number of texts.
PIECE = 16_000_000
WORD = re.compile(r"[^\x20\x09-\x0D]+")
OUTER = re.compile(r"^[\W_]+|[\W_]+$")


def held_out(doc_id: Column) -> Column:
    """Documents that training never reads: every fifth by CRC-32 of the id's text; null ids are held out."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % FOLDS == 0, F.lit(True))


def core(word: str) -> str:
    return OUTER.sub("", word).lower()


def stems(word: str) -> list[str]:
    """The word's form, its beginnings and its ends, as keys."""
    own = core(word)
    if not own:
        return []
    keys = [f"={own}"]
    keys += [f"^{own[:n]}" for n in range(3, min(9, len(own)))]
    keys += [f"{own[-n:]}$" for n in range(3, min(7, len(own)))]
    return keys


# A bias, the case, and up to eleven stems.
N_FEATURES = 13


def features(word: str) -> list[int]:
    """Hashed features of one word, padded to one length."""
    names = ["bias", f"case={word[:1].isupper()}{word[1:2].isupper()}", *stems(word)]
    found = [xxhash.xxh32_intdigest(n) % (BUCKETS - 1) + 1 for n in names]
    return found + [0] * (N_FEATURES - len(found))


@dataclass
class Model:
    """Weights of the features and moves in favour of the toxic state, and of the document score."""

    weights: np.ndarray
    moves: np.ndarray  # log weights: from state, to state
    document: np.ndarray = field(default_factory=lambda: np.zeros(3))
    known: dict[str, float] = field(default_factory=dict, repr=False)
    earlier: dict[str, float] = field(default_factory=dict, repr=False)

    def __getstate__(self):
        return {**self.__dict__, "known": {}, "earlier": {}}

    def word_scores(self, words: list[str]) -> np.ndarray:
        if len(self.known) > MAX_WORDS:  # words in use come back from the earlier half
            self.earlier, self.known = self.known, {}
        lacking = [w for w in words if w not in self.known]
        new = [w for w in lacking if w not in self.earlier]
        scores = self.weights[np.array([features(w) for w in new], np.int64).reshape(-1, N_FEATURES)].sum(axis=1)
        found = dict(zip(new, scores.tolist()))
        self.known.update((w, found[w] if w in found else self.earlier[w]) for w in lacking)
        return np.fromiter(map(self.known.__getitem__, words), float, len(words))

    def marginals(self, scores: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Probability of the toxic state of every token; texts of `counts` tokens lie end to end.

        All texts take their next token at once, longest texts first, so that those still going form a
        prefix. Messages are odds of toxic against clean.
        """
        emit = np.exp(np.clip(scores, -30, 30))
        stay, leave = np.exp(self.moves[0]), np.exp(self.moves[1])
        by_length = np.argsort(-counts, kind="stable")
        starts = (np.cumsum(counts) - counts)[by_length]
        lengths = counts[by_length]
        longest = int(lengths[0]) if len(lengths) else 0
        going = len(lengths) - np.searchsorted(lengths[::-1], np.arange(longest), side="right")
        forward, backward = np.empty(len(scores)), np.empty(len(scores))
        odds = np.zeros(0)
        for t in range(longest):
            at = starts[: going[t]] + t
            before = odds[: going[t]] if t else None
            carried = 1.0 if before is None else (stay[1] + before * leave[1]) / (stay[0] + before * leave[0])
            odds = np.minimum(emit[at] * carried, 1e30)
            forward[at] = odds
        after = np.ones(len(lengths))
        for t in range(longest - 1, -1, -1):
            k = going[t]
            at = starts[:k] + t
            backward[at] = after[:k]
            ahead = np.minimum(emit[at] * after[:k], 1e30)
            after[:k] = (leave[0] + leave[1] * ahead) / (stay[0] + stay[1] * ahead)
        joint = forward * backward
        return joint / (1 + joint)

    def score(self, sums: np.ndarray, most: np.ndarray) -> np.ndarray:
        z = self.document[0] + self.document[1] * np.log1p(sums) + self.document[2] * most
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def gradient(
    weights: np.ndarray, moves: np.ndarray, words: np.ndarray, tags: np.ndarray, lengths: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Slope of the log likelihood of the tags, by weights and by moves. words: windows x SPAN x features; tags:
    windows x SPAN (0 beyond the window's length)."""
    n, span, _ = words.shape
    inside = np.arange(span)[None] < lengths[:, None]
    on_moves = np.zeros((2, 2))
    for a in (0, 1):
        for b in (0, 1):
            on_moves[a, b] = ((tags[:, :-1] == a) & (tags[:, 1:] == b) & inside[:, 1:]).sum()
    emit = np.stack([np.zeros((n, span)), weights[words].sum(axis=2)], axis=2)
    forward = np.empty((n, span, 2))
    forward[:, 0] = emit[:, 0]
    for t in range(1, span):
        step_in = np.logaddexp.reduce(forward[:, t - 1, :, None] + moves[None], axis=1) + emit[:, t]
        forward[:, t] = np.where(inside[:, t, None], step_in, forward[:, t - 1])
    backward = np.zeros((n, span, 2))
    total = np.logaddexp.reduce(forward[:, -1], axis=1)
    for t in range(span - 2, -1, -1):
        ahead = moves[None] + (emit[:, t + 1] + backward[:, t + 1])[:, None]
        own = np.logaddexp.reduce(ahead, axis=2)
        backward[:, t] = np.where(inside[:, t + 1, None], own, backward[:, t + 1])
        joint = np.exp(forward[:, t, :, None] + ahead - total[:, None, None])
        on_moves -= (joint * inside[:, t + 1, None, None]).sum(axis=0)
    toxic = np.exp(forward[:, :, 1] + backward[:, :, 1] - total[:, None])
    error = (tags - toxic) * inside
    on_weights = np.bincount(words.ravel(), np.repeat(error.ravel(), words.shape[2]), minlength=BUCKETS)
    on_weights[0] = 0.0  # padding
    return on_weights, on_moves


def train_field(windows: DataFrame, n: int, steps: int = STEPS) -> Model:
    """Maximum likelihood by Adam over the stored windows (words: SPAN x features numbers, tags), `n` of them."""
    params = [np.zeros(BUCKETS), np.zeros((2, 2))]
    slots = [(np.zeros_like(p), np.zeros_like(p)) for p in params]

    def slope(weights: np.ndarray, moves: np.ndarray) -> list[np.ndarray]:
        def run(batches):
            sums = [np.zeros(BUCKETS), np.zeros((2, 2))]
            for batch in batches:
                for low in range(0, batch.num_rows, AT_ONCE):
                    part = batch.slice(low, AT_ONCE)
                    lengths = part.column("length").to_numpy().astype(np.int64)
                    words = np.frombuffer(b"".join(part.column("words").to_pylist()), "<i4")
                    tags = np.frombuffer(b"".join(part.column("tags").to_pylist()), np.uint8).astype(np.int64)
                    found = gradient(weights, moves, words.reshape(-1, SPAN, N_FEATURES), tags.reshape(-1, SPAN), lengths)
                    sums = [x + y for x, y in zip(sums, found)]
            yield pa.RecordBatch.from_arrays([pa.array([x.tobytes()]) for x in sums], ["weights", "moves"])

        rows = windows.mapInArrow(run, "weights binary, moves binary").collect()  # one of fixed size per task
        every = [[np.frombuffer(r[i]) for r in rows] for i in range(2)]
        # Sums of floats hang on their order; rounding hides which task came first.
        return [np.round(np.sum(x, axis=0), 9).reshape(p.shape) for x, p in zip(every, params)]

    for step in range(1, steps + 1):
        for i, slopes in enumerate(slope(*params)):
            mean, square = slots[i]
            step_up = (slopes - 0.02 * params[i]) / n
            mean += 0.1 * (step_up - mean)
            square += 0.01 * (step_up**2 - square)
            params[i] = params[i] + 0.15 * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-8)
    return Model(params[0], params[1])


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, rounds: int = 25) -> np.ndarray:
    """Weighted logistic regression by Newton steps, with a weak prior."""
    beta = np.zeros(x.shape[1])
    prior = np.diag([1e-4, *[1e-2] * (x.shape[1] - 1)])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        curve = (x * (weight * p * (1 - p))[:, None]).T @ x + prior
        beta = beta + np.linalg.solve(curve, x.T @ (weight * (y - p)) - prior @ beta)
    return beta


def training_documents(documents: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """(h, text, toxic): at most `sample` labelled documents of either class outside the held-out fold."""
    marks = labels.select(F.col("doc_id").alias("__id"), F.col("toxic").alias("__toxic")).where("__toxic in (0, 1)")
    marks = marks.where(~held_out(F.col("__id"))).groupBy("__id").agg(F.max("__toxic").alias("__toxic"))
    # The ids are chosen first, so the texts of the chosen few alone are joined, by a broadcast of them.
    h = F.xxhash64(F.col("__id"))
    chosen = [marks.where(F.col("__toxic") == side).orderBy(h, "__id").limit(sample) for side in (0, 1)]
    few = F.broadcast(chosen[0].unionByName(chosen[1]))
    texts = documents.select(F.col("doc_id").alias("__doc"), F.col("text").alias("__text"))
    joined = texts.join(few, F.col("__doc") == F.col("__id"))
    own = joined.select(h.alias("h"), "__id", F.coalesce("__text", F.lit("")).alias("text"), F.col("__toxic").cast("int").alias("toxic"))
    # One row per id, merged within tasks, however many rows share it.
    first = F.min(F.struct(F.xxhash64("text"), "text"))
    return own.groupBy("h", "__id", "toxic").agg(first.alias("first")).select("h", F.col("first.text").alias("text"), "toxic")


def _stem_counts(batches):
    """(stem, toxic documents, clean documents), summed up over a batch."""
    for batch in batches:
        sides = (Counter(), Counter())
        for text, toxic in zip(batch["text"].to_pylist(), batch["toxic"].to_pylist()):
            sides[toxic].update({key for word in set(WORD.findall(text)) for key in stems(word)})
        keys = list(sides[0].keys() | sides[1].keys())
        yield pa.RecordBatch.from_arrays(
            [pa.array(keys, pa.string()), *(pa.array([side[k] for k in keys], pa.int64()) for side in sides[::-1])],
            ["stem", "t", "c"],
        )


def toxic_stems(sample: DataFrame, n_toxic: int, n_clean: int) -> list[str]:
    """Forms, beginnings and ends of words that tell toxic documents from clean ones."""
    counted = sample.select("text", "toxic").mapInArrow(_stem_counts, "stem string, t long, c long")
    sums = counted.groupBy("stem").agg(F.sum("t").alias("t"), F.sum("c").alias("c"))
    ratio = ((F.col("t") + 0.5) / (n_toxic + 1)) / ((F.col("c") + 0.5) / (n_clean + 1))
    share = n_toxic / (n_toxic + n_clean)
    both = F.col("t") + F.col("c")
    above = (F.col("t") - share * both) / F.sqrt(share * (1 - share) * both)
    found = sums.where((ratio >= LEAST_RATIO) & (above >= LEAST_SDS))
    return sorted(r["stem"] for r in found.collect())


def windows_of(sample: DataFrame, lexicon: list[str]) -> DataFrame:
    """(words, tags, length) of all windows of the sampled documents: features of SPAN words, and one byte a word
    that says whether it is tagged as toxic. Toxic words are those of toxic documents with a listed stem."""
    listed = frozenset(lexicon)

    def run(batches):
        known: dict[str, tuple[bytes, bool]] = {}
        nothing = np.zeros(N_FEATURES, "<i4").tobytes()
        for batch in batches:
            for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
                rows = []
                if len(known) > MAX_WORDS:
                    known.clear()
                words = WORD.findall(text)
                for word in words:
                    if word not in known:
                        known[word] = np.array(features(word), "<i4").tobytes(), not listed.isdisjoint(stems(word))
                for low in range(0, len(words), SPAN):
                    own = [known[word] for word in words[low : low + SPAN]]
                    spare = SPAN - len(own)
                    tags = bytes(int(bool(toxic) and hit) for _, hit in own) + bytes(spare)
                    rows.append((b"".join(x for x, _ in own) + nothing * spare, tags, len(own)))
                if rows:
                    kinds = (pa.binary(), pa.binary(), pa.int32())
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(column, kind) for column, kind in zip(zip(*rows), kinds)], ["words", "tags", "length"]
                    )

    return sample.select("text", "toxic").mapInArrow(run, "words binary, tags binary, length int")


def _aggregates(model: Model, piece: pa.Array):
    """Sum and largest of the tokens' probabilities per text, and all of them with the tokens' counts."""
    words, counts = words_of(piece)
    if not len(words):
        return np.zeros(len(counts)), np.zeros(len(counts)), np.zeros(0), counts
    coded = words.dictionary_encode()
    scores = model.word_scores(coded.dictionary.to_pylist())[coded.indices.to_numpy()]
    p = model.marginals(scores, counts)
    ends = np.concatenate(([0], np.cumsum(counts)))
    sums = np.concatenate(([0.0], np.cumsum(np.where(p > 0.1, p, 0.0))))
    most = np.zeros(len(counts))
    filled = counts > 0
    most[filled] = np.maximum.reduceat(p, ends[:-1][filled])
    return np.maximum(sums[ends[1:]] - sums[ends[:-1]], 0.0), most, p, counts


def fit(documents: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model | None:
    """Train on labelled documents outside the held-out fold, as many as `sample` of either class."""
    chosen = stored(training_documents(documents, labels, sample), "toxic-sample")
    sizes = {r["toxic"]: r["count"] for r in chosen.groupBy("toxic").count().collect()}
    if len(sizes) < 2:
        return None
    windows = stored(windows_of(chosen, toxic_stems(chosen, sizes[1], sizes[0])), "toxic-windows")
    n = windows.count()
    if not n:
        return None
    model = train_field(windows, n)

    def run(batches):
        for batch in batches:
            for first, piece in text_pieces(batch["text"]):
                sums, most, _, _ = _aggregates(model, piece)
                own = batch["toxic"].slice(first, len(piece))
                yield pa.RecordBatch.from_arrays([pa.array(sums), pa.array(most), own], ["sums", "most", "toxic"])

    found = np.array(
        sorted(map(tuple, chosen.select("text", "toxic").mapInArrow(run, "sums double, most double, toxic int").collect()))
    )
    # The sample has other shares of the classes than the labels; their weights undo that.
    shares = labels.where(F.col("toxic").isin(0, 1) & ~held_out(F.col("doc_id"))).groupBy("toxic").count().collect()
    whole = {r["toxic"]: r["count"] for r in shares}
    toxic = found[:, 2]
    weight = np.where(toxic == 1, whole[1] / sizes[1], whole[0] / sizes[0])
    x = np.column_stack([np.ones(len(found)), np.log1p(found[:, 0]), found[:, 1]])
    model.document = _logistic(x, toxic, weight * len(found) / weight.sum())
    return model


def _places(text: str, hits: set[int]) -> list[dict[str, int]]:
    return [{"start": m.start(), "stop": m.end()} for i, m in enumerate(WORD.finditer(text)) if i in hits]


def score(df: DataFrame, model: Model | None, keep: list[str], text_col: str = "text") -> DataFrame:
    """The columns `keep`, `score` and `offending` (places of toxic tokens, code points) of every whole text."""
    kind = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))

    def run(batches):
        for batch in batches:
            *kept, texts = batch.columns
            for first, piece in text_pieces(texts, PIECE):
                places: list[list] = [[] for _ in range(len(piece))]
                if model is None:
                    scores = np.zeros(len(piece))
                else:
                    sums, most, p, counts = _aggregates(model, piece)
                    scores = model.score(sums, most)
                    starts = np.cumsum(counts) - counts
                    for i in np.flatnonzero(most > 0.5):
                        own = p[starts[i] : starts[i] + counts[i]]
                        places[i] = _places(piece[int(i)].as_py(), set(np.flatnonzero(own > 0.5).tolist()))
                rows = [c.slice(first, len(piece)) for c in kept]
                yield pa.RecordBatch.from_arrays([*rows, pa.array(scores), pa.array(places, kind)], [*keep, "score", "offending"])

    schema = schema_with(df, keep, "score double, offending array<struct<start:bigint,stop:bigint>>")
    return df.select(*keep, F.col(text_col).alias("__text")).mapInArrow(run, schema)
