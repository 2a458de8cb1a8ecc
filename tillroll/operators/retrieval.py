"""Review embeddings, exact cosine top-k retrieval, and the prompt text built from the hits."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType, StructField, StructType

from tillroll.functions.text import excerpt_line
from tillroll.functions.vectors import SCORE_DIGITS, as_vector, hashed_word_counts
from tillroll.operators.enrichment import strict
from tillroll.operators.model_calls import TRIES, ask

# Vector width, hits per question, and the rating up to which a review is a complaint.
EMBEDDING_WIDTH = 768
TOP_K = 5
MAX_RATING = 3

# Questions, and stored vectors, that make one side of a tile: three megabytes of 768 floats each.
BLOCK_ROWS = 1024

# Questions are broadcast up to so many bytes of vectors; more of them are sent to slices of the index, one
# slice for about so many stored vectors.
QUESTION_BYTES = 64 * 1024 * 1024
SLICE_ROWS = 262_144

# Hits that a task holds before it passes them on, and ids without a review that are broadcast.
HELD_HITS = 4_000_000
ORPHANS = 100_000

# Hits are three numbers each, so this many of them are a few megabytes.
BROADCAST_HITS = 100_000

# An embedder is made once per partition and turns a batch of texts into a batch of vectors.
Embedder = Callable[[list[str]], Sequence[Sequence[float]]]


def complaints(reviews: DataFrame, max_rating: int = MAX_RATING) -> DataFrame:
    return reviews.where(F.col("rating") <= max_rating)


def _hashed_words(reviews: DataFrame, width: int) -> DataFrame:
    """Counts of the lower-cased words, hashed to `width` buckets and scaled to length 1; no shuffle. A text's words
    are counted first, so that each is hashed once."""
    key = reviews.schema["review_id"].dataType
    lowered = reviews.select("review_id", F.lower(F.coalesce("review_text", F.lit(""))).cast("binary").alias("text"))

    def run(batches):
        for batch in batches:
            for low in range(0, batch.num_rows, BLOCK_ROWS):
                ids, texts = batch.slice(low, BLOCK_ROWS).columns
                vectors = pa.array(np.concatenate([hashed_word_counts(text.as_py(), width) for text in texts]))
                offsets = pa.array(np.arange(len(ids) + 1, dtype=np.int32) * width)
                yield pa.RecordBatch.from_arrays([ids, pa.ListArray.from_arrays(offsets, vectors)], ["review_id", "embedding"])

    schema = StructType([StructField("review_id", key), StructField("embedding", ArrayType(FloatType(), False))])
    return lowered.mapInArrow(run, schema)


def build_embeddings(
    reviews: DataFrame,
    make_embedder: Callable[[], Embedder] | None = None,
    width: int = EMBEDDING_WIDTH,
) -> DataFrame:
    """One vector per review over its whole text; by hashed words unless a model is plugged in."""
    if make_embedder is None:
        return _hashed_words(reviews, width)

    asked = model_vectors(reviews, make_embedder)
    return asked.select("review_id", as_vector(strict(asked, "embedding"), width).alias("embedding"))


def model_vectors(reviews: DataFrame, make_embedder: Callable[[], Embedder], tries: int = TRIES) -> DataFrame:
    """(review_id, embedding, error): a model's vectors, asked in Arrow batches with one client per partition."""
    asked = ask(reviews, "review_id", "review_text", make_embedder, "array<float>", tries)
    return asked.withColumnRenamed("answer", "embedding")


def top_k(
    df: DataFrame, by: str, k: int, partition: str | None = None, ties: Sequence[str] = ()
) -> DataFrame:
    """The k rows with the highest `by`, overall or per partition; NULL comes last."""
    order = [F.desc_nulls_last(by), *[F.asc_nulls_last(t) for t in ties]]
    if partition is None:
        return df.orderBy(*order).limit(k)
    rank = F.row_number().over(Window.partitionBy(partition).orderBy(*order))
    return df.withColumn("rank", rank).where(F.col("rank") <= k)


def _known_vectors(index: DataFrame, reviews: DataFrame) -> DataFrame:
    """The stored vectors that have a review; others may not take a rank.

    Ids without one are found on the ids alone and, up to ORPHANS of them, broadcast, so that no vector is moved.
    Beyond that the vectors are joined with the reviews' ids.
    """
    ids = reviews.select("review_id").where("review_id is not null")
    orphans = index.select("review_id").where("review_id is not null").distinct().join(ids, "review_id", "left_anti")
    if orphans.limit(ORPHANS + 1).count() > ORPHANS:
        return index.join(ids, "review_id", "left_semi")
    return index.where("review_id is not null").join(F.broadcast(orphans), "review_id", "left_anti")


def _question_size(questions: DataFrame) -> tuple[int, int]:
    """How many questions there are, and how wide their vectors; the frame is checked on the way."""
    repeated = questions.groupBy("question_id").count().where("count > 1").select("question_id").first()
    if repeated:
        raise ValueError(f"question id {repeated[0]} stands for more than one question")
    width = F.coalesce(F.size("question"), F.lit(-1))
    n, least, most = questions.agg(F.count(F.lit(1)), F.min(width), F.max(width)).first()
    if n and (least != most or least < 1):
        raise ValueError(f"question vectors must be of one width, not {least} to {most}")
    return n, most or 0


def _question_blocks(questions: DataFrame, n: int, slices: int) -> DataFrame:
    """(slice, block, asked): blocks of about BLOCK_ROWS questions, one copy for each slice of the index."""
    blocks = -(-n // BLOCK_ROWS)
    block = F.pmod(F.xxhash64("question_id"), F.lit(blocks)).alias("block")
    asked = F.sort_array(F.collect_list(F.struct("question_id", F.col("question").cast("array<float>"))))
    packed = questions.groupBy(block).agg(asked.alias("asked"))
    return packed.select(F.explode(F.sequence(F.lit(0), F.lit(slices - 1))).alias("slice"), "block", "asked")


def _vector_blocks(index: DataFrame, width: int, slices: int) -> DataFrame:
    """(slice, ids, vectors): the stored vectors as they lie, BLOCK_ROWS of them to a row. A missing vector
    becomes one without length."""

    def pack(batches):
        for batch in batches:
            for low in range(0, batch.num_rows, BLOCK_ROWS):
                ids, vectors = batch.slice(low, BLOCK_ROWS).columns
                data = vectors.flatten().to_numpy(zero_copy_only=False).astype("<f4").tobytes()
                own = ids.to_numpy(zero_copy_only=False).astype("<i8")
                yield pa.RecordBatch.from_arrays(
                    [pa.array([int(own[0]) % slices], pa.int32()), pa.array([own.tobytes()]), pa.array([data])],
                    ["slice", "ids", "vectors"],
                )

    no_length = F.array_repeat(F.lit(0.0).cast("float"), width)
    vector = F.coalesce(as_vector(F.col("embedding"), width), no_length)
    return index.select("review_id", vector.alias("embedding")).mapInArrow(
        pack, "slice int, ids binary, vectors binary"
    )


# Hits of a block of questions: place of the question in the block, review id, score.
Hits = tuple[np.ndarray, np.ndarray, np.ndarray]
NO_HITS: Hits = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))


def merge_best(held: Hits, fresh: Hits, k: int) -> Hits:
    """The k best of both per question: by score, then by the lower review id. Merging in any order and any
    number of steps gives the same."""
    question, found, score = (np.concatenate(pair) for pair in zip(held, fresh))
    order = np.lexsort((found, -score, question))
    ordered = question[order]
    keep = order[np.arange(len(order)) - np.searchsorted(ordered, ordered, side="left") < k]
    return question[keep], found[keep], score[keep]


def tile_best(asked: np.ndarray, ids: np.ndarray, vectors: np.ndarray, k: int) -> Hits:
    """The k best stored vectors of one tile for each of its questions, by one matrix product."""
    lengths = np.sqrt((vectors * vectors).sum(axis=1))[:, None] * np.sqrt((asked * asked).sum(axis=1))[None, :]
    with np.errstate(divide="ignore", invalid="ignore"):
        scores = np.round(vectors @ asked.T / lengths, SCORE_DIGITS)
    scores = np.where(np.isfinite(scores), scores, -np.inf)
    if len(ids) > k:
        at, question = np.nonzero(scores >= np.partition(scores, len(ids) - k, axis=0)[len(ids) - k])
    else:
        at, question = (x.ravel() for x in np.indices(scores.shape))
    return merge_best(NO_HITS, (question.astype(np.int64), ids[at], scores[at, question]), k)


def _best_ids(questions: DataFrame, index: DataFrame, n: int, width: int, k: int) -> DataFrame:
    """(question_id, review_id, score) of the k best vectors per question.

    Blocks of questions meet blocks of the index in tiles. Questions of up to QUESTION_BYTES are broadcast, and the
    index is read where it lies. More of them are sent, block by block, to slices of the index, which is
    then shuffled once. Either way a task merges the hits of its tiles, so that k rows per question and task, or
    slice, leave it; a missing vector, or one without length, scores NULL and comes last.
    """
    n_vectors = index.count() if n * width * 4 > QUESTION_BYTES else 0
    slices = max(1, -(-n_vectors // SLICE_ROWS))
    asked, stored = _question_blocks(questions, n, slices), _vector_blocks(index, width, slices)
    if n_vectors:
        tiles = asked.join(stored, "slice")
    else:
        tiles = stored.join(F.broadcast(asked), "slice")
    id_field = questions.schema["question_id"]

    def best(batches) -> Iterator[pa.RecordBatch]:
        held: dict[int, Hits] = {}
        names: dict[int, pa.Array] = {}

        def passed() -> Iterator[pa.RecordBatch]:
            for block, (question, found, score) in held.items():
                yield pa.RecordBatch.from_arrays(
                    [names[block].take(pa.array(question)), pa.array(found), pa.array(score, mask=np.isinf(score))],
                    ["question_id", "review_id", "score"],
                )
            held.clear()
            names.clear()

        for batch in batches:
            for i in range(batch.num_rows):
                block = batch.column(0)[i].as_py()
                entries = batch.column(1).slice(i, 1).flatten()
                vectors = entries.field(1).flatten().to_numpy(zero_copy_only=False).astype(np.float64)
                ids = np.frombuffer(batch.column(2)[i].as_py(), "<i8")
                own = np.frombuffer(batch.column(3)[i].as_py(), "<f4").astype(np.float64).reshape(len(ids), width)
                fresh = tile_best(vectors.reshape(-1, width), ids, own, k)
                names[block] = entries.field(0)
                held[block] = merge_best(held.get(block, NO_HITS), fresh, k)
            if sum(len(h[0]) for h in held.values()) > HELD_HITS:
                yield from passed()
        yield from passed()

    of_tasks = tiles.select("block", "asked", "ids", "vectors").mapInArrow(
        best, f"question_id {id_field.dataType.simpleString()}, review_id bigint, score double"
    )
    return top_k(of_tasks, "score", k, partition="question_id", ties=["review_id"]).drop("rank")


def attach_reviews(hits: DataFrame, reviews: DataFrame, n_hits: int) -> DataFrame:
    """Text and rating of the hits. Up to BROADCAST_HITS hits go to the reviews, which then stay
    where they are; beyond that both sides are shuffled."""
    small = F.broadcast(hits) if n_hits <= BROADCAST_HITS else hits
    return reviews.select("review_id", "rating", "review_text").join(small, "review_id")


def retrieve(
    questions: DataFrame, index: DataFrame, reviews: DataFrame, k: int = TOP_K
) -> DataFrame:
    """The k most similar reviews per question: (question_id, rank, review_id, rating, text, score).

    `questions` holds (question_id, question vector) and may have any number of rows: they stay distributed, and
    only their number and width are asked for (actions). An id that stands twice is an error, rows without one drop
    out. The search is exact; equal scores are ranked by review id.
    """
    asked = questions.select("question_id", "question").where(F.col("question_id").isNotNull())
    n, width = _question_size(asked)
    if n:
        best = _best_ids(asked, _known_vectors(index, reviews), n, width, k)
    else:
        id_type = asked.schema["question_id"].dataType.simpleString()
        schema = f"question_id {id_type}, review_id bigint, score double"
        best = questions.sparkSession.createDataFrame([], schema)
    hits = attach_reviews(best, reviews, n * k)
    # A review stored twice gives two rows for its hit, as in a plain join before the limit.
    ranked = top_k(
        hits, "score", k, partition="question_id", ties=["review_id", "rating", "review_text"]
    )
    return ranked.select("question_id", "rank", "review_id", "rating", "review_text", "score")


# Fixed value: how a question and its excerpts are put to a model.
PROMPT = "Question: %s\n\nReview excerpts:\n%s"


def rag_prompt(contexts: DataFrame, questions: DataFrame) -> DataFrame:
    """(question_id, prompt) of every question text; without hits the excerpts are empty.

    `contexts` is what `rag_context` makes, `questions` has question_id and question_text.
    """
    asked = questions.select("question_id", "question_text").join(contexts, "question_id", "left")
    text = F.format_string(PROMPT, F.col("question_text"), F.coalesce("context", F.lit("")))
    return asked.select("question_id", text.alias("prompt"))


def rag_context(retrieved: DataFrame) -> DataFrame:
    """The prompt lines of each question's hits, best first, joined by line breaks."""
    line: Column = excerpt_line(F.col("review_id"), F.col("rating"), F.col("review_text"))
    lines = F.array_sort(F.collect_list(F.struct("rank", line.alias("line"))))
    return retrieved.groupBy("question_id").agg(
        F.array_join(F.transform(lines, lambda entry: entry["line"]), "\n").alias("context")
    )
