"""Exact similarity join of texts on word n-grams, and the groups that its links make.

A text is the set of its distinct five-word shingles, hashed to 64 bits. Two texts link when their sets have
a Jaccard similarity of at least 0.75. The steps:

1. Every set is named by a hash of itself, so copies are one set from here on: what follows reads the text of one
   row for each set, and of the few others that a Bloom filter lets pass.
2. How many sets hold a shingle is counted for all of them, roughly: each batch sends each of its shingles
   once, and what occurs again goes into bitmaps of bounded size. Rare ones are put before common ones, then
   by hash. Two sets that link must share a shingle among the first quarter of each; only shingles that occur
   again matter there, so most sets have none.
3. First each set meets one leader per shingle; those that link are joined. Then sets of different groups that
   still share such a shingle, directly or through others, meet in tiles of bounded size. In a tile each set
   is held against those of its own size band and the next: by size, then by bitmap signatures, whose
   differing bits bound the overlap from above, then by intersecting the sorted shingles. A pair whose groups
   have been joined meanwhile is passed over, so a tile gives no more links than it has sets.

4. Every link lies within a group, so then all pairs of a group are verified, in tiles of bounded size again,
   and the links of each set are counted there. A group of two sets has one link.

Groups are found without looking at all their pairs, while no link between two groups is lost: the components
and the numbers of links are exact. The order of shingles and the bitmaps decide the work, never the result. The hash of a set or
shingle stands for it; with 64 bits, chance agreement is of no account below some billions of texts.

Texts without words (null, empty) have no shingles and link with nothing; with fewer words than a shingle
the whole sequence is one. Repeated rows are in one group; a null id stands in the group of its text.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.functions.bloom import BloomFilter, bloom_filter, mark_maybe
from tillroll.llm.common import ragged, stored, text_pieces, words_of
from tillroll.llm.components import components

SHINGLE = 5
# Shingles per part of the count; the tables of what occurs again have 2^TABLE_BITS bits, and up to 2^MOST_TABLE_BITS
# where there are more shingles.
PART_SHINGLES = 4_000_000
TABLE_BITS, MOST_TABLE_BITS = 27, 29
COMMON = 16
# Keys that stand on several fetched sets are broadcast up to this many; beyond it all fetched sets are grouped by key.
REPEATED_KEYS = 100_000
# Shingles of a block of sets; a tile holds two blocks.
BLOCK = 1_500_000
# Shingles of a block of one group whose links are counted.
COUNT_BLOCK = 250_000
# Shingles that a worker holds at once, besides those of one piece of text.
CHUNK = 1_000_000

_STEPS = np.array(
    [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64
)


def _mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers."""
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def shingle_sets(texts: pa.Array) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of every text."""
    words, counts = words_of(pc.ascii_lower(texts))
    if not len(words):
        return [np.zeros(0, np.uint64)] * len(texts)
    coded = words.dictionary_encode()
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, coded.dictionary.to_pylist()), np.uint64, len(coded.dictionary))
    own = hashes[coded.indices.to_numpy()]
    n = len(own)
    grams = np.zeros(n, np.uint64)
    for step in range(min(SHINGLE, n)):
        grams[: n - step] += own[step:] * _STEPS[step]
    grams = _mix(grams)
    found = []
    end = 0
    for count in counts.tolist():
        start, end = end, end + count
        if count >= SHINGLE:
            found.append(np.unique(grams[start : end - SHINGLE + 1]))
        elif count:
            whole = (own[start:end] * _STEPS[:count]).sum(dtype=np.uint64) + np.uint64(count)
            found.append(_mix(np.array([whole], np.uint64)))
        else:
            found.append(np.zeros(0, np.uint64))
    return found


def set_key(grams: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(grams.tobytes()) - (1 << 63)


def _distinct_sets(batch: pa.RecordBatch):
    """(key, shingles) of the distinct sets of a batch, empty ones left out."""
    seen = set()
    for _, piece in text_pieces(batch.column(0)):
        for grams in shingle_sets(piece):
            key = set_key(grams)
            if len(grams) and key not in seen:
                seen.add(key)
                yield key, grams


def _chunks(batch: pa.RecordBatch):
    """The distinct sets of a batch in lists of bounded size, to keep workers small."""
    held, size = [], 0
    for key, grams in _distinct_sets(batch):
        held.append((key, grams))
        size += len(grams)
        if size >= CHUNK:
            yield held
            held, size = [], 0
    if held:
        yield held


def text_mark(text: Column) -> Column:
    """Stands for the text among those of one id."""
    return F.xxhash64(text)


def membership(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, n, key, mark) of every row; the mark is `text_mark` of its text."""

    def run(batches):
        for batch in batches:
            ids, marks, texts = batch.columns
            for first, piece in text_pieces(texts):
                sets = shingle_sets(piece)
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(first, len(piece)), pa.array([len(s) for s in sets], pa.int64()),
                     pa.array([set_key(s) for s in sets], pa.int64()), marks.slice(first, len(piece))], ["id", "n", "key", "mark"],
                )

    texts = df.select(F.col(id_col).cast("long").alias("id"), text_mark(F.col(text_col)).alias("mark"), F.col(text_col).alias("text"))
    return texts.mapInArrow(run, "id long, n long, key long, mark long")


def first_texts(df: DataFrame, members: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, int]:
    """The text of one row of each set, and of some others; the shingles of all sets. `members` is the membership of `df`.

    So copies are neither cut into shingles again nor sent. The row whose hash is least stands for its set; a Bloom
    filter tells the rows, so the texts stay where they are. It lets some others pass, and rows alike in id and text.
    """
    first = members.where("n > 0").groupBy("key").agg(F.min(F.xxhash64("id", "mark")).alias("row"), F.max("n").alias("n"))
    first = stored(first, "distinct-sets")
    sets, total = first.agg(F.count("*"), F.sum("n")).first()
    bloom = bloom_filter(first, F.col("row"), sets)
    bloom = BloomFilter(stored(bloom.table, "distinct-rows"), bloom.blocks)
    text = F.col(text_col)
    rows = df.select(F.xxhash64(F.col(id_col).cast("long"), text_mark(text)).alias("row"), text.alias("text"))
    return mark_maybe(rows, F.col("row"), bloom, "__maybe").where("__maybe").select("text"), total or 0


def table_bits(total: int) -> int:
    """Bits of the number of a slot, for so many shingles."""
    return max(TABLE_BITS, min(MOST_TABLE_BITS, int(total).bit_length()))


def packed(numbers: np.ndarray) -> bytes:
    """Ascending 32-bit numbers in few bytes: their steps, bytes of one weight side by side."""
    steps = np.diff(numbers, prepend=np.uint32(0)).astype("<u4")
    return pa.compress(steps.view(np.uint8).reshape(-1, 4).T.tobytes(), codec="zstd", asbytes=True)


def unpacked(data: bytes, size: int) -> np.ndarray:
    planes = np.frombuffer(pa.decompress(data, 4 * size, codec="zstd", asbytes=True), np.uint8).reshape(4, size)
    return np.cumsum(np.ascontiguousarray(planes.T).view("<u4").ravel(), dtype=np.uint32)


def repeated(texts: DataFrame, total: int) -> tuple[np.ndarray, np.ndarray]:
    """Bitmaps of the shingles that occur in two sets at least, and in COMMON.

    A shingle is sent as 32 bits within its part. Parts grow in number with the input, so the chance that two
    shingles agree by accident stays the same; the first bitmap grows as well, within its bound, as it would fill up.
    """
    parts = max(1, -(-total // PART_SHINGLES))
    widths = (table_bits(total), TABLE_BITS)

    def send(batches):
        for sets in (chunk for batch in batches for chunk in _chunks(batch)):
            grams, counts = np.unique(np.concatenate([grams for _, grams in sets]), return_counts=True)
            part = (grams & np.uint64(0xFFFFFFFF)) % np.uint64(parts)
            order = np.argsort(part, kind="stable")
            edges = np.searchsorted(part[order], np.arange(parts + 1, dtype=np.uint64))
            short = (grams >> np.uint64(32)).astype(np.uint32)[order]
            few = np.minimum(counts, 255).astype(np.uint8)[order]
            filled = [p for p in range(parts) if edges[p + 1] > edges[p]]
            own = [slice(edges[p], edges[p + 1]) for p in filled]
            yield pa.RecordBatch.from_arrays(
                [pa.array(filled, pa.int32()), pa.array([packed(short[x]) for x in own], pa.binary()),
                 pa.array([few[x].tobytes() for x in own], pa.binary())],
                ["part", "short", "few"],
            )

    def count(found: pa.Table) -> pa.Table:
        few = found["few"].to_pylist()
        short = np.concatenate([unpacked(b, len(n)) for b, n in zip(found["short"].to_pylist(), few)])
        few = np.concatenate([np.frombuffer(b, np.uint8) for b in few])
        order = np.argsort(short, kind="stable")
        short, few = short[order], few[order].astype(np.int64)
        first = np.flatnonzero(np.concatenate(([True], short[1:] != short[:-1])))
        sums = np.add.reduceat(few, first)
        levels = [
            (level, np.unique(short[first[sums >= least]] >> np.uint32(32 - width)).astype(np.int64))
            for level, least, width in zip((1, 2), (2, COMMON), widths)
        ]
        return pa.table({
            "level": pa.array(np.concatenate([np.full(len(s), lv, np.int32) for lv, s in levels])),
            "slot": pa.array(np.concatenate([s for _, s in levels])),
        })

    sent = texts.mapInArrow(send, "part int, short binary, few binary")
    again, common = bitmaps(sent.groupBy("part").applyInArrow(count, "level int, slot long"), widths)
    return again, common


def bitmaps(slots: DataFrame, widths: tuple[int, ...]) -> list[np.ndarray]:
    """The numbers in `slots` (level, slot), of the levels 1, 2, ..., as bits; those of a level are below 2^width."""
    tables = [np.zeros((1 << width) // 8, np.uint8) for width in widths]
    bits = slots.groupBy("level", F.shiftright("slot", 15).alias("at")).agg(
        F.bitmap_construct_agg(F.col("slot").bitwiseAND(32767)).alias("bits")
    )
    for row in stored(bits, "bitmaps").collect():  # at most 2^(width - 15) rows of 4 KB for a level
        tables[row["level"] - 1][row["at"] * 4096 : (row["at"] + 1) * 4096] = np.frombuffer(row["bits"], np.uint8)
    return tables


def _in_table(table: np.ndarray, grams: np.ndarray) -> np.ndarray:
    """Which shingles are marked in a bitmap, of whatever width."""
    slots = (grams >> np.uint64(65 - (8 * len(table)).bit_length())).astype(np.int64)
    return (table[slots >> 3] >> (slots & 7).astype(np.uint8)) & 1 == 1


def prefix(grams: np.ndarray, again: np.ndarray, common: np.ndarray) -> np.ndarray:
    """Those of the set's first shingles, rare ones first, that may occur elsewhere."""
    n = len(grams)
    first = n - (3 * n + 3) // 4 + 1
    shared = _in_table(again, grams)
    left = first - (n - int(shared.sum()))
    if left <= 0:
        return grams[:0]
    grams = grams[shared]
    often = _in_table(common, grams)
    return np.concatenate((grams[~often], grams[often]))[:left]


def signature(grams: np.ndarray) -> bytes:
    """Bitmap of the set; its width follows from the size band."""
    bits = max(64, 8 << (len(grams).bit_length() - 1))
    marks = np.zeros(bits, np.uint8)
    marks[(grams & np.uint64(bits - 1)).astype(np.int64)] = 1
    return np.packbits(marks, bitorder="little").tobytes()


def _folded(bits: bytes, size: int) -> np.ndarray:
    """A signature folded to `size` bytes, as 64-bit words."""
    found = np.frombuffer(bits, np.uint8).reshape(-1, size)
    return np.bitwise_or.reduce(found, axis=0).view(np.uint64)


def may_link(n: np.ndarray, bits: np.ndarray, m: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Whether sizes and signatures of (broadcast) pairs leave room for a link."""
    lost_n = np.bitwise_count(bits & ~others).sum(axis=-1, dtype=np.int64)
    lost_m = np.bitwise_count(others & ~bits).sum(axis=-1, dtype=np.int64)
    return 7 * np.minimum(n - lost_n, m - lost_m) >= 3 * (n + m)


def links(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether two sorted sets have a similarity of at least 0.75."""
    if len(a) > len(b):
        a, b = b, a
    if 4 * len(a) < 3 * len(b):
        return False
    at = np.searchsorted(b, a)
    both = int((b[np.minimum(at, len(b) - 1)] == a).sum())
    return 7 * both >= 3 * (len(a) + len(b))


def _verified(pairs: DataFrame, near: DataFrame) -> DataFrame:
    """The pairs (a, b) that link. Signatures go first, so few sets are moved."""

    def by_bits(batches):
        for batch in batches:
            keep = []
            for n, x, m, y in zip(*(batch[c].to_pylist() for c in ("na", "xa", "nb", "xb"))):
                size = min(len(x), len(y))
                keep.append(bool(may_link(np.int64(n), _folded(x, size), np.int64(m), _folded(y, size))))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    def by_sets(batches):
        for batch in batches:
            keep = [
                links(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64))
                for x, y in zip(batch["xa"].to_pylist(), batch["xb"].to_pylist())
            ]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    def beside(df: DataFrame, column: str) -> DataFrame:
        for side in ("a", "b"):
            more = near.select(F.col("key").alias(side), F.col("n").alias(f"n{side}"), F.col(column).alias(f"x{side}"))
            df = df.join(more, side)
        return df.where(4 * F.least("na", "nb") >= 3 * F.greatest("na", "nb"))

    some = stored(beside(pairs, "bits").mapInArrow(by_bits, "a long, b long"), "pairs")
    return stored(beside(some, "grams").mapInArrow(by_sets, "a long, b long"), "links")


def _grouped(links_so_far: DataFrame, postings: DataFrame) -> DataFrame:
    """Postings with the group of their set."""
    groups = components(links_so_far)
    joined = postings.join(groups, "key", "left")
    return joined.select("token", "key", "n", F.coalesce("label", "key").alias("label"))


def _mixed(postings: DataFrame) -> DataFrame:
    """Postings of the shingles that still hold more than one group, with the least set that holds each."""
    several = postings.groupBy("token").agg(F.min("label").alias("l"), F.max("label").alias("h"), F.min("key").alias("least"))
    return postings.join(several.where("l < h").select("token", "least"), "token")


def _tiles(mixed: DataFrame, near: DataFrame) -> DataFrame:
    """Links (a, b) that join groups, from all pairs of different groups that share a shingle."""
    edges = mixed.select(F.col("key").alias("a"), F.col("least").alias("b")).distinct()
    clusters = components(edges).select("key", F.col("label").alias("cluster"))
    sets = stored(mixed.select("key", "n", F.col("label")).distinct().join(clusters, "key"), "tile-sets")
    # Large clusters are cut into blocks, by the shingles that they hold; every two blocks make a tile.
    sizes = sets.groupBy("cluster").agg(F.ceil(F.sum("n") / BLOCK).cast("int").alias("blocks"))
    dealt = sets.join(sizes, "cluster").withColumn("own", F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int"))
    met = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = met.select(
        "cluster", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "key", "n", "label"
    ).join(near.select("key", "bits", "grams"), "key")

    def compare(tile: pa.Table) -> pa.Table:
        key, n, label, own = (tile[c].to_numpy().copy() for c in ("key", "n", "label", "own"))
        _, label = np.unique(label, return_inverse=True)
        raw = tile["bits"].to_pylist()
        grams = [np.frombuffer(g, np.uint64) for g in tile["grams"].to_pylist()]
        two = bool((own != own[0]).any())
        band = np.array([int(x).bit_length() for x in n])
        found: list[tuple[int, int]] = []
        for low in np.unique(band):
            rows = np.flatnonzero((band == low) | (band == low + 1))
            size = min(len(raw[r]) for r in rows)
            bits = np.stack([_folded(raw[r], size) for r in rows])
            for at, r in enumerate(rows):
                if band[r] != low:
                    continue
                fits = (label[rows] != label[r]) & (4 * np.minimum(n[rows], n[r]) >= 3 * np.maximum(n[rows], n[r]))
                fits &= (band[rows] > low) | (key[rows] > key[r])
                if two:
                    fits &= own[rows] != own[r]
                left = np.flatnonzero(fits)
                if len(left):
                    left = left[may_link(n[r], bits[at], n[rows[left]], bits[left])]
                for x in rows[left]:
                    if label[x] != label[r] and links(grams[r], grams[x]):
                        label[label == label[x]] = label[r]
                        found.append((int(key[r]), int(key[x])))
        a, b = zip(*found) if found else ((), ())
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return stored(rows.groupBy("cluster", "i", "j").applyInArrow(compare, "a long, b long"), "links")


def link_counts(linked: DataFrame, near: DataFrame) -> DataFrame:
    """(key, n_links) of the sets in `linked` (key, label, sets, blocks): with how many other sets each of them links.
    `sets` and `blocks` are those of the whole group."""
    several = linked.where("sets > 2").withColumn("own", F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int"))
    met = several.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = met.select("label", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "key")
    rows = rows.join(near.select("key", "grams"), "key")

    def count(tile: pa.Table) -> pa.Table:
        i, j, own = tile["i"][0].as_py(), tile["j"][0].as_py(), tile["own"].to_numpy()
        grams = [np.frombuffer(g, np.uint64) for g in tile["grams"].to_pylist()]
        size = np.fromiter(map(len, grams), np.int64, len(grams))
        found, ids = np.unique(np.concatenate(grams), return_inverse=True)
        begin = np.cumsum(size) - size
        left, right = np.flatnonzero(own == i), np.flatnonzero(own == j)
        n = np.zeros(len(grams), np.int64)
        if len(right):
            flat = ids[ragged(begin[right], size[right])]
            at = np.cumsum(size[right]) - size[right]
            held = np.zeros(len(found), bool)
            for r in left:
                mine = ids[begin[r] : begin[r] + size[r]]
                held[mine] = True
                both = np.add.reduceat(held[flat], at, dtype=np.int64)
                held[mine] = False
                linked = 7 * both >= 3 * (size[r] + size[right])
                n[r] += linked.sum() - (i == j)  # not with itself
                if i != j:
                    n[right] += linked
        return pa.table({"key": tile["key"].combine_chunks(), "n_links": pa.array(n)})

    counted = rows.groupBy("label", "i", "j").applyInArrow(count, "key long, n_links long")
    counted = counted.groupBy("key").agg(F.sum("n_links").alias("n_links"))
    return counted.unionByName(linked.where("sets = 2").select("key", F.lit(1).cast("long").alias("n_links")))


def _postings(texts: DataFrame, total: int) -> DataFrame:
    """(token, key, n, lead) of the shingles by which sets may link and that several sets hold."""
    # The driver and the executors hold the tables, of fixed size, for this one step.
    tables = texts.sparkSession.sparkContext.broadcast(repeated(texts, total))

    def post(batches):
        for batch in batches:
            tokens, keys, sizes = [np.zeros(0, np.uint64)], [], []
            for key, grams in _distinct_sets(batch):
                tokens.append(prefix(grams, *tables.value))
                keys.append(key)
                sizes.append(len(grams))
            held = [len(own) for own in tokens[1:]]
            columns = np.concatenate(tokens).view(np.int64), *(np.repeat(np.array(x, np.int64), held) for x in (keys, sizes))
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], ["token", "key", "n"])

    # A set may be here twice, which changes nothing below.
    sent = stored(texts.mapInArrow(post, "token long, key long, n long"), "postings")
    tables.destroy()
    # Keys are hashes, so the least set of a shingle is as good a leader as any. It comes with the shingles that
    # several sets hold: what follows needs no further join or group by shingle, which may be a hot key.
    met = sent.groupBy("token").agg(F.min("key").alias("lead"), F.max("key").alias("last")).where("lead < last")
    return stored(sent.join(met.select("token", "lead"), "token"), "postings")


def _near(texts: DataFrame, postings: DataFrame) -> DataFrame:
    """(key, n, bits, grams) of the sets that meet another one, found again in the texts with a table of their
    keys of fixed size."""
    slot = F.shiftrightunsigned(F.xxhash64("key"), 64 - TABLE_BITS)
    (wanted,) = bitmaps(postings.select(F.lit(1).alias("level"), slot.alias("slot")), (TABLE_BITS,))
    asked = texts.sparkSession.sparkContext.broadcast(wanted)

    def fetch(batches):
        for sets in (chunk for batch in batches for chunk in _chunks(batch)):
            found = []
            for key, grams in sets:
                # As xxhash64("key") in Spark: seed 42 over the eight bytes.
                at = xxhash.xxh64_intdigest(key.to_bytes(8, "little", signed=True), 42) >> (64 - TABLE_BITS)
                if asked.value[at >> 3] >> (at & 7) & 1:
                    found.append((key, len(grams), signature(grams), grams.tobytes()))
            columns = list(zip(*found)) or [[], [], [], []]
            kinds = (pa.int64(), pa.int64(), pa.binary(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)], ["key", "n", "bits", "grams"])

    found = stored(texts.mapInArrow(fetch, "key long, n long, bits binary, grams binary"), "near-sets")
    asked.destroy()
    # Sets are told apart on their keys alone, and only those that came twice are moved for it.
    twice = stored(found.groupBy("key").agg(F.count("*").alias("rows")).where("rows > 1").select("key"), "repeated-keys")
    n = twice.count()
    if not n:
        return found
    if n > REPEATED_KEYS:
        return stored(found.dropDuplicates(["key"]), "near-sets")
    once = stored(found.join(F.broadcast(twice), "key", "left_semi").dropDuplicates(["key"]), "near-sets")
    return found.join(F.broadcast(twice), "key", "left_anti").unionByName(once)


def set_labels(texts: DataFrame, total: int) -> tuple[DataFrame, DataFrame]:
    """(key, label) of the sets that link with another one, and the sets that may, with their shingles;
    `total` is the number of shingles of all sets."""
    postings = _postings(texts, total)
    near = _near(texts, postings)
    pairs = postings.where("lead < key").select(F.col("lead").alias("a"), F.col("key").alias("b")).distinct()
    found = _verified(pairs, near)
    rest = _tiles(stored(_mixed(_grouped(found, postings)), "postings"), near)
    return components(found.unionByName(rest)), near


def groups(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_shingles, component_id, n_links) of every row: the smallest id reachable by links, its own
    included, and the number of other sets that its set links with; copies are one set."""
    members = stored(membership(df, id_col, text_col), "shingle-members")
    labels, near = set_labels(*first_texts(df, members, id_col, text_col))
    by_key = members.where("n > 0").groupBy("key").agg(F.min("id").alias("low"), F.max("n").alias("n"))
    by_key = stored(by_key.join(labels, "key", "left"), "set-labels")
    # What follows is stored step by step: in one plan its stages would run at once, and the driver keep account of all their tasks.
    linked = by_key.where("label is not null")
    whole = linked.groupBy("label").agg(
        F.min("low").alias("component"), F.count("*").alias("sets"), F.ceil(F.sum("n") / COUNT_BLOCK).cast("int").alias("blocks")
    )
    linked = stored(linked.join(whole, "label").select("key", "label", "component", "sets", "blocks"), "set-groups")
    counts = stored(link_counts(linked, near), "link-counts")
    named = by_key.join(linked.select("key", "component"), "key", "left").join(counts, "key", "left")
    named = stored(named.select("key", F.coalesce("component", "low").alias("component"), "n_links"), "set-names")
    return members.join(named, "key", "left").select(
        "id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("id")).alias("component_id"),
        F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
    )


def firsts(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, mark, n_rows) of one row of each group, with the number of rows that are alike in both: the row of
    smallest id, then of smallest key; null ids come last. Texts without words are groups of their own."""
    members = stored(membership(df, id_col, text_col), "shingle-members")
    labels, _ = set_labels(*first_texts(df, members, id_col, text_col))
    alike = members.groupBy("n", "key", "id", "mark").agg(F.count("*").alias("n_rows"))
    row = F.struct(F.col("id").isNull().alias("last"), "id", "key", "mark", "n_rows")
    by_key = alike.where("n > 0").groupBy("key").agg(F.min(row).alias("row"))
    joined = by_key.join(labels, "key", "left").select(F.coalesce("label", "key").alias("label"), "row")
    chosen = joined.groupBy("label").agg(F.min("row").alias("row")).select("row.id", "row.mark", "row.n_rows")
    return chosen.unionByName(alike.where("n = 0").select("id", "mark", "n_rows"))
