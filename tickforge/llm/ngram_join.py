"""N-gram Jaccard join (10): blocked sparse product of documents by shingles.

The incidence matrix has a row per distinct word sequence and a column per
five-word shingle.  Columns are ordered by how often they occur, rare ones
first, then by hash; counts come from a sketch of fixed size over all documents
(any order gives the same result, this one keeps the shared columns short).
Sizes bound the product: two sets of n and m shingles reach a similarity of
3/4 only if they share a column among the first ``n // 4 + 1`` and ``m // 4 + 1``
of their own, and if 4 min(n, m) >= 3 max(n, m).  The first block of columns is
therefore multiplied by bucket (column) over those prefixes only; pairs below
the size bound are discarded.  Of the pairs left, each row first sends a bit map
of its columns: a bit set in one map only is a column of that row only, which
bounds the overlap from above and discards most pairs.  The remaining blocks
are accumulated for the others, as the exact overlap of the two rows.

Documents with the same word sequence are one row.  Rows are kept as sorted
64-bit shingle hashes, from which sizes, columns and overlaps all come: they are
exact unless two of the shingles of one pair collide, about n * m / 2**64.
Within a column, members meet a pivot first and only then each other across
groups (``linking``), so a family of near copies costs linear work.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickforge.llm.common import bound_batches, cut, read_table, rows_of, with_row_key
from tickforge.llm.linking import components, link_buckets
from tickforge.plans.joins import join_small

SHINGLE = 5
PER_CENT = 75
# The counters of the column order: one byte each at the driver and in every
# worker (4 MiB), whatever the corpus.
COUNTER_BITS = 22
_BLOCK = 4_096
# A text's columns are several times its size in a worker, as hashes, bytes and Arrow.
BATCH_BYTES = 1 << 20
MAP_BITS = 2  # bits of a row's map for each of its columns, rounded up to a power of two
_MIX = np.uint64(0x9E3779B97F4A7C15)


def shingle_set(text: str) -> tuple[int, int, np.ndarray]:
    """``(id, n, set)``: hash of the word sequence, distinct shingles, and their
    sorted distinct 64-bit hashes; an empty sequence has n = 0."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0, 0, np.zeros(0, dtype="<u8")
    key = xxhash.xxh64_intdigest(b" ".join(words), 11) - (1 << 63)
    w = np.asarray([xxhash.xxh64_intdigest(x) for x in words], dtype=np.uint64)
    size = min(SHINGLE, len(w))
    h = np.zeros(len(w) - size + 1, dtype=np.uint64)
    for j in range(size):
        h = (h ^ w[j:len(w) - size + 1 + j]) * _MIX
        h ^= h >> np.uint64(29)
    h = np.unique(h)
    return key, len(h), h.astype("<u8", copy=False)


def bit_map(cols: np.ndarray) -> bytes:
    """The map of sorted columns: the leading bits of each say which bit is set."""
    width = max(3, int(MAP_BITS * len(cols) - 1).bit_length())
    bits = np.zeros(1 << width, dtype=bool)
    bits[cols >> cols.dtype.type(8 * cols.itemsize - width)] = True
    return np.packbits(bits).tobytes()


def most_shared(n: int, m: int, one: bytes, two: bytes) -> int:
    """The largest overlap that the maps of two rows of n and m columns allow."""
    x, y = np.unpackbits(np.frombuffer(one, "u1")), np.unpackbits(np.frombuffer(two, "u1"))
    width = min(len(x), len(y))  # the finer map is folded to the coarser one
    x, y = x.reshape(width, -1).any(axis=1), y.reshape(width, -1).any(axis=1)
    return min(n - int(np.count_nonzero(x & ~y)), m - int(np.count_nonzero(y & ~x)))


def shingle_sets(docs: DataFrame) -> DataFrame:
    """``rid, doc_id, id, n, cols, bits`` from ``rid, doc_id, text``; ``cols`` (the
    sorted 64-bit hashes as bytes) and ``bits`` (their map) are null where an
    earlier row of the same batch has the same sequence."""
    bound_batches(docs.sparkSession, nbytes=BATCH_BYTES)
    schema = pa.schema([("rid", pa.int64()), ("doc_id", pa.int64()), ("id", pa.int64()), ("n", pa.int64()),
                        ("cols", pa.binary()), ("bits", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, seen = [], set()
            for rid, doc_id, text in rows_of(batch, "rid", "doc_id", "text"):
                key, n, cols = shingle_set(text)
                new = n and key not in seen
                out.append((rid, doc_id, key, n, cols.tobytes() if new else None, bit_map(cols) if new else None))
                seen.add(key)
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in out], f.type) for i, f in enumerate(schema)], schema=schema)
        pa.default_memory_pool().release_unused()  # the worker lives on beside stages without Python

    return docs.select("rid", "doc_id", "text").mapInArrow(
        run, "rid long, doc_id long, id long, n long, cols binary, bits binary")


def count_columns(total: np.ndarray, cols: bytes) -> None:
    """Add a row's columns to their counters, a power of two of them, which stop at 255."""
    # the columns are sorted: equal counters stand together
    at, n = np.unique(np.frombuffer(cols, dtype="<u8") >> np.uint64(65 - len(total).bit_length()), return_counts=True)
    total[at] = np.minimum(total[at] + n, 255)


def column_ranks(sets: DataFrame) -> np.ndarray:
    """How often the columns of each counter occur over all rows, on a logarithmic
    scale of a byte.  A task sends its counters as blocks of bytes (each at most
    255 a task); they are added per block as they stream in."""
    size = 1 << COUNTER_BITS
    schema = pa.schema([("k", pa.int32()), ("c", pa.binary())])

    def send(blocks: dict[int, bytes]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(blocks), pa.int32()), pa.array(list(blocks.values()), pa.binary())], schema=schema)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, dtype="u1")
        for batch in batches:
            for (cols,) in rows_of(batch, "cols"):
                count_columns(total, cols)
        each = total.reshape(-1, _BLOCK)
        yield send({int(k): each[k].tobytes() for k in np.flatnonzero(each.any(axis=1))})
        pa.default_memory_pool().release_unused()

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, c in rows_of(batch, "k", "c"):
                if k not in total:
                    total[k] = np.zeros(_BLOCK, dtype=np.int64)
                total[k] += np.frombuffer(c, dtype="u1")
        yield send({k: np.minimum(8 * np.log2(1 + t), 255).astype("u1").tobytes() for k, t in total.items()})

    counted = sets.filter("cols IS NOT NULL").select("cols").mapInArrow(count, "k int, c binary")
    ranks = np.zeros((size // _BLOCK, _BLOCK), dtype="u1")
    for k, c in counted.repartition("k").mapInArrow(add, "k int, c binary").collect():  # 4 MiB in all
        ranks[k] = np.frombuffer(c, dtype="u1")
    return ranks.reshape(-1)


def first_block(sets: DataFrame, ranks: np.ndarray) -> DataFrame:
    """``bucket, id, n, at``: the prefix columns of every distinct row and their places in its order."""
    shared = sets.sparkSession.sparkContext.broadcast(ranks)
    schema = pa.schema([("bucket", pa.int64()), ("id", pa.int64()), ("n", pa.int64()), ("at", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order = shared.value
        for batch in batches:
            parts, ids, sizes = [], [], []
            for key, n, cols in rows_of(batch, "id", "n", "cols"):
                own = np.frombuffer(cols, dtype="<u8")
                by_rank = np.argsort(order[own >> np.uint64(64 - COUNTER_BITS)], kind="stable")
                parts.append(own[by_rank[:n // 4 + 1]])
                ids.append(key)
                sizes.append(n)
            lengths = [len(p) for p in parts]
            yield pa.RecordBatch.from_arrays([
                pa.array(np.concatenate(parts or [np.zeros(0, "u8")]).view(np.int64)),
                pa.array(np.repeat(np.asarray(ids, dtype=np.int64), lengths)),
                pa.array(np.repeat(np.asarray(sizes, dtype=np.int64), lengths)),
                pa.array(np.concatenate([np.arange(k, dtype=np.int32) for k in lengths] or [np.zeros(0, "i4")]))], schema=schema)

    return sets.filter("cols IS NOT NULL").select("id", "n", "cols").mapInArrow(run, "bucket long, id long, n long, at int")


def shared_columns(block: DataFrame) -> DataFrame:
    """The rows of columns that at least two different rows have."""
    from pyspark.sql import Window

    column = Window.partitionBy("bucket")
    return (block.repartition("bucket").dropDuplicates(["bucket", "id"])
            .withColumn("x", F.min("id").over(column)).withColumn("y", F.max("id").over(column))
            .filter("x <> y").drop("x", "y"))


def size_bound(x: str, y: str) -> Column:
    """Whether the sizes allow the threshold, if this is the first column that the
    two rows share: no more than what is left of each can be shared (a pair that
    reaches the threshold passes in the bucket of its first shared column)."""
    n, m = F.col(f"{x}.n"), F.col(f"{y}.n")
    left = F.least(n - F.col(f"{x}.at"), m - F.col(f"{y}.at"))
    return (100 * F.least(n, m) >= PER_CENT * F.greatest(n, m)) & ((100 + PER_CENT) * left >= PER_CENT * (n + m))


def kept_pairs(pairs: DataFrame, rows: DataFrame, column: str, shared: Callable[[int, int, bytes, bytes], int]) -> DataFrame:
    """The pairs (a, b) that reach the threshold if they share ``shared(n, m, one,
    two)`` columns, from the ``column`` of their ``rows`` (``id, n``, unique)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])
        for batch in batches:
            kept = []
            for a, b, n, m, one, two in rows_of(batch, "a", "b", "n", "m", "one", "two"):
                both = shared(n, m, one, two)
                if 100 * both >= PER_CENT * (n + m - both):
                    kept.append((a, b))
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in kept], pa.int64()) for i in (0, 1)], schema=schema)

    left = rows.select(F.col("id").alias("a"), "n", F.col(column).alias("one"))
    right = rows.select(F.col("id").alias("b"), F.col("n").alias("m"), F.col(column).alias("two"))
    return pairs.join(left, "a").join(right, "b").mapInArrow(run, "a long, b long")


def exact_shared(n: int, m: int, one: bytes, two: bytes) -> int:
    return len(np.intersect1d(np.frombuffer(one, "<u8"), np.frombuffer(two, "<u8"), assume_unique=True))


def overlap_check(sets: DataFrame):
    """Keeps the distinct pairs (a, b) whose exact overlap reaches the threshold."""
    rows = sets.filter("cols IS NOT NULL")
    maps = cut(rows.select("id", "n", "bits").dropDuplicates(["id"]), "ngram-maps")
    # one row of each sequence, so that only the columns of rows in a pair ever move
    first = cut(rows.groupBy("id").agg(F.min("rid").alias("rid")), "ngram-first")

    def check(pairs: DataFrame) -> DataFrame:
        pairs = cut(kept_pairs(pairs, maps, "bits", most_shared), "ngram-pairs")
        ids = pairs.select(F.col("a").alias("id")).unionByName(pairs.select(F.col("b").alias("id"))).distinct()
        mine = cut(join_small(rows.select("id", "rid", "n", "cols"), ids.join(first, "id"), ["id", "rid"], "left_semi").drop("rid"), "ngram-rows")
        return kept_pairs(pairs, mine, "cols", exact_shared)

    return check


def group_rows(docs: DataFrame) -> DataFrame:
    """``rid, doc_id, n, comp`` of documents with a row key; ``comp`` is the
    same for documents of one component and null without words."""
    sets = cut(shingle_sets(docs), "shingle-sets")
    block = cut(shared_columns(first_block(sets, column_ranks(sets))), "ngram-block")
    nodes = sets.select("rid", "doc_id", "id", "n")
    words = nodes.filter("n > 0")
    if not block.isEmpty():
        groups = components(link_buckets(block, size_bound, overlap_check(sets)))
        words = words.join(groups, "id", "left").withColumn("comp", F.coalesce("comp", "id"))
    else:
        words = words.withColumn("comp", F.col("id"))
    words = words.select("rid", "doc_id", "n", "comp")
    return words.unionByName(nodes.filter("n = 0").select("rid", "doc_id", "n", F.lit(None).cast("long").alias("comp")))


def join_ngrams(docs: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, component_id`` per document.

    Null, empty and blank texts have no shingle and are linked with nothing;
    texts of fewer than five words are one shingle.  Rows that repeat a doc_id
    are rows of their own; a component whose ids are all null has a null
    component_id; an empty table gives no rows; extra columns are not read.
    """
    rows = cut(group_rows(with_row_key(docs)), "ngram-groups")
    low = cut(rows.filter("comp IS NOT NULL").groupBy("comp").agg(F.min("doc_id").alias("component_id")), "ngram-low")
    some = rows.filter("comp IS NOT NULL").join(low, "comp").select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    return some.unionByName(rows.filter("comp IS NULL").select(
        "doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id")))


def op10_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query 10 over ``documents``."""
    return join_ngrams(read_table(spark, sf_dir, "documents"))
