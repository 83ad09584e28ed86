"""Suffix-array dedup (8): distributed prefix doubling to 100 bytes.

A suffix array ranks positions by ever longer prefixes; here only equality up
to 100 bytes counts, so ranks are names (hashes) and a position leaves as soon
as its name is unique.  Starting from every byte would sort one row a byte and
round, so the first round sorts sampled positions instead: each 100-byte string
names the 32-byte string with the smallest hash in it, its anchor.  Equal
100-byte strings have equal anchors at equal places, so nothing is lost, and
neighbouring strings mostly share their anchor: about 3 positions in 100 bytes
are sorted.

Round 1 sorts (anchor name, name of the run, document, start), a run being the
consecutive string starts with one anchor and its name that of all their bytes.
Anchors with one occurrence leave.  Of equal runs all but the first are covered.
Round 2, at offsets up to 100, takes the first occurrences whose anchor has
several runs, names every 100-byte string in them and sorts (anchor, name,
document, start): all but the first of a name are covered.

Names are polynomial hashes of the bytes: 64 bits of anchor and 64 of run, or 64
and 64 of the string.  Equal rows of one batch are reduced where they are read,
so a text with very many copies reaches the sort once a batch.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window
from pyspark.sql import functions as F

from tickforge.llm.common import bound_batches, cut, read_table, rows_of, with_row_key

LENGTH = 100
ANCHOR = 32
CHUNK_BYTES = 2 << 20
_U = np.uint64
_PLACE = _U((1 << 24) - 1)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.empty(n, dtype=np.uint64)
    out[0], done = 1, 1
    while done < n:
        more = min(done, n - done)
        out[done:done + more] = out[:more] * _U(pow(base, done, 1 << 64))
        done += more
    return out


class Hasher:
    """Polynomial hashes of all substrings of a chunk, modulo 2**64."""

    BASE = 0x9E3779B97F4A7C15

    def __init__(self, size: int = CHUNK_BYTES + LENGTH):
        self.size = size
        self.table = np.random.default_rng(7).integers(0, 1 << 64, 256, dtype=np.uint64) | _U(1)
        self.up = _powers(self.BASE, size + 1)
        self.down = _powers(pow(self.BASE, -1, 1 << 64), size + 1)

    def sums(self, data: np.ndarray) -> np.ndarray:
        out = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum(self.table[data] * self.up[:len(data)], out=out[1:])
        return out


_HASHER: list[Hasher] = []


def hasher() -> Hasher:
    if not _HASHER:
        _HASHER.append(Hasher())
    return _HASHER[0]


def runs_of(parts: list[tuple[int, int, bytes]]) -> tuple[np.ndarray, ...] | None:
    """``anchor, run, rid, start, n, covered`` of a chunk of (rid, offset, bytes)
    parts: n consecutive string starts from ``start`` share an anchor;
    ``covered`` marks runs with an earlier equal one in the chunk."""
    h = hasher()
    data = np.frombuffer(b"".join(p[2] for p in parts), dtype=np.uint8)
    if len(data) < LENGTH:
        return None
    sums, down = h.sums(data), h.down
    names = (sums[ANCHOR:] - sums[:-ANCHOR]) * down[:len(data) - ANCHOR + 1]
    mixed = names ^ (names >> _U(29))
    mixed *= _U(0xBF58476D1CE4E5B9)
    mixed ^= mixed >> _U(32)
    # the place breaks ties to the left
    mixed = (mixed & ~_PLACE) | np.arange(len(mixed), dtype=np.uint64)
    width = LENGTH - ANCHOR + 1
    padded = np.concatenate([mixed, np.full(-len(mixed) % width, ~_U(0))]).reshape(-1, width)
    after = np.minimum.accumulate(padded, axis=1).ravel()
    before = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
    m = len(data) - LENGTH + 1
    place = (np.minimum(before[:m], after[width - 1:width - 1 + m]) & _PLACE).astype(np.int64)
    lengths = np.asarray([len(p[2]) for p in parts])
    first = np.cumsum(lengths) - lengths
    part = np.repeat(np.arange(len(parts)), lengths)[:m]
    last = (first + lengths - LENGTH)[part]
    starts = np.flatnonzero(np.concatenate([[True], (place[1:] != place[:-1]) | (part[1:] != part[:-1])]))
    ends = np.concatenate([starts[1:], [m]]) - 1
    fits = starts <= last[starts]
    starts, ends = starts[fits], np.minimum(ends[fits], last[starts[fits]])
    anchor = names[place[starts]]
    run = (sums[ends + LENGTH] - sums[starts]) * down[starts]
    run ^= ((ends - starts).astype(np.uint64) + _U(1)) * _U(0x94D049BB133111EB)
    run ^= (place[starts] - starts).astype(np.uint64) << _U(50)
    rid = np.asarray([p[0] for p in parts], dtype=np.int64)[part[starts]]
    begin = starts - first[part[starts]] + np.asarray([p[1] for p in parts], dtype=np.int64)[part[starts]]
    order = np.lexsort((begin, rid, run, anchor))
    same = np.zeros(len(order), dtype=bool)
    a, r = anchor[order], run[order]
    same[1:] = (a[1:] == a[:-1]) & (r[1:] == r[:-1])
    covered = np.zeros(len(order), dtype=bool)
    covered[order] = same
    return anchor, run, rid, begin, ends - starts + 1, covered


_RUN_DDL = "anchor long, run long, rid long, loc long"


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple[int, int, bytes]]]:
    """Parts of about CHUNK_BYTES; longer texts in pieces that overlap by LENGTH - 1."""
    held: list[tuple[int, int, bytes]] = []
    size = 0
    for batch in batches:
        for rid, text in rows_of(batch, "rid", "text"):
            data = text.encode("utf-8", "surrogatepass")
            for at in range(0, max(1, len(data) - LENGTH + 1), CHUNK_BYTES - LENGTH):
                piece = data[at:at + CHUNK_BYTES - 1]
                if size + len(piece) > CHUNK_BYTES:
                    yield held
                    held, size = [], 0
                held.append((rid, at, piece))
                size += len(piece)
    if held:
        yield held


def sampled_runs(docs: DataFrame) -> DataFrame:
    """Round 1 input.  ``loc`` packs start, run length and whether the run is
    already covered; those rows only travel on, under a key of their own."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for parts in _chunks(batches):
            found = runs_of(parts)
            if found is None:
                continue
            anchor, name, rid, start, n, covered = found
            anchor = np.where(covered, (rid.astype(np.uint64) * _U(Hasher.BASE)) ^ (start.astype(np.uint64) << _U(20)), anchor)
            loc = (start << 8) | (n << 1) | covered
            yield pa.RecordBatch.from_arrays([
                pa.array(anchor.view(np.int64)), pa.array(name.view(np.int64)), pa.array(rid), pa.array(loc)],
                names=["anchor", "run", "rid", "loc"])

    return docs.select("rid", "text").mapInArrow(run, _RUN_DDL)


def first_round(runs: DataFrame) -> DataFrame:
    """``anchor, rid, start, n, probe``: covered runs, and the first
    occurrences that round 2 must look into (``probe``)."""
    done = (F.col("loc").bitwiseAND(F.lit(1)) == 1)
    w = Window.partitionBy("anchor").orderBy("run", "rid", "loc")
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    df = (runs.repartition("anchor").withColumn("before", F.lag("run").over(w))
          .withColumn("low", F.first("run").over(whole)).withColumn("high", F.last("run").over(whole))
          .withColumn("again", done | F.coalesce(F.col("before") == F.col("run"), F.lit(False)))
          .filter("again OR low <> high"))
    return df.select("anchor", "rid", F.shiftright("loc", 8).alias("start"),
                     F.shiftright("loc", 1).bitwiseAND(F.lit(127)).alias("n"), (~F.col("again")).alias("probe"))


def packed_texts(docs: DataFrame) -> DataFrame:
    """``rid, doc_id, body``: texts compressed for the shuffle."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = pa.Codec("zstd", 1)
        for batch in batches:
            rows = list(rows_of(batch, "rid", "doc_id", "text"))
            raw = [t.encode("utf-8", "surrogatepass") for _, _, t in rows]
            yield pa.RecordBatch.from_arrays([
                pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()),
                pa.array([len(x).to_bytes(8, "little") + codec.compress(x, asbytes=True) for x in raw], pa.binary())],
                names=["rid", "doc_id", "body"])

    return docs.select("rid", "doc_id", "text").mapInArrow(run, "rid long, doc_id long, body binary")


def _unpacked(body: bytes) -> bytes:
    return pa.Codec("zstd").decompress(body[8:], int.from_bytes(body[:8], "little"), asbytes=True)


def second_round(probes: DataFrame, bodies: DataFrame) -> DataFrame:
    """``rid, start, n``: strings of the probed runs with an earlier equal one."""
    places = probes.groupBy("rid").agg(F.collect_list(F.struct("anchor", "start", "n")).alias("places"))  # of one document

    def cut_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for rid, body, runs in rows_of(batch, "rid", "body", "places"):
                data = _unpacked(body)
                out += [(p["anchor"], rid, p["start"], p["n"], data[p["start"]:p["start"] + p["n"] - 1 + LENGTH]) for p in runs]
            yield pa.RecordBatch.from_arrays([
                *[pa.array([r[i] for r in out], pa.int64()) for i in range(4)], pa.array([r[4] for r in out], pa.binary())],
                names=["anchor", "rid", "start", "n", "bytes"])

    around = bodies.select("rid", "body").join(places, "rid").mapInArrow(
        cut_out, "anchor long, rid long, start long, n long, bytes binary")
    each = (around.repartition("anchor")
            .select("anchor", "rid", "start", "bytes", F.explode(F.sequence(F.lit(0), (F.col("n") - 1).cast("int"))).alias("i"))
            .withColumn("s", F.expr(f"substring(bytes, i + 1, {LENGTH})"))
            .select("anchor", "rid", (F.col("start") + F.col("i")).alias("start"), F.xxhash64("s").alias("name"),
                    F.xxhash64("s", F.lit(1)).alias("name2")))
    # the anchor's partitioning serves this sort as well: no further shuffle
    w = Window.partitionBy("anchor", "name", "name2").orderBy("rid", "start")
    return each.withColumn("k", F.row_number().over(w)).filter("k > 1").select("rid", "start", F.lit(1).cast("long").alias("n"))


def dedup_substrings(docs: DataFrame) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` per document: every
    byte of a 100-byte string that also starts earlier is removed.

    Null texts are empty; texts under 100 bytes lose nothing.  Earlier means a
    smaller doc_id (nulls first; rows that repeat an id in the order of a text
    hash) or an earlier start in the document.  An empty table gives no rows;
    extra columns are not read.
    """
    bound_batches(docs.sparkSession)
    keyed = with_row_key(docs)
    found = cut(first_round(sampled_runs(keyed)), "suffix-round1")
    bodies = packed_texts(keyed)
    more = second_round(found.filter("probe"), bodies)
    gone = (found.filter("NOT probe").select("rid", "start", "n").unionByName(more)
            .groupBy("rid").agg(F.collect_list(F.expr("shiftleft(start, 8) | n")).alias("gone")))  # of one document
    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()),
                        ("n_spans", pa.int64()), ("kept_sha256", pa.string())])

    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc_id, body, spans in rows_of(batch, "doc_id", "body", "gone"):
                data = _unpacked(body)
                kept, removed, pieces = data, 0, 0
                if spans:
                    packed = np.asarray(spans, dtype=np.int64)
                    start = packed >> 8
                    edge = np.zeros(len(data) + 1, dtype=np.int64)
                    np.add.at(edge, start, 1)
                    np.add.at(edge, start + (packed & 255) - 1 + LENGTH, -1)
                    mask = np.cumsum(edge[:-1]) > 0
                    removed = int(mask.sum())
                    pieces = int(mask[0]) + int((mask[1:] & ~mask[:-1]).sum())
                    kept = np.frombuffer(data, dtype=np.uint8)[~mask].tobytes()
                out.append((doc_id, len(data), removed, pieces, hashlib.sha256(kept).hexdigest()))
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in out], f.type) for i, f in enumerate(schema)], schema=schema)

    return bodies.join(gone, "rid", "left").select("doc_id", "body", "gone").mapInArrow(
        take, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query 8 over ``documents``."""
    return dedup_substrings(read_table(spark, sf_dir, "documents"))
