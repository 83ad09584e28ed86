"""Token-ID output (1): directly addressable codes in binary shard files.

An id is split into chunks of ``CHUNK_BITS`` bits, one array per level.  Level
0 holds the low chunk of every id; a level's bitmap says which of its entries
continue, and entry ``i`` continues at position ``rank(i)`` (set bits before
``i``) of the next level.  A rank directory holds the set bits before each
64-bit word, so any token is read with a few array look-ups and no block is
decoded.

Shard file, little-endian: magic ``DAC1``, u32 levels, u64 documents, u64
tokens, then int64 doc_id[documents], u8 has_id[documents], u64
first_token[documents + 1], then per level u64 n, u8 chunk[n], u64
bitmap[ceil(n/64)], u64 rank[ceil(n/64)], each array padded to 8 bytes.

Documents are ordered by doc_id with one range shuffle; every task writes its
range as shards of about ``SHARD_TOKENS`` tokens under names that follow from
the partition and a counter, so a repeated task writes the same files again.
"""

from __future__ import annotations

import io
import os
import re
import struct
import uuid
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window
from pyspark.sql import functions as F

from tickforge.llm.common import bound_batches, cut, read_table, rows_of, text_of
from tickforge.session import scratch_path

MAGIC = b"DAC1"
CHUNK_BITS = 8
SHARD_TOKENS = 2_000_000
# The word cache turns over at this size (texts, ids and what a word costs besides);
# two generations and the words of one group of texts are held.
CACHE_BYTES = 128 << 20
WORD_BYTES = 160
JOINED = 1_000  # new words encoded at once
# Fixed value: how the byte alphabet writes a space.
SPACE_BYTE = "\u0120"
# Texts split into words at once: at most this many, of this many letters in all.
GROUP = 1_000
GROUP_LETTERS = 2 << 20
END_ID = 0


# ---------------------------------------------------------------- encoding

class WordEncoder:
    """Whole-text encoding by cached words; the ids are those of encoding the
    text at once.

    The byte-level pre-tokenizer always starts a new pre-token at a single
    space before a character that is no white space, so the ids of a text are
    those of its space-led words one after another.  The tokenizer only sees
    words that the cache, bounded in bytes, lacks.
    """

    #: A space before more white space: there the boundary is not certain.
    RUNS = re.compile(r" (?=\s)")
    BOUNDARY = re.compile(r"(?<=\S) (?=\S)")
    #: White space beside a space, or at the end, in joined words.
    ODD = re.compile(r" \s|\s |\s\Z")

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        # tokens that begin with the byte of a space
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.led = np.zeros(max(vocabulary.values(), default=0) + 1, bool)
        self.led[[i for t, i in vocabulary.items() if t.startswith(SPACE_BYTE)]] = True
        # words of late, and those of the generation before
        self.words: dict[str, bytes] = {}
        self.before: dict[str, bytes] = {}
        self.held = 0

    def _alone(self, text: str) -> bytes:
        ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return np.asarray(ids, dtype="<u4").tobytes()

    def _learn(self, words: list[str]) -> None:
        """Ids of new words: many at once as one text.  Each word's first token is the one
        that begins with its space; words with a space of their own, or with white space
        at an end, go alone."""
        for k in range(0, len(words), JOINED):
            part = words[k:k + JOINED]
            text = " " + " ".join(part)
            if self.ODD.search(text):
                odd = [w for w in part if not w or " " in w or w[0].isspace() or w[-1].isspace()]
                part = [w for w in part if w and not (" " in w or w[0].isspace() or w[-1].isspace())]
                text = " " + " ".join(part)
            else:
                odd = []
            # without the places of the tokens in the text, which nothing here reads
            ids = np.asarray(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype="<u4") if part else np.zeros(0, "<u4")
            cuts = np.flatnonzero(self.led[ids]) * 4
            if len(cuts) == len(part):
                cuts, codes = [*cuts.tolist(), 4 * len(ids)], ids.tobytes()
                self.words.update((w, codes[a:b]) for w, a, b in zip(part, cuts, cuts[1:]))
            else:  # a special token took a space with it
                odd = odd + part
            self.words.update((w, self._alone(" " + w)) for w in odd)
            self.held += 4 * len(text) + 4 * len(ids) + WORD_BYTES * len(part) + sum(8 * len(w) + WORD_BYTES for w in odd)

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        split = [self.BOUNDARY.split(t) if self.RUNS.search(t) else t.split(" ") for t in texts]
        starts = [parts.pop(0) for parts in split]
        if self.held > CACHE_BYTES:  # words not met since the last turn are let go
            self.before, self.words, self.held = self.words, {}, 0
        missing = []
        for word in set().union(*split).difference(self.words):
            code = self.before.get(word)
            if code is None:
                missing.append(word)
            else:
                self.words[word] = code
                self.held += 4 * len(word) + len(code) + WORD_BYTES
        self._learn(missing)
        known = self.words.__getitem__
        first = [np.asarray(c.ids, dtype="<u4").tobytes()
                 for c in self.tokenizer.encode_batch_fast(starts, add_special_tokens=False)]
        return [a + b"".join(map(known, parts)) for a, parts in zip(first, split)]


def grouped(rows: Iterable[tuple]) -> Iterator[list[tuple]]:
    """Rows (id, text) in order, in groups to encode at once: up to ``GROUP`` rows and
    ``GROUP_LETTERS`` letters; a longer text is a group of its own."""
    group: list[tuple] = []
    letters = 0
    for row in rows:
        if group and (len(group) == GROUP or letters + len(row[1]) > GROUP_LETTERS):
            yield group
            group, letters = [], 0
        group.append(row)
        letters += len(row[1])
    if group:
        yield group


_ENCODERS: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    """This worker's encoder for a tokenizer file."""
    # a task has one core; threads of the tokenizer would only wait for each other
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


# ---------------------------------------------------------------- shard format

def _padded(data: bytes) -> bytes:
    return data + b"\0" * (-len(data) % 8)


def pack_levels(ids: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Chunks, continuation bitmap words and rank directory of each level."""
    levels = []
    rest = ids
    while True:
        more = rest >= 1 << CHUNK_BITS
        bits = np.packbits(more, bitorder="little").tobytes()
        words = np.frombuffer(_padded(bits), dtype="<u8")
        before = np.zeros(len(words), dtype="<u8")
        if len(words):
            np.cumsum(np.bitwise_count(words[:-1]), out=before[1:])
        levels.append((rest.astype(np.uint8), words, before))
        if not more.any():
            return levels
        rest = rest[more] >> np.uint32(CHUNK_BITS)


def pack_shard(doc_ids: list[int | None], codes: list[bytes]) -> bytes:
    """One shard file's bytes."""
    ids = np.frombuffer(b"".join(codes), dtype="<u4")
    first = np.zeros(len(codes) + 1, dtype="<u8")
    np.cumsum([len(c) // 4 for c in codes], out=first[1:])
    levels = pack_levels(ids)
    out = [MAGIC, struct.pack("<IQQ", len(levels), len(codes), len(ids))]
    out.append(np.asarray([d or 0 for d in doc_ids], dtype="<i8").tobytes())
    out.append(_padded(np.asarray([d is not None for d in doc_ids], dtype="u1").tobytes()))
    out.append(first.tobytes())
    for chunks, words, before in levels:
        out += [struct.pack("<Q", len(chunks)), _padded(chunks.tobytes()), words.tobytes(), before.tobytes()]
    return b"".join(out)


class Shard:
    """Reads one shard.  ``source`` is a seekable binary file; only the small
    header and document table are read at once, tokens are addressed in place.
    """

    def __init__(self, source):
        self.file = source
        head = self._at(0, 24)
        if head[:4] != MAGIC:
            raise ValueError("not a token shard")
        n_levels, self.n_docs, self.n_tokens = struct.unpack("<IQQ", head[4:])
        at = 24
        self.ids = np.frombuffer(self._at(at, 8 * self.n_docs), dtype="<i8")
        at += 8 * self.n_docs
        self.has_id = np.frombuffer(self._at(at, self.n_docs), dtype="u1")
        at += self.n_docs + (-self.n_docs % 8)
        self.first = np.frombuffer(self._at(at, 8 * (self.n_docs + 1)), dtype="<u8")
        at += 8 * (self.n_docs + 1)
        self.levels: list[tuple[int, int, int, int]] = []
        for _ in range(n_levels):
            (n,) = struct.unpack("<Q", self._at(at, 8))
            chunks = at + 8
            words = chunks + n + (-n % 8)
            ranks = words + 8 * -(-n // 64)
            at = ranks + 8 * -(-n // 64)
            self.levels.append((n, chunks, words, ranks))

    def _at(self, offset: int, size: int) -> bytes:
        self.file.seek(offset)
        return self.file.read(size)

    def token(self, i: int) -> int:
        """Token ``i`` of the shard by direct addressing."""
        if not 0 <= i < self.n_tokens:
            raise IndexError(i)
        value = shift = 0
        for _, chunks, words, ranks in self.levels:
            value |= self._at(chunks + i, 1)[0] << shift
            shift += CHUNK_BITS
            (word,) = struct.unpack("<Q", self._at(words + 8 * (i >> 6), 8))
            if not word >> (i & 63) & 1:
                break
            (before,) = struct.unpack("<Q", self._at(ranks + 8 * (i >> 6), 8))
            i = before + (word & ((1 << (i & 63)) - 1)).bit_count()
        return value

    def tokens(self) -> np.ndarray:
        """All ids, level by level."""
        out = where = None
        for k, (n, chunks, words, _) in enumerate(self.levels):
            level = np.frombuffer(self._at(chunks, n), dtype="u1").astype("<u4")
            bits = np.frombuffer(self._at(words, 8 * -(-n // 64)), dtype="u1")
            more = np.flatnonzero(np.unpackbits(bits, count=n, bitorder="little"))
            if k == 0:
                out, where = level, more
            else:
                out[where] |= level << np.uint32(CHUNK_BITS * k)
                where = where[more]
        return out

    def doc_id(self, k: int) -> int | None:
        return int(self.ids[k]) if self.has_id[k] else None


def open_shard(root: str, name: str) -> Shard:
    """A shard of a written store, opened through its file system."""
    from pyarrow import fs

    files, path = fs.FileSystem.from_uri(root)
    return Shard(files.open_input_file(f"{path}/{name}"))


# ---------------------------------------------------------------- Spark jobs

_MANIFEST = "part int, seq int, name string, n_docs long, n_tokens long"


def write_store(docs: DataFrame, root: str, tokenizer: str) -> DataFrame:
    """Encode ``docs`` (doc_id, text) and write shards below ``root``.

    Returns the manifest, one row per shard: ``part, seq, name, n_docs,
    n_tokens, start`` where ``start`` counts the tokens of all shards before.
    Null texts are empty (a lone end id); rows sort by doc_id, nulls first, then
    by text, so repeated ids keep a fixed order.  An empty table writes no
    shard.  Extra columns are not read.
    """
    bound_batches(docs.sparkSession)
    order = [F.col("doc_id").asc_nulls_first(), F.col("text")]
    ranged = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
              .repartitionByRange(F.col("doc_id").asc_nulls_first()).sortWithinPartitions(*order))
    end = np.asarray([END_ID], dtype="<u4").tobytes()

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        files, path = fs.FileSystem.from_uri(root)
        files.create_dir(path, recursive=True)
        coder, part = encoder(tokenizer), TaskContext.get().partitionId()
        ids: list[int | None] = []
        codes: list[bytes] = []
        held = seq = 0

        def flush() -> pa.RecordBatch:
            nonlocal ids, codes, held, seq
            name = f"part-{part:06d}-{seq:06d}.dac"
            aside = f"{path}/.{name}-{uuid.uuid4().hex}"
            with files.open_output_stream(aside) as out:
                out.write(pack_shard(ids, codes))
            files.move(aside, f"{path}/{name}")
            row = pa.RecordBatch.from_pylist(
                [{"part": part, "seq": seq, "name": name, "n_docs": len(ids), "n_tokens": held}],
                pa.schema([("part", pa.int32()), ("seq", pa.int32()), ("name", pa.string()),
                           ("n_docs", pa.int64()), ("n_tokens", pa.int64())]))
            ids, codes, held, seq = [], [], 0, seq + 1
            return row

        for batch in batches:
            for rows in grouped(rows_of(batch, "doc_id", "text")):
                for (doc_id, _), code in zip(rows, coder.encode([t for _, t in rows])):
                    ids.append(doc_id)
                    codes.append(code + end)
                    held += len(code) // 4 + 1
                    if held >= SHARD_TOKENS:
                        yield flush()
        if ids:
            yield flush()

    shards = cut(ranged.mapInArrow(write, _MANIFEST), "token-manifest")
    # one row per partition in the single-task prefix sum, as zipWithIndex does
    parts = shards.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = parts.withColumn(
        "before", F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)))
    within = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    return shards.withColumn("within", F.sum("n_tokens").over(within)).join(
        before.select("part", "before"), "part"
    ).withColumn("start", F.coalesce("within", F.lit(0)) + F.coalesce("before", F.lit(0))).drop("within", "before")


def read_store(manifest: DataFrame, root: str) -> DataFrame:
    """Read the shards back: per document ``doc_id, start, n_tokens,
    ids_crc32`` (the end id included)."""
    shards = cut(manifest, "token-shards")
    n = max(1, shards.count())
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()),
                        ("ids_crc32", pa.int64())])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, start in rows_of(batch, "name", "start"):
                shard = open_shard(root, name)
                ids = shard.tokens().tobytes()
                first = shard.first.tolist()
                yield pa.RecordBatch.from_arrays([
                    pa.array([shard.doc_id(k) for k in range(shard.n_docs)], pa.int64()),
                    pa.array([start + f for f in first[:-1]], pa.int64()),
                    pa.array([b - a for a, b in zip(first, first[1:])], pa.int64()),
                    pa.array([zlib.crc32(ids[4 * a:4 * b]) for a, b in zip(first, first[1:])], pa.int64()),
                ], schema=schema)

    return shards.select("name", "start").repartition(n).mapInArrow(
        read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def op1_token_store(spark: SparkSession, sf_dir: str, tokenizer: str | None = None) -> DataFrame:
    """Contract query 1 over ``documents``."""
    if tokenizer is None:
        import public_tokenizers

        tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    root = scratch_path(spark, "token-store")
    manifest = write_store(read_table(spark, sf_dir, "documents"), root, tokenizer)
    return read_store(manifest, root)


def shard_from_bytes(data: bytes) -> Shard:
    """A shard held in memory."""
    return Shard(io.BytesIO(data))
