"""Benchmark decontamination (6): BM25 with block-max WAND.

The inverted index holds the benchmark items: per term its postings (item,
impact) with BM25 impacts divided by the item's own full score, so a score of 1
means that a passage holds all of the item's weight.  Items are numbered and
cut into blocks of ``BLOCK``; a term's largest impact is kept per block.

Every document is cut into passages of ``2 L`` words that start every ``L``
words (``L``: the longest item's words), so an item copied whole lies whole in
one passage.  Each passage is a query: its terms' largest impacts bound its
score, then their block bounds do, and only blocks whose bound reaches the
threshold are scored by document-at-a-time WAND.  What is retrieved is checked:
the five-word shingles of the item's question and the words of its answer must
recur in the passage.

The index is sent to the tasks, so items are taken in groups of at most about
``GROUP`` items, each with its own index and pass; document frequencies are
counted over all items.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickforge.llm.common import bound_batches, read_table, rows_of

K1, B = 1.2, 0.75
THRESHOLD = 0.6
QUESTION_OVERLAP = 0.75
ANSWER_OVERLAP = 0.75
SHINGLE = 5
BLOCK = 8
GROUP = 2_000
LEAST_PASSAGE = 16
_PART = 400_000  # passage terms bounded at once

_WORDS = re.compile(r"\w+").findall
_SENTENCES = re.compile(r"[^.!?\n]+")


def words(text: str) -> list[str]:
    return _WORDS(text.lower())


def shingles(w: list[str], size: int = SHINGLE) -> set[tuple[str, ...]]:
    """Distinct word shingles; a shorter sequence is one shingle."""
    if not w:
        return set()
    size = min(size, len(w))
    return {tuple(w[i:i + size]) for i in range(len(w) - size + 1)}


def question_answer(text: str) -> tuple[list[str], list[str]]:
    """Words of an item's question and answer: the last sentence is the answer;
    an item of one sentence is halved."""
    parts = [p for p in map(words, _SENTENCES.findall(text)) if p]
    if not parts:
        return [], []
    if len(parts) == 1:
        half = (len(parts[0]) + 1) // 2
        return parts[0][:half], parts[0][half:]
    return [w for p in parts[:-1] for w in p], parts[-1]


class Index:
    """Inverted index of one group of items."""

    def __init__(self, items: list[tuple[int, str]], df: dict[str, int], n_items: int, mean_words: float):
        self.items = []
        self.longest = LEAST_PASSAGE
        terms: dict[str, int] = {}
        entries: list[tuple[int, int, float]] = []
        for item_id, text in sorted(items, key=lambda x: (x[0] is None, x[0] or 0, x[1])):
            tf = Counter(words(text))
            if not tf:
                continue
            size = sum(tf.values())
            self.longest = max(self.longest, size)
            norm = K1 * (1 - B + B * size / mean_words)
            gain = {w: math.log(1 + (n_items - df[w] + 0.5) / (df[w] + 0.5)) * f * (K1 + 1) / (f + norm)
                    for w, f in tf.items()}
            own = sum(gain.values())
            k = len(self.items)
            question, answer = question_answer(text)
            self.items.append((item_id, shingles(question), Counter(answer)))
            for w, g in gain.items():
                entries.append((terms.setdefault(w, len(terms)), k, g / own))
        self.terms = terms
        self.n_blocks = max(1, -(-len(self.items) // BLOCK))
        self.bound = np.zeros((len(terms), self.n_blocks), dtype=np.float32)
        self.postings: list[dict[int, list[tuple[int, float]]]] = [{} for _ in terms]  # by block
        for t, k, g in entries:  # items come in rising order
            self.postings[t].setdefault(k // BLOCK, []).append((k, g))
            self.bound[t, k // BLOCK] = max(self.bound[t, k // BLOCK], g)
        self.top = self.bound.max(axis=1) if len(terms) else np.zeros(0, dtype=np.float32)

    def wand(self, query: list[int], threshold: float, blocks: list[int] | None = None) -> list[tuple[int, float]]:
        """Items whose score reaches the threshold, by block-max WAND.

        Blocks whose bounds do not reach it are passed over (``blocks`` lists the
        others where the caller has bounded them already); inside a block the
        lists advance to the first item their block bounds can bring over it.
        """
        if blocks is None:
            blocks = np.flatnonzero(self.bound[query].sum(axis=0) >= threshold - 1e-4).tolist() if query else []
        out = []
        for block in blocks:
            lists = [[self.postings[t][block], 0, self.bound[t, block]] for t in query if block in self.postings[t]]
            while lists:
                lists.sort(key=lambda x: x[0][x[1]][0])
                total, pivot = 0.0, -1
                for x in lists:
                    total += x[2]
                    if total >= threshold - 1e-4:
                        pivot = x[0][x[1]][0]
                        break
                if pivot < 0:
                    break
                value = 0.0
                whole = lists[0][0][lists[0][1]][0] == pivot
                for x in lists:
                    item, gain = x[0][x[1]]
                    if item > pivot:
                        break
                    if whole:
                        value += gain
                        x[1] += 1
                    else:
                        while x[1] < len(x[0]) and x[0][x[1]][0] < pivot:
                            x[1] += 1
                if whole and value >= threshold:
                    out.append((pivot, value))
                lists = [x for x in lists if x[1] < len(x[0])]
        return out

    def search(self, texts: list[str]) -> list[dict[int, tuple[float, float, float]]]:
        """Per text: item number -> (score, question overlap, answer overlap) of verified items."""
        out: list[dict[int, tuple[float, float, float]]] = [{} for _ in texts]
        get, step = self.terms.get, self.longest
        split = [words(t) for t in texts]
        counts = np.asarray([len(w) for w in split])
        if not len(self.terms) or not counts.sum():
            return out
        term = np.fromiter((get(w, -1) for ws in split for w in ws), dtype=np.int64, count=int(counts.sum()))
        n_windows = np.maximum(1, -(-counts // step))
        first = np.concatenate([[0], np.cumsum(n_windows)])
        doc = np.repeat(np.arange(len(texts)), counts)
        place = np.arange(len(term)) - np.repeat(np.cumsum(counts) - counts, counts)
        known = term >= 0
        term, doc, cell = term[known], doc[known], place[known] // step
        # a word lies in the passage that starts in its cell and in the one before
        window = first[doc] + cell
        back = cell > 0
        key = np.unique(np.concatenate([window, window[back] - 1]) * len(self.terms)
                        + np.concatenate([term, term[back]]))
        if not len(key):
            return out
        window, term = key // len(self.terms), key % len(self.terms)
        starts = np.flatnonzero(np.concatenate([[True], window[1:] != window[:-1]]))
        ends = np.concatenate([starts[1:], [len(window)]])
        hopeful = np.flatnonzero(np.add.reduceat(self.top[term], starts) >= THRESHOLD - 1e-4)
        part = max(1, _PART // self.n_blocks)
        at = 0
        while at < len(hopeful):
            # passages whose terms fill one part
            size = np.cumsum(ends[hopeful[at:at + part]] - starts[hopeful[at:at + part]])
            upto = at + max(1, int(np.searchsorted(size, part)))
            some = hopeful[at:upto]
            at = upto
            lengths = ends[some] - starts[some]
            flat = np.repeat(starts[some] - (np.cumsum(lengths) - lengths), lengths) + np.arange(lengths.sum())
            bounds = np.add.reduceat(self.bound[term[flat]], np.cumsum(lengths) - lengths, axis=0)
            reach = bounds >= THRESHOLD - 1e-4
            for k in np.flatnonzero(reach.any(axis=1)):
                w = some[k]
                found = self.wand(term[starts[w]:ends[w]].tolist(), THRESHOLD, np.flatnonzero(reach[k]).tolist())
                if found:
                    number = int(window[starts[w]])
                    d = int(np.searchsorted(first, number, side="right")) - 1
                    begin = (number - int(first[d])) * step
                    self._verify(split[d][begin:begin + 2 * step], found, out[d])
        return out

    def _verify(self, passage: list[str], found: list[tuple[int, float]], kept: dict) -> None:
        grams: dict[int, set] = {}
        have = Counter(passage)
        for k, value in found:
            _, question, answer = self.items[k]
            size = len(next(iter(question)))
            if size not in grams:
                grams[size] = shingles(passage, size)
            q = len(question & grams[size]) / len(question)
            a = sum((answer & have).values()) / sum(answer.values()) if answer else 1.0
            if q >= QUESTION_OVERLAP and a >= ANSWER_OVERLAP and value > kept.get(k, (0.0,))[0]:
                kept[k] = (value, q, a)


def indexes(items: DataFrame) -> Iterator[Index]:
    """One index per group of items; document frequencies count all items.

    Items without a word are left out; a null text has none.
    """
    items = items.select(F.col("item_id").cast("long").alias("item_id"), F.coalesce("text", F.lit("")).alias("text"))
    stats = items.select(F.size(F.regexp_extract_all(F.lower("text"), F.lit(r"(?U)\w+"), F.lit(0))).alias("n")) \
        .agg(F.count(F.lit(1)).alias("items"), F.sum("n").alias("words")).first()
    if not stats["items"]:
        return
    groups = -(-stats["items"] // GROUP)
    tagged = items.withColumn("part", F.pmod(F.xxhash64("item_id", "text"), F.lit(groups)))

    def terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = [(part, w) for part, text in rows_of(batch, "part", "text") for w in set(words(text))]
            yield pa.RecordBatch.from_arrays([pa.array([p for p, _ in pairs], pa.int64()),
                                              pa.array([w for _, w in pairs], pa.string())], names=["part", "w"])

    each = tagged.mapInArrow(terms, "part long, w string")
    df = each.groupBy("w").agg(F.count(F.lit(1)).alias("df"), F.collect_set("part").alias("parts"))
    for g in range(groups):
        held = [(r["item_id"], r["text"]) for r in tagged.filter(F.col("part") == g).collect()]  # about GROUP items
        own = {r["w"]: r["df"] for r in df.filter(F.array_contains("parts", F.lit(g).cast("long"))).select("w", "df").collect()}
        yield Index(held, own, stats["items"], max(1.0, (stats["words"] or 0) / stats["items"]))


def leaks(docs: DataFrame, items: DataFrame) -> DataFrame:
    """``doc_id, item_id, score, question_overlap, answer_overlap``: one row per
    document row and benchmark item found in it (its best passage).

    Null and empty texts hold no item; repeated rows give repeated results; a
    null doc_id or item_id stays null; without documents or items there are no
    rows; extra columns are not read.
    """
    bound_batches(docs.sparkSession)
    spark = docs.sparkSession
    schema = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("score", pa.float64()),
                        ("question_overlap", pa.float64()), ("answer_overlap", pa.float64())])
    ddl = "doc_id long, item_id long, score double, question_overlap double, answer_overlap double"
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")

    def searcher(index) -> Callable:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            own = index.value
            for batch in batches:
                ids, found = _searched(own, batch)
                rows = [(d, own.items[k][0], *v) for d, hits in zip(ids, found) for k, v in sorted(hits.items())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[i] for r in rows], f.type) for i, f in enumerate(schema)], schema=schema)
        return run

    out = None
    for index in indexes(items):
        part = texts.mapInArrow(searcher(spark.sparkContext.broadcast(index)), ddl)
        out = part if out is None else out.unionByName(part)
    return spark.createDataFrame([], ddl) if out is None else out


def _searched(index: Index, batch: pa.RecordBatch) -> tuple[list, list[dict]]:
    ids = batch.column(batch.schema.get_field_index("doc_id")).to_pylist()
    texts = batch.column(batch.schema.get_field_index("text")).to_pylist()
    return ids, index.search([t or "" for t in texts])


def drop_leaks(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item, all columns kept, no row moved."""
    bound_batches(docs.sparkSession)
    spark = docs.sparkSession

    def cleaner(index) -> Callable:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                _, found = _searched(index.value, batch)
                yield batch.filter(pa.array([not hits for hits in found], pa.bool_()))
        return run

    for index in indexes(items):
        docs = docs.mapInArrow(cleaner(spark.sparkContext.broadcast(index)), docs.schema)
    return docs


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query 6: every passage of ``documents`` against ``benchmark``."""
    return leaks(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
