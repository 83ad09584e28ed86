"""Toxicity (5): multiple-instance learning with noisy-or.

A document is a bag of sentences and only the bag has a label.  A sentence
scores ``p = sigmoid(bias + sum of word weights)`` where it holds at least one
word of the model and 0 otherwise; the document scores
``1 - (1 - leak) * product(1 - p)``, the noisy-or of its sentences with a small
leak.  Weights follow from document labels alone, by gradient steps on the
document likelihood; the sentence scores then point to the offending sentences.

The model is fitted on the driver from a bounded sample of labelled documents
(``MAX_POSITIVE``, ``MAX_NEGATIVE`` documents of at most ``MAX_CHARS``
characters each, chosen by a hash of the id).  Every document is scored whole.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickforge.llm.common import bound_batches, read_table, rows_of, text_of

MAX_POSITIVE = 2_000
MAX_NEGATIVE = 4_000
MAX_CHARS = 20_000
MAX_WORDS = 5_000
MIN_DOCS = 4
MIN_GAIN = 12.0
STEPS = 300

_SENTENCE = re.compile(r"[^.!?\n]+[.!?]*|[.!?]+")
_MARK = re.compile(r"[.!?\n]")
_WORD = re.compile(r"[^\W_]+")


@dataclass
class Model:
    weights: dict[str, float]
    bias: float
    leak: float

    def sentences(self, text: str) -> list[tuple[int, int, float]]:
        """``(start, end, score)`` of each sentence with evidence."""
        weights, out = self.weights, []
        if not weights:
            return out
        low = text.lower()
        if len(low) != len(text):  # a few letters change length in lower case
            low = "".join(c if len(c.lower()) != 1 else c.lower() for c in text)
        # one pass finds the words with a weight; their sentences follow from the places
        hits = [(m.start(), weights[m[0]]) for m in _WORD.finditer(low) if m[0] in weights]
        # the marks that end sentences are walked once, beside the hits
        marks = (m.start() for m in _MARK.finditer(low)) if hits else iter(())
        k, start, end = 0, 0, next(marks, len(low))
        while k < len(hits):
            while end < hits[k][0]:
                start, end = end + 1, next(marks, len(low))
            z = self.bias
            while k < len(hits) and hits[k][0] < end:
                z += hits[k][1]
                k += 1
            out.append((start, min(end + 1, len(low)), 1 / (1 + math.exp(-max(-50.0, min(50.0, z))))))
        return out

    def score(self, found: list[tuple[int, int, float]]) -> float:
        clean = 1 - self.leak
        for _, _, p in found:
            clean *= 1 - p
        return 1 - clean


def held_out(column: str = "doc_id") -> Column:
    """Fold of a row: crc32 of the id as text, remainder 0 of 5."""
    return F.coalesce(F.crc32(F.col(column).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def sample(docs: DataFrame, labels: DataFrame) -> list[tuple[str, int]]:
    """The bounded training sample: (text, label) of documents outside the held-out fold."""
    marks = (labels.filter("toxic IS NOT NULL AND doc_id IS NOT NULL").filter(~held_out())
             .groupBy("doc_id").agg(F.max("toxic").alias("toxic")).withColumn("h", F.xxhash64("doc_id")))
    take = [marks.filter(F.col("toxic") == y).orderBy("h", "doc_id").limit(n)
            for y, n in ((1, MAX_POSITIVE), (0, MAX_NEGATIVE))]
    chosen = take[0].unionByName(take[1]).select(F.col("doc_id").alias("id"), "toxic")
    rows = (docs.select("doc_id", text_of().alias("text")).filter(F.length("text") <= MAX_CHARS)
            .join(F.broadcast(chosen), F.col("doc_id") == F.col("id"))  # at most 6,000 ids
            .select("doc_id", "text", "toxic").dropDuplicates(["doc_id"]).collect())
    return [(r["text"], int(r["toxic"])) for r in sorted(rows, key=lambda r: r["doc_id"])]


def _gain(a: int, b: int, n1: int, n0: int) -> float:
    """Log-likelihood ratio of a word seen in ``a`` of n1 and ``b`` of n0 documents."""
    def part(seen: float, expected: float) -> float:
        return seen * math.log(seen / expected) if seen else 0.0

    rate = (a + b) / (n1 + n0)
    return 2 * (part(a, n1 * rate) + part(b, n0 * rate) + part(n1 - a, n1 * (1 - rate)) + part(n0 - b, n0 * (1 - rate)))


def fit(rows: list[tuple[str, int]]) -> Model:
    """Fit the model.  Without both labels every score is the leak, 0.01."""
    n1 = sum(y for _, y in rows)
    n0 = len(rows) - n1
    if not n1 or not n0:
        return Model({}, 0.0, 0.01)
    bags = [[_WORD.findall(s) for s in _SENTENCE.findall(text.lower())] for text, _ in rows]
    seen = [Counter(), Counter()]
    for bag, (_, y) in zip(bags, rows):
        seen[y].update({w for words in bag for w in words})
    gains = {}
    for word, a in seen[1].items():
        b = seen[0][word]
        if a >= MIN_DOCS and a / n1 > b / n0 and (g := _gain(a, b, n1, n0)) >= MIN_GAIN:
            gains[word] = g
    chosen = {w: i for i, w in enumerate(sorted(gains, key=lambda w: (-gains[w], w))[:MAX_WORDS])}
    word_at, sentence_of, doc_of = [], [], []
    for d, bag in enumerate(bags):
        for words in bag:
            ids = [chosen[w] for w in words if w in chosen]
            if ids:
                word_at += ids
                sentence_of += [len(doc_of)] * len(ids)
                doc_of.append(d)
    if not doc_of:
        return Model({}, 0.0, max(0.01, min(0.49, n1 / len(rows))))
    words, of, docs = np.asarray(word_at), np.asarray(sentence_of), np.asarray(doc_of)
    y = np.asarray([label for _, label in rows], dtype=float)
    # weight vector: words, then bias, then the leak's logit
    theta = np.zeros(len(chosen) + 2)
    theta[-2], theta[-1] = -1.0, -3.0
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, STEPS + 1):
        z = np.bincount(of, theta[words], len(docs)) + theta[-2]
        p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        leak = 1 / (1 + np.exp(-theta[-1]))
        log_clean = np.bincount(docs, np.log1p(-np.minimum(p, 1 - 1e-9)), len(y)) + np.log1p(-leak)
        toxic = np.clip(-np.expm1(log_clean), 1e-9, 1.0)
        pull = np.where(y > 0, -(1 - toxic) / toxic, 1.0)  # d loss / d logit is pull * p
        gz = pull[docs] * p
        grad = np.concatenate([np.bincount(words, gz[of], len(chosen)), [gz.sum()], [(pull * leak).sum()]]) / len(y)
        grad[:-2] += 1e-4 * theta[:-2]
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        theta -= 0.05 * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-9)
    leak = float(1 / (1 + np.exp(-theta[-1])))
    return Model({w: float(theta[i]) for w, i in chosen.items()}, float(theta[-2]), leak)


def train(docs: DataFrame, labels: DataFrame) -> Model:
    return fit(sample(docs, labels))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, held_out, score, predicted, offending``: every whole text scored.

    ``offending`` lists (start, end, score) of the sentences at 0.5 or more, in
    code points.  Null and empty texts score the leak; repeated rows score the
    same; a null doc_id is not held out; an empty table gives no rows; extra
    columns are not read.
    """
    bound_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # at most MAX_WORDS words
    span = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())])
    schema = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("score", pa.float64()),
                        ("predicted", pa.int32()), ("offending", pa.list_(span))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            ids, folds, texts = (list(c) for c in zip(*rows_of(batch, "doc_id", "held_out", "text"))) \
                if batch.num_rows else ([], [], [])
            found = [own.sentences(t) for t in texts]
            scores = [own.score(f) for f in found]
            yield pa.RecordBatch.from_arrays([
                pa.array(ids, pa.int64()), pa.array(folds, pa.bool_()), pa.array(scores, pa.float64()),
                pa.array([int(s >= 0.5) for s in scores], pa.int32()),
                pa.array([[{"start": a, "end": b, "score": p} for a, b, p in f if p >= 0.5] for f in found], pa.list_(span)),
            ], schema=schema)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"),
                       text_of().alias("text")).mapInArrow(
        run, "doc_id long, held_out boolean, score double, predicted int, "
             "offending array<struct<start:int,end:int,score:double>>")


def drop_toxic(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs`` that the model does not reject, all columns kept, no row moved."""
    bound_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index("text")).to_pylist()
            yield batch.filter(pa.array([own.score(own.sentences(t or "")) < 0.5 for t in texts], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query 5 over ``documents``, labels outside the held-out fold."""
    docs = read_table(spark, sf_dir, "documents")
    return score(docs, train(docs, read_table(spark, sf_dir, "labels")))
