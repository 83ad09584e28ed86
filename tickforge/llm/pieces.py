"""SentencePiece encoding and decoding (2): N-best segmentation.

A text becomes ``▁`` for every space, with one ``▁`` put in front.  Over that,
the pieces of the model form a lattice; a path's score is the sum of its piece
scores.  A forward Viterbi pass gives the best score from the start to every
position.  A-star then searches from the end backwards: a partial path is
ranked by its own score plus the forward score of the position it has reached,
which is exact, so paths leave the queue best first.

No usable piece has ``▁`` after its first character (the model's runs of
``▁`` have a score of minus a billion and are left out), and no piece holds two
characters side by side that are side by side in none: every path stops at such
places, so the lattice is a chain of part lattices.  A text's N best are
therefore found from its parts: only the N - 1 parts that lose least by their
second-best path can appear changed, and the same A-star search runs over the
chain of these.

The texts of an Arrow batch are cut together; each different part is solved
once, the parts of up to ``LONG_PART`` characters side by side (one array step per
place and piece length), longer ones one by one; the ids are then put together by
array takes.  Nothing but the alternatives of changed parts is kept between
batches, so a worker's memory goes with its batch.

Unknown characters, and ``▁`` itself, become their UTF-8 bytes as byte pieces,
each with the score ``lowest - UNKNOWN_PENALTY``; decoding gives the text back exactly.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickforge.llm.common import bound_batches, read_table, rows_of, text_of

SPACE = "▁"
UNKNOWN_PENALTY = 10.0
_NO = object()
N_BEST = 4
UNUSABLE = -1e8
# Texts are worked on together up to this many characters; a longer one is alone.
GROUP_CHARS = 2 << 20
LONG_PART = 64
# Parts solved side by side, and the characters of the parts whose alternatives are kept.
SIDE_BY_SIDE = 1 << 15
KEPT_CHARS = 4 << 20


class Solved(NamedTuple):
    """Best paths of parts: their ids one after the other, how many each has, the
    scores, and what each part's second-best path loses (infinity if it has one path)."""

    ids: np.ndarray
    count: np.ndarray
    score: np.ndarray
    loss: np.ndarray


class Encoded(NamedTuple):
    """A text's best ids, their score, the N best scores, for each of these the changes
    (start, n, ids) to the best ids, and whether all of them decode to the text."""

    ids: np.ndarray
    score: float
    scores: list[float]
    changes: list[list[tuple[int, int, tuple[int, ...]]]]
    exact: bool


def starts_of(lengths: np.ndarray) -> np.ndarray:
    """Where each of consecutive runs starts, and the end of the last one."""
    return np.concatenate([np.zeros(1, dtype=np.int64), np.cumsum(lengths, dtype=np.int64)])


def take_runs(pool: np.ndarray, first: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The runs of ``pool`` of the given starts and lengths, one after the other."""
    at = starts_of(lengths)
    return pool[np.repeat(first - at[:-1], lengths) + np.arange(at[-1])]


class Pieces:
    """The vocabulary of a model file as a lattice scorer."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.table: dict[str, tuple[int, float]] = {}
        self.byte_id: list[int] = [0] * 256
        self.text_of: dict[int, bytes] = {}
        low = 0.0
        for i in range(model.vocab_size()):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                value = int(piece[3:5], 16)
                self.byte_id[value] = i
                self.text_of[i] = bytes([value])
            elif not (model.is_control(i) or model.is_unknown(i)):
                self.text_of[i] = piece.replace(SPACE, " ").encode()
                score = model.get_score(i)
                if SPACE not in piece[1:] and (score > UNUSABLE or len(piece) == 1):
                    self.table[piece] = (i, score)
                    low = min(low, score) if score > UNUSABLE else low
        self.low = low - UNKNOWN_PENALTY
        # pieces, and None for what only begins one
        self.begins: dict[str, tuple[int, float] | None] = {}
        self.pairs: set[str] = set()
        for piece in self.table:
            for k in range(1, len(piece)):
                self.begins.setdefault(piece[:k])
                self.pairs.add(piece[k - 1:k + 1])
        self.begins.update(self.table)
        texts = [self.text_of.get(i, b"") for i in range(model.vocab_size())]
        self.bytes_at = starts_of(np.array([len(t) for t in texts]))
        self.bytes = np.frombuffer(b"".join(texts), dtype="u1")
        self._arrays()
        self.others: dict[str, tuple[list[tuple[float, tuple[int, ...]]], bool]] = {}
        self.others_chars = 0

    def _arrays(self) -> None:
        """The pairs and the pieces as arrays over classes of characters: 0 is every
        character that is in no pair; the escaped space has the class of ``▁``."""
        chars = sorted({c for pair in self.pairs for c in pair})
        number = {c: k for k, c in enumerate(chars, 1)}
        self.class_of = np.zeros(0x110000, dtype=np.int16)
        for c, k in number.items():
            self.class_of[ord(c)] = k
        self.class_of[ord(" ")] = number.get(SPACE, 0)
        self.class_of[ord(SPACE)] = 0
        self.joined = np.zeros((len(chars) + 1, len(chars) + 1), dtype=bool)
        for x, y in self.pairs:
            self.joined[number[x], number[y]] = True
        # classes whose character is a piece: others need bytes
        self.whole = np.array([False] + [c in self.table for c in chars])
        known = [b for b in self.begins if b[0] in number]
        longer = sorted({b[:-1] for b in known if len(b) > 1}, key=len)
        at = {"": 0, **{b: k for k, b in enumerate(longer, 1)}}
        self.inner = len(at)
        for b in known:
            at.setdefault(b, len(at))
        self.step = np.full((self.inner, len(chars) + 1), -1, dtype=np.int32)
        self.piece = np.zeros(len(at), dtype=np.int32)
        self.gain = np.full(len(at), -np.inf)
        for b in known:
            self.step[at[b[:-1]], number[b[-1]]] = at[b]
            if self.begins[b] is not None:
                self.piece[at[b]], self.gain[at[b]] = self.begins[b]

    def edges(self, word: str) -> list[list[tuple[int, tuple[int, ...], float]]]:
        """For each end position, the (start, ids, score) that reach it; a space at
        the start of ``word`` is an escaped one, a ``▁`` is that character."""
        begins, n = self.begins, len(word)
        marked = SPACE + word[1:] if word[:1] == " " else word
        into: list[list[tuple[int, tuple[int, ...], float]]] = [[] for _ in range(n + 1)]
        for start in range(n):
            single = False
            if word[start] != SPACE:
                for end in range(start + 1, n + 1):
                    found = begins.get(marked[start:end], _NO)
                    if found is _NO:
                        break
                    if found is not None:
                        into[end].append((start, (found[0],), found[1]))
                        single = single or end == start + 1
            if not single:  # no piece of this one character
                raw = word[start].encode("utf-8", "surrogatepass")
                into[start + 1].append((start, tuple([self.byte_id[b] for b in raw]), self.low * len(raw)))
        return into

    @staticmethod
    def forward(into: list) -> list[float]:
        """Best score from the start to each position."""
        best = [0.0]
        for here in into[1:]:
            best.append(max([best[start] + score for start, _, score in here]))
        return best

    def best(self, word: str) -> tuple[list[int], float, float]:
        """Best ids, their score, and what the second-best path loses."""
        into = self.edges(word)
        best = self.forward(into)
        n = len(word)
        rest = [float("-inf")] * (n + 1)
        rest[n] = 0.0
        second = float("-inf")
        top = best[n]
        path: list[tuple[int, ...]] = []
        on = n  # the best path's next position, walking back
        for end in range(n, 0, -1):
            after = rest[end]
            if after == float("-inf"):
                continue
            chosen = False
            for start, ids, score in into[end]:
                if after + score > rest[start]:
                    rest[start] = after + score
                if end == on and not chosen and best[start] + score == best[end]:
                    chosen, step, back = True, ids, start
                    continue
                through = best[start] + score + after
                if through > second:
                    second = through
            if chosen:
                path.append(step)
                on = back
        return [i for step in reversed(path) for i in step], top, top - second

    def solve(self, classes: np.ndarray, first: np.ndarray, lengths: np.ndarray) -> Solved:
        """``best`` of many parts side by side: part k is ``lengths[k]`` classes from
        ``first[k]`` on, all of them pieces by themselves."""
        order = np.argsort(-lengths, kind="stable")  # the parts that reach a place come first
        first, size = first[order], lengths[order]
        n, top = len(size), int(size[0])
        each = np.arange(n)
        reach = np.searchsorted(-size, -np.arange(top + 1), side="right")  # parts of at least so many
        cells = np.zeros((top, n), dtype=np.int16)
        for p in range(top):
            cells[p, :reach[p + 1]] = classes[first[:reach[p + 1]] + p]
        best = np.full((top + 1, n), -np.inf)
        best[0] = 0.0
        back = np.zeros((top + 1, n), dtype=np.int16)
        by = np.zeros((top + 1, n), dtype=np.int32)
        hits: list[tuple[int, int, np.ndarray, np.ndarray]] = []
        for p in range(top):
            rows, state = each[:reach[p + 1]], np.zeros(reach[p + 1], dtype=np.int32)
            for end in range(p + 1, top + 1):
                some = np.searchsorted(rows, reach[end])
                rows, state = rows[:some], self.step[state[:some], cells[end - 1, rows[:some]]]
                ok = state >= 0
                rows, state = rows[ok], state[ok]
                if not len(rows):
                    break
                gain = self.gain[state]
                hit = gain > -np.inf
                here, gain, node = rows[hit], gain[hit], state[hit]
                hits.append((p, end, here, gain))
                value = best[p, here] + gain
                better = value > best[end, here]
                here = here[better]
                best[end, here], back[end, here], by[end, here] = value[better], end - p, self.piece[node[better]]
                more = state < self.inner
                rows, state = rows[more], state[more]
        # the best paths: the end of the step from each place, and its id
        on, ids = np.zeros((top, n), dtype=np.int16), np.zeros((top, n), dtype=np.int32)
        rows, at = each, size.copy()
        while len(rows):
            start = at - back[at, rows]
            on[start, rows], ids[start, rows] = at, by[at, rows]
            rows, at = rows[start > 0], start[start > 0]
        # what the best path that leaves them reaches, from the end backwards
        rest, second = np.full((top + 1, n), -np.inf), np.full(n, -np.inf)
        rest[size, each] = 0.0
        for p, end, here, gain in reversed(hits):
            after = rest[end, here]
            rest[p, here] = np.maximum(rest[p, here], after + gain)
            other = on[p, here] != end
            here = here[other]
            second[here] = np.maximum(second[here], best[p, here] + gain[other] + after[other])
        score = best[size, each]
        # back to the order given
        place = np.argsort(order, kind="stable")
        taken = (on > 0).T[place]
        return Solved(ids.T[place][taken], taken.sum(axis=1), score[place], (score - second)[place])

    def parts(self, joined: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Classes of the characters of ``joined``, their places in its UTF-8, and where the parts start."""
        codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype="<u4")
        classes = self.class_of[codes]
        width = 1 + (codes >= 0x80).astype("i1") + (codes >= 0x800) + (codes >= 0x10000)
        starts = np.flatnonzero(~self.joined[classes[:-1], classes[1:]]) + 1
        return classes, starts_of(width), np.concatenate([[0], starts, [len(codes)]])

    def solve_parts(self, joined: str, classes: np.ndarray, first: np.ndarray, size: np.ndarray) -> Solved:
        """Best paths of different parts, the short ones of whole characters side by side."""
        strange = starts_of(~self.whole[classes])
        plain = (size <= LONG_PART) & (strange[first + size] == strange[first])
        made, order = [], []
        sides = np.flatnonzero(plain)
        sides = sides[np.argsort(size[sides], kind="stable")]  # parts of like length together
        for k in range(0, len(sides), SIDE_BY_SIDE):
            some = sides[k:k + SIDE_BY_SIDE]
            made.append(self.solve(classes, first[some], size[some]))
            order.append(some)
        single = np.flatnonzero(~plain)
        if len(single):
            found = [self.best(joined[a:a + n]) for a, n in zip(first[single].tolist(), size[single].tolist())]
            made.append(Solved(np.array([i for f in found for i in f[0]], dtype=np.int32), np.array([len(f[0]) for f in found]),
                               np.array([f[1] for f in found]), np.array([f[2] for f in found])))
            order.append(single)
        back = np.argsort(np.concatenate(order), kind="stable")
        ids, count, score, loss = (np.concatenate(x) for x in zip(*made))
        return Solved(take_runs(ids, starts_of(count)[:-1][back], count[back]), count[back], score[back], loss[back])

    def alternatives(self, word: str, n: int) -> list[tuple[float, tuple[int, ...]]]:
        """The ``n`` best (score, ids) of a part by backward A-star, best first; of equal
        ones that of ``best`` is the first."""
        into = self.edges(word)
        found = list(a_star(into, self.forward(into), n))
        best = tuple(self.best(word)[0])
        return [(found[0][0], best), *[f for f in found if f[1] != best][:n - 1]]

    def _others(self, word: str, n: int) -> tuple[list[tuple[float, tuple[int, ...]]], bool]:
        """``alternatives``, and whether each decodes to the part; kept, bounded by characters."""
        found = self.others.get(word)
        if found is None or len(found[0]) < n:
            paths = self.alternatives(word, n)
            found = paths, all(b"".join([self.text_of[i] for i in ids]) == word.encode("utf-8", "surrogatepass") for _, ids in paths)
            if self.others_chars > KEPT_CHARS:
                self.others, self.others_chars = {}, 0
            self.others[word] = found
            self.others_chars += len(word)
        return found

    def decode_array(self, ids: np.ndarray) -> np.ndarray:
        """The bytes of ids, with the leading space of every text."""
        return take_runs(self.bytes, self.bytes_at[ids], self.bytes_at[ids + 1] - self.bytes_at[ids])

    def decode(self, ids: list[int]) -> str:
        """The text of a path; the leading space that encoding added is removed."""
        return self.decode_array(np.asarray(ids, dtype=np.int64)).tobytes()[1:].decode("utf-8", "surrogatepass")

    def words(self, text: str) -> list[str]:
        """The chain of word lattices, each led by its escaped space."""
        return [" " + w for w in text.split(" ")]

    def encode_all(self, texts: list[str], n: int = N_BEST) -> Iterator[Encoded]:
        """Every text encoded, those of up to ``GROUP_CHARS`` characters together."""
        group: list[str] = []
        chars = 0
        for text in texts:
            if group and chars + len(text) > GROUP_CHARS:
                yield from self._group(group, n)
                group, chars = [], 0
            group.append(text)
            chars += len(text) + 1
        if group:
            yield from self._group(group, n)

    def _group(self, texts: list[str], n: int) -> Iterator[Encoded]:
        joined = " " + " ".join(texts)  # every text with its leading space
        raw = np.frombuffer(joined.encode("utf-8", "surrogatepass"), dtype="u1")
        classes, byte_at, starts = self.parts(joined)
        names = pa.Array.from_buffers(pa.large_binary(), len(starts) - 1, [
            None, pa.py_buffer(byte_at[starts].astype(np.int64)), pa.py_buffer(raw)]).dictionary_encode()
        which = names.indices.to_numpy()
        # parts are numbered as they first appear
        new = np.flatnonzero(np.diff(np.maximum.accumulate(which), prepend=-1))
        first, size = starts[new], starts[new + 1] - starts[new]
        solved = self.solve_parts(joined, classes, first, size)
        count = solved.count[which]
        ids = take_runs(solved.ids, starts_of(solved.count)[:-1][which], count)
        id_at = starts_of(count)
        score, loss = solved.score[which], solved.loss[which]
        # a text's first and last part, and the bytes of its ids
        text_at = starts_of(np.array([len(t) + 1 for t in texts]))
        part_at = np.searchsorted(starts, text_at)
        back = self.decode_array(ids)
        back_at = starts_of(self.bytes_at[ids + 1] - self.bytes_at[ids])
        total = np.add.reduceat(score, part_at[:-1])
        for k in range(len(texts)):
            a, b = part_at[k], part_at[k + 1]
            x, y = byte_at[text_at[k]], byte_at[text_at[k + 1]]
            exact = np.array_equal(back[back_at[id_at[a]]:back_at[id_at[b]]], raw[x:y])
            scores, changes = [float(total[k])], [[]]
            if n > 1:
                least = loss[a:b]
                least = np.argpartition(least, n - 2)[:n - 1] if b - a >= n else np.arange(b - a)
                least = sorted(j for j in (least + a).tolist() if loss[j] < np.inf)
                paths = []
                for j in least:
                    found, good = self._others(joined[starts[j]:starts[j + 1]], n)
                    paths.append(found[:n])
                    exact = exact and good
                scores, changes = self._chain(scores[0], paths, n)
                changes = [[(int(id_at[least[j]] - id_at[a]), int(count[least[j]]), paths[j][r][1]) for j, r in path] for path in changes]
            yield Encoded(ids[id_at[a]:id_at[b]], float(total[k]), scores, changes, bool(exact))

    def _chain(self, total: float, paths: list, n: int) -> tuple[list[float], list[list[tuple[int, int]]]]:
        """The ``n`` best scores over the chain of parts that may change, and the (part,
        rank) that each changes, by the same search."""
        into: list[list[tuple[int, tuple, float]]] = [[]]
        for j, found in enumerate(paths):
            into.append([(j, ((j, rank),), score) for rank, (score, _) in enumerate(found)])
        base = total - sum([found[0][0] for found in paths])
        chain = list(a_star(into, self.forward(into), n))
        return [base + s for s, _ in chain], [sorted((j, r) for j, r in path if r) for _, path in chain]

    def encode(self, text: str, n: int = N_BEST) -> tuple[np.ndarray, float, list[float], list[list]]:
        """One text by itself: its best ids, their score, the N best scores and their changes."""
        return next(self.encode_all([text], n))[:4]

    def segmentation(self, text: str, changes: list[tuple[int, int, tuple[int, ...]]]) -> list[int]:
        """The ids of one of the N best, from its changes to the best ids."""
        best = self.encode(text, 1)[0].tolist()
        out, at = [], 0
        for start, n, other in changes:
            out += [*best[at:start], *other]
            at = start + n
        return out + best[at:]


def a_star(into: list, best: list[float], n: int) -> Iterator[tuple[float, tuple]]:
    """Up to ``n`` paths, best first, searched from the end backwards.

    ``into[e]`` lists the (start, labels, score) edges that reach ``e``; ``best``
    are the forward scores, the exact heuristic.  Of equal scores the newest
    path goes on first, so ties are followed to the end one at a time.
    """
    end = len(into) - 1
    queue: list = [(-best[end], 0, end, 0.0, None)]
    made = 0
    while queue and n:
        _, _, at, score, tail = heapq.heappop(queue)
        if at == 0:
            labels: list = []
            while tail is not None:
                step, tail = tail
                labels += step
            n -= 1
            yield score, tuple(labels)
            continue
        for start, step, gain in into[at]:
            made -= 1
            heapq.heappush(queue, (-(best[start] + gain + score), made, start, gain + score, (step, tail)))


_MODELS: dict[str, Pieces] = {}


def model(path: str) -> Pieces:
    """This worker's pieces of a model file."""
    if path not in _MODELS:
        _MODELS[path] = Pieces(path)
    return _MODELS[path]


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


_CHANGE = pa.struct([("start", pa.int32()), ("n", pa.int32()), ("ids", pa.list_(pa.int32()))])
_OUT = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32())), ("n_pieces", pa.int64()),
                  ("score", pa.float64()), ("nbest_scores", pa.list_(pa.float64())),
                  ("nbest_changes", pa.list_(pa.list_(_CHANGE))), ("ids_crc32", pa.int64()), ("exact", pa.bool_())])


def encode(docs: DataFrame, path: str | None = None, n: int = N_BEST, keep_ids: bool = True) -> DataFrame:
    """Encode every whole text: ``doc_id, ids, n_pieces, score, nbest_scores,
    nbest_changes, ids_crc32, exact``.

    ``ids`` is the best segmentation (null when ``keep_ids`` is false),
    ``nbest_scores`` the scores of the ``n`` best in falling order (fewer if the
    lattice has fewer paths; ties stay as found), ``nbest_changes`` for each of
    them what it changes in ``ids``: ``n`` ids from place ``start`` on become
    others (``segmentations`` puts them together), ``exact`` whether decoding
    gave the text back, by the best ids and by every change.  Null and empty texts
    are one ``▁``.  A very long text is worked on alone, at some 100 bytes of memory a
    character; one without places to cut is one part, searched by itself.  Repeated rows
    give repeated results, a null doc_id stays null, an empty table gives no
    rows, and extra columns are not read.
    """
    path = path or default_model()
    bound_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = model(path)
        for batch in batches:
            doc_ids, texts = (batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("doc_id", "text"))
            out: list[list] = [[] for _ in _OUT]
            for doc_id, (ids, score, scores, changes, exact) in zip(doc_ids, pieces.encode_all(texts, n)):
                changes = [[{"start": a, "n": k, "ids": other} for a, k, other in some] for some in changes]
                row = (doc_id, ids if keep_ids else None, len(ids), score, scores, changes,
                       zlib.crc32(ids.astype("<u4").tobytes()), exact)
                for column, value in zip(out, row):
                    column.append(value)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(out, _OUT)], schema=_OUT)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text")).mapInArrow(
        run, "doc_id long, ids array<int>, n_pieces long, score double, nbest_scores array<double>, "
             "nbest_changes array<array<struct<start: int, n: int, ids: array<int>>>>, ids_crc32 long, exact boolean")


def segmentations(encoded: DataFrame) -> DataFrame:
    """``doc_id, rank, score, ids``: a row for each of the N best of every encoded text, the
    best with rank 0.  Rows whose ids are null give null ids."""
    each = encoded.select("doc_id", F.col("ids").alias("best"), "nbest_scores", F.posexplode("nbest_changes").alias("rank", "changes"))
    return each.select("doc_id", "rank", F.expr("nbest_scores[rank]").alias("score"), F.expr("""aggregate(changes,
        struct(cast(array() as array<int>) as ids, 0 as at),
        (s, c) -> struct(concat(s.ids, slice(best, s.at + 1, c.start - s.at), c.ids) as ids, c.start + c.n as at),
        s -> concat(s.ids, slice(best, s.at + 1, size(best) - s.at)))""").alias("ids"))


def decode(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """``doc_id, text`` from ``doc_id, ids``; null ids give a null text."""
    path = path or default_model()
    schema = pa.schema([("doc_id", pa.int64()), ("text", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = model(path)
        for batch in batches:
            rows = [(d, None if ids is None else pieces.decode(ids)) for d, ids in rows_of(batch, "doc_id", "ids")]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in rows], f.type) for i, f in enumerate(schema)], schema=schema)

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query 2 over ``documents``: piece counts, scores and the N-best scores and changes."""
    return encode(read_table(spark, sf_dir, "documents"), keep_ids=False).drop("ids")
