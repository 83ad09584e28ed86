"""URL filters (13): all wildcard rules at once by a bit-parallel automaton.

A canonical URL is ``.host`` + separator + ``path`` as UTF-8 bytes; the separator is
a byte that UTF-8 never holds, so no rule reaches across it by chance.  A rule is a
glob on the host (it fits the host and all its subdomains) and on the beginning of
the path: ``*`` is any run of characters but dots in a host or slashes in a path,
``**`` any run, ``?`` one character; everything else stands for itself.

Every rule has one bit for its start and one for each of its characters; the bits of
all rules are packed into 64-bit words (multiword Shift-And).  Reading a byte shifts
all states at once, keeps those whose character class holds the byte, and keeps in
place the states that a wildcard follows.  Bytes that no rule tells apart share one
class, so the masks take (classes x words).  Rules are laid out longest first, so
the lowest accepting bit is the rule that wins.  A batch of URLs advances byte by
byte together, in slices of at most ``STATE_BYTES`` of state.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickforge.llm.common import bound_batches, read_table

ALLOW, BLOCK = "allow", "block"
_SEPARATOR = 0xFF
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# State of the URLs that advance together.
STATE_BYTES = 8 << 20


def _bytes_but(*out: int) -> np.ndarray:
    mask = np.ones(256, bool)
    mask[[_SEPARATOR, *out]] = False
    return mask


_FOLLOWING = np.zeros(256, bool)
_FOLLOWING[0x80:0xC0] = True  # bytes inside a UTF-8 character


class UrlRules:
    """Compiled rules: (text, verdict) pairs, text being ``host/path`` or ``host``.

    The path part starts at the first slash; a text without one fits every path.  A-Z
    in the host part count as a-z, as in hosts.  The longest text that fits wins
    (characters, wildcards too); of equal length the one given first.  A URL that no
    rule fits has no rule and the verdict ``default``.
    """

    def __init__(self, rules: Sequence[tuple[str, str]], default: str = ALLOW):
        for text, verdict in rules:
            if not text.partition("/")[0]:
                raise ValueError(f"rule {text!r} names no host")
            if verdict not in (ALLOW, BLOCK):
                raise ValueError(f"rule {text!r} has verdict {verdict!r}")
        self.default = default
        self.rules = sorted(((t, v) for t, v in rules), key=lambda r: -len(r[0]))
        enter, stay, starts, ends = [], [], [], []
        for text, _ in self.rules:
            classes, loops = _positions(text)
            starts.append(len(enter))
            # the start state takes no byte; a subdomain keeps it
            enter += [np.zeros(256, bool), *classes]
            stay += [_bytes_but(), *loops]
            ends.append(len(enter) - 1)
        self.words = max(1, -(-len(enter) // 64))
        masks = np.zeros((2, 256, self.words * 64), bool)
        for bit, (e, s) in enumerate(zip(enter, stay)):
            masks[0, :, bit], masks[1, :, bit] = e, s
        packed = np.packbits(masks, axis=2, bitorder="little").view("<u8")
        # one class for all bytes that no rule tells apart
        both = np.concatenate([packed[0], packed[1]], axis=1)
        both, self.byte_class = np.unique(both, axis=0, return_inverse=True)
        self.byte_class = self.byte_class.reshape(-1).astype(np.uint8)
        self.enter, self.stay = both[:, :self.words].copy(), both[:, self.words:].copy()
        self.start, self.accept = _words(starts, self.words), _words(ends, self.words)
        self.rule_at = np.full(self.words * 64, -1, np.int64)
        self.rule_at[ends] = np.arange(len(ends))

    def match(self, canonical: pa.Array) -> np.ndarray:
        """Index into ``rules`` of the rule that wins for each canonical URL, or -1."""
        offsets = np.frombuffer(canonical.buffers()[1], np.int64)[canonical.offset:canonical.offset + len(canonical) + 1]
        data = canonical.buffers()[2]
        flat = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
        size = np.diff(offsets)
        by = np.argsort(-size, kind="stable")  # URLs that have ended are the last ones
        out = np.full(len(size), -1, np.int64)
        step = max(1, STATE_BYTES // (8 * self.words))
        for at in range(0, len(by), step):
            rows = by[at:at + step]
            out[rows] = self._run(flat, offsets[rows], size[rows])
        return out

    def _run(self, flat: np.ndarray, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
        state = np.repeat(self.start[None, :], len(begin), axis=0)
        going = len(begin)
        for j in range(int(size[0]) if len(size) else 0):
            while size[going - 1] <= j:
                going -= 1
            now = state[:going]
            c = self.byte_class[flat[begin[:going] + j]]
            moved = now << np.uint64(1)
            moved[:, 1:] |= now[:, :-1] >> np.uint64(63)
            moved &= self.enter[c]
            now &= self.stay[c]
            now |= moved
        state &= self.accept
        hit = state != 0
        word = hit.argmax(axis=1)
        low = state[np.arange(len(state)), word]
        low &= ~low + np.uint64(1)
        bit = np.log2(np.where(low == 0, 1, low).astype(float)).astype(np.int64)
        return np.where(hit.any(axis=1), self.rule_at[word * 64 + bit], -1)


def _positions(text: str) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Byte class of each position of a rule and the bytes that keep its state; the
    first position is the dot before the host."""
    host, slash, path = text.partition("/")
    host = host.translate(str.maketrans(_UPPER, _LOWER))
    classes, loops = [], []

    def literal(byte: int) -> None:
        one = np.zeros(256, bool)
        one[byte] = True
        classes.append(one)
        loops.append(np.zeros(256, bool))

    def part(glob: str, stop: str) -> None:
        i = 0
        while i < len(glob):
            if glob.startswith("**", i):
                loops[-1] = loops[-1] | _bytes_but()
                i += 1
            elif glob[i] == "*":
                loops[-1] = loops[-1] | _bytes_but(ord(stop))
            elif glob[i] == "?":
                # a whole character: its first byte, then those inside it
                classes.append(_bytes_but(ord(stop)) & ~_FOLLOWING)
                loops.append(_FOLLOWING.copy())
            else:
                for byte in glob[i].encode():
                    literal(byte)
            i += 1

    literal(ord("."))
    part(host, ".")
    literal(_SEPARATOR)
    part(slash + path, "/")
    # whatever follows the path of the rule
    loops[-1] = loops[-1] | _bytes_but()
    return classes, loops


def _words(bits: list[int], words: int) -> np.ndarray:
    out = np.zeros(words * 64, bool)
    out[bits] = True
    return np.packbits(out, bitorder="little").view("<u8").copy()


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (after the first ``://`` up to a slash, question mark, hash or the end; A-Z as a-z)
    and path (then up to a question mark, hash or the end); both empty for null or
    without ``://``."""
    rest = F.when(F.locate("://", url) > 0, F.substring_index(F.regexp_replace(url, r"(?s)\A.*?://", ""), "#", 1)).otherwise("")
    rest = F.substring_index(F.coalesce(rest, F.lit("")), "?", 1)
    host = F.substring_index(rest, "/", 1)
    return F.translate(host, _UPPER, _LOWER), rest.substr(F.length(host) + 1, F.length(rest))


def judge(url: Column, rules: UrlRules, spark: SparkSession) -> Column:
    """``struct<host, path, rule, verdict>`` of a URL column; ``rule`` is the text of the
    winning rule or null.  Null, empty and broken URLs have an empty host and path, fit
    no rule and get the default verdict; URLs of any length are read whole."""
    bound_batches(spark)

    @F.arrow_udf("struct<rule: string, verdict: string>")
    def winner(host: pa.Array, path: pa.Array) -> pa.Array:
        large = pa.large_binary()
        canonical = pc.binary_join_element_wise(
            pa.scalar(b".", large), host.cast(pa.large_string()).cast(large), pa.scalar(bytes([_SEPARATOR]), large),
            path.cast(pa.large_string()).cast(large), pa.scalar(b"", large))
        at = rules.match(canonical)
        texts = pa.array([*(t for t, _ in rules.rules), None], pa.string())
        verdicts = pa.array([*(v for _, v in rules.rules), rules.default], pa.string())
        at = pa.array(np.where(at < 0, len(rules.rules), at))
        return pa.StructArray.from_arrays([texts.take(at), verdicts.take(at)], names=["rule", "verdict"])

    host, path = host_and_path(url)
    found = winner(host, path)
    return F.struct(host.alias("host"), path.alias("path"), found["rule"].alias("rule"), found["verdict"].alias("verdict"))


def keep_allowed(df: DataFrame, rules: UrlRules, url: str = "url") -> DataFrame:
    """The rows of ``df`` whose URL is allowed, with all their columns, whatever their names."""
    whole = F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row")
    judged = df.select(whole, judge(F.col(f"`{url}`"), rules, df.sparkSession)["verdict"].alias("verdict"))
    return judged.filter(F.col("verdict") == ALLOW).select(*[F.col(f"row.`{c}`").alias(c) for c in df.columns])


RULES = (("net/", BLOCK), ("example.net/en/", ALLOW), ("example.com/de/", BLOCK), ("org/fr/", ALLOW))


def op13_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query 13 over ``pages``: every URL under the four fixed rules."""
    found = judge(F.col("url"), UrlRules(RULES), spark)
    return read_table(spark, sf_dir, "pages").select("page_id", found.alias("j")).select("page_id", "j.host", "j.path", "j.rule", "j.verdict")


def _sql() -> str:
    fits = [(f"((host = '{h}' OR host LIKE '%.{h}') AND starts_with(path, '/{p}'))", f"{h}/{p}", verdict)
            for (h, _, p), verdict in sorted(((t.partition("/"), v) for t, v in RULES), key=lambda r: -len("".join(r[0])))]
    rule = " ".join(f"WHEN {cond} THEN '{text}'" for cond, text, _ in fits)
    verdict = " ".join(f"WHEN {cond} THEN '{v}'" for cond, _, v in fits)
    return f"""
WITH cut AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), bare AS (
  SELECT page_id, split_part(split_part(coalesce(rest, ''), '#', 1), '?', 1) AS rest FROM cut
), parts AS (
  SELECT page_id, translate(split_part(rest, '/', 1), '{_UPPER}', '{_LOWER}') AS host,
         substr(rest, length(split_part(rest, '/', 1)) + 1) AS path FROM bare
)
SELECT page_id, host, path, CASE {rule} END AS rule, CASE {verdict} ELSE '{ALLOW}' END AS verdict FROM parts
"""


OP13_SQL = _sql()
