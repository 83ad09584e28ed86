"""Secret scans (3), DataFrame functions only: multipart credential linking.

Base findings (assignments, access keys, long hex runs) come from regular
expressions.  Weak parts - account names, weakly named secrets, endpoints -
mean little alone: they are reported only where complementary parts lie within
``SCOPE`` characters.  Parts are cut into cells of that width; each part is
equi-joined with the per-cell, per-role extent of its own and the two
neighbouring cells, which is an exact interval join of linear size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickforge.llm.common import cut, read_table, text_of

SCOPE = 300

# Fixed patterns of the base kinds, in the order of their listing.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}+"
HEX = r"[0-9a-f]{24,}+"
ASSIGN_MIN = 6

# Patterns of the weak parts.
WEAK_ID = r"""(?i)(?<![A-Za-z0-9_])(?:client_?id|user_?name|user|login|account|access_?key_?id)["']?\x20*[:=]\x20*["']?[A-Za-z0-9@._-]{3,}"""
WEAK_SECRET = r"""(?i)(?<![A-Za-z0-9_])(?:pwd|pass|pass_?phrase|private_?key|access_?key|auth|credential|signature)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]{6,}"""
ENDPOINT = r"""(?i)(?:https?|ftp|postgres(?:ql)?|mysql|mongodb|redis|amqp)://[^\s"'<>]+"""

KINDS = ["assign", "access", "hex", "weak_id", "weak_secret", "endpoint"]
ROLE = {"assign": "secret", "hex": "secret", "weak_secret": "secret",
        "access": "id", "weak_id": "id", "endpoint": "endpoint"}

_SPAN = "struct<start:int,rank:int,end:int,kind:string>"
_NONE = f"cast(array() as array<{_SPAN}>)"


def _spans(kind: str, pattern: str, matches: str) -> Column:
    """Spans of all matches as an array: a match starts after the gaps and
    matches before it (``split`` and ``regexp_extract_all`` walk the same finds)."""
    rank = KINDS.index(kind)
    gap = "length(g[i])"
    return F.expr(f"""
        CASE WHEN size({matches}) > 0 THEN aggregate(
          sequence(0, size({matches}) - 1),
          named_struct('at', 0, 'g', split(text, '{_sql(pattern)}', -1), 'out', {_NONE}),
          (s, i) -> named_struct(
            'at', s.at + length(s.g[i]) + length({matches}[i]), 'g', s.g,
            'out', concat(s.out, array(named_struct(
               'start', s.at + length(s.g[i]), 'rank', {rank},
               'end', s.at + length(s.g[i]) + length({matches}[i]), 'kind', '{kind}')))),
          s -> s.out) ELSE {_NONE} END""".replace(gap, "length(s.g[i])"))


def _sql(pattern: str) -> str:
    return pattern.replace("\\", "\\\\").replace("'", "\\'")


def _found(pattern: str, group: int = 0) -> Column:
    return F.regexp_extract_all("text", F.lit(pattern), F.lit(group))


def find_parts(docs: DataFrame) -> DataFrame:
    """``doc_id, base, weak, key``: span arrays of each whole text.

    ``key`` is the SHA-256 of the text where it has a weak part, else null:
    weak parts are linked per distinct text.
    """
    df = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    df = df.select(
        "doc_id", "text", _found(ASSIGN).alias("m0"), _found(ACCESS).alias("m1"), _found(HEX).alias("m2"),
        _found(WEAK_ID).alias("m3"), _found(WEAK_SECRET).alias("m4"), _found(ENDPOINT).alias("m5"))
    df = df.withColumn("v0", F.when(F.size("m0") > 0, _found(ASSIGN, 2)))
    # an assignment with a short value is dropped after matching, as listed
    assign = F.expr(f"""filter(a0, (x, i) -> length(v0[i]) >= {ASSIGN_MIN})""")
    df = df.select(
        "doc_id", "text", "v0", _spans("assign", ASSIGN, "m0").alias("a0"),
        F.concat(_spans("access", ACCESS, "m1"), _spans("hex", HEX, "m2")).alias("plain"),
        F.concat(_spans("weak_id", WEAK_ID, "m3"), _spans("weak_secret", WEAK_SECRET, "m4"),
                 _spans("endpoint", ENDPOINT, "m5")).alias("weak"))
    return df.select(
        "doc_id", F.array_sort(F.concat(assign, "plain")).alias("base"), "weak",
        F.when(F.size("weak") > 0, F.sha2("text", 256)).alias("key"))


def link_parts(parts: DataFrame, scope: int = SCOPE) -> DataFrame:
    """``key, added``: weak spans that lie within ``scope`` characters of their
    complements, per distinct text.

    A weak id needs a secret near it, a weak secret an id, an endpoint both.
    """
    texts = parts.filter("key IS NOT NULL").groupBy("key").agg(
        F.first("base").alias("base"), F.first("weak").alias("weak"))
    role = F.create_map(*[F.lit(x) for pair in ROLE.items() for x in pair])
    each = texts.select("key", F.explode(F.concat("base", "weak")).alias("p")).select(
        "key", "p.*", role[F.col("p.kind")].alias("role"),
        F.floor(F.col("p.start") / scope).cast("int").alias("cell"))
    extent = each.groupBy("key", "cell", "role").agg(F.min("start").alias("low"), F.max("start").alias("high"))
    weak = each.filter(F.col("rank") >= KINDS.index("weak_id")).select(
        "key", "start", "rank", "end", "kind", F.col("role").alias("own"),
        F.explode(F.array(*[F.col("cell") + d for d in (-1, 0, 1)])).alias("cell"))
    near = weak.join(extent, ["key", "cell"]).filter(
        (F.col("role") != F.col("own")) & (F.col("low") <= F.col("start") + scope)
        & (F.col("high") >= F.col("start") - scope))
    has = near.groupBy("key", "start", "rank", "end", "kind", "own").agg(
        F.max(F.col("role") == "id").alias("id"), F.max(F.col("role") == "secret").alias("secret"))
    kept = has.filter("(own = 'id' AND secret) OR (own = 'secret' AND id) OR (own = 'endpoint' AND id AND secret)")
    return kept.groupBy("key").agg(F.collect_list(F.struct("start", "rank", "end", "kind")).alias("added"))


def _joined(spans: str) -> Column:
    return F.expr(f"array_join(transform(array_sort({spans}), x -> concat_ws(':', x.kind, x.start, x.end)), ',')")


def scan(docs: DataFrame) -> DataFrame:
    """All findings per document: ``doc_id, n_assign, n_access, n_hex,
    base_sha256, spans``.

    Offsets are code points, end exclusive.  Null and empty texts have no span
    (the digest of an empty string); repeated rows and null ids give a row each;
    an empty table gives none; extra columns are not read.
    """
    parts = cut(find_parts(docs), "secret-parts")
    linked = link_parts(parts)
    # texts without weak parts have no key and stay out of the join
    plain = parts.filter("key IS NULL").withColumn("added", F.expr(_NONE))
    joined = parts.filter("key IS NOT NULL").join(linked, "key", "left")
    both = plain.select("doc_id", "base", "added").unionByName(
        joined.select("doc_id", "base", F.coalesce("added", F.expr(_NONE)).alias("added")))
    count = {k: F.expr(f"cast(size(filter(base, x -> x.kind = '{k}')) as long)") for k in KINDS[:3]}
    return both.select(
        "doc_id", *[count[k].alias(f"n_{k}") for k in KINDS[:3]],
        F.sha2(_joined("base"), 256).alias("base_sha256"),
        _joined("concat(base, added)").alias("spans"))


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query 3 over ``documents``."""
    return scan(read_table(spark, sf_dir, "documents"))
