"""Groups from links, without emitting all pairs of a group.

``components`` joins links to connected groups.  ``link_buckets`` finds the
links among rows that share a bucket: first every bucket's members are tested
against one pivot (linear work, which joins large groups of near copies), then
whatever is still in different groups of one bucket is tested pair by pair.
Pairs inside a group that is already connected are never made.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickforge.llm.common import cut


# In the last round, members of a bucket that one task pairs with all others of it.
PART_ROWS = 128


def components(links: DataFrame) -> DataFrame:
    """``id, comp``: the smallest linked id, for every id in ``links`` (a, b).

    Minimum labels spread along the links and each label is replaced by its own
    label, so long chains shorten geometrically.  Every step is written to the
    shared folder; only one number a step comes to the driver.
    """
    edges = cut(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
                .filter("a <> b").distinct(), "link-edges")
    labels = cut(edges.groupBy(F.col("a").alias("id")).agg(F.least(F.min("b"), F.first("a")).alias("comp")), "labels")
    total = None
    while True:
        now = labels.agg(F.sum(F.col("comp").cast("decimal(38,0)"))).first()[0]
        if now == total or now is None:
            return labels
        total = now
        seen = edges.join(labels.withColumnRenamed("id", "b"), "b").groupBy(F.col("a").alias("id")) \
            .agg(F.min("comp").alias("low"))
        both = labels.join(seen, "id")
        # a label also learns what its members saw
        told = (both.select("id", F.least("comp", "low").alias("comp"))
                .unionByName(both.select(F.col("comp").alias("id"), F.col("low").alias("comp")))
                .groupBy("id").agg(F.min("comp").alias("comp")))
        told = cut(told, "labels")
        up = told.select(F.col("id").alias("comp"), F.col("comp").alias("up"))
        labels = cut(told.join(up, "comp", "left").select("id", F.least("comp", F.coalesce("up", "comp")).alias("comp")),
                     "labels")


def open_buckets(members: DataFrame) -> DataFrame:
    """The members of buckets that hold more than one group (column ``comp``)."""
    mixed = members.groupBy("bucket").agg(F.min("comp").alias("x"), F.max("comp").alias("y")).filter("x <> y")
    return members.join(mixed.select("bucket"), "bucket", "left_semi")


def link_buckets(members: DataFrame, near: Callable[[str, str], Column], check: Callable[[DataFrame], DataFrame], rounds: int = 2,
                 further: tuple[Callable[[DataFrame], DataFrame], Callable[[str, str], Column]] | None = None) -> DataFrame | None:
    """All links needed to connect what belongs together.

    ``members`` is ``bucket, id`` and further columns of the id (no id twice in a
    bucket); ``near(a, b)`` is a cheap necessary condition over the columns of
    two aliased sides; ``check`` keeps the linked ones of the pairs (a, b).
    The pivot of a bucket is the member in most buckets: in a family of near
    copies that is the text closest to all others.  ``further`` is for the last round, pair
    by pair: more columns by ``id`` of ids that are left, and a dearer necessary condition.
    """
    weight = members.groupBy("id").agg(F.count(F.lit(1)).alias("weight"))
    rows = cut(members.join(weight, "id"), "bucket-members")
    carried = [c for c in members.columns if c not in ("bucket", "id")]
    links: list[DataFrame] = []
    for _ in range(rounds):
        mixed = [F.min("comp").alias("low"), F.max("comp").alias("high")] if links else []
        pivots = rows.groupBy("bucket").agg(F.min(F.struct((-F.col("weight")).alias("w"), "id", *carried)).alias("y"), *mixed)
        if links:  # at first all members are groups of their own
            pivots = cut(pivots.filter("low <> high").select("bucket", "y"), "pivots")
            if pivots.isEmpty():
                return _union(links)
        # the pivot meets every member and leaves the bucket
        met = cut(rows.join(pivots, "bucket").filter("id <> y.id").select("bucket", F.struct("id", *carried).alias("x"), "y", "weight"), "bucket-met")
        pairs = met.filter(near("x", "y")).select(F.least("x.id", "y.id").alias("a"), F.greatest("x.id", "y.id").alias("b")).distinct()
        links.append(cut(check(pairs), "links"))
        groups = components(_union(links))
        rest = met.select("bucket", "x.*", "weight").join(groups, "id", "left")
        rows = cut(rest.withColumn("comp", F.coalesce("comp", "id")), "bucket-members")
    rows = cut(open_buckets(rows), "bucket-members")
    if rows.isEmpty():
        return _union(links)
    # the largest group of a bucket is never paired with itself
    size = rows.groupBy("bucket", "comp").agg(F.count(F.lit(1)).alias("n"))
    main = cut(size.groupBy("bucket").agg(F.max(F.struct("n", "comp")).alias("m")).select("bucket", F.col("m.comp").alias("main")), "bucket-main")
    # one side of a large bucket is cut into parts, which the other side meets one by one
    parts = size.groupBy("bucket").agg(F.ceil(F.sum("n") / PART_ROWS).cast("int").alias("parts"))
    rows = rows.join(main, "bucket").join(parts, "bucket")
    meet = near("x", "y")
    if further:
        columns, condition = further
        rows = rows.join(cut(columns(rows.select("id").distinct()), "bucket-columns"), "id")
        meet = meet & condition("x", "y")
    rows = cut(rows, "bucket-members")
    # few bytes make much work here, so the partitions are not merged by their size
    dealt = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), "bucket", "part"
    one = rows.filter("comp <> main").withColumn("part", F.expr("pmod(hash(id), parts)")).repartition(*dealt).alias("x")
    two = rows.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).repartition(*dealt).alias("y")
    pairs = one.join(two, (F.col("x.bucket") == F.col("y.bucket")) & (F.col("x.part") == F.col("y.part")) & (F.col("x.comp") != F.col("y.comp"))
                     & ((F.col("y.comp") == F.col("y.main")) | (F.col("x.id") < F.col("y.id"))) & meet)
    pairs = pairs.select(F.least("x.id", "y.id").alias("a"), F.greatest("x.id", "y.id").alias("b")).distinct()
    links.append(cut(check(pairs), "links"))
    return _union(links)


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
