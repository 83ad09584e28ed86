"""Join helpers with an explicit size check before broadcasting."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickforge.session import checkpoint_root

# What a broadcast may hold: counted values, and what a row costs besides them.
BROADCAST_BYTES = 128 << 20
ROW_BYTES = 32


def value_bytes(value: Column, kind: T.DataType) -> Column:
    """Bytes of one value: texts and binaries by their length, arrays, maps and
    structs by what they hold, everything else by the size of its type."""
    if isinstance(kind, (T.StringType, T.BinaryType)):
        size = F.octet_length(value)
    elif isinstance(kind, T.StructType):
        size = F.lit(0)
        for f in kind.fields:
            size = size + value_bytes(value.getField(f.name), f.dataType)
    elif isinstance(kind, T.ArrayType):
        size = F.aggregate(F.transform(value, lambda x: value_bytes(x, kind.elementType)), F.lit(0).cast("bigint"), lambda a, x: a + x)
    elif isinstance(kind, T.MapType):
        size = value_bytes(F.map_keys(value), T.ArrayType(kind.keyType)) + value_bytes(F.map_values(value), T.ArrayType(kind.valueType))
    elif isinstance(kind, T.VariantType):
        size = F.octet_length(F.to_json(value))
    else:
        size = F.lit(16)
    return F.coalesce(size.cast("bigint"), F.lit(0).cast("bigint")) + 8


def measured(df: DataFrame) -> tuple[int, int]:
    """Rows and bytes of ``df``; the two numbers are all that reaches the driver."""
    size = F.lit(ROW_BYTES).cast("bigint")
    for f in df.schema.fields:
        size = size + value_bytes(F.col(f"`{f.name}`"), f.dataType)
    rows, total = df.agg(F.count(F.lit(1)), F.coalesce(F.sum(size), F.lit(0))).first()
    return rows, total


def written_small(small: DataFrame, max_rows: int, max_bytes: int) -> tuple[DataFrame, bool]:
    """``small`` checkpointed to the shared folder, and whether it is within both bounds."""
    checkpoint_root(small.sparkSession)  # fails on a cluster without a shared folder
    small = small.checkpoint(eager=True)
    rows, size = measured(small)
    return small, rows <= max_rows and size <= max_bytes


def join_small(
    big: DataFrame,
    small: DataFrame,
    on: list[str],
    how: str = "inner",
    max_rows: int = 2_000_000,
    max_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Join ``big`` with a side expected to be small.

    The small side is checkpointed to the shared checkpoint folder first
    (computed once, lineage cut, safe against lost executors), then its rows are
    counted and its bytes added up.  Within ``max_rows`` and ``max_bytes`` it is
    broadcast; beyond that the join is a normal shuffle join, where AQE's skew
    handling can split hot keys.
    """
    small, fits = written_small(small, max_rows, max_bytes)
    return big.join(F.broadcast(small) if fits else small, on=on, how=how)
