"""Landed API responses -> rows.

Responses are landed as rows of JSON text (one document per row, e.g. read
with ``spark.read.text`` or kept in Parquet beside the HTTP status).  Each
flattener parses with a declared schema (``from_json``), which is vectorised
JVM code, then explodes the nested array / map into rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import _parse_datatype_string

from tickforge.plans.scans import written

# Shapes of the three response kinds.
BAR_PAGE_SCHEMA = (
    "STRUCT<Data: ARRAY<STRUCT<time: BIGINT, open: DOUBLE, high: DOUBLE, low: DOUBLE, "
    "close: DOUBLE, volumefrom: DOUBLE, volumeto: DOUBLE>>, TimeFrom: BIGINT>"
)
COIN_LIST_SCHEMA = "STRUCT<Data: MAP<STRING, MAP<STRING, STRING>>>"
BAR_FIELDS = {"time": "bigint", "open": "double", "high": "double", "low": "double", "close": "double",
              "volumefrom": "double", "volumeto": "double"}
POINT_FIELDS = {"x": "bigint", "y": "double"}
CHART_SCHEMA = "STRUCT<values: ARRAY<STRUCT<x: BIGINT, y: DOUBLE>>>"
OK_STATUS = 200


def json_parse(body: Column | str, schema: str | None = None, strict: bool = True) -> Column:
    """JSON text -> nested value.

    With a schema: ``from_json``; without: ``parse_json`` to VARIANT.  Both fail
    the job on malformed text; ``strict=False`` gives NULL instead.
    """
    body = F.col(body) if isinstance(body, str) else body
    if schema:
        return F.from_json(body, schema, {"mode": "FAILFAST"} if strict else {})
    return F.parse_json(body) if strict else F.try_parse_json(body)


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """Landed JSON documents, one per file (as ``sink_json`` writes them):
    rows of (``path``, ``body``) plus any partition columns of the folders.

    Each file is one row (``wholetext``), so a document is never split; the
    files are spread over tasks by Spark's file listing.  The folders are listed
    once, by a few tasks with many folders each.
    """
    held = {
        # folder values are text as they are written: '007' stays '007'
        "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
        "spark.sql.sources.parallelPartitionDiscovery.parallelism": str(2 * spark.sparkContext.defaultParallelism),
    }
    before = {k: spark.conf.get(k) for k in held}
    for k, v in held.items():
        spark.conf.set(k, v)
    try:
        docs = spark.read.option("wholetext", True).option("basePath", path).text(path)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    names = [c for c in docs.columns if c != "value"]
    return docs.select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("body"), *names)


PACK_INDEX = "folder string, name string, pack int, offset long, length long"


def read_packed(spark: SparkSession, path: str, names: DataFrame | None = None) -> DataFrame:
    """Documents of ``sink_json_packed``: ``folder, name, body``; all, or those in ``names``
    (``folder, name``; each once).

    The index says where a document lies; packs are read as the bytes of one file each,
    and the wanted documents are cut out by their offsets, without parsing any other.
    """
    index = spark.read.schema(PACK_INDEX).parquet(f"{path}/index")
    if names is not None:
        index = index.join(names.select("folder", "name").distinct(), ["folder", "name"], "left_semi")
    wanted = index.groupBy("pack").agg(F.collect_list(F.struct("folder", "name", "offset", "length")).alias("docs"))
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").option("recursiveFileLookup", True).load(f"{path}/packs")
    files = files.select(F.regexp_extract("path", "/pack=([0-9]+)/", 1).try_cast("int").alias("pack"), "content")
    each = files.join(wanted, "pack").select("content", F.explode("docs").alias("d"))
    body = F.substring(F.col("content"), (F.col("d.offset") + 1).cast("int"), F.col("d.length").cast("int")).cast("string")
    return each.select("d.folder", "d.name", body.alias("body"))


def map_values(m: Column | str) -> Column:
    """The values of a keyed object, as an array."""
    return F.map_values(F.col(m) if isinstance(m, str) else m)


def explode_rows(df: DataFrame, nested: Column, keep: tuple[str, ...] | list[str]) -> DataFrame:
    """One row per element of ``nested`` (array of structs, or map), the
    ``keep`` columns carried along; empty and missing collections give no row.

    An outer generator plus a filter on the element position is used, not
    ``inline``/``explode``: for those Catalyst infers a ``size(x) > 0``
    filter below the generator, which would parse every JSON body a second
    time.
    """
    out = df.select(*keep, F.posexplode_outer(nested).alias("_pos", "_item"))
    return out.filter(F.col("_pos").isNotNull()).drop("_pos")


def parse_bar_pages(pages: DataFrame, body: str = "body") -> DataFrame:
    """Add ``Data`` and ``TimeFrom`` parsed from the page body; drop the text."""
    parsed = json_parse(body, BAR_PAGE_SCHEMA)
    return pages.withColumns(
        {"Data": parsed.getField("Data"), "TimeFrom": parsed.getField("TimeFrom")}
    ).drop(body)


def bar_data(body: Column | str = "body", schema: str = BAR_PAGE_SCHEMA) -> Column:
    """The ``Data`` array of a bar page.

    A page with status 200 whose body is no JSON of the schema, or has no
    ``Data``, fails the job; bodies of failed requests may be anything.
    """
    data = json_parse(body, schema, strict=False).getField("Data")
    missing = F.when(F.col("status") == OK_STATUS, F.raise_error(F.lit("bar page with status 200 but without Data")))
    return F.coalesce(data, missing)


def with_rest(rows: DataFrame, items: Column, known: dict[str, str], keep: tuple[str, ...] | list[str]) -> DataFrame:
    """One row per element of ``items`` (array of VARIANT objects): ``keep``, the ``known``
    fields by type, and ``rest`` - a VARIANT object of all other fields, NULL if there are none.

    A field that does not fit its type is NULL; an element that is no object has all
    fields NULL.  The body behind ``items`` is parsed once.
    """
    each = explode_rows(rows, items, keep)
    fields = F.col("_item").try_cast("map<string,variant>")
    other = F.map_filter(fields, lambda k, _: ~k.isin(*known))
    cols = [F.try_variant_get("_item", f"$.{name}", kind).alias(name) for name, kind in known.items()]
    return each.select(*keep, *cols, F.when(F.size(other) > 0, F.to_variant_object(other)).alias("rest"))


def _items(body: str, field: str, missing: Column) -> Column:
    """The array of objects ``field`` of a JSON body as VARIANTs; ``missing`` where there is none."""
    return F.coalesce(F.try_variant_get(F.try_parse_json(body), f"$.{field}", "array<variant>"), missing)


def flatten_bars(pages: DataFrame, keep: tuple[str, ...] = ("fsym", "tsym", "page_no"), rest: bool = False) -> DataFrame:
    """Bar pages -> one row per bar; non-200 and empty pages give no rows.

    ``rest`` keeps what the declared fields leave out: a VARIANT column with the other
    fields of each bar (``with_rest``).
    """
    ok = pages.filter(F.col("status") == OK_STATUS)
    if rest:
        missing = F.raise_error(F.lit("bar page with status 200 but without Data"))
        return with_rest(ok, _items("body", "Data", missing), BAR_FIELDS, keep)
    data = F.col("Data") if "Data" in ok.columns else bar_data()
    return explode_rows(ok, data, keep).select(*keep, "_item.*")


def coin_objects(docs: DataFrame, body: str = "body") -> DataFrame:
    """The coins of coin-list documents, one VARIANT (column ``coin``) per row.

    Each body is parsed once.  A body that is no JSON, names a key twice, or has no object
    ``Data`` fails the job: a coin list without coins is no answer.
    """
    found = F.try_variant_get(F.parse_json(body), "$.Data", "map<string,variant>")
    data = F.coalesce(found, F.raise_error(F.lit("coin-list document without Data")))
    return explode_rows(docs, map_values(data), []).withColumnRenamed("_item", "coin")


def field_names(objects: DataFrame, column: str = "coin") -> tuple[str, ...]:
    """The sorted field names of VARIANT objects: one merged schema, aggregated in the
    tasks, is all that reaches the driver - not the keys of every object."""
    # a value that is no object has no fields
    named = objects.filter(F.col(column).try_cast("map<string,variant>").isNotNull())
    merged = named.agg(F.schema_of_variant_agg(column)).first()[0]
    if merged is None or not merged.startswith("OBJECT<"):
        return ()
    return tuple(sorted(_parse_datatype_string(merged.replace("OBJECT<", "STRUCT<")).fieldNames()))


def flatten_coins(
    docs: DataFrame,
    fields: tuple[str, ...] | None = None,
    body: str = "body",
) -> DataFrame:
    """Coin-list documents (object keyed by symbol) -> one row per coin.

    All values are text, nested ones JSON text; fields a coin lacks are NULL.  With
    ``fields`` the result is lazy.  ``fields=None`` finds the names from the data: the
    coins are parsed once, written, and their schema is aggregated (``field_names``).
    """
    coins = coin_objects(docs, body)
    if fields is None:
        coins = written(coins, "coins")
        fields = field_names(coins)
    values = coins.select(F.col("coin").try_cast("map<string,variant>").alias("coin"))
    return values.select(*[F.col("coin").getItem(f).cast("string").alias(f) for f in fields])


def flatten_charts(docs: DataFrame, body: str = "body", rest: bool = False) -> DataFrame:
    """Chart documents -> (chart, x, y) rows; the chart name is kept.

    A document without ``values`` fails the job; an empty array gives no rows.  ``rest``
    adds a VARIANT column with the other fields of each point.
    """
    missing = F.raise_error(F.concat(F.lit("chart document without values: "), F.coalesce("chart", F.lit("null"))))
    if rest:
        return with_rest(docs, _items(body, "values", missing), POINT_FIELDS, ["chart"])
    points = F.coalesce(json_parse(body, CHART_SCHEMA).getField("values"), missing)
    return explode_rows(docs, points, ["chart"]).select("chart", "_item.*")
