"""Tables as JSON documents, in both layouts.

* rows layout    ``[{"id":1,"Fname":"a",...}, ...]``   (array of objects)
* columns layout ``{"id":[1,...],"Fname":["a",...]}``  (object of arrays)

A whole table in one JSON value does not scale (one value per task, 2 GB
cap), so documents are made per batch or per key: ``to_*_documents`` take a
batch column (see ``operators.batches.fixed_size_batches``) and give one
document per batch. Rows are collected as whole structs **once**: collecting
single columns would drop nulls and shift columns against each other.

Null fields are written (``ignoreNullFields=false``) so a missing value
survives the trip back; decoding takes a record type (``StructType``), or
infers one from files, in which case dates stay text as JSON has no date.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import nullable

# Text forms of dates and zone-less timestamps inside JSON.
# Six fraction digits: Spark's precision (its default keeps milliseconds only).
TIMESTAMP_TEXT_OUT = "yyyy-MM-dd HH:mm:ss.SSSSSS"
TIMESTAMP_TEXT_IN = "yyyy-MM-dd[ HH:mm:ss[.SSSSSS]][['T'HH:mm:ss[.SSSSSS]]]"
WRITE_OPTIONS = {"ignoreNullFields": "false", "timestampNTZFormat": TIMESTAMP_TEXT_OUT,
                 "dateFormat": "yyyy-MM-dd"}
READ_OPTIONS = {"timestampNTZFormat": TIMESTAMP_TEXT_IN, "dateFormat": "yyyy-MM-dd"}

ROWS, COLUMNS = "rows", "columns"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _records(df: DataFrame, batch: str | list[str], order_by: str, columns: list[str]) -> DataFrame:
    """(batch..., records): each batch's rows as structs sorted by ``order_by``.

    ``array_sort`` compares struct fields left to right, so the key goes first
    for sorting; the caller's column order is restored by the writers.
    """
    fields = [order_by] + [c for c in columns if c != order_by]
    keys = [batch] if isinstance(batch, str) else list(batch)
    return df.groupBy(*keys).agg(
        F.array_sort(F.collect_list(F.struct(*fields))).alias("__recs"))


# Folder key of documents that are written one per file.
FOLDER = "__document"


def _field(name: str):
    # A one-argument lambda: ``transform`` reads a second parameter as the index.
    return lambda r: r[name]


def _columns_of(df: DataFrame, batch: str | list[str], columns: list[str] | None) -> list[str]:
    keys = [batch] if isinstance(batch, str) else list(batch)
    return columns or [c for c in df.columns if c not in keys]


def _rows_text(cols: list[str], pretty: bool = False) -> Column:
    ordered = F.transform("__recs", lambda r: F.struct(*[r[c].alias(c) for c in cols]))
    return F.to_json(ordered, {**WRITE_OPTIONS, **({"pretty": "true"} if pretty else {})})


def _columns_text(cols: list[str], pretty: bool = False) -> Column:
    """Each column array is taken from the same sorted records, so positions
    line up."""
    obj = F.struct(*[F.transform("__recs", _field(c)).alias(c) for c in cols])
    return F.to_json(obj, {**WRITE_OPTIONS, **({"pretty": "true"} if pretty else {})})


def rows_documents(df: DataFrame, order_by: str, batch: str | list[str] = "batch",
                   columns: list[str] | None = None, pretty: bool = False,
                   name: str = "json") -> DataFrame:
    """One array-of-objects document per batch: (batch, json)."""
    return mixed_documents(df, order_by, F.lit(True), batch, columns, pretty, name)


def columns_documents(df: DataFrame, order_by: str, batch: str | list[str] = "batch",
                      columns: list[str] | None = None, pretty: bool = False,
                      name: str = "json") -> DataFrame:
    """One object-of-arrays document per batch: (batch, json)."""
    return mixed_documents(df, order_by, F.lit(False), batch, columns, pretty, name)


def mixed_documents(df: DataFrame, order_by: str, by_rows: Column, batch: str | list[str] = "batch",
                    columns: list[str] | None = None, pretty: bool = False, name: str = "json") -> DataFrame:
    """One document per batch, (batch, json): laid out by rows where ``by_rows``
    (over the batch columns) holds, else by columns. Records are collected once."""
    keys = [batch] if isinstance(batch, str) else list(batch)
    cols = _columns_of(df, batch, columns)
    text = F.when(by_rows, _rows_text(cols, pretty)).otherwise(_columns_text(cols, pretty))
    return _records(df, batch, order_by, cols).select(*keys, text.alias(name))


def key_batches(df: DataFrame, key: str, order_by: str, max_rows: int,
                name: str = "doc") -> DataFrame:
    """Tag rows for documents per key: document ``i`` of a key holds its rows
    ``i * max_rows`` onwards in (key, order) order, so a key of at most
    ``max_rows`` rows is one document.

    Positions are global, so a hot key is never gathered: a key's first
    position is a window within a part, and only keys that span parts (fewer
    than there are parts) are looked up.
    """
    from pyspark.sql import Window

    from ..operators.batches import row_numbers
    numbered = row_numbers(df, [key, order_by], "__rn", keep_part="__in")
    firsts = numbered.groupBy(F.col(key).alias("__key"), "__in").agg(F.min("__rn").alias("__rn0"))
    spanning = (firsts.groupBy("__key").agg(F.min("__rn0").alias("__start"), F.count(F.lit(1)).alias("__parts"))
                .where("__parts > 1").drop("__parts"))
    local = F.min("__rn").over(Window.partitionBy("__in", key))
    return (numbered.withColumn("__first", local)
            .join(F.broadcast(spanning), F.col(key).eqNullSafe(F.col("__key")), "left")
            .withColumn(name, F.floor((F.col("__rn") - F.coalesce("__start", "__first")) / int(max_rows)).cast("bigint"))
            .drop("__rn", "__in", "__first", "__start", "__key"))


def key_documents(df: DataFrame, key: str, order_by: str, max_rows: int,
                  layout: str = ROWS, pretty: bool = False, name: str = "json") -> DataFrame:
    """Documents per key, at most ``max_rows`` rows each: (key, doc, json).
    The key stays in every record, so decoded rows are complete."""
    tagged = key_batches(df, key, order_by, max_rows)
    make = rows_documents if layout == ROWS else columns_documents
    return make(tagged, order_by, batch=[key, "doc"], columns=df.columns, pretty=pretty, name=name)


def pretty(text: Column | str, schema: T.DataType) -> Column:
    """Indented JSON for a document of the given type."""
    return F.to_json(F.from_json(_col(text), schema, READ_OPTIONS), {**WRITE_OPTIONS, "pretty": "true"})


def layout(text: Column | str) -> Column:
    """'rows' for an array, 'columns' for an object, an error for anything else.

    Only the first non-blank character is looked at."""
    first = F.regexp_extract(_col(text), r"^\s*(\S)", 1)
    return (F.when(first == "[", F.lit(ROWS))
            .when(first == "{", F.lit(COLUMNS))
            .otherwise(F.raise_error(F.concat(
                F.lit("JSON table must be an array of objects or an object of arrays, found: "),
                F.substring(F.ltrim(_col(text)), 1, 20)))))


def columns_schema(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, T.ArrayType(f.dataType, True), True)
                         for f in schema.fields])


def _opts(mode: str) -> dict:
    return {**READ_OPTIONS, "mode": mode}


def rows_records(text: Column | str, schema: T.StructType, mode: str = "FAILFAST") -> Column:
    """array<record> from an array-of-objects document."""
    return F.from_json(_col(text), T.ArrayType(schema, True), _opts(mode))


def parse_columns(text: Column | str, schema: T.StructType, mode: str = "FAILFAST") -> Column:
    """struct<array,...> from an object-of-arrays document."""
    return F.from_json(_col(text), columns_schema(schema), _opts(mode))


def zip_columns(parsed: Column, schema: T.StructType) -> Column:
    """array<record> from a parsed object of arrays; unequal column lengths
    (or a missing column) fail the job rather than pad with nulls."""
    sizes = [F.coalesce(F.size(parsed[f.name]), F.lit(-1)) for f in schema.fields]
    ragged = F.lit(False)
    for s in sizes[1:]:
        ragged = ragged | (s != sizes[0])
    zipped = F.arrays_zip(*[parsed[f.name] for f in schema.fields]).cast(
        T.ArrayType(nullable(schema), True))
    return F.when(ragged, F.raise_error(F.concat(
        F.lit("columns of unequal length in JSON object of arrays: "),
        F.concat_ws(",", *[s.cast("string") for s in sizes])))).otherwise(zipped)


def columns_records(text: Column | str, schema: T.StructType, mode: str = "FAILFAST") -> Column:
    """array<record> from an object-of-arrays document, as one expression.

    Inside a generator the parse would be repeated per use; ``read_columns``
    parses once in a projection first."""
    return zip_columns(parse_columns(text, schema, mode), schema)


def read_rows(docs: DataFrame, text: str, schema: T.StructType, mode: str = "FAILFAST",
              keep: list[str] | None = None) -> DataFrame:
    return docs.select(*(keep or []), F.inline(rows_records(text, schema, mode)))


def read_columns(docs: DataFrame, text: str, schema: T.StructType, mode: str = "FAILFAST",
                 keep: list[str] | None = None) -> DataFrame:
    keep = keep or []
    parsed = docs.select(*keep, parse_columns(text, schema, mode).alias("__cols"))
    return parsed.select(*keep, F.inline(zip_columns(F.col("__cols"), schema)))


def read_auto(docs: DataFrame, text: str, schema: T.StructType, mode: str = "FAILFAST",
              keep: list[str] | None = None) -> DataFrame:
    """Either layout through one entry point: each document is routed by its
    first character and parsed once, by the parser of its layout (one scan,
    no union)."""
    keep = keep or []
    lay = layout(text)
    routed = docs.select(*keep, lay.alias("__layout"), _col(text).alias("__text")).select(
        *keep,
        F.when(F.col("__layout") == ROWS, rows_records("__text", schema, mode)).alias("__rows"),
        F.when(F.col("__layout") == COLUMNS, parse_columns("__text", schema, mode)).alias("__cols"))
    recs = F.coalesce(F.col("__rows"), zip_columns(F.col("__cols"), schema))
    return routed.select(*keep, F.inline(recs))


def write_documents(docs: DataFrame, path: str, text: str = "json", batch: str = "batch",
                    mode: str = "overwrite", one_per_file: bool = False) -> str:
    """Write documents as text.

    By default one document per line in ordinary text files: Spark's JSON
    reader turns a top-level array on a line into its rows, so the files
    stay splittable and any number of documents fit in a file. Indented
    (multi-line) documents need ``one_per_file=True``: one file per document
    (``batch=<n>/part-*.txt``), read back with ``multiline=True``.
    """
    if one_per_file:
        docs.select(F.col(batch).alias(FOLDER), text).write.mode(mode).partitionBy(FOLDER).text(path)
    else:
        docs.select(text).write.mode(mode).text(path)
    return path


def read_documents_inferred(spark: SparkSession, path: str, names: list[str] | None = None,
                            multiline: bool = False) -> DataFrame:
    """Read JSON files with inferred types: numbers and strings are typed,
    dates stay text. Spark sorts inferred names, so the caller's order is
    restored."""
    df = spark.read.option("multiLine", str(multiline).lower()).json(path)
    cols = names or [c for c in df.columns if c != FOLDER]
    return df.select(*cols)


def read_documents_typed(spark: SparkSession, path: str, schema: T.StructType,
                         mode: str = "FAILFAST", multiline: bool = False,
                         corrupt_column: str | None = None) -> DataFrame:
    """Read JSON files straight into a record type. ``FAILFAST`` (default)
    raises on a value of the wrong type; ``PERMISSIVE`` with
    ``corrupt_column`` keeps the raw text of bad records there."""
    r = spark.read.options(**_opts(mode)).option("multiLine", str(multiline).lower())
    if corrupt_column is not None:
        r = r.option("columnNameOfCorruptRecord", corrupt_column)
        schema = T.StructType([*schema.fields, T.StructField(corrupt_column, T.StringType(), True)])
    return r.schema(schema).json(path)


def layout_sizes(df: DataFrame, order_by: str, batch: str = "batch") -> DataFrame:
    """Bytes of JSON text per layout for the same rows: (layout, documents, bytes)."""
    cols = _columns_of(df, batch, None)
    sizes = _records(df, batch, order_by, cols).select(
        F.octet_length(_rows_text(cols)).alias("r"), F.octet_length(_columns_text(cols)).alias("c"))
    total = sizes.agg(F.count(F.lit(1)).alias("n"), F.sum("r").cast("bigint").alias("r"), F.sum("c").cast("bigint").alias("c"))
    return total.where("n > 0").select(F.inline(F.array(*[
        F.struct(F.lit(x).alias("layout"), F.col("n").alias("documents"), F.col(v).alias("bytes"))
        for x, v in ((ROWS, "r"), (COLUMNS, "c"))])))
