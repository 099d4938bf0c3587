"""Delimited text in and out.

Access paths of the reference and their Spark form:

* whole file, names given       -> ``read_delimited(names=..., schema=...)``
* whole file, types inferred    -> ``read_delimited(infer=True)`` (+ widening)
* row scan, no inference        -> ``read_text_rows`` (all ``string``)
* row scan, some types given    -> ``read_partial_types``
* chunks                        -> ``chunks(df, n)`` tags each row with its chunk
* text held in a column         -> ``parse_delimited_column`` (``from_csv``)

Gzip input is not splittable: one file is read by one task. ``read_*`` take
``partitions`` to spread rows after a scan that has fewer splits than that;
writers produce one file per task (``min_files`` spreads a small table), so
the next reader has several splits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import ddl, widen_inferred

# Text forms used for zone-less timestamps and dates, both ways.
TIMESTAMP_TEXT = "yyyy-MM-dd HH:mm:ss[.SSSSSS]"
# Six fraction digits: Spark's precision, so text round trips lose nothing.
TIMESTAMP_TEXT_OUT = "yyyy-MM-dd HH:mm:ss.SSSSSS"
DATE_TEXT = "yyyy-MM-dd"


def _opts(sep=",", quote=None, escape=None, null_value=None, date_format=None,
          timestamp_format=None, header=False, mode=None, multiline=None, extra=None) -> dict:
    o = {"sep": sep, "header": str(bool(header)).lower()}
    if quote is not None:
        o["quote"] = quote
    if escape is not None:
        o["escape"] = escape
    if null_value is not None:
        o["nullValue"] = null_value
    if date_format is not None:
        o["dateFormat"] = date_format
    if timestamp_format is not None:
        o["timestampNTZFormat"] = timestamp_format
        o["timestampFormat"] = timestamp_format
    if mode is not None:
        o["mode"] = mode
    if multiline is not None:
        o["multiLine"] = str(bool(multiline)).lower()
    o.update(extra or {})
    return o


def write_delimited(df: DataFrame, path: str, *, sep: str = ",", header: bool = False,
                    compression: str | None = "gzip", null_value: str | None = None,
                    quote: str | None = None, escape: str | None = None,
                    date_format: str | None = None,
                    timestamp_format: str | None = TIMESTAMP_TEXT_OUT,
                    files: int | None = None, min_files: int | None = None,
                    mode: str = "overwrite", extra: dict | None = None) -> str:
    """Write ``df`` as delimited text (headerless by default, as the reference
    reads it). By default each write task writes one file, which keeps the
    write free of a shuffle. ``files`` forces that many files; ``min_files``
    only spreads a table with fewer partitions than that (it never gathers a
    large table into few files)."""
    out = df.repartition(files) if files else at_least(df, min_files)
    opts = _opts(sep, quote, escape, null_value, date_format, timestamp_format, header, extra=extra)
    # Spark's writer trims fields by default; text must come back unchanged.
    opts.setdefault("ignoreLeadingWhiteSpace", "false")
    opts.setdefault("ignoreTrailingWhiteSpace", "false")
    w = out.write.mode(mode).options(**opts)
    if compression:
        w = w.option("compression", compression)
    w.csv(path)
    return path


def at_least(df: DataFrame, n: int | None) -> DataFrame:
    """``df`` spread over ``n`` partitions if it has fewer, else unchanged."""
    if n and df.rdd.getNumPartitions() < n:
        return df.repartition(n)
    return df


def _spread(df: DataFrame, partitions: int | None) -> DataFrame:
    # Only a scan with fewer splits than asked (a few gzip files) is spread.
    return at_least(df, partitions)


def read_delimited(spark: SparkSession, path: str, *, names: list[str] | None = None,
                   schema: T.StructType | None = None, infer: bool = False,
                   sep: str = ",", header: bool = False, quote: str | None = None,
                   escape: str | None = None, null_value: str | None = None,
                   date_format: str | None = None, timestamp_format: str | None = TIMESTAMP_TEXT,
                   mode: str | None = None, multiline: bool | None = None,
                   partitions: int | None = None, extra: dict | None = None,
                   corrupt_column: str | None = None, sample: float | None = None) -> DataFrame:
    """Read delimited text.

    With ``schema`` the types are taken as given (no inference pass). With
    ``infer=True`` Spark infers types in an extra pass over the input; the
    result is widened to 64-bit integers and wall-clock timestamps, and the
    caller's ``names`` replace the generated ``_c0 ...``. ``mode`` decides
    what a bad row does: ``FAILFAST`` (the default), ``PERMISSIVE`` (nulls; the
    default with ``corrupt_column``, which keeps the raw line) or
    ``DROPMALFORMED``.

    Inference reads all of the input once more before the real read. At
    very large scale ``sample`` (a fraction) infers from a sample instead;
    a value the sample missed can then fail the read (``FAILFAST``) or turn
    into a null (``PERMISSIVE``), so the full pass stays the default.
    """
    mode = mode or ("PERMISSIVE" if corrupt_column is not None else "FAILFAST")
    opts = _opts(sep, quote, escape, null_value, date_format, timestamp_format, header, mode, multiline, extra)
    r = spark.read.options(**opts)
    if corrupt_column is not None:
        if schema is None:
            raise ValueError("corrupt_column needs an explicit schema")
        r = r.option("columnNameOfCorruptRecord", corrupt_column)
        schema = T.StructType([*schema.fields, T.StructField(corrupt_column, T.StringType(), True)])
    if schema is not None:
        df = r.schema(schema).csv(path)
    elif infer:
        if sample is not None:
            opts["samplingRatio"] = str(sample)
        df = widen_inferred(r.schema(_inferred(spark, opts, path)).csv(path))
    else:
        df = r.csv(path)
    if names is not None and schema is None:
        if len(names) != len(df.columns):
            raise ValueError(f"{len(names)} names for {len(df.columns)} columns")
        df = df.toDF(*names)
    return _spread(df, partitions)


def _inferred(spark: SparkSession, opts: dict, path: str) -> T.StructType:
    """The inferred schema, with zone-less timestamps: the text holds wall-clock
    values, so they are ``timestamp_ntz`` directly (no round trip through the
    session zone). A session of its own carries the setting, so other threads
    of the caller's never see it."""
    other = spark.newSession()
    for key in ("spark.sql.session.timeZone", "spark.sql.caseSensitive", "spark.sql.legacy.timeParserPolicy"):
        other.conf.set(key, spark.conf.get(key))
    other.conf.set("spark.sql.timestampType", "TIMESTAMP_NTZ")
    return other.read.options(**opts).option("inferSchema", "true").csv(path).schema


def text_schema(names: list[str]) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType(), True) for n in names])


def read_text_rows(spark: SparkSession, path: str, names: list[str], **kw) -> DataFrame:
    """Every column as text: no inference pass, nothing parsed but the fields."""
    return read_delimited(spark, path, schema=text_schema(names), **kw)


def read_partial_types(spark: SparkSession, path: str, names: list[str],
                       types: dict[str, T.DataType | str], **kw) -> DataFrame:
    """Only the named columns are parsed to the given types; the rest stay text.

    The cast runs in the scan's projection, so pruned columns are never cast.
    """
    df = read_text_rows(spark, path, names, **kw)
    unknown = set(types) - set(names)
    if unknown:
        raise ValueError(f"types given for unknown columns {sorted(unknown)}")
    return df.withColumns({c: F.col(c).cast(t) for c, t in types.items()})


def default_chunks(spark: SparkSession) -> int:
    """The default number of chunks: the parallelism, or 8 with only one slot."""
    n = int(spark.sparkContext.defaultParallelism)
    return 8 if n <= 1 else n


def chunks(df: DataFrame, n: int | None = None, name: str = "chunk") -> DataFrame:
    """Tag each row with the typed part (chunk) it belongs to.

    Without ``n`` the chunks are the scan's own splits: no data moves. With
    ``n`` the rows are dealt round robin into exactly ``n`` parts (one
    shuffle; round-robin repartition sorts rows locally first, so a retried
    task gets the same rows).
    """
    parts = df.repartition(n) if n else df
    return parts.withColumn(name, F.spark_partition_id())


def to_delimited_column(df: DataFrame, columns: list[str] | None = None, *, sep: str = ",",
                        timestamp_format: str = TIMESTAMP_TEXT_OUT, name: str = "line") -> Column:
    """One text line per row (``to_csv``); nulls become empty fields."""
    cols = columns or df.columns
    return F.to_csv(F.struct(*cols), {"sep": sep, "timestampNTZFormat": timestamp_format,
                                      "timestampFormat": timestamp_format}).alias(name)


def parse_delimited_column(text: Column | str, schema: T.StructType, *, sep: str = ",", escape: str = "\\",
                           timestamp_format: str = TIMESTAMP_TEXT, mode: str = "FAILFAST",
                           name: str = "row") -> Column:
    """Parse delimited text held in a column into a struct (``from_csv``)."""
    col = F.col(text) if isinstance(text, str) else text
    return F.from_csv(col, ddl(schema), {"sep": sep, "escape": escape, "timestampNTZFormat": timestamp_format,
                                         "timestampFormat": timestamp_format,
                                         "mode": mode}).alias(name)


def _record_pattern(escape: str) -> str:
    """A record: anything up to a line end, quoted parts (with their line ends)
    included. Possessive throughout, so a long text never backtracks."""
    inner = r'[^"]++|""' if escape == '"' else r'[^"\\]++|\\.|""'
    return rf"""(?s)(?:[^"\r\n]++|"(?:{inner})*+")++"""


def read_text_values(df: DataFrame, text: str, schema: T.StructType, *, keep: list[str] | None = None,
                     sep: str = ",", escape: str = "\\", timestamp_format: str = TIMESTAMP_TEXT,
                     mode: str = "FAILFAST") -> DataFrame:
    """The rows of whole delimited texts held one per value, with the columns
    ``keep``. Line ends within double quotes belong to the field; ``escape`` (a
    backslash or a second quote) stands before a quote within them. Blank lines,
    empty and null texts give no row."""
    keep = keep or []
    records = df.select(*keep, F.explode(F.regexp_extract_all(F.col(text), F.lit(_record_pattern(escape)), F.lit(0))).alias("__record"))
    parsed = records.select(*keep, parse_delimited_column("__record", schema, sep=sep, escape=escape,
                                                          timestamp_format=timestamp_format, mode=mode, name="__row"))
    return parsed.select(*keep, "__row.*")
