"""The ``people`` table derived from the driver's ``orders``.

No driver table has the reference's seven columns and ``orders`` has no
nulls, so the fixture derives them: every third key lacks ``Salary``, the
other two lack ``Wage``, and only finished orders carry a ``TermDate``.
The same definition runs as DuckDB SQL in the oracles (``PEOPLE_CTE``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .schemas import PERSON, PERSON_COLUMNS

# Fixed value: the fixture definition, shared verbatim by every oracle query.
PEOPLE_CTE = """WITH people AS (
  SELECT o_orderkey AS id, o_orderpriority AS Fname, o_orderstatus AS Lname,
         CASE WHEN o_orderkey % 3 <> 0 THEN CAST(floor(o_totalprice) AS BIGINT) END AS Salary,
         CASE WHEN o_orderkey % 3 = 0 THEN o_totalprice / 2080 END AS Wage,
         CAST(o_orderdate AS DATE) AS StartDate,
         CASE WHEN o_orderstatus = 'F' THEN o_orderdate + INTERVAL 400 DAY + INTERVAL 1 SECOND END AS TermDate
  FROM orders
)
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def people(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The seven-column people table; only four ``orders`` columns are read."""
    o = table(spark, sf_dir, "orders")
    key = F.col("o_orderkey")
    df = o.select(
        key.alias("id"),
        F.col("o_orderpriority").alias("Fname"),
        F.col("o_orderstatus").alias("Lname"),
        F.when(key % 3 != 0, F.floor("o_totalprice").cast("bigint")).alias("Salary"),
        F.when(key % 3 == 0, F.col("o_totalprice") / F.lit(2080.0)).alias("Wage"),
        F.col("o_orderdate").cast("date").alias("StartDate"),
        F.when(F.col("o_orderstatus") == "F",
               F.col("o_orderdate").cast("timestamp_ntz")
               + F.expr("INTERVAL 400 DAYS") + F.expr("INTERVAL 1 SECOND")).alias("TermDate"),
    )
    return df.select([F.col(c).cast(PERSON[c].dataType).alias(c) for c in PERSON_COLUMNS])


def people_sql(body: str) -> str:
    """An oracle query over the fixture: ``WITH people AS (...) <body>``."""
    return PEOPLE_CTE + body
