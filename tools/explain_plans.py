"""Print the formatted physical plans of representative operators.

    python tools/explain_plans.py [sf_dir]
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from tessera import attach, build_session  # noqa: E402
from tessera.fixtures import people  # noqa: E402
from tessera.functions import payloads  # noqa: E402
from tessera.operators import batches, means, tables  # noqa: E402
from tessera.schemas import PERSON  # noqa: E402
from tessera.session import scratch_path  # noqa: E402
from tessera.sources import delimited, json_tables  # noqa: E402


def show(title, df):
    print(f"\n===== {title} =====")
    print(df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted"))


def main(sf_dir: str) -> None:
    spark = attach(build_session())
    p = people(spark, sf_dir)
    csv = delimited.write_delimited(p, scratch_path(spark, "plans-csv"), files=4)
    arrow = scratch_path(spark, "plans-arrow")
    p.write.format("arrow_ipc").mode("overwrite").save(arrow)
    c = delimited.read_delimited(spark, csv, schema=PERSON)
    show("csv: mean of Wage where Lname = 'F'", means.both_means(c.where("Lname = 'F'"), "Wage"))
    a = spark.read.format("arrow_ipc").load(arrow)
    show("arrow: filtered projection", a.where("id > 100 AND Lname = 'F'").select("id", "Wage"))
    b = batches.fixed_size_batches(p, "id", 1000)
    show("fixed-size batches -> rows per batch", batches.batch_lengths(b))
    show("JSON rows documents per batch", json_tables.rows_documents(b, "id"))
    show("Arrow payloads per batch", payloads.encode_payloads(b, order_by="id"))
    show("column equality (union + group by key)", tables.columns_equal(c, p, "id", "Wage"))
    show("mean by chunks (scan splits)", batches.combine_partials(batches.chunk_partials(c, "Wage")))
    show("first rows (top-k)", tables.first_rows(p, "id", 5))
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01")
