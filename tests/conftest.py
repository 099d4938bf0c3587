from __future__ import annotations

import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from tessera import attach
    from tessera.session import SESSION_DEFAULTS

    b = (SparkSession.builder.master("local[*]").appName("tessera-tests")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.ui.enabled", "false"))
    for k, v in SESSION_DEFAULTS.items():
        b = b.config(k, v)
    s = b.getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    attach(s)
    yield s


@pytest.fixture()
def tmp_dir():
    """A fresh folder per test (test data under /root/testdata is read-only)."""
    return tempfile.mkdtemp(prefix="tessera-test-")
