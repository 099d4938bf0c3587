"""The package must work when the caller's working folder is not the repo:
planner and streaming-source processes on the driver and Python workers on
executors all import it."""

from __future__ import annotations

import os
import subprocess
import sys
import tempfile

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = r"""
import sys
sys.path.insert(0, {root!r})
from tessera import attach, build_session
from tessera.fixtures import people
from tessera.functions import payloads
from tessera.operators import batches
from tessera.schemas import PERSON
from tessera.session import scratch_path
from tessera.streaming import streams
spark = attach(build_session(master="local[2]"))
p = people(spark, "/root/testdata/sf0.001")
src = scratch_path(spark, "outside")
p.write.format("arrow_ipc").mode("overwrite").option("batch", "200").save(src)
assert spark.read.format("arrow_ipc").load(src).count() == 1500
out = streams.drain_aggregate(streams.rows_running_mean(streams.arrow_stream(spark, src), "Wage"),
                              scratch_path(spark, "o"), scratch_path(spark, "c")).first()
assert out["rows"] == 1500
enc = payloads.encode_payloads(batches.fixed_size_batches(p, "id", 500), order_by="id")
assert payloads.decode_payloads(enc, PERSON).count() == 1500
print("OK")
"""


def test_runs_from_another_folder():
    cwd = tempfile.mkdtemp(prefix="tessera-cwd-")
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    r = subprocess.run([sys.executable, "-c", SCRIPT.format(root=ROOT)], cwd=cwd, env=env,
                       capture_output=True, text=True, timeout=600)
    assert r.returncode == 0 and "OK" in r.stdout, r.stderr[-3000:]
