from __future__ import annotations

import os
import time

import pytest

from tessera import clear_scratch, session


def test_only_old_scratch_folders_go(spark, tmp_dir, monkeypatch):
    monkeypatch.setattr(session, "checkpoint_root", lambda _: tmp_dir)
    assert clear_scratch(spark, 0) == []                     # no scratch folder yet
    old, fresh, mixed = (session.scratch_path(spark, x) for x in ("old", "fresh", "mixed"))
    for path in (old, fresh, mixed):
        spark.range(3).write.parquet(path)
    long_ago = time.time() - 10 * 3600
    for path in (old, mixed):
        for at, _, files in os.walk(path, topdown=False):
            for name in files:
                os.utime(f"{at}/{name}", (long_ago, long_ago))
            os.utime(at, (long_ago, long_ago))
    with open(f"{mixed}/late", "w") as f:
        f.write("still written")
    os.makedirs(f"{tmp_dir}/other")
    assert clear_scratch(spark, 5) == [os.path.basename(old)]
    assert not os.path.exists(old) and os.path.exists(f"{tmp_dir}/other")
    assert spark.read.parquet(fresh).count() == 3 and os.path.exists(f"{mixed}/late")
    assert clear_scratch(spark, 24) == []
    with pytest.raises(ValueError):
        clear_scratch(spark, -1)
