"""URL filter on a sorted digest array.

Rules are (verdict, host, path). A rule fits its host and every subdomain of
it when the url's path starts with the rule's path; the longest rule wins
(host and path together; ties: the longer host).

The compiled rules are three NumPy files: the sorted 64-bit xxhash keys of
the rule hosts, the sorted keys of ``host path`` and, beside each key, where
its full string lies. Executors fetch the files once (``SparkContext.addFile``
from the shared scratch folder) and memory-map them, so all Python workers
of a machine share one copy. A batch of urls is probed with ``searchsorted``
over all its host suffixes at once; a key that is found is confirmed against
the stored string, so a digest collision never decides.

Nulls, urls without ``://`` and empty urls have an empty host and path; an
empty path fits no rule whose path starts with ``/``. Without a rule the
verdict is ``default``. Repeated rules count once (the first given wins).
An empty table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

import io
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path
from ..sources.arrow_ipc import filesystem

#: Rules held by one compiled filter. The files are mapped, not loaded, but
#: they are built on the driver.
MAX_RULES = 20_000_000

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
HOST_FIELDS = "host string, path string"


def with_host_path(df: DataFrame, url: str) -> DataFrame:
    """Adds the columns ``host`` and ``path``, cut by SQL functions alone."""
    u = F.coalesce(F.col(url), F.lit(""))
    at = F.instr(u, "://")
    rest = F.when(at > 0, F.substr(u, at + 3)).otherwise(F.lit(""))
    before = F.regexp_extract(rest, r"(?s)^([^?#]*)", 1)
    host = F.regexp_extract(before, r"(?s)^([^/]*)", 1)
    return df.withColumns({
        "host": F.translate(host, _UPPER, _UPPER.lower()),
        "path": F.substr(before, F.length(host) + 1)})


def _digest(x: str) -> int:
    return xxhash.xxh64_intdigest(x.encode("utf-8", "surrogatepass"))


class DigestArray:
    """Sorted 64-bit digests with the strings they stand for."""

    def __init__(self, keys: np.ndarray, starts: np.ndarray, text: np.ndarray):
        self.keys, self.starts, self.text = keys, starts, text

    @staticmethod
    def build(strings: list[str], digest=_digest) -> "DigestArray":
        strings = sorted(strings, key=lambda s: (digest(s), s))
        raw = [s.encode("utf-8") for s in strings]
        return DigestArray(np.array([digest(s) for s in strings], dtype=np.uint64),
                           np.cumsum([0, *map(len, raw)], dtype=np.int64),
                           np.frombuffer(b"".join(raw) or b"\0", dtype=np.uint8))

    def string(self, i: int) -> str:
        return self.text[self.starts[i]:self.starts[i + 1]].tobytes().decode("utf-8")

    def find(self, strings: list[str], digest=_digest) -> np.ndarray:
        """Index of each string, -1 if absent. One vectorised binary search;
        equal digests are then walked until the string itself agrees."""
        out = np.full(len(strings), -1, dtype=np.int64)
        if not len(self.keys) or not strings:
            return out
        probe = np.fromiter((digest(s) for s in strings), dtype=np.uint64, count=len(strings))
        at = np.searchsorted(self.keys, probe)
        hit = np.flatnonzero(self.keys[np.minimum(at, len(self.keys) - 1)] == probe)
        for j in hit:
            i = int(at[j])
            while i < len(self.keys) and self.keys[i] == probe[j]:
                if self.string(i) == strings[j]:
                    out[j] = i
                    break
                i += 1
        return out


def compile_rules(rules: list[tuple[str, str, str]], digest=_digest) -> dict[str, np.ndarray]:
    """The arrays of a compiled filter. For every rule host the lengths of its
    paths are kept, so a url tries only path prefixes that exist."""
    if len(rules) > MAX_RULES:
        raise ValueError(f"more than {MAX_RULES} rules")
    verdicts: dict[str, str] = {}
    lengths: dict[str, set[int]] = {}
    for verdict, host, path in rules:
        if verdict not in ("block", "allow"):
            raise ValueError(f"verdict {verdict!r}")
        verdicts.setdefault(f"{host} {path}", verdict)
        lengths.setdefault(host, set()).add(len(path))
    hosts, full = DigestArray.build(list(lengths), digest), DigestArray.build(list(verdicts), digest)
    sizes = [sorted(lengths[hosts.string(i)], reverse=True) for i in range(len(lengths))]
    return {
        "host_keys": hosts.keys, "host_starts": hosts.starts, "host_text": hosts.text,
        "rule_keys": full.keys, "rule_starts": full.starts, "rule_text": full.text,
        "rule_block": np.array([verdicts[full.string(i)] == "block" for i in range(len(verdicts))]),
        "path_starts": np.cumsum([0, *map(len, sizes)], dtype=np.int64),
        "path_lengths": np.array([x for s in sizes for x in s] or [0], dtype=np.int64),
    }


def judge(hosts: list[str], paths: list[str], a: dict[str, np.ndarray],
          digest=_digest) -> tuple[list[str | None], list[bool | None]]:
    """(rule, blocked) of each url; None, None without a rule."""
    host_set = DigestArray(a["host_keys"], a["host_starts"], a["host_text"])
    rule_set = DigestArray(a["rule_keys"], a["rule_starts"], a["rule_text"])
    owner, suffix = [], []
    for i, h in enumerate(hosts):
        owner.append(i)
        suffix.append(h)
        for dot in re.finditer(r"\.", h):
            owner.append(i)
            suffix.append(h[dot.end():])
    found = host_set.find(suffix, digest)
    tries, whose = [], []
    for j in np.flatnonzero(found >= 0):
        k, path = int(found[j]), paths[owner[j]]
        for n in a["path_lengths"][a["path_starts"][k]:a["path_starts"][k + 1]]:
            if n <= len(path):
                tries.append(f"{suffix[j]} {path[:n]}")
                whose.append((owner[j], len(suffix[j]) + int(n), len(suffix[j])))
    rules: list[str | None] = [None] * len(hosts)
    blocked: list[bool | None] = [None] * len(hosts)
    best: list[tuple[int, int]] = [(-1, -1)] * len(hosts)
    for (i, n, h), r, key in zip(whose, rule_set.find(tries, digest), tries, strict=True):
        if r >= 0 and (n, h) > best[i]:
            best[i] = (n, h)
            rules[i] = key.replace(" ", "", 1)
            blocked[i] = bool(a["rule_block"][r])
    return rules, blocked


def _publish(spark, arrays: dict[str, np.ndarray]) -> list[str]:
    """Write the arrays under the shared scratch folder and hand them to every
    executor; returns the file names."""
    base = scratch_path(spark, "digests")
    tag = base.rsplit("-", 1)[1]
    fs, folder = filesystem(base)
    fs.create_dir(folder, recursive=True)
    names = []
    for name, values in arrays.items():
        buffer = io.BytesIO()
        np.save(buffer, values)
        file = f"{name}-{tag}.npy"
        with fs.open_output_stream(f"{folder}/{file}") as out:
            out.write(buffer.getvalue())
        spark.sparkContext.addFile(f"{base}/{file}")
        names.append(file)
    return names


def url_verdicts(df: DataFrame, rules: list[tuple[str, str, str]], id_col: str, url_col: str,
                 default: str = "allow") -> DataFrame:
    """One row per url: (id, host, path, rule, verdict)."""
    spark = df.sparkSession
    files = _publish(spark, compile_rules(rules))
    rows = with_host_path(df.select(F.col(id_col), F.col(url_col).cast("string").alias("__url")),
                          "__url").drop("__url")

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrays = {f.rsplit("-", 1)[0]: np.load(os.path.join(SparkFiles.getRootDirectory(), f), mmap_mode="r")
                  for f in files}
        for b in batches:
            rule, blocked = judge(b.column("host").to_pylist(), b.column("path").to_pylist(), arrays)
            verdict = [default if x is None else ("block" if x else "allow") for x in blocked]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column("host"), b.column("path"), pa.array(rule, pa.string()),
                 pa.array(verdict, pa.string())], names=[id_col, "host", "path", "rule", "verdict"])

    kind = rows.schema[id_col].dataType.simpleString()
    return rows.select(id_col, "host", "path").mapInArrow(
        probe, f"`{id_col}` {kind}, host string, path string, rule string, verdict string")
