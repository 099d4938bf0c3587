"""The commit log of an Arrow dataset.

Tasks write data files under their final names; a file counts once a version
lists it. A version is one file, ``_versions/<number>.jsonl``, created whole or
not at all, so a writer that dies leaves the dataset as it was, and a reader keeps
to the version it planned with. The first line says what the version did; the
others name data files (size, rows, rows of each record batch in runs). Every
``FULL_EVERY``-th version and every overwrite lists the whole dataset, the others
only what they add; so a snapshot is read from at most that many files.

Two writers that want the same number: the second one's create fails, it reads
the new head and takes the next number. That needs a store that refuses to create
a name twice: local and network folders (hard links) and HDFS (rename) do. Where a
move overwrites (object storage), commit from one job at a time.

``_versions/feed`` repeats the added files in up to ``FEED_FILES`` small files a
version, for streams to discover. It follows from the versions: every commit and
every start of a stream first completes what a killed commit left out. An
overwrite drops the feed of the versions before it.

A folder without a log is a dataset of all its visible files; the first commit
takes them over as version 1.
"""

from __future__ import annotations

import json
import os
import time
import uuid
from collections.abc import Iterable

import pyarrow.fs as pafs

LOG = "_versions"
FULL_EVERY = 16
FEED_FILES = 1000


def _log_names(fs: pafs.FileSystem, folder: str) -> list[str]:
    found = fs.get_file_info(pafs.FileSelector(folder, allow_not_found=True))
    return sorted(f.base_name for f in found
                  if f.type == pafs.FileType.File and f.base_name.endswith(".jsonl") and f.base_name[0].isdigit())


def _create(fs: pafs.FileSystem, path: str, lines: Iterable[dict]) -> bool:
    """Create ``path`` with all of its lines, unless it exists."""
    folder, name = path.rsplit("/", 1)
    fs.create_dir(folder, recursive=True)
    draft = f"{folder}/.{name}-{uuid.uuid4().hex}"
    with fs.open_output_stream(draft) as out:
        for line in lines:
            out.write(json.dumps(line).encode() + b"\n")
    try:
        if isinstance(fs, pafs.LocalFileSystem):
            os.link(draft, path)
        elif fs.get_file_info(path).type != pafs.FileType.NotFound:
            return False
        else:
            fs.move(draft, path)
        return True
    except OSError:
        if fs.get_file_info(path).type == pafs.FileType.NotFound:
            raise
        return False
    finally:
        if fs.get_file_info(draft).type != pafs.FileType.NotFound:
            fs.delete_file(draft)


def _lines(fs: pafs.FileSystem, path: str) -> list[dict]:
    with fs.open_input_stream(path) as f:
        return [json.loads(line) for line in f.read().splitlines()]


def _name(base: str, version: int) -> str:
    return f"{base}/{LOG}/{version:020d}.jsonl"


def numbers(fs: pafs.FileSystem, base: str) -> list[int]:
    """The versions that can be read, ascending (empty: no log)."""
    return [int(n.split(".")[0]) for n in _log_names(fs, f"{base}/{LOG}")]


def header(fs: pafs.FileSystem, base: str, version: int) -> dict:
    with fs.open_input_stream(_name(base, version)) as f:
        return json.loads(f.read().split(b"\n", 1)[0])


def snapshot(fs: pafs.FileSystem, base: str, version: int | None = None) -> tuple[int, list[dict]] | None:
    """(version, data files in order) of the newest or the given version; None
    for a folder without a log."""
    known = numbers(fs, base)
    if not known:
        if version is not None:
            raise ValueError(f"{base} has no versions")
        return None
    at = known[-1] if version is None else version
    if at not in known:
        raise ValueError(f"{base} has no version {at} (oldest {known[0]}, newest {known[-1]})")
    parts = []
    for v in range(at, -1, -1):
        if v not in known:
            raise ValueError(f"version {at} of {base} needs version {v}, which has expired")
        head, *files = _lines(fs, _name(base, v))
        parts.append(files)
        if head["full"]:
            break
    return at, [f for files in reversed(parts) for f in files]


def commit(fs: pafs.FileSystem, base: str, files: list[dict], kind: str = "append", present: list[dict] | None = None,
           stream: str | None = None, batch: int | None = None) -> int | None:
    """Publish ``files`` as the next version and return its number; None if this
    micro-batch of the stream is in the log already. ``present``: the files of a
    folder that has no log yet."""
    while True:
        known = numbers(fs, base)
        if not known and present:
            _create(fs, _name(base, 1), [_head(1, "adopt", True, len(present), {}, 1), *present])
            continue
        last = header(fs, base, known[-1]) if known else {"version": 0, "streams": {}, "since": 1}
        if stream is not None and last["streams"].get(stream, -1) >= batch:
            return None
        version = last["version"] + 1
        replaces = kind == "overwrite" or not known
        full = replaces or version % FULL_EVERY == 0
        before = [] if replaces or not full else snapshot(fs, base, last["version"])[1]
        streams = last["streams"] | ({stream: batch} if stream is not None else {})
        head = _head(version, kind, full, len(files), streams, version if replaces else last["since"])
        if _create(fs, _name(base, version), [head, *before, *files]):
            complete_feed(fs, base)
            return version


def _head(version: int, kind: str, full: bool, added: int, streams: dict, since: int) -> dict:
    return {"version": version, "kind": kind, "full": full, "added": added, "streams": streams, "since": since,
            "committed_ms": int(time.time() * 1000)}


def complete_feed(fs: pafs.FileSystem, base: str) -> None:
    """Write what is missing of the feed, oldest version first (so a version with
    a whole feed has no gap before it), and drop what an overwrite replaced."""
    known = numbers(fs, base)
    if not known:
        return
    feed = f"{base}/{LOG}/feed"
    there: dict[int, int] = {}
    for n in _log_names(fs, feed):
        v = int(n.split("-")[0])
        there[v] = there.get(v, 0) + 1
    since = header(fs, base, known[-1])["since"]
    missing = []
    for v in reversed([k for k in known if k >= since]):
        head, *files = _lines(fs, _name(base, v))
        added = files[len(files) - head["added"]:]
        size = max(1, -(-len(added) // FEED_FILES))
        groups = [added[i:i + size] for i in range(0, len(added), size)]
        if groups and there.get(v, 0) == len(groups):
            break
        missing.append((v, groups))
    for v, groups in reversed(missing):
        for i, group in enumerate(groups):
            _create(fs, f"{feed}/{v:020d}-{i:04d}.jsonl", group)
    for n in _log_names(fs, feed):
        if int(n.split("-")[0]) < since:
            fs.delete_file(f"{feed}/{n}")


def feed_files(fs: pafs.FileSystem, base: str) -> int:
    """How many files the feed has."""
    return len(_log_names(fs, f"{base}/{LOG}/feed"))


def history(path: str) -> list[dict]:
    """What each readable version did, oldest first."""
    from .arrow_ipc import filesystem
    fs, base = filesystem(path)
    return [header(fs, base, v) for v in numbers(fs, base)]


def expire(path: str, keep: int = 1, min_age_hours: float = 24.0) -> int:
    """Forget all but the last ``keep`` versions and delete the data files that no
    remaining version names; returns how many. Versions and files younger than
    ``min_age_hours`` stay: a running job may be reading or writing them."""
    from .arrow_ipc import FILE_EXT, STREAM_EXT, filesystem
    fs, base = filesystem(path)
    known = numbers(fs, base)
    if not known:
        return 0
    before = time.time() - min_age_hours * 3600
    heads = {v: header(fs, base, v) for v in known}
    # A version was current until the next one came.
    old = [v for v, following in zip(known, known[1:]) if heads[following]["committed_ms"] / 1000 <= before]
    first = min([v for v in known if v not in old] + known[-max(1, keep):])
    while not heads[first]["full"]:
        first -= 1
    for v in known:
        if v < first:
            fs.delete_file(_name(base, v))
    named = {f["file"] for v in known if v >= first for f in _lines(fs, _name(base, v))[1:]}
    gone = [i.path for i in fs.get_file_info(pafs.FileSelector(base)) if i.type == pafs.FileType.File
            and i.base_name.endswith((FILE_EXT, STREAM_EXT)) and i.base_name not in named
            and i.mtime.timestamp() <= before]
    for p in gone:
        fs.delete_file(p)
    return len(gone)
