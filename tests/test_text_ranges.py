from __future__ import annotations

import gzip
import os
import random
import zlib

import pytest
from pyspark.sql import types as T

from tessera.fixtures import people, table
from tessera.schemas import PERSON
from tessera.sources import delimited, text_ranges
from tests.conftest import SF_CHECK, SF_SMALL

PAIR = T.StructType([T.StructField("id", T.LongType()), T.StructField("t", T.StringType())])


def _put(path, data: bytes):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as f:
        f.write(data)
    return path


def _same(a, b):
    assert a.schema.names == b.schema.names
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def _csv(rows, escape, ends="\n"):
    """Every text quoted, by Python."""
    def quoted(t):
        return t.replace('"', '""') if escape == '"' else t.replace("\\", "\\\\").replace('"', '\\"')
    return "".join(f'{i},"{quoted(t)}"{ends}' for i, t in rows).encode()


def _texts(seed, n=300):
    rnd = random.Random(seed)
    pieces = ["a", "bc", "\n", "\n\n", '"', '""', ",", "\\", "\\\\", '\\"', "é", "\U0001f600", ' ,"x",\n7,"', " ", "\\" * 9]
    return [(i, "x" + "".join(rnd.choices(pieces, k=rnd.choice([0, 1, 3, 30, 400]))) + "x") for i in range(n)]


def test_one_gzip_file_is_read_by_many_tasks(spark, tmp_dir):
    p = people(spark, SF_CHECK)
    out = delimited.write_delimited(p, f"{tmp_dir}/one", compression="gzip", files=1)
    index = text_ranges.index_text(spark, out, f"{tmp_dir}/index", step=10_000)
    cuts = sorted(text_ranges.ranges(spark, index).collect(), key=lambda r: r["part"])
    # zlib's blocks of this text are larger than the step: one range a block.
    assert len(cuts) >= 3 and cuts[0]["text_start"] == 0
    assert all(a["text_end"] == b["text_start"] for a, b in zip(cuts, cuts[1:]))
    df = text_ranges.read_indexed(spark, index, PERSON)
    _same(df, p)
    assert df.rdd.getNumPartitions() == len(cuts)
    filled = df.rdd.glom().map(len).collect()
    assert sum(n > 0 for n in filled) == len(cuts)


@pytest.mark.parametrize("escape", ['"', "\\"])
@pytest.mark.parametrize("gz", [False, True])
@pytest.mark.parametrize("step", [7, 1000])
def test_quoted_ranges_equal_the_whole_read(spark, tmp_dir, escape, gz, step):
    rows = _texts(step, 12 if step < 1000 else 200)
    data = _csv(rows, escape)
    if gz:
        # Several members, an empty one, stored and packed blocks, many flushes.
        packed = b""
        for cut in range(0, len(data), max(1, len(data) // 3)):
            z = zlib.compressobj(cut % 7, zlib.DEFLATED, 31)
            piece = data[cut:cut + max(1, len(data) // 3)]
            for at in range(0, len(piece), 900):
                packed += z.compress(piece[at:at + 900]) + z.flush(zlib.Z_FULL_FLUSH if at % 1800 else zlib.Z_BLOCK)
            packed += z.flush()
        data = packed + gzip.compress(b"")
    path = _put(f"{tmp_dir}/in/q.csv" + (".gz" if gz else ""), data)
    step = max(step, len(data) // 40)                        # a task a range: 40 tasks
    index = text_ranges.index_text(spark, path, f"{tmp_dir}/index", step=step, quote='"', escape=escape)
    got = {r["id"]: r["t"] for r in text_ranges.read_indexed(spark, index, PAIR).collect()}
    assert got == dict(rows)


def test_states_inside_quotes_and_escapes(spark, tmp_dir):
    """A range of one byte each: every state is met."""
    data = b'1,"a\\"\nb\\\\"\n2,"\\\\\\"\n\\\\"\n'
    path = _put(f"{tmp_dir}/in/s.csv", data)
    index = text_ranges.index_text(spark, path, f"{tmp_dir}/index", step=1, quote='"', escape="\\")
    states = {r["part"]: (r["quoted"], r["pending"]) for r in spark.read.parquet(f"{index}/states").collect()}
    quoted = pending = False
    for i, c in enumerate(data):
        assert states[i] == (quoted, pending), i
        if c == 34 and not pending:
            quoted = not quoted
        pending = c == 92 and not pending
    got = {r["id"]: r["t"] for r in text_ranges.read_indexed(spark, index, PAIR).collect()}
    assert got == {1: 'a"\nb\\', 2: '\\"\n\\'}


def test_documents_as_one_quoted_file(spark, tmp_dir):
    docs = table(spark, SF_SMALL, "documents").select("doc_id", "text", "lang")
    for escape in ('"', "\\"):
        out = delimited.write_delimited(docs, f"{tmp_dir}/docs{ord(escape)}", compression=None, files=1, header=True,
                                        quote='"', escape=escape)
        whole = delimited.read_delimited(spark, out, schema=docs.schema, header=True, quote='"', escape=escape, multiline=True)
        index = text_ranges.index_text(spark, out, f"{tmp_dir}/ix{ord(escape)}", step=50_000, quote='"', escape=escape)
        df = text_ranges.read_indexed(spark, index, docs.schema, header=True)
        assert df.rdd.getNumPartitions() > 4
        _same(df, whole)


def test_line_ends_blank_lines_header_bom_and_no_last_line_end(spark, tmp_dir):
    _put(f"{tmp_dir}/in/a.csv", b"\xef\xbb\xbfid,t\r\n1,a\r\n\r\n\n2,\r\n3,c")
    _put(f"{tmp_dir}/in/b.csv.gz", gzip.compress(b"id,t\n4,d\n"))
    _put(f"{tmp_dir}/in/empty.csv", b"")
    _put(f"{tmp_dir}/in/empty.csv.gz", gzip.compress(b""))
    _put(f"{tmp_dir}/in/_SUCCESS", b"no text")
    for step in (1, 5, 1000):
        index = text_ranges.index_text(spark, f"{tmp_dir}/in", f"{tmp_dir}/index{step}", step=step)
        got = {r["id"]: r["t"] for r in text_ranges.read_indexed(spark, index, PAIR, header=True).collect()}
        assert got == {1: "a", 2: None, 3: "c", 4: "d"}, step
    os.makedirs(f"{tmp_dir}/none")
    index = text_ranges.index_text(spark, f"{tmp_dir}/none", f"{tmp_dir}/ix-none", quote='"')
    assert text_ranges.read_indexed(spark, index, PAIR).count() == 0


def test_long_record_spans_ranges(spark, tmp_dir):
    rnd = random.Random(5)
    rows = [(1, "a"), (2, "\n".join(rnd.randbytes(9).hex() for _ in range(150_000))), (3, "c")]
    path = _put(f"{tmp_dir}/in/l.csv.gz", gzip.compress(_csv(rows, '"')))
    index = text_ranges.index_text(spark, path, f"{tmp_dir}/index", step=500_000, quote='"')
    assert text_ranges.ranges(spark, index).count() > 3
    got = {r["id"]: r["t"] for r in text_ranges.read_indexed(spark, index, PAIR).collect()}
    assert got == dict(rows)


@pytest.mark.parametrize("text", [b'1,5" pipe\n2,x\n3,"y"\n', b'1,"a"b\n2,c\n', b'1,"open\n2,c\n'])
def test_misplaced_quotes_fail(spark, tmp_dir, text):
    path = _put(f"{tmp_dir}/in/m.csv", text)
    for step in (3, 1000):
        index = text_ranges.index_text(spark, path, f"{tmp_dir}/index{step}", step=step, quote='"')
        with pytest.raises(Exception, match="quote"):
            text_ranges.read_indexed(spark, index, PAIR).collect()


def test_damaged_changed_and_invalid_files_fail(spark, tmp_dir):
    data = bytearray(gzip.compress(b"1,a\n" * 1000))
    data[-6] ^= 1
    path = _put(f"{tmp_dir}/in/d.csv.gz", bytes(data))
    with pytest.raises(Exception, match="checksum"):
        text_ranges.index_text(spark, path, f"{tmp_dir}/index")
    path = _put(f"{tmp_dir}/in2/p.csv", b"1,a\n")
    index = text_ranges.index_text(spark, path, f"{tmp_dir}/index2")
    _put(path, b"1,a\n2,b\n")
    with pytest.raises(Exception, match="changed after"):
        text_ranges.read_indexed(spark, index, PAIR).collect()
    path = _put(f"{tmp_dir}/in3/u.csv", b"1,\xff\xfe\n")
    index = text_ranges.index_text(spark, path, f"{tmp_dir}/index3")
    with pytest.raises(Exception, match="UTF"):
        text_ranges.read_indexed(spark, index, PAIR).collect()
    with pytest.raises(ValueError):
        text_ranges.index_text(spark, path, f"{tmp_dir}/index4", quote="''")
    with pytest.raises(FileNotFoundError):
        text_ranges.index_text(spark, f"{tmp_dir}/absent", f"{tmp_dir}/index5")
