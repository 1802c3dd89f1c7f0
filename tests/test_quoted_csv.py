"""CSV with quoted line breaks, read in splits of a few bytes, against Spark's reader of whole files and Python's."""

import csv
import io
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.sources import quoted_csv as q
from tallyhouse.sources.files import CORRUPT, read_csv
from tests.conftest import rows

SCHEMA = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("text", T.StringType()), T.StructField("day", T.DateType()), T.StructField("last", T.StringType())])
PIECES = ["plain", "with, comma", 'a "quoted" word', "two\nlines", "\n", "", "é\n\n日本\n", '"', '""', "\r\n", "x" * 300 + "\n" + "y" * 300, "a\tb "]


def write(path, values, seed, end="\n"):
    """Fields at random quoted or not where they may be either."""
    rng = random.Random(seed)

    def field(v):
        if v is None:
            return ""
        must = v == "" or any(c in v for c in ',"\n\r')
        return '"' + v.replace('"', '""') + '"' if must or rng.random() < 0.3 else v

    text = "id,text,day,last" + end + "".join(f"{i},{field(a)},{day or ''},{field(b)}{end}" for i, a, day, b in values)
    path.write_bytes(text.encode())


def values(n, seed):
    rng = random.Random(seed)
    return [(i, rng.choice([*PIECES, None]), rng.choice([None, "2024-02-29"]), rng.choice(PIECES) + str(i)) for i in range(n)]


@pytest.mark.parametrize(("split", "end"), [(64, "\n"), (700, "\r\n"), (1 << 20, "\n")])
def test_small_splits_read_what_the_whole_file_reader_reads(spark, setting, tmp_path, split, end):
    for name, n, seed in (("a.csv", 120, 1), ("b.csv", 7, 2), ("c.csv", 0, 3)):
        write(tmp_path / name, values(n, seed), seed, end)
    expected = rows(read_csv(spark, str(tmp_path), SCHEMA, multiline=True))
    setting("spark.sql.files.maxPartitionBytes", str(split))
    setting("spark.sql.files.openCostInBytes", "0")
    found = q.read_quoted_csv(spark, str(tmp_path), SCHEMA)
    # The reader of whole files makes the line breaks of a file with carriage returns alike.
    alike = [F.regexp_replace(c, "\r\n", "\n").alias(c) if c in ("text", "last") else F.col(c) for c in found.columns]
    assert rows(found.select(alike) if end == "\r\n" else found) == expected and len(expected) == 127
    plain = {v[0]: v for v in values(120, 1)}
    by_id = {r["id"]: r for r in found.where("last not like '%!'").collect() if r["id"] >= 7}
    assert all(by_id[i]["text"] == plain[i][1] and by_id[i]["last"] == plain[i][3] for i in by_id)
    if split < 1000:
        lines = q._lines(spark, str(tmp_path))
        assert lines.select("file", "start").distinct().count() > 10


def test_records_are_those_of_pythons_reader(spark, setting, tmp_path):
    path = tmp_path / "a.csv"
    write(path, values(200, 5), 5)
    setting("spark.sql.files.maxPartitionBytes", "100")
    setting("spark.sql.files.openCostInBytes", "0")
    found = [r["record"] for r in q.read_records(spark, str(path)).collect()]
    expected = list(csv.reader(io.StringIO(path.read_bytes().decode(), newline="")))
    assert sorted(next(csv.reader(io.StringIO(t, newline=""))) for t in found) == sorted(expected)


def test_malformed_records_are_kept_whole(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,text,day,last\n1,a,2024-01-01,z\n2,"b\nc"\n3,"d\ne",2024-13-01,z\nx,f,2024-01-01,z\n\n4,"open\nto the end')
    found = {r["id"]: r for r in q.read_quoted_csv(spark, str(tmp_path), SCHEMA).collect()}
    assert found[1][CORRUPT] is None
    assert found[2][CORRUPT] == '2,"b\nc"' and found[3][CORRUPT].startswith('3,"d\ne"') and found[None][CORRUPT].startswith("x,f")
    assert found[4][CORRUPT] is not None and len(found) == 5


def test_a_row_like_the_header_and_a_header_with_a_break(spark, setting, tmp_path):
    (tmp_path / "a.csv").write_text('id,"te\nxt",day,last\n1,a,,b\nid,"te\nxt",day,last\n')
    setting("spark.sql.files.maxPartitionBytes", "5")
    setting("spark.sql.files.openCostInBytes", "0")
    found = q.read_quoted_csv(spark, str(tmp_path), SCHEMA)
    assert sorted((r["id"] or 0, r["text"]) for r in found.collect()) == [(0, "te\nxt"), (1, "a")]


def test_a_quote_that_nothing_closes_is_an_error(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,text,day,last\n1,\"" + ("x" * 1000 + "\n") * 70_000)
    with pytest.raises(Exception, match="not closed within"):
        q.read_quoted_csv(spark, str(tmp_path), SCHEMA).agg(F.max("id"), F.max(CORRUPT)).collect()


def test_lines_are_put_together_without_a_loop_and_only_open_splits_are_read_for_pieces(spark, setting, tmp_path, monkeypatch):
    """Lines handed to Python one by one took most of the time of a file of many short quoted lines."""
    lines = pa.array(['1,"a', "b", 'c"', "2,d"] * 1000)
    n = len(lines)
    batch = pa.record_batch({"split": np.zeros(n, np.int64), "start": np.zeros(n, np.int64), "value": lines, "inside": np.zeros(n, bool)})
    calls = []
    monkeypatch.setattr(q, "_joined", lambda parts: calls.append(parts) or "")
    records = pa.Table.from_batches(q._records(iter([batch]), "p", pieces=False))
    assert records["record"].to_pylist() == ['1,"a\nb\nc"', "2,d"] * 1000 and not calls
    assert records["header"].to_pylist() == [True] + [False] * 1999
    assert not list(q._records(iter([batch]), "p", pieces=True)) and not calls


@pytest.mark.parametrize("size", [1, 2, 3, 7, 50])
def test_batches_may_end_anywhere(size):
    """Three splits of one file in batches of any size: whole records and pieces make up all records."""
    text = 'h,"x\ny"\n1,a\n2,"b\n\n""c""\nd"\n3,"e\nf\ng\nh"\n4,"i"\n5,"j\nk"'
    lines = text.split("\n")
    splits = np.array([0] * 5 + [1] * 3 + [2] * (len(lines) - 8))
    odd = np.cumsum([line.count('"') for line in lines]) % 2 == 1
    inside = {0: False, 1: bool(odd[4]), 2: bool(odd[7])}
    whole = pa.record_batch({"split": splits, "start": splits * 10, "value": pa.array(lines), "inside": pa.array([inside[s] for s in splits])})
    batches = [whole.slice(i, size) for i in range(0, len(lines), size)]
    records = [r for b in q._records(iter(batches), "p", pieces=False) for r in b.to_pylist()]
    pieces = [r for b in q._records(iter(batches), "p", pieces=True) for r in b.to_pylist()]
    joined, open_record = [], None
    for p in sorted(pieces, key=lambda p: (p["split"], not p["ends_here"])):
        open_record = p["record"] if p["begins_here"] else open_record + "\n" + p["record"]
        if p["ends_here"]:
            joined.append(open_record)
    expected = ['h,"x\ny"', "1,a", '2,"b\n\n""c""\nd"', '3,"e\nf\ng\nh"', '4,"i"', '5,"j\nk"']
    assert sorted([r["record"] for r in records] + joined) == sorted(expected) and joined
    assert [r["record"] for r in records if r["header"]] == ['h,"x\ny"'] and not any(p["header"] for p in pieces)
