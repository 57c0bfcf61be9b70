"""Quoted CSV files read in blocks cut at any byte, against Python's csv module and the whole-file reader."""
import csv
import io
import random
from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cashbook.session import scratch_dir
from cashbook.sources import csv_split
from cashbook.sources.readers import read_csv_snapshot, write_csv_snapshot

SCHEMA = T.StructType([T.StructField("a b", T.StringType()), T.StructField("n", T.LongType()),
                       T.StructField("c", T.StringType())])


def dump(tmp_path, text, name="part.csv"):
    folder = tmp_path / "dump"
    folder.mkdir(exist_ok=True)
    (folder / name).write_bytes(text.encode())
    return str(folder)


def quoted(v):
    """As COPY ... CSV prints it."""
    if v is None:
        return ""
    if v == "" or any(x in v for x in ',"\n\r') or v != v.strip():
        return '"' + v.replace('"', '""') + '"'
    return v


def rows_of(n, seed=1):
    r = random.Random(seed)
    parts = ["x", "é", '"', '""', "\n", "\r\n", ",", " ", "\\", "\\N", "tab\t", "long " * 9, "\n\n", "日本"]
    return [("".join(r.choices(parts, k=r.randint(0, 7))) if r.random() < .9 else None, i,
             "".join(r.choices(parts, k=r.randint(0, 12))) if r.random() < .9 else None) for i in range(n)]


def text_of(rows, end="\n"):
    return "".join(",".join([quoted(a), str(n), quoted(c)]) + end for a, n, c in rows)


@pytest.mark.parametrize("split", [17, 300, 1 << 20, None])
def test_records_equal_what_was_written(spark, tmp_path, split):
    rows = rows_of(30)
    path = dump(tmp_path, text_of(rows))
    dump(tmp_path, text_of(rows_of(20, 2)), "other.csv")
    got = read_csv_snapshot(spark, path, SCHEMA, split_bytes=split)
    assert got.columns == ["a b", "n", "c"]
    assert Counter(map(tuple, got.collect())) == Counter(rows + rows_of(20, 2))


def test_value_that_fills_many_blocks(spark, tmp_path):
    rows = [("start", 1, None), ("line\n" * 400 + 'with "quotes"\n' * 50, 2, "after"), (None, 3, "x\ny"), ("z", 4, "")]
    got = read_csv_snapshot(spark, dump(tmp_path, text_of(rows)), SCHEMA, split_bytes=60)
    assert Counter(map(tuple, got.collect())) == Counter(rows)


def test_ends_of_records(spark, tmp_path):
    """Carriage returns outside quotes go, blank lines are no records, the last line end may be missing."""
    text = 'a,1,"x\r\ny"\r\n\nb,2,\r\n"q ""\n",3,last'
    got = read_csv_snapshot(spark, dump(tmp_path, text), SCHEMA, split_bytes=5)
    assert Counter(map(tuple, got.collect())) == Counter(
        [("a", 1, "x\r\ny"), ("b", 2, None), ('q "\n', 3, "last")])


def test_unfinished_value_is_an_error(spark, tmp_path):
    with pytest.raises(ValueError, match="ends inside a quoted value"):
        read_csv_snapshot(spark, dump(tmp_path, 'a,1,x\nb,2,"open\nc,3,y\n' * 3), SCHEMA, split_bytes=4)


def test_large_record_ends_are_joined_by_shuffle(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(csv_split, "MOST_SENT", 0)
    rows = rows_of(80, 5)
    got = read_csv_snapshot(spark, dump(tmp_path, text_of(rows)), SCHEMA, split_bytes=90)
    assert Counter(map(tuple, got.collect())) == Counter(rows)


def test_one_column_and_empty_files(spark, tmp_path):
    values = [None, "", "plain", 'with "quotes"', "two\nlines", "a,b", " edge ", None, "x" * 300]
    one = T.StructType([T.StructField("v", T.StringType())])
    path = scratch_dir(spark, "one")
    write_csv_snapshot(spark.createDataFrame([(v,) for v in values], "v string").coalesce(1), path)
    got = [r.v for r in read_csv_snapshot(spark, path, one, split_bytes=10).collect()]
    assert Counter(got) == Counter(values)
    assert read_csv_snapshot(spark, dump(tmp_path, ""), SCHEMA, split_bytes=10).count() == 0


def test_same_fields_as_the_whole_file_reader(spark, tmp_path):
    """Spellings that only the parser decides: both readers must agree."""
    text = 'ab,1,c\n"",2,""\n\\N,3,\\\n  x ,4,"  y "\n"a""b",5,"c\\"\n'
    path = dump(tmp_path, text)
    whole = read_csv_snapshot(spark, path, SCHEMA).collect()
    split = read_csv_snapshot(spark, path, SCHEMA, split_bytes=6).collect()
    assert Counter(map(tuple, split)) == Counter(map(tuple, whole))


def test_several_tasks_read_one_file(spark, tmp_path):
    rows = rows_of(400, 9)
    path = dump(tmp_path, text_of(rows))
    size = len(text_of(rows).encode())
    records = csv_split.csv_records(spark, path, size // 6)
    tasks = records.select(F.spark_partition_id().alias("p")).groupBy("p").count().collect()
    assert len(tasks) >= 6 and sum(t["count"] for t in tasks) == len(rows)
    plan = records._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan and "Exchange SinglePartition" not in plan


def test_blocks_do_not_depend_on_the_session(spark, tmp_path):
    """Another number of cores or split size of the session between scans changes nothing."""
    rows = rows_of(100, 3)
    got = read_csv_snapshot(spark, dump(tmp_path, text_of(rows)), SCHEMA, split_bytes=100)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "33")
        assert Counter(map(tuple, got.collect())) == Counter(rows)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_no_task_writes_the_whole_dump(spark, monkeypatch):
    """The query's dump has a file for each task that reads the table, and the snapshot all of its rows."""
    import __spark_entry__ as E
    rows, folders, write = rows_of(40, 6), [], E.write_csv_snapshot
    docs = spark.createDataFrame(rows, "a string, n long, c string").repartition(4)

    def dumped(df, path, **options):
        folders.append(Path(path))
        write(df, path, **options)
    monkeypatch.setattr(E, "read_table", lambda *a, **k: docs)
    monkeypatch.setattr(E, "write_csv_snapshot", dumped)
    got = E.q_snapshot_csv_split(spark, "anywhere")
    assert len(list(folders[0].glob("part-*.csv"))) == 4
    assert Counter(map(tuple, got.collect())) == Counter(rows)


def test_python_csv_agrees(tmp_path):
    """The quoting of these tests is standard CSV."""
    rows = [r for r in rows_of(60, 4) if r[0] is not None and r[2] is not None]
    read = list(csv.reader(io.StringIO(text_of(rows), newline="")))
    assert [(a, int(n), c) for a, n, c in read] == rows
