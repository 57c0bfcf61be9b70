"""Runs that are taken up again, and the order of their copies."""
import heapq

import pytest

from cashbook.session import scratch_dir
from cashbook.sources import snapshot as S
from cashbook.sources.journal import RunJournal
from cashbook.sources.snapshot import FrameSource, SourceObject, largest_first, snapshot_sources
from cashbook.sources.tally import Total, tally_of
from cashbook.sources.warehouse import Warehouse


def counted_source(spark, tables, fail=()):
    """A source that counts the reads of its tables, and fails on some."""
    reads = []

    def frame(name):
        def read():
            reads.append(name)
            if name in fail:
                raise RuntimeError(f"{name} is gone")
            return spark.range(len(name) + 3)
        return read
    objects = {("s", n): SourceObject("r", frame(n), {"id": "bigint"}, size=z) for n, z in tables.items()}
    source = FrameSource(spark, "main", objects)
    source.columns = lambda schema, name: [("id", "bigint")]
    return source, reads


TABLES = {"a": 1, "bb": 50, "ccc": 20, "dddd": 5}


def test_a_run_is_taken_up_where_it_stopped(spark):
    wh = Warehouse(spark, scratch_dir(spark, "t-resume"), namespace="t_resume")
    source, reads = counted_source(spark, TABLES, fail=("dddd",))
    with pytest.raises(RuntimeError, match="dddd is gone"):
        snapshot_sources(spark, [source], wh, parallelism=1, retries=0, run="2024-05-01T03:00")
    assert reads == ["bb", "ccc", "dddd"]                             # two copied, then the end
    source, reads = counted_source(spark, TABLES)
    rep = snapshot_sources(spark, [source], wh, parallelism=1, run="2024-05-01T03:00")
    assert reads == ["dddd", "a"]                                     # only what was missing
    assert [c[1] for c in rep.copied] == sorted(TABLES)
    for n in TABLES:
        assert rep.totals[("s", n)] == tally_of(wh.table("s", n)) and rep.totals[("s", n)].rows == len(n) + 3
        assert rep.locations[("s", n)].endswith(wh.committed("s", n)[-1])
    # the run has ended: the next one, of whatever name, copies all
    source, reads = counted_source(spark, TABLES)
    snapshot_sources(spark, [source], wh, run="2024-05-01T03:00")
    assert sorted(reads) == sorted(TABLES)
    assert ("s", "a") in Warehouse(spark, wh.root, namespace="t_resume").attach()


def test_other_runs_and_replaced_tables_are_copied_again(spark):
    wh = Warehouse(spark, scratch_dir(spark, "t-resume2"), namespace="t_resume2")
    source, _ = counted_source(spark, TABLES, fail=("a",))
    with pytest.raises(RuntimeError):
        snapshot_sources(spark, [source], wh, parallelism=1, retries=0, run="one")
    wh.replace("s", "bb", spark.range(1))                             # someone else's version since
    source, reads = counted_source(spark, TABLES)
    snapshot_sources(spark, [source], wh, parallelism=1, run="one")
    assert reads == ["bb", "a"]
    source, reads = counted_source(spark, TABLES, fail=("a",))
    with pytest.raises(RuntimeError):
        snapshot_sources(spark, [source], wh, parallelism=1, retries=0, run="one")
    source, reads = counted_source(spark, TABLES)
    snapshot_sources(spark, [source], wh, parallelism=1, run="two")
    assert len(reads) == 4


def test_entries_are_whole_or_absent(spark):
    wh = Warehouse(spark, scratch_dir(spark, "t-journal"), namespace="t_journal")
    journal = RunJournal(wh, "r/1")
    assert journal.done() == {}
    location = wh.replace("s_x", "t_y", spark.range(2))
    journal.record("s_x", "t_y", "main", location, Total(2, "0" * 32))
    journal.record("s_x", "t_y", "main", location, Total(2, "1" * 32))
    journal.record("s.x", "go@ne", "main", "nowhere/v1", Total(2, "2" * 32))
    assert RunJournal(wh, "r/1").done() == {("s_x", "t_y"): ("main", location, Total(2, "1" * 32))}
    assert RunJournal(wh, "r").done() == {}
    journal.close()
    assert journal.done() == {}


def makespan(sizes, workers):
    ends = [0] * workers
    for size in sizes:
        heapq.heapreplace(ends, ends[0] + size)
    return max(ends)


def test_largest_first_shortens_the_run():
    sizes = [3, 2, 9, 1, 8, 2, 30, 4, 1, 7]
    order = largest_first(sizes, lambda s: s)
    assert order == sorted(sizes, reverse=True)
    assert makespan(order, 3) == 30 < makespan(sizes, 3)              # the largest alone is the bound
    for workers in (2, 4, 5):
        assert makespan(order, workers) <= (4 / 3) * max(30, sum(sizes) / workers)
    assert largest_first(["b", "a"], lambda s: 0) == ["b", "a"]       # unknown sizes keep their order


def test_copies_start_in_order_of_size(spark):
    wh = Warehouse(spark, scratch_dir(spark, "t-sizes"), namespace="t_sizes")
    source, reads = counted_source(spark, TABLES)
    rep = snapshot_sources(spark, [source], wh, parallelism=1)
    assert reads == ["bb", "ccc", "dddd", "a"] and [c[1] for c in rep.copied] == sorted(TABLES)


def test_file_source_lists_sizes(spark):
    root = scratch_dir(spark, "t-file-sizes")
    spark.range(10).coalesce(1).write.parquet(f"{root}/s/small")
    spark.range(100_000).coalesce(1).write.parquet(f"{root}/s/large")
    sizes = S.FileSource(spark, "f", root).sizes()
    assert sizes[("s", "large")] > sizes[("s", "small")] > 0
