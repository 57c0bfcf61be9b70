"""Records of quoted CSV files, cut at any byte.

A quoted value may hold line ends, so a block of a file cannot tell by itself
whether its first line starts a record.  The quotes in front of it can: where
their number is odd, the block starts inside a value (a doubled quote inside a
value counts twice and changes nothing).

1. One scan counts the quotes of each block (one row a block).
2. Their running parity, file by file, gives the state in which each block
   starts.
3. A block that starts inside a value has the end of a record of an earlier
   block in front of its first unquoted line end: these heads are read from
   those blocks only.
4. Each block is cut at its unquoted line ends.  Its head is left out, and an
   open last record gets the heads that belong to it.

Steps 3 and 4 are left out where no line has an odd number of quotes: every
line is a record then.  Blocks are read in order by the tasks of the scan and
never shuffled; what moves is one row a block and the records that cross
blocks.

The blocks must be the same in every scan, also after executors were lost or
added, so they are read through a session of its own whose split size depends
on no cluster setting.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cashbook.session import scratch_dir

#: Bytes of a file that one task reads.
SPLIT_BYTES = 128 << 20
#: Blocks whose states are sent to all tasks (a path and four numbers each); more need larger blocks.
MOST_BLOCKS = 1 << 20
#: Bytes of record ends that are sent to all tasks; beyond, the records that cross blocks are joined by shuffle.
MOST_SENT = 64 << 20


def split_session(spark: SparkSession, split_bytes: int) -> SparkSession:
    """A session with the settings of ``spark`` that cuts files every ``split_bytes``."""
    session = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if key.startswith("spark.sql.") and spark.conf.isModifiable(key):
            session.conf.set(key, value)
    session.conf.set("spark.sql.files.maxPartitionBytes", str(split_bytes))
    session.conf.set("spark.sql.files.minPartitionNum", "1")
    session.conf.set("spark.sql.files.openCostInBytes", "0")
    return session


def _kept(df: DataFrame, tag: str) -> DataFrame:
    path = scratch_dir(df.sparkSession, tag)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _lines(session: SparkSession, path: str) -> DataFrame:
    """(value, file, block) of each line, in the order of the file inside a block."""
    return (session.read.option("lineSep", "\n").text(path)
            .select("value", F.col("_metadata.file_path").alias("file"),
                    F.col("_metadata.file_block_start").alias("block")))


def block_states(lines: DataFrame) -> DataFrame:
    """One row a block: file, block, slot (its number), inside and after (0 / 1: open value at its start and end), torn.

    ``torn``: some line of the block has an odd number of quotes.
    """
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    counts = lines.groupBy("file", "block").agg(F.sum(quotes).alias("quotes"), (F.max(quotes % 2) == 1).alias("torn"))
    upto = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    after = (F.sum("quotes").over(upto) % 2).cast("int")
    return counts.select(
        "file", "block", F.row_number().over(Window.orderBy("file", "block")).alias("slot"),
        ((after + F.col("quotes") % 2) % 2).cast("int").alias("inside"), after.alias("after"), "torn")


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int, pa.Array]]:
    """(slot, inside, lines) of runs of lines of one block; columns value, slot, inside."""
    for batch in batches:
        slot = batch.column(1).to_numpy(zero_copy_only=False)
        cuts = [0, *(np.flatnonzero(slot[1:] != slot[:-1]) + 1).tolist(), len(slot)]
        for lo, hi in zip(cuts, cuts[1:]):
            if hi > lo:
                yield int(slot[lo]), batch.column(2)[lo].as_py(), batch.column(0).slice(lo, hi - lo)


def _record_ends(lines: pa.Array, state: int) -> tuple[np.ndarray, int]:
    """Lines whose end is outside quotes, and the state after the last line."""
    quotes = pc.count_substring(lines, '"').to_numpy(zero_copy_only=False)
    open_ = (np.cumsum(quotes) + state) & 1
    return np.flatnonzero(open_ == 0), int(open_[-1])


def _text(parts: list[pa.Array]) -> str:
    return "\n".join(x for part in parts for x in part.to_pylist())


def _heads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(slot, head, closed): the lines of each block up to the first line end outside quotes."""
    now, state, parts, closed = None, 0, [], False

    def out():
        return pa.RecordBatch.from_arrays([pa.array([now], pa.int32()), pa.array([_text(parts)]), pa.array([closed])],
                                          names=["slot", "head", "closed"])
    for slot, inside, lines in _blocks(batches):
        if slot != now:
            if now is not None:
                yield out()
            now, state, parts, closed = slot, inside, [], False
        if not closed:
            ends, state = _record_ends(lines, state)
            closed = len(ends) > 0
            parts.append(lines.slice(0, int(ends[0]) + 1) if closed else lines)
    if now is not None:
        yield out()


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(record, slot): the records that start in each block; slot only where the record goes on in a later block."""
    now, state, pending, skip = None, 0, [], False

    def tail():
        return pa.RecordBatch.from_arrays([pa.array([_text(pending)]), pa.array([now], pa.int32())],
                                          names=["record", "slot"])

    def out(records: pa.Array):
        return pa.RecordBatch.from_arrays([records, pa.nulls(len(records), pa.int32())], names=["record", "slot"])

    for slot, inside, lines in _blocks(batches):
        if slot != now:
            if pending:
                yield tail()
            now, state, pending, skip = slot, inside, [], inside == 1
        ends, state = _record_ends(lines, state)
        if not len(ends):
            if not skip:
                pending.append(lines)
            continue
        first = int(ends[0]) + 1
        if skip:
            skip = False
        elif pending:
            yield out(pa.array([_text([*pending, lines.slice(0, first)])]))
        else:
            first = 0
        pending = []
        bounds = np.append(first, ends[ends >= first] + 1).astype(np.int32)
        if len(bounds) > 1:
            yield out(pc.binary_join(pa.ListArray.from_arrays(pa.array(bounds), lines), "\n"))
        if bounds[-1] < len(lines):
            pending.append(lines.slice(int(bounds[-1])))
    if pending:
        yield tail()


def csv_records(spark: SparkSession, path: str, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """Column ``record``: the records of the CSV files under ``path``, line ends inside quotes kept.

    A record ends at a line feed outside quotes; a carriage return in front
    of it goes.  Blank lines are records of their own.  A file that ends
    inside a quoted value is an error.
    """
    session = split_session(spark, split_bytes)
    lines = _lines(session, path)
    states = _kept(block_states(lines), "csv-blocks")
    seen = states.agg(F.count(F.lit(1)).alias("blocks"), F.max("torn").alias("torn")).first()
    record = F.regexp_replace("record", r"\r\z", "")
    if not seen["torn"]:
        return lines.select(F.col("value").alias("record")).select(record.alias("record"))
    if seen["blocks"] > MOST_BLOCKS:
        raise ValueError(f"{seen['blocks']} blocks under {path}: read them with larger split_bytes")
    last = states.groupBy("file").agg(F.max(F.struct("block", "after")).alias("last"))
    broken = last.filter("last.after = 1").first()
    if broken is not None:
        raise ValueError(f"{broken['file']} ends inside a quoted value")

    side = F.broadcast(states.select("file", "block", "slot", "inside"))
    heads = _kept(lines.join(F.broadcast(states.filter("inside = 1").select("file", "block", "slot", "inside")),
                             ["file", "block"]).select("value", "slot", "inside")
                  .mapInArrow(_heads, "slot int, head string, closed boolean"), "csv-heads")
    # a head belongs to the last block before it in which a record was opened and left open
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    opens = (F.col("after") == 1) & ((F.col("inside") == 0) | F.col("closed"))
    owner = (states.join(heads.select("slot", "closed"), "slot", "left")
             .select("slot", "inside", F.last(F.when(opens, F.col("slot")), ignorenulls=True).over(before).alias("owner"))
             .filter("inside = 1").drop("inside"))
    rest = _kept(heads.join(owner, "slot").groupBy("owner").agg(
        F.array_sort(F.collect_list(F.struct("slot", "head"))).alias("heads"))
        .select(F.col("owner").alias("slot"), F.array_join("heads.head", "\n").alias("rest")), "csv-rest")
    sent = rest.agg(F.sum(F.octet_length("rest")).alias("n")).first()["n"] or 0

    # a block that the first scan did not see would mean that the files have changed since
    state = F.when(F.col("slot").isNull(), F.raise_error(F.lit(f"the files under {path} have changed"))).otherwise(
        F.col("inside")).cast("int")
    cut = (lines.join(side, ["file", "block"], "left").select("value", "slot", state.alias("inside"))
           .mapInArrow(_records, "record string, slot int"))
    if sent <= MOST_SENT:
        whole = cut.join(F.broadcast(rest), "slot", "left")
    else:
        whole = (cut.filter("slot IS NULL").withColumn("rest", F.lit(None).cast("string"))
                 .unionByName(cut.filter("slot IS NOT NULL").join(rest, "slot", "left")))
    return (whole.select(F.when(F.col("rest").isNull(), F.col("record"))
                         .otherwise(F.concat("record", F.lit("\n"), "rest")).alias("record"))
            .select(record.alias("record")))
