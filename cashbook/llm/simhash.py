"""SimHash near-duplicates by deletion variants of the fingerprint's segments.

A 64-bit fingerprint is cut into three segments.  Of two fingerprints that
differ in at most four bits, one segment differs in at most one bit, so with
that bit left out the two are equal there.  Every distinct fingerprint is
therefore filed under 64 keys, one for each bit: its segment with that bit left
out.  Fingerprints under one key meet in a task and are compared on all bits.

Copies are collapsed to one fingerprint first.  A key with more than
``KEY_ROWS`` fingerprints is cut into blocks.  Links inside blocks give first
components; then, under these keys, only fingerprints of different components
are compared across blocks, and the largest component not with itself.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cashbook.llm.common import LOWER, NOT_SPACE, stored, text_slices, word_spans
from cashbook.llm.components import components

BITS = 64
#: First bit and number of bits of each segment.
SEGMENTS = [(0, 22), (22, 21), (43, 21)]
#: Differing bits at which fingerprints are linked: less than twice the segments.
MOST_BITS = 4
#: Fingerprints under one key that one task compares; longer lists are cut into blocks of this size.
KEY_ROWS = 4096
#: Lists up to this length are compared lag by lag over all lists at once, longer ones one by one.
SHORT = 32
#: Hot keys up to this many are sent to all tasks (two longs each); more are joined by shuffle.
BROADCAST_ROWS = 200_000


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _segment_mask(seg: int) -> int:
    first, size = SEGMENTS[seg]
    return ((1 << size) - 1) << first


#: For each bit, the segment it is in, without that bit.
SEGMENT_OF = [seg for seg, (_, size) in enumerate(SEGMENTS) for _ in range(size)]
VARIANT_MASK = [_signed(_segment_mask(SEGMENT_OF[bit]) & ~(1 << bit)) for bit in range(BITS)]


# ---------------------------------------------------------------- fingerprints

def _spaced(low: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[bytes, np.ndarray, np.ndarray]:
    """All words of a slice joined by single spaces, with their new starts and ends."""
    size = ends - starts
    end = np.cumsum(size + 1)
    out = np.full(int(end[-1]), 0x20, dtype=np.uint8)
    inside = np.ones(len(out), dtype=bool)
    inside[end - 1] = False
    out[inside] = low[NOT_SPACE[low]]
    return out.tobytes(), end - size - 1, end - 1


def _majority(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """For each run of hashes, the bits set in over half of them; 0 for an empty run."""
    n = np.diff(first)
    result = np.zeros(len(n), dtype=np.uint64)
    full = np.flatnonzero(n)
    if not len(full):
        return result
    # sums of one bit of each byte stay below 256 over runs of up to 255 hashes
    pieces = -(-n[full] // 255)
    owner = np.repeat(np.arange(len(full)), pieces)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    cuts = first[:-1][full][owner] + 255 * nth
    lanes = np.uint64(0x0101010101010101)
    sums = np.stack([np.add.reduceat((hashes >> np.uint64(j)) & lanes, cuts) for j in range(8)], axis=1)
    per_piece = sums.view(np.uint8).reshape(len(cuts), 8, 8).astype(np.int64)      # piece, bit in byte, byte
    totals = np.add.reduceat(per_piece, np.searchsorted(owner, np.arange(len(full))), axis=0)
    ones = 2 * totals > n[full][:, None, None]
    place = (8 * np.arange(8)[None, :] + np.arange(8)[:, None]).astype(np.uint64)
    result[full] = np.where(ones, np.uint64(1) << place, np.uint64(0)).reshape(len(full), 64).sum(
        axis=1, dtype=np.uint64)
    return result


def fingerprints(data: np.ndarray, offsets: np.ndarray, width: int) -> np.ndarray:
    """The fingerprint of each text of a slice."""
    low = LOWER[data]
    starts, ends, first = word_spans(low, offsets, NOT_SPACE)
    count = np.diff(first)
    if not len(starts):
        return np.zeros(len(count), dtype=np.uint64)
    buf, starts, ends = _spaced(low, starts, ends)
    n = np.where(count >= width, count - width + 1, (count > 0).astype(count.dtype))
    run = np.zeros(len(n) + 1, dtype=np.int64)
    np.cumsum(n, out=run[1:])
    text = np.repeat(np.arange(len(n)), n)
    begin = first[:-1][text] + np.arange(run[-1]) - run[:-1][text]
    last = np.minimum(begin + width, first[1:][text]) - 1
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(buf[s:e], 42) for s, e in zip(starts[begin].tolist(), ends[last].tolist())),
                         dtype=np.uint64, count=len(begin))
    return _majority(hashes, run)


def document_fingerprints(docs: DataFrame, width: int = 4) -> DataFrame:
    """(id, fp) of each row of (id, text); a text without words has fingerprint 0."""
    def run(batches):
        for batch in batches:
            for lo, hi, data, off in text_slices(batch, "text"):
                fp = fingerprints(data, off, width).view(np.int64)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), pa.array(fp)],
                                                 names=["id", "fp"])

    return docs.mapInArrow(run, f"id {docs.schema['id'].dataType.simpleString()}, fp long")


# ----------------------------------------------------------------------- links

def _variants(prints: DataFrame) -> DataFrame:
    """(bit, part, fp): the fingerprint's segment around each bit, with that bit left out."""
    masks = F.array(*[F.lit(m).cast("long") for m in VARIANT_MASK])
    rows = prints.select("*", F.explode(F.sequence(F.lit(0), F.lit(BITS - 1))).alias("bit"))
    return rows.withColumn("part", F.col("fp").bitwiseAND(F.element_at(masks, F.col("bit") + 1)))


def _hot_keys(prints: DataFrame) -> DataFrame:
    """(bit, part, rows) of the keys that hold more than ``KEY_ROWS`` fingerprints.

    Counted by whole segments, three rows a fingerprint: what a key holds is
    the segments with its bit 0 and with its bit 1.
    """
    masks = F.array(*[F.lit(_signed(_segment_mask(seg))).cast("long") for seg in range(len(SEGMENTS))])
    seg = F.explode(F.sequence(F.lit(0), F.lit(len(SEGMENTS) - 1))).alias("seg")
    held = (prints.select("fp", seg).withColumn("value", F.col("fp").bitwiseAND(F.element_at(masks, F.col("seg") + 1)))
            .groupBy("seg", "value").agg(F.count(F.lit(1)).alias("rows")))
    # one of the two segments of such a key holds over half of it
    many = stored(held, "simhash-segments")
    big = many.filter(F.col("rows") > KEY_ROWS // 2)
    bits = F.array(*[F.array(*[F.lit(b) for b in range(first, first + size)]) for first, size in SEGMENTS])
    powers = F.array(*[F.lit(_signed(1 << b)).cast("long") for b in range(BITS)])
    near = big.select("seg", "value", F.col("rows").alias("own"),
                      F.explode(F.element_at(bits, F.col("seg") + 1)).alias("bit"))
    near = near.withColumn("value", F.col("value").bitwiseXOR(F.element_at(powers, F.col("bit") + 1)))
    both = near.join(many, ["seg", "value"], "left")
    masks64 = F.array(*[F.lit(m).cast("long") for m in VARIANT_MASK])
    return (both.select("bit", F.col("value").bitwiseAND(F.element_at(masks64, F.col("bit") + 1)).alias("part"),
                        (F.col("own") + F.coalesce("rows", F.lit(0))).alias("rows"))
            .filter(F.col("rows") > KEY_ROWS).distinct())


def _few(table: DataFrame) -> DataFrame:
    return F.broadcast(table) if table.count() <= BROADCAST_ROWS else table


def _met(key: np.ndarray, cut: np.ndarray, fp: np.ndarray, side: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """Linked pairs under equal keys that span what is linked there.

    With ``side``, only rows of different sides are compared.  Short lists
    give all their linked pairs, long ones a forest grown row by row.
    """
    a, b = [], []
    size = np.diff(cut)
    rows = np.flatnonzero(np.repeat(size <= SHORT, size))
    lag = 1
    while len(rows):
        rows = rows[rows + lag < len(key)]
        rows = rows[key[rows] == key[rows + lag]]
        near = np.bitwise_count(fp[rows] ^ fp[rows + lag]) <= MOST_BITS
        if side is not None:
            near &= side[rows] != side[rows + lag]
        a.append(rows[near]), b.append(rows[near] + lag)
        lag += 1
    for i in np.flatnonzero(size > SHORT):
        left = np.arange(cut[i], cut[i + 1])
        todo: list[int] = []
        while len(left):
            at = todo.pop() if todo else int(left[0])
            if at == left[0]:
                left = left[1:]
            near = np.bitwise_count(fp[left] ^ fp[at]) <= MOST_BITS
            if side is not None:
                near &= side[left] != side[at]
            found = left[near]
            if len(found):
                a.append(np.full(len(found), at)), b.append(found)
                todo.extend(found.tolist())
                left = left[~near]
    none = np.zeros(0, dtype=np.int64)
    return np.concatenate([none, *a]), np.concatenate([none, *b])


def _links(dealt: DataFrame, sided: bool) -> DataFrame:
    """(a, b): links among rows (key, fp[, side]) of equal key."""
    def run(batches):
        held = None

        def out(t: pa.Table):
            key = t.column("key").to_numpy()
            fp = t.column("fp").to_numpy().view(np.uint64)
            side = t.column("side").to_numpy() if sided else None
            cut = np.concatenate([[0], np.flatnonzero(key[1:] != key[:-1]) + 1, [len(key)]])
            a, b = _met(key, cut, fp, side)
            pairs = np.unique(np.stack([np.minimum(fp[a], fp[b]), np.maximum(fp[a], fp[b])], axis=1), axis=0)
            return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0].view(np.int64)), pa.array(pairs[:, 1].view(np.int64))],
                                              names=["a", "b"])
        for batch in batches:
            t = pa.Table.from_batches([batch])
            held = t if held is None else pa.concat_tables([held, t])
            key = held.column("key").to_numpy()
            end = int(np.searchsorted(key, key[-1])) if len(key) else 0      # the last list may go on
            if end and len(key) >= 1 << 17:
                yield out(held.slice(0, end).combine_chunks())
                held = held.slice(end)
        if held is not None and len(held):
            yield out(held.combine_chunks())

    return (dealt.repartition("key").sortWithinPartitions("key").mapInArrow(run, "a long, b long")
            .filter("a <> b").distinct())


def _across(filed: DataFrame, label: DataFrame) -> DataFrame:
    """Links under hot keys between fingerprints of different components so far.

    The rows of a key's largest component meet the others, block by block, and
    the others meet each other.
    """
    rows = stored(filed.join(label.withColumnRenamed("node", "fp"), "fp", "left")
                  .select("bit", "part", "fp", F.coalesce("label", "fp").alias("side")), "simhash-hot")
    sizes = rows.groupBy("bit", "part", "side").agg(F.count(F.lit(1)).alias("rows"))
    keys = (sizes.groupBy("bit", "part").agg(F.max(F.struct("rows", "side")).alias("top"), F.sum("rows").alias("all"))
            .select("bit", "part", F.col("top.side").alias("largest"),
                    F.ceil(F.col("top.rows") / KEY_ROWS).cast("int").alias("n_top"),
                    (F.col("all") - F.col("top.rows")).alias("others"))
            .filter("others > 0").withColumn("n_other", F.ceil(F.col("others") / KEY_ROWS).cast("int")))
    rows = rows.join(keys, ["bit", "part"])
    top = F.col("side") == F.col("largest")
    rows = rows.withColumn("own", F.pmod(F.xxhash64("fp"), F.when(top, F.col("n_top")).otherwise(F.col("n_other"))))
    other = F.sequence(F.lit(0), F.col("n_other") - 1)
    with_top = F.transform(F.sequence(F.lit(0), F.col("n_top") - 1),
                           lambda j: F.struct(F.lit(0).alias("kind"), j.cast("long").alias("x"), F.col("own").alias("y")))
    with_others = F.transform(other, lambda j: F.struct(
        F.lit(1).alias("kind"), F.least(j.cast("long"), F.col("own")).alias("x"),
        F.greatest(j.cast("long"), F.col("own")).alias("y")))
    of_top = F.transform(other, lambda j: F.struct(F.lit(0).alias("kind"), F.col("own").alias("x"),
                                                   j.cast("long").alias("y")))
    meets = rows.select("bit", "part", "fp", "side", F.explode(
        F.when(top, of_top).otherwise(F.concat(with_top, with_others))).alias("at"))
    return _links(meets.select(F.xxhash64("bit", "part", "at.kind", "at.x", "at.y").alias("key"), "fp", "side"), True)


def fingerprint_components(prints: DataFrame) -> DataFrame:
    """(node, label) of linked distinct fingerprints (column fp); unlinked ones are left out."""
    hot = stored(_hot_keys(prints), "simhash-keys")
    n_hot = hot.count()
    filed = _variants(prints)
    if not n_hot:
        return components(_links(filed.select(F.xxhash64("bit", "part").alias("key"), "fp"), False))
    marked = filed.join(F.broadcast(hot) if n_hot <= BROADCAST_ROWS else hot, ["bit", "part"], "left")
    block = F.when(F.col("rows").isNotNull(), F.pmod(F.xxhash64("fp"), F.ceil(F.col("rows") / KEY_ROWS)))
    links = stored(_links(marked.select(F.xxhash64("bit", "part", block).alias("key"), "fp"), False), "simhash-links")
    label = components(links)
    more = _across(filed.join(_few(hot).drop("rows"), ["bit", "part"]), label)
    return components(links.unionByName(more))


def simhash_components(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 4) -> DataFrame:
    """One row per input row: doc_id, fingerprint (16 hex digits), component_id.

    The fingerprint has a bit set where over half of the XXH64 values (seed
    42) of the text's ``width``-word shingles have it; A-Z lower-cased, words
    split at space and tab to carriage return, shingles joined by one space
    and counted as often as they occur; with fewer words the whole sequence is
    the one shingle.  Null, empty and blank texts have fingerprint 0 and are
    linked like any other.  Rows are linked when their fingerprints differ in
    at most four bits; ``component_id`` is the smallest id reachable by links,
    itself included.  Null ids take part and are never the smallest unless all
    are null.  Repeated rows share their component.  An empty table gives an
    empty result.  Other columns are not read.
    """
    docs = df.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    rows = stored(document_fingerprints(docs, width), "simhash-rows")
    prints = stored(rows.groupBy("fp").agg(F.min("id").alias("low")), "simhash-prints")
    label = fingerprint_components(prints.select("fp")).withColumnRenamed("node", "fp")
    placed = stored(prints.join(label, "fp", "left").select("fp", "low", F.coalesce("label", "fp").alias("label")),
                    "simhash-placed")
    least = placed.groupBy("label").agg(F.min("low").alias("component_id"))
    final = stored(placed.join(least, "label").select("fp", "component_id"), "simhash-final")
    return rows.join(final, "fp").select(F.col("id").alias("doc_id"),
                                         F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
