"""Exact dedup over an extendible-hash index, in DataFrame operations only.

1. The distinct hash keys of the normalised texts are counted.  A directory
   over their leading bits is doubled while a bucket holds more keys than its
   capacity (``split_directory``); buckets are key ranges.
2. Rows are routed through the directory.  They are collapsed by (bucket, key,
   bytes) in ``SALTS`` parts of each group first, so a group of copies of any
   size sends a few entries, then every bucket's entries go to its owner task.
3. The owner settles its key range: entries of one key are chained, their
   bytes compared, and the parts of each text put together.  The entries are
   the index, written to the shared folder.
4. Each row looks its entry up by key.  Only where a chain holds several
   texts are the bytes themselves compared again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cashbook.llm.common import SPACES, stored

#: Histogram bits read per pass while the directory is doubled.
STEP_BITS = 8
#: Parts in which the rows of one text are collapsed before they go to the owner of their bucket.
SALTS = 16


def _prefix(bits: int):
    return F.shiftrightunsigned("key", 64 - bits).cast("long") if bits else F.lit(0).cast("long")


def split_directory(entries: DataFrame, capacity: int, max_bits: int = 24) -> tuple[int, list[int]]:
    """Directory (depth, bucket per leading-bits value) so that no bucket exceeds ``capacity``.

    Starts with one bucket; an overfull bucket is split on its next bit, and
    the directory doubles when the bucket already uses all its bits.  Counts
    come from histograms of ``STEP_BITS`` more bits over the overfull prefixes
    only.  A bucket of one single key cannot be split: it stays, chained; so
    does one at ``max_bits``.
    """
    counts: dict[tuple[int, int], tuple[int, bool]] = {}

    def histogram(bits: int, inside: list[int] | None):
        rows = entries
        if inside is not None:
            rows = rows.filter(_prefix(bits - STEP_BITS).isin(inside))
        got = (rows.groupBy(_prefix(bits).alias("p"))
               .agg(F.count(F.lit(1)).alias("n"), F.min("key").alias("lo"), F.max("key").alias("hi")).collect())
        for r in got:
            counts[(bits, r.p)] = (r.n, r.lo == r.hi)
        for b in range(bits - 1, bits - STEP_BITS - 1, -1):
            below: dict[int, list] = {}
            for (bb, p), v in counts.items():
                if bb == b + 1:
                    below.setdefault(p >> 1, []).append(v)
            for p, v in below.items():
                counts.setdefault((b, p), (sum(x[0] for x in v), len(v) == 1 and v[0][1]))

    depth, leaves = 0, [(0, 0)]
    histogram(STEP_BITS, None)
    known = STEP_BITS
    while True:
        over = [(b, p) for b, p in leaves
                if counts.get((b, p), (0, True))[0] > capacity and not counts[(b, p)][1] and b < max_bits]
        if not over:
            break
        deepest = [p for b, p in over if b == known]
        if deepest:
            known += STEP_BITS
            histogram(known, deepest)
        for b, p in over:
            leaves.remove((b, p))
            leaves += [(b + 1, 2 * p), (b + 1, 2 * p + 1)]
            depth = max(depth, b + 1)           # the directory doubles
    directory = [0] * (1 << depth)
    for bucket, (b, p) in enumerate(sorted(leaves, key=lambda x: x[1] << (depth - x[0]))):
        for i in range(p << (depth - b), (p + 1) << (depth - b)):
            directory[i] = bucket
    return depth, directory


def _rows(df: DataFrame, id_col: str, text_col: str, key_bits: int) -> DataFrame:
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = df.select(F.col(id_col).alias("id"), F.char_length(text).alias("points"),
                     F.translate(text, SPACES, "").alias("norm"))
    key = F.xxhash64("norm")
    if key_bits < 64:                            # tests: force chains
        key = F.shiftleft(F.shiftrightunsigned(key, 64 - key_bits), 64 - key_bits)
    return rows.withColumn("key", key)


def _best():
    """First: most code points, then smallest id, null ids last."""
    return F.min(F.struct((-F.col("points")).alias("neg"), F.col("id").isNull().alias("noid"),
                          F.col("id").alias("id"))).alias("best")


def exact_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                bucket_rows: int | None = None, key_bits: int = 64) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256, bucket.

    Texts are equal when they agree after deleting space and tab to carriage
    return; a null text counts as empty, so null, empty and blank texts form
    one group.  The row with the most code points stays, then the smallest
    id, null ids last.  Of rows that agree in id and in their number of code
    points, one stays.  An empty table gives an empty result.  Other columns
    are not read.

    ``bucket_rows``: capacity of an index bucket; by default so large that
    the directory has some thousands of buckets, 2048 entries at least.
    """
    rows = _rows(df, id_col, text_col, key_bits)
    keys = stored(rows.groupBy("key").agg(F.count(F.lit(1)).alias("rows")), "dedup-keys")
    depth, directory = split_directory(keys, bucket_rows or max(2048, keys.count() // 2048))
    bucket = F.element_at(F.lit(directory), (_prefix(depth) + 1).cast("int"))
    sent = (rows.groupBy(bucket.alias("bucket"), "key", "norm", F.pmod(F.xxhash64("id"), F.lit(SALTS)).alias("salt"))
            .agg(F.count(F.lit(1)).alias("n"), _best()).repartition("bucket"))
    # inside the owner task of the bucket: no further exchange
    settled = sent.groupBy("bucket", "key", "norm").agg(F.sum("n").alias("n"), F.min("best").alias("best"))
    index = stored(settled.select("bucket", "key", F.sha2("norm", 256).alias("sha"), "n", "best")
                   .sortWithinPartitions("bucket", "key"), "dedup-index")
    chained = index.groupBy("bucket", "key").agg(F.count(F.lit(1)).alias("texts"))
    several = chained.filter("texts > 1").select("key")

    same = rows.groupBy("id", "key", "points").agg(F.count(F.lit(1)).alias("times"))
    if several.isEmpty():
        found = same.join(index, "key")
    else:
        single = same.join(several, "key", "left_anti").join(index, "key")
        texts = rows.join(several, "key", "left_semi")
        entry = texts.groupBy("key", "norm").agg(F.count(F.lit(1)).alias("n"), _best())
        compared = (texts.groupBy("id", "key", "points", "norm").agg(F.count(F.lit(1)).alias("times"))
                    .join(entry, ["key", "norm"])
                    .select("key", "id", "points", "times", F.sha2("norm", 256).alias("sha"), "n", "best")
                    .withColumn("bucket", bucket))
        found = single.select("key", "id", "points", "times", "sha", "n", "best", "bucket").unionByName(compared)
    copy = F.explode(F.sequence(F.lit(1), F.col("times").cast("int")))
    first = (F.col("id").eqNullSafe(F.col("best.id"))) & (F.col("points") == -F.col("best.neg"))
    return (found.select("*", copy.alias("copy"))
            .select(F.col("id").alias("doc_id"), F.col("best.id").alias("keep_id"),
                    F.col("n").cast("long").alias("group_size"),
                    (first & (F.col("copy") == 1)).alias("kept"),
                    F.col("sha").alias("text_sha256"), F.col("bucket").cast("int").alias("bucket")))
