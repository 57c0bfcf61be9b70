"""Shared helpers of the text operators: inputs, stored tables, byte-level words.

Texts are handled as UTF-8 bytes.  A word class is a table over the 256 byte
values, which is exact for the classes used here because every byte of a
non-ASCII character is 0x80 or above.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cashbook.session import scratch_dir

#: Characters that end a word: space, and tab to carriage return.
SPACES = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"

#: Text bytes handled at once inside a task; bounds the numpy temporaries.
SLICE_BYTES = 1 << 20
#: Bytes of a batch of rows on its way to or from a Python task (by default 64 MB, which counts on both sides of it).
BATCH_BYTES, BATCH_CONF = 4 << 20, "spark.sql.execution.arrow.maxBytesPerBatch"


def bounded_batches(spark: SparkSession) -> None:
    """Bounds the rows held between Spark and its Python tasks, unless the session sets a bound of its own."""
    if BATCH_CONF not in spark.conf.getAll:
        spark.conf.set(BATCH_CONF, str(BATCH_BYTES))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    bounded_batches(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, tag: str) -> DataFrame:
    """Write to the shared folder and read back: lineage ends at the files."""
    spark = df.sparkSession
    bounded_batches(spark)
    path = scratch_dir(spark, tag)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def most_frequent(counts: DataFrame, n_col: str, most: int) -> DataFrame:
    """The rows of the largest counts, at most ``most`` of them, whole classes of about equal counts.

    Their least count is read off a histogram (sixteen classes for each
    doubling, so under a thousand rows come to the driver), and what is above
    it has a known size.
    """
    step = F.floor(F.log2(n_col) * 16).cast("int")
    held = counts.groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("rows"), F.min(n_col).alias("low")).collect()
    least, rows = None, 0
    for r in sorted(held, key=lambda r: -r["step"]):
        rows += r["rows"]
        if rows > most:
            break
        least = r["low"]
    return counts.filter(F.col(n_col) >= least) if least is not None else counts.limit(0)


def held_out(id_col: str, modulus: int, remainder: int):
    """True where crc32(doc_id as text) mod ``modulus`` equals ``remainder``; a null id is never held out."""
    crc = F.crc32(F.col(id_col).cast("string").cast("binary"))
    return F.coalesce(crc % modulus == remainder, F.lit(False))


# ------------------------------------------------------------ byte-level words

def byte_class(excluded: list[tuple[int, int]]) -> np.ndarray:
    keep = np.ones(256, dtype=bool)
    for lo, hi in excluded:
        keep[lo:hi + 1] = False
    return keep


#: Bytes of ``[^\x20\x09-\x0D]``.
NOT_SPACE = byte_class([(0x20, 0x20), (0x09, 0x0D)])
#: Bytes of ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]`` (after lower-casing A-Z).
ALNUM = byte_class([(0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F)])

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def text_slices(batch: pa.RecordBatch, column: str,
                budget: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of rows of at most ``budget`` text bytes (one row at least).

    Yields (first row, end row, bytes, offsets); a null text is empty.
    """
    arr = batch.column(batch.schema.get_field_index(column))
    n = len(arr)
    if n == 0:
        return
    if arr.null_count:
        arr = arr.fill_null(b"" if pa.types.is_binary(arr.type) or pa.types.is_large_binary(arr.type)
                            else "")
    wide = pa.types.is_large_string(arr.type) or pa.types.is_large_binary(arr.type)
    _, off_buf, data_buf = arr.buffers()
    off = np.frombuffer(off_buf, dtype=np.int64 if wide else np.int32)[arr.offset:arr.offset + n + 1]
    off = off.astype(np.int64)
    data = np.frombuffer(data_buf, dtype=np.uint8) if data_buf is not None else np.zeros(0, np.uint8)
    lo = 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(off, off[lo] + budget, side="right")) - 1)
        hi = min(hi, n)
        yield lo, hi, data[off[lo]:off[hi]], off[lo:hi + 1] - off[lo]
        lo = hi


def word_spans(data: np.ndarray, offsets: np.ndarray,
               keep: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of every word, and the first word of each text (one more entry than texts)."""
    inside = keep[data]
    before = np.empty(len(data) + 1, dtype=bool)
    before[0] = False
    before[1:] = inside
    cut = np.zeros(len(data) + 1, dtype=bool)
    cut[offsets] = True
    starts = np.flatnonzero(inside & (~before[:-1] | cut[:-1]))
    after = np.empty(len(data) + 1, dtype=bool)
    after[:-1] = inside
    after[-1] = False
    ends = np.flatnonzero(inside & (~after[1:] | cut[1:])) + 1
    return starts, ends, np.searchsorted(starts, offsets)


_RNG = np.random.default_rng(20240607)
_BYTE_CODE = _RNG.integers(1, 1 << 63, size=256, dtype=np.uint64) | np.uint64(1)
_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INV = pow(_BASE, -1, 1 << 64)
_POWERS: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        size = max(n, SLICE_BYTES + 1)
        step = np.full(size, base, dtype=np.uint64)
        step[0] = 1
        have = np.multiply.accumulate(step)
        if size == SLICE_BYTES + 1:                   # the powers of a longer word are not kept
            _POWERS[base] = have
    return have[:n]


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (multiply and xor-shift), so that all bits depend on all bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(lowered: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash per word (in order of the text): polynomial over byte codes by one running sum, then mixed.

    Runs of words of at most ``SLICE_BYTES`` (one word at least) share a sum;
    a hash does not depend on the place of its word.
    """
    out = np.zeros(len(starts), dtype=np.uint64)
    lo = 0
    while lo < len(starts):
        begin = int(starts[lo])
        hi = max(lo + 1, int(np.searchsorted(ends, begin + SLICE_BYTES, side="right")))
        low, first, last = lowered[begin:int(ends[hi - 1])], starts[lo:hi] - begin, ends[lo:hi] - begin
        total = np.zeros(len(low) + 1, dtype=np.uint64)
        np.cumsum(_BYTE_CODE[low] * _powers(_BASE, len(low)), out=total[1:])
        raw = (total[last] - total[first]) * _powers(_BASE_INV, len(low))[first]
        out[lo:hi] = mix64(raw + (last - first).astype(np.uint64))
        lo = hi
    return out


def shingle_hashes(words: np.ndarray, first: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash per run of ``width`` words inside a text, and the first shingle of each text.

    A text of fewer words, but not none, has one shingle: the whole sequence.
    """
    counts = np.diff(first)
    n_sh = np.where(counts >= width, counts - width + 1, (counts > 0).astype(counts.dtype))
    out_first = np.zeros(len(counts) + 1, dtype=np.int64)
    np.cumsum(n_sh, out=out_first[1:])
    total = int(out_first[-1])
    if total == 0:
        return np.zeros(0, dtype=np.uint64), out_first
    text = np.repeat(np.arange(len(counts)), n_sh)
    begin = first[:-1][text] + (np.arange(total) - out_first[:-1][text])
    size = np.minimum(counts[text], width)
    h = np.full(total, 0x51ED270B, dtype=np.uint64)
    for k in range(width):
        at = np.minimum(begin + k, len(words) - 1)
        h = np.where(k < size, mix64(h * np.uint64(_BASE) + words[at]), h)
    return h, out_first
