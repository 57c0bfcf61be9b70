"""Quality classifier: random Fourier features over document statistics, ridge regression, isotonic calibration.

1. One pass over the texts gives some thirty statistics per document, stored.
2. Over the labelled rows, partitions sum counts and moments (to standardise),
   then the normal equations of ridge regression on the random features, then
   a histogram of the fitted values by label.  Each is a fixed-size sum,
   whatever the number of rows.
3. The histogram is made monotone by pooling adjacent violators; a document's
   score is its calibrated fitted value.

All labelled rows outside the held-out fold take part; nothing is sampled.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cashbook.llm.common import (LOWER, NOT_SPACE, byte_class, held_out, mix64, stored, text_slices, word_hashes,
                                 word_spans)

LINE = byte_class([(0x0A, 0x0A)])

#: Classes of bytes that are counted: letters (lower, upper), digits, space, line ends, sentence marks, other
#: punctuation singly where junk uses it, other symbols, control, non-ASCII lead and follow bytes.
_CLASS = np.full(256, 9, dtype=np.uint8)
for _chars, _code in ((b"abcdefghijklmnopqrstuvwxyz", 0), (b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", 1), (b"0123456789", 2),
                      (b" \t", 3), (b"\n\r", 4), (b".,;:?'\"()-", 5), (b"!", 6), (b"|", 7), (b"#$%&*@^~<>{}[]\\/=+_`", 8)):
    for _c in _chars:
        _CLASS[_c] = _code
_CLASS[0x80:0xC0] = 11
_CLASS[0xC0:] = 10
_CLASSES = 12

STATISTICS = ["log_bytes", "log_words", "log_lines", "lower", "upper", "digit", "space", "newline", "sentence",
              "bang", "pipe", "symbol", "other", "lead", "mean_word", "sd_word", "short_words", "long_words",
              "distinct_words", "top_word", "distinct_pairs", "repeat_next", "distinct_lines", "top_line",
              "words_per_line", "sd_line", "odd_words", "stops", "distinct_stems", "empty"]

#: Random features, kernel width as a share of the number of statistics, ridge, and calibration bins.
FEATURES, WIDTH, RIDGE, BINS = 384, 1.0, 1.0, 2000


def _shares(hashes: np.ndarray) -> tuple[float, float]:
    """Share of distinct values, and of the most frequent one."""
    if not len(hashes):
        return 1.0, 0.0
    n = np.unique(hashes, return_counts=True)[1]
    return len(n) / len(hashes), n.max() / len(hashes)


def statistics(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row of ``STATISTICS`` per text."""
    texts = len(offsets) - 1
    size = np.diff(offsets)
    owner = np.repeat(np.arange(texts), size)
    counts = np.bincount(owner * _CLASSES + _CLASS[data], minlength=texts * _CLASSES).reshape(texts, _CLASSES)
    low = LOWER[data]
    starts, ends, first = word_spans(low, offsets, NOT_SPACE)
    words = word_hashes(low, starts, ends)
    length = (ends - starts).astype(np.float64)
    ls, le, lfirst = word_spans(data, offsets, LINE)
    lines = word_hashes(data, ls, le)
    line_size = (le - ls).astype(np.float64)
    last = low[ends - 1] if len(ends) else np.zeros(0, np.uint8)
    stop, odd = last == 0x2E, (_CLASS[last] >= 6) & (_CLASS[last] <= 9)
    stem = np.zeros(len(starts), np.uint64)
    for k in range(4):                                    # the first bytes of the word
        at = np.minimum(starts + k, np.maximum(ends - 1, 0))
        stem = (stem << np.uint64(8)) | low[at].astype(np.uint64)
    pair = mix64(words[:-1] * np.uint64(3) + words[1:]) if len(words) > 1 else words[:0]
    out = np.zeros((texts, len(STATISTICS)))
    for i in range(texts):
        a, z = int(first[i]), int(first[i + 1])
        n, b, c = z - a, max(int(size[i]), 1), counts[i]
        if n == 0:
            out[i, 0], out[i, -1] = np.log1p(size[i]), 1.0
            continue
        w, g, p = words[a:z], length[a:z], pair[a:z - 1]
        la, lz = int(lfirst[i]), int(lfirst[i + 1])
        word_share, word_top = _shares(w)
        line_share, line_top = _shares(lines[la:lz])
        out[i] = (np.log1p(b), np.log1p(n), np.log1p(lz - la), c[0] / b, c[1] / max(c[0] + c[1], 1), c[2] / b,
                  c[3] / b, c[4] / b, c[5] / b, c[6] / n, c[7] / n, c[8] / n, c[9] / b, c[10] / b,
                  g.mean(), g.std(), (g <= 3).mean(), (g >= 12).mean(), word_share, word_top, _shares(p)[0],
                  (w[1:] == w[:-1]).mean() if n > 1 else 0.0, line_share, line_top, np.log1p(n / max(lz - la, 1)),
                  np.log1p(line_size[la:lz].std()), odd[a:z].mean(), stop[a:z].mean(), _shares(stem[a:z])[0], 0.0)
    return out


def document_statistics(docs: DataFrame, text_col: str) -> DataFrame:
    """``row`` (all columns but the text) and x, the statistics as doubles in binary."""
    def run(batches):
        for batch in batches:
            x = [row.tobytes() for _, _, data, off in text_slices(batch, "text") for row in statistics(data, off)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(x, pa.binary())], names=["row", "x"])

    own = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text_col]).alias("row"),
                      F.col(text_col).cast("string").alias("text"))
    return own.mapInArrow(run, T.StructType([own.schema["row"], T.StructField("x", T.BinaryType())]))


def _matrix(column) -> np.ndarray:
    rows = column.to_pylist()
    return np.frombuffer(b"".join(rows), np.float64).reshape(len(rows), len(STATISTICS))


def _summed(rows: DataFrame, each) -> list[np.ndarray]:
    """Sum of ``each(x, y)`` over batches and partitions; a list of arrays of fixed shape.

    Partial sums meet in a few tasks, then on the driver: one row a task.
    """
    def run(batches):
        total = None
        for batch in batches:
            if batch.num_rows:
                got = each(_matrix(batch.column(0)), batch.column(1).to_numpy(zero_copy_only=False))
                total = got if total is None else [a + b for a, b in zip(total, got)]
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([i for i in range(len(total))]),
                                              pa.array([np.ascontiguousarray(t, np.float64).tobytes() for t in total])],
                                             names=["at", "part"])

    def merge(batches):
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for at, part in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                x = np.frombuffer(part, np.float64)
                total[at] = total[at] + x if at in total else x
        if total:
            yield pa.RecordBatch.from_arrays([pa.array(list(total)), pa.array([v.tobytes() for v in total.values()])],
                                             names=["at", "part"])

    schema = "at long, part binary"
    parts = rows.select("x", "y").mapInArrow(run, schema).repartition(4, "at").mapInArrow(merge, schema).collect()
    out: dict[int, np.ndarray] = {}
    for r in parts:
        x = np.frombuffer(r.part, np.float64)
        out[r.at] = out[r.at] + x if r.at in out else x
    return [out[k] for k in sorted(out)]


def random_features(x: np.ndarray, model: dict) -> np.ndarray:
    z = np.clip((x - model["mean"]) / model["sd"], -4, 4)
    return np.concatenate([np.sqrt(2.0 / FEATURES) * np.cos(z @ model["w"] + model["b"]), z * 0.1,
                           np.ones((len(x), 1))], axis=1)


def pool_adjacent_violators(value: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """The nearest non-decreasing values, by weighted squares."""
    blocks: list[list[float]] = []
    for v, w in zip(value, weight):
        blocks.append([float(v), float(w), 1])
        while len(blocks) > 1 and blocks[-2][0] >= blocks[-1][0]:
            v1, w1, n1 = blocks.pop()
            v0, w0, n0 = blocks.pop()
            blocks.append([(v0 * w0 + v1 * w1) / (w0 + w1), w0 + w1, n0 + n1])
    return np.concatenate([np.full(n, v) for v, _, n in blocks]) if blocks else np.zeros(0)


def fit(rows: DataFrame, seed: int = 11) -> dict | None:
    """Model from rows of x (statistics) and y (label, 0 to 1); None where there are no rows."""
    sums = _summed(rows, lambda x, y: [np.array([len(x), y.sum()]), x.sum(axis=0), (x * x).sum(axis=0)])
    if not sums:
        return None
    n, good = sums[0]
    mean = sums[1] / n
    sd = np.sqrt(np.maximum(sums[2] / n - mean * mean, 0))
    rng = np.random.default_rng(seed)
    model = {"mean": mean, "sd": np.where(sd > 1e-9, sd, 1.0),
             "w": rng.standard_normal((len(STATISTICS), FEATURES)) / np.sqrt(WIDTH * len(STATISTICS)),
             "b": rng.uniform(0, 2 * np.pi, FEATURES)}

    def equations(x, y):
        f = random_features(x, model)
        return [f.T @ f, f.T @ y]
    a, b = _summed(rows, equations)
    k = len(b)
    a = a.reshape(k, k) + RIDGE * np.eye(k)
    model["beta"] = np.linalg.solve(a, b)

    def histogram(x, y):
        at = _bin(random_features(x, model) @ model["beta"])
        return [np.bincount(at, minlength=BINS), np.bincount(at, weights=y, minlength=BINS)]
    weight, ones = _summed(rows, histogram)
    used = weight > 0
    # half a row of the base rate in each bin, so that no score is exactly 0 or 1 on little evidence
    value = (ones[used] + 0.5 * good / n) / (weight[used] + 0.5)
    level = pool_adjacent_violators(value, weight[used] + 0.5)
    model["calibrated"] = np.interp(np.arange(BINS), np.flatnonzero(used), level)
    return model


def _bin(value: np.ndarray) -> np.ndarray:
    """Fitted values from -0.5 to 1.5 in ``BINS`` equal bins."""
    return np.clip(((value + 0.5) / 2.0 * BINS).astype(np.int64), 0, BINS - 1)


def quality_scores(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   label_col: str = "quality", modulus: int = 5, remainder: int = 0) -> DataFrame:
    """All columns but the text, and quality_score (0 to 1; higher: label 1 is likelier).

    Null texts count as empty; empty texts are scored like others, from their
    statistics.  Labels count where label and id are not null and crc32(id)
    mod ``modulus`` is not ``remainder``; several labels of an id are
    averaged.  Rows that share a labelled id all take part.  Without usable
    labels every score is 0.5.
    """
    own = [c for c in docs.columns if c != text_col]
    seen = stored(document_statistics(docs, text_col), "quality-statistics")
    y = (labels.filter(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
         .filter(~held_out(id_col, modulus, remainder))
         .groupBy(F.col(id_col).alias("fit_id_")).agg(F.avg(F.col(label_col).cast("double")).alias("y")))
    rows = stored(seen.join(y, F.col(f"row.`{id_col}`") == F.col("fit_id_")).select("x", "y"), "quality-labelled")
    sent = docs.sparkSession.sparkContext.broadcast(fit(rows))

    def run(batches):
        model = sent.value
        for batch in batches:
            x = _matrix(batch.column(1))
            s = (np.full(len(x), 0.5) if model is None else
                 model["calibrated"][_bin(random_features(x, model) @ model["beta"])])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.clip(s, 0.0, 1.0))],
                                             names=["row", "quality_score"])

    schema = T.StructType([seen.schema["row"], T.StructField("quality_score", T.DoubleType())])
    scored = seen.mapInArrow(run, schema)
    return scored.select(*[F.col(f"row.`{c}`").alias(c) for c in own], "quality_score")
