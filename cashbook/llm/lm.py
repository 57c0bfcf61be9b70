"""Language-model scores: a log-bilinear model over word classes, trained in numpy by noise-contrastive estimation.

Tokens are lower-cased words and one end per text.  The most frequent words
are classes of their own; all other words fall into classes by their last two
bytes.  The model predicts a class from the two before it: the context vector
is a bilinear sum of class vectors, the score of a class its product with the
context vector, plus a bias.  Inside a class, a word has its smoothed share
of the class's training tokens, with one share for an unknown word, so that
token probabilities are normalised over all words.

1. Words of all training texts are counted (partial counts per task).
2. Class trigrams of all training texts are counted: at most (K + 1)**2 * K
   cells, whatever the corpus.
3. Training: each round, every task passes all cells of its contexts several
   times, weighed by their counts, learns against the class frequencies as
   noise, and returns its parameters, which are averaged.  No cell and no
   noise is drawn: every training token counts in every pass.
4. Scoring: one batched matrix product gives the normalised log-probabilities
   of all contexts; texts look theirs up.  Counts of at most ``FREQUENT`` of
   the most frequent words go to the tasks; those of all other words are joined.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cashbook.llm.common import (LOWER, NOT_SPACE, held_out, mix64, most_frequent, stored, text_slices, word_hashes,
                                 word_spans)

#: Words with a class of their own (beside the end), classes by ending, frequent words sent to tasks.
OWN, ENDINGS, FREQUENT = 63, 64, 1 << 17
#: Vector size, noise per token, training rounds, passes over all cells and least steps per round, contexts a step, step.
DIM, NOISE, ROUNDS, PASSES, STEPS, BATCH, STEP = 24, 8, 4, 24, 256, 128, 0.08
#: Tasks that share the training cells; distinct words or cells held in a task before they are passed on.
TASKS, HELD = 6, 1 << 20
END = np.uint64(0x0E4D0E4D0E4D0E4D)
SMOOTH = 0.1


def tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash and ending of every token, an end after each text, and the first token of each text."""
    low = LOWER[data]
    starts, ends, first = word_spans(low, offsets, NOT_SPACE)
    hashes = word_hashes(low, starts, ends)
    if len(ends):
        one = low[ends - 1].astype(np.uint64)
        two = np.where(ends - starts > 1, low[np.maximum(ends - 2, 0)], 0).astype(np.uint64)
        ending = (mix64((two << np.uint64(8)) | one) % np.uint64(ENDINGS)).astype(np.int64)
    else:
        ending = np.zeros(0, np.int64)
    at = first[1:]                                    # an end goes after the words of each text
    return np.insert(hashes, at, END), np.insert(ending, at, -1), first + np.arange(len(first))


def word_counts(texts: DataFrame) -> DataFrame:
    """(word, ending, n) over all texts; the end has ending -1."""
    def run(batches):
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        size = 0

        def merged():
            w, e, n = (np.concatenate(x) for x in zip(*held))
            values, first, back = np.unique(w, return_index=True, return_inverse=True)
            return values, e[first], np.bincount(back, weights=n).astype(np.int64)

        def out(w, e, n):
            return pa.RecordBatch.from_arrays([pa.array(w.view(np.int64)), pa.array(e), pa.array(n)],
                                              names=["word", "ending", "n"])
        for batch in batches:
            for _, _, data, off in text_slices(batch, "text"):
                w, e, _ = tokens(data, off)
                values, first, n = np.unique(w, return_index=True, return_counts=True)
                held.append((values, e[first], n))
                size += len(values)
                if size > 2 * HELD:
                    one = merged()
                    held, size = [one], len(one[0])
                    if size > HELD:
                        yield out(*one)
                        held, size = [], 0
        if held:
            yield out(*merged())

    return (texts.select("text").mapInArrow(run, "word long, ending long, n long")
            .groupBy("word", "ending").agg(F.sum("n").alias("n")))


class Classes:
    """Class of a token: own words first, then the end, then endings; ``size`` is the start of a text (context only)."""

    def __init__(self, own: np.ndarray):
        self.own = np.sort(own.astype(np.uint64))
        self.end = len(self.own)
        self.size = self.end + 1 + ENDINGS

    def of(self, words: np.ndarray, ending: np.ndarray) -> np.ndarray:
        c = self.end + 1 + ending
        c[ending < 0] = self.end
        if len(self.own):
            at = np.minimum(np.searchsorted(self.own, words), len(self.own) - 1)
            c = np.where((self.own[at] == words) & (ending >= 0), at, c)
        return c

    def contexts(self, c: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Number of the context (two before, one before) of every token."""
        one, two = np.empty_like(c), np.empty_like(c)
        one[1:], two[2:] = c[:-1], c[:-2]
        begin = first[:-1]
        one[begin], two[begin] = self.size, self.size
        second = begin[np.diff(first) > 1] + 1
        two[second] = self.size
        return two * (self.size + 1) + one


def trigram_cells(texts: DataFrame, classes: Classes) -> DataFrame:
    """(cell, n): counts of (two before, one before, class) over all texts; cell = context * K + class."""
    def run(batches):
        held, size = [], 0

        def merged():
            v, n = (np.concatenate(x) for x in zip(*held))
            values, back = np.unique(v, return_inverse=True)
            return values, np.bincount(back, weights=n).astype(np.int64)
        for batch in batches:
            for _, _, data, off in text_slices(batch, "text"):
                w, e, first = tokens(data, off)
                c = classes.of(w, e)
                values, n = np.unique(classes.contexts(c, first) * classes.size + c, return_counts=True)
                held.append((values, n))
                size += len(values)
                if size > 2 * HELD:
                    one = merged()
                    held, size = [one], 0             # bounded by the number of cells
        if held:
            values, n = merged()
            yield pa.RecordBatch.from_arrays([pa.array(values), pa.array(n)], names=["cell", "n"])

    return texts.select("text").mapInArrow(run, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n"))


# ------------------------------------------------------------------ the model

def new_model(classes: int, share: np.ndarray, seed: int) -> dict[str, np.ndarray]:
    r = np.random.default_rng(seed)
    return {"in": 0.1 * r.standard_normal((classes + 1, DIM)), "out": 0.1 * r.standard_normal((classes, DIM)),
            "one": np.eye(DIM) + 0.01 * r.standard_normal((DIM, DIM)),
            "two": 0.5 * np.eye(DIM) + 0.01 * r.standard_normal((DIM, DIM)), "bias": np.log(share)}


def learn(m: dict[str, np.ndarray], cells: np.ndarray, n: np.ndarray, share: np.ndarray, step: float,
          seed: int) -> dict[str, np.ndarray]:
    """One round of noise-contrastive estimation on all the cells, each weighed by its count.

    A step takes some contexts with all their classes, and the noise by its
    expectation; only the order of the contexts is random.
    """
    rng = np.random.default_rng(seed)
    k = len(share)
    contexts, row = np.unique(cells // k, return_inverse=True)
    two, one = contexts // (k + 1), contexts % (k + 1)
    counts = np.zeros((len(contexts), k))
    np.add.at(counts, (row, cells % k), n)
    batches = -(-len(contexts) // BATCH)
    counts *= batches / counts.sum()                   # a step's weights add up to about one
    m = {x: v.copy() for x, v in m.items()}
    noise = NOISE * share
    memory = {x: np.full(v.shape, 2e-5) for x, v in m.items()}
    for _ in range(max(PASSES, -(-STEPS // batches))):
        for part in np.array_split(rng.permutation(len(contexts)), batches):
            v1, v2, data = m["in"][one[part]], m["in"][two[part]], counts[part]
            h = v1 @ m["one"] + v2 @ m["two"]
            p = 1 / (1 + np.exp(-(h @ m["out"].T + m["bias"] - np.log(noise))))
            d = data * (p - 1) + data.sum(axis=1, keepdims=True) * noise * p
            dh = d @ m["out"]
            g = {"in": np.zeros_like(m["in"]), "out": d.T @ h, "bias": d.sum(axis=0), "one": v1.T @ dh, "two": v2.T @ dh}
            np.add.at(g["in"], one[part], dh @ m["one"].T)
            np.add.at(g["in"], two[part], dh @ m["two"].T)
            for x in m:
                memory[x] += g[x] ** 2
                m[x] -= step * g[x] / np.sqrt(memory[x])
    return m


def log_probabilities(m: dict[str, np.ndarray]) -> np.ndarray:
    """log10 of the normalised class probabilities: one row per context, in blocks of batched products."""
    k = len(m["bias"])
    left, right = m["in"] @ m["two"], m["in"] @ m["one"]
    out = np.empty(((k + 1) * (k + 1), k), np.float32)
    for two in range(k + 1):
        s = (left[two] + right) @ m["out"].T + m["bias"]
        s -= s.max(axis=1, keepdims=True)
        s -= np.log(np.exp(s).sum(axis=1, keepdims=True))
        out[two * (k + 1):(two + 1) * (k + 1)] = s / np.log(10)
    return out


def train(cells: DataFrame, classes: int, share: np.ndarray, seed: int = 3) -> dict[str, np.ndarray]:
    model = new_model(classes, share, seed)
    shapes = {x: v.shape for x, v in model.items()}
    # a context's cells meet in one task
    dealt = stored(cells.repartition(TASKS, F.xxhash64(F.floor(F.col("cell") / classes))), "lm-cells-dealt")
    for r in range(ROUNDS):
        now, step = model, STEP / (1 + r)

        def run(batches, now=now, step=step, r=r):
            got = [b for b in batches if b.num_rows]
            if not got:
                return
            c = np.concatenate([b.column(0).to_numpy() for b in got])
            n = np.concatenate([b.column(1).to_numpy() for b in got])
            order = np.argsort(c)
            c, n = c[order], n[order]
            m = learn(now, c, n, share, step, seed + 97 * r + int(c[0] % 1009))
            yield pa.RecordBatch.from_arrays(
                [pa.array([int(n.sum())]), pa.array([b"".join(m[x].tobytes() for x in shapes)])],
                names=["n", "model"])

        parts = dealt.mapInArrow(run, "n long, model binary").collect()        # one row a task
        if not parts:
            break
        total = sum(p.n for p in parts)
        flat = sum(np.frombuffer(p.model, np.float64) * (p.n / total) for p in parts)
        model, at = {}, 0
        for x, shape in shapes.items():
            size = int(np.prod(shape))
            model[x] = flat[at:at + size].reshape(shape)
            at += size
    return model


# ------------------------------------------------------------------ operator

def score_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", modulus: int = 10,
                    remainder: int = 0) -> DataFrame:
    """One row per input row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Learns from the rows whose crc32(id as text) mod ``modulus`` is not
    ``remainder`` (null ids included).  Scores are log10 of the text's
    probability: ``base_score`` by smoothed word counts alone, ``score`` by
    the model.  Null texts count as empty: one end token.  Repeated rows
    count and are scored each time.  With nothing to learn from, all counts
    are zero.  An empty table gives an empty result.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"),
                       held_out(id_col, modulus, remainder).alias("held"))
    training = rows.filter("NOT held").select("text")
    counts = stored(word_counts(training), "lm-counts")
    n_all, v_all = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    some = counts.filter("ending >= 0")
    own = some.orderBy(F.desc("n"), "word").limit(OWN).toPandas()
    classes = Classes(own["word"].to_numpy(np.int64).view(np.uint64))
    # the words with a class of their own are always among those sent
    top = pd.concat([own, most_frequent(some, "n", FREQUENT).toPandas()]).drop_duplicates("word")
    words = top["word"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(words)
    known, known_n = words[order], top["n"].to_numpy(np.int64)[order]
    own_rows = counts.filter(F.col("ending") >= 0)
    if len(classes.own):
        own_rows = own_rows.filter(~F.col("word").isin(classes.own.view(np.int64).tolist()))
    of_ending = {r.ending: (r.n, r.v) for r in own_rows.groupBy("ending").agg(
        F.sum("n").alias("n"), F.count(F.lit(1)).alias("v")).collect()}
    inside = np.array([of_ending.get(e, (0, 0)) for e in range(ENDINGS)], dtype=np.float64)
    log_inside = np.zeros(classes.size)                # log10 of the class's tokens, smoothed; own words: certain
    log_inside[classes.end + 1:] = np.log10(inside[:, 0] + SMOOTH * (inside[:, 1] + 1))

    cells = stored(trigram_cells(training, classes), "lm-cells")
    freq = {r.c: r.n for r in cells.groupBy((F.col("cell") % classes.size).alias("c"))
            .agg(F.sum("n").alias("n")).collect()}
    share = np.array([freq.get(c, 0) + 1.0 for c in range(classes.size)])
    share /= share.sum()
    model = train(cells, classes.size, share)
    end_n = n_all - int(own_rows.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]) - int(own["n"].sum())
    sent = spark.sparkContext.broadcast((model, classes, known, known_n, log_inside, end_n))

    def run(batches):
        m, cl, known, known_n, log_inside, end_n = sent.value
        table = log_probabilities(m)
        task, row = TaskContext.get().partitionId(), 0
        log_known = np.log10(known_n + SMOOTH)
        for batch in batches:
            out = {x: [] for x in ("uid", "n_tokens", "n_known", "base", "lm", "words", "times")}
            for lo, hi, data, off in text_slices(batch, "text"):
                w, e, first = tokens(data, off)
                c = cl.of(w, e)
                by_class = table[cl.contexts(c, first), c].astype(np.float64)
                own = c <= cl.end
                is_end = e < 0
                at = np.minimum(np.searchsorted(known, w), max(len(known) - 1, 0))
                seen = (known[at] == w) & ~is_end if len(known) else np.zeros(len(w), bool)
                log_c = np.full(len(w), np.log10(SMOOTH))
                log_c[seen] = log_known[at[seen]]
                log_c[is_end] = np.log10(end_n + SMOOTH)
                counted = seen | (is_end & (end_n > 0))
                lm = by_class + np.where(own, 0.0, log_c - log_inside[c])
                begin = first[:-1]
                out["n_tokens"].append(np.diff(first))
                out["n_known"].append(np.add.reduceat(counted.astype(np.int64), begin))
                out["base"].append(np.add.reduceat(log_c, begin))
                out["lm"].append(np.add.reduceat(lm, begin))
                out["uid"].append(np.arange(row, row + hi - lo) + (task << 40))
                row += hi - lo
                rare = np.flatnonzero(~seen & ~is_end)
                cut = np.searchsorted(rare, first)
                rare_words = w[rare].view(np.int64)
                for i in range(hi - lo):
                    values, n = np.unique(rare_words[cut[i]:cut[i + 1]], return_counts=True)
                    out["words"].append(values)
                    out["times"].append(n.astype(np.int32))
            size = np.cumsum([0] + [len(x) for x in out["words"]]).astype(np.int32)

            def flat(x, kind):
                return np.concatenate(out[x]).astype(kind) if out[x] else np.zeros(0, kind)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(flat("uid", np.int64)),
                 pa.array(flat("n_tokens", np.int64)), pa.array(flat("n_known", np.int64)),
                 pa.array(flat("base", np.float64)), pa.array(flat("lm", np.float64)),
                 pa.ListArray.from_arrays(pa.array(size), pa.array(flat("words", np.int64))),
                 pa.ListArray.from_arrays(pa.array(size), pa.array(flat("times", np.int32)))],
                names=["id", "held", "uid", "n_tokens", "n_known", "base", "lm", "words", "times"])

    kind = T.StructType([rows.schema["id"], T.StructField("held", T.BooleanType())] + [
        T.StructField(x, T.LongType()) for x in ("uid", "n_tokens", "n_known")] + [
        T.StructField(x, T.DoubleType()) for x in ("base", "lm")] + [
        T.StructField("words", T.ArrayType(T.LongType())), T.StructField("times", T.ArrayType(T.IntegerType()))])
    first_pass = stored(rows.select("id", "held", "text").mapInArrow(run, kind), "lm-rows")
    # the other words: what their counts add over a count of zero
    rare = first_pass.select("uid", F.explode(F.arrays_zip("words", "times")).alias("x")).select(
        "uid", F.col("x.words").alias("word"), F.col("x.times").alias("times"))
    gain = F.log10(F.col("n") + SMOOTH) - F.log10(F.lit(SMOOTH))
    more = (rare.join(counts.filter("ending >= 0").select("word", "n"), "word")
            .select("uid", "times", (gain * F.col("times")).alias("gain"))
            .groupBy("uid").agg(F.sum("gain").alias("gain"), F.sum("times").alias("rare_known")))
    scale = float(np.log10(n_all + SMOOTH * (v_all + 1)))
    gained = F.coalesce("gain", F.lit(0.0))
    return (first_pass.drop("words", "times").join(more, "uid", "left")
            .select(F.col("id").alias("doc_id"), F.col("held").alias("held_out"), "n_tokens",
                    (F.col("n_known") + F.coalesce("rare_known", F.lit(0))).cast("long").alias("n_known"),
                    F.lit(int(n_all)).cast("long").alias("train_tokens"),
                    (F.col("base") + gained - F.col("n_tokens") * scale).alias("base_score"),
                    (F.col("lm") + gained).alias("score")))
