"""Toxicity: a bidirectional gated recurrent network over word and character inputs, in numpy.

A word enters as its own vector, where it is known (in ``LEAST_TEXTS`` texts of
the training sample at least), beside the mean vector of its hashed character
n-grams.  A forward and a backward recurrent layer read a window of
words, attention pools their states, and a logistic unit scores the pool.  A
document is scored on all its overlapping windows; its score is that of its
worst window, calibrated on the labelled documents.

Training data are a bounded sample of the labelled documents (``TRAIN_TOXIC``
and ``TRAIN_CLEAN`` rows, chosen by id hash); training is one task.
"""

from __future__ import annotations

import pickle

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cashbook.llm.common import ALNUM, LOWER, held_out, mix64, text_slices, word_hashes, word_spans

#: Bound of the training sample: labelled documents of each class.
TRAIN_TOXIC, TRAIN_CLEAN = 1500, 2500
#: Words per window, and from one window's start to the next.
WINDOW, STRIDE = 48, 32
LEAST_TEXTS, CHAR_ROWS, GRAMS = 3, 1 << 15, (3, 5)
WORD_DIM, CHAR_DIM, HIDDEN, ATT = 4, 8, 8, 8
EPOCHS, STEPS, BATCH, RATE, DECAY = 6, 500, 96, 0.05, 1e-4
#: Windows scored at once.
BLOCK = 1024


# ------------------------------------------------------------------ inputs

def vocabulary(data: np.ndarray, offsets: np.ndarray):
    """Distinct words of a slice: (id per word, first word per text, hash per id, n-gram rows, first n-gram per id).

    N-grams run over the bytes of the word and one mark on either side.
    """
    low = LOWER[data]
    starts, ends, first = word_spans(low, offsets, ALNUM)
    hashes = word_hashes(low, starts, ends)
    values, at, ids = np.unique(hashes, return_index=True, return_inverse=True)
    s, size = starts[at], (ends - starts)[at] + 2            # with both marks
    cuts = np.cumsum(size) - size
    total = int(size.sum())
    place = np.arange(total) - np.repeat(cuts, size)
    marked = low[np.clip(np.repeat(s - 1, size) + place, 0, max(len(low) - 1, 0))].astype(np.uint64)
    marked[cuts] = 1
    marked[cuts + size - 1] = 2
    left = np.repeat(size, size) - place                     # bytes up to the end of the marked word
    padded = np.concatenate([marked, np.zeros(max(GRAMS), np.uint64)])
    rows, own = [], []
    code = np.zeros(total, np.uint64)
    for k in range(max(GRAMS)):
        code = (code << np.uint64(8)) | padded[k:k + total]
        if k + 1 in GRAMS:
            whole = np.flatnonzero(left > k)
            rows.append(mix64(code[whole] + np.uint64(k << 56)) % np.uint64(CHAR_ROWS))
            own.append(np.searchsorted(cuts, whole, side="right") - 1)
    own = np.concatenate(own)
    order = np.argsort(own, kind="stable")
    return (ids, first, values, np.concatenate(rows)[order].astype(np.int64),
            np.searchsorted(own[order], np.arange(len(values))))


def windows(first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, first word, words) of every window; a text without words has none."""
    n = np.diff(first)
    count = np.where(n > 0, np.maximum(-(-(n - WINDOW) // STRIDE), 0) + 1, 0)
    text = np.repeat(np.arange(len(n)), count)
    k = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
    begin = first[:-1][text] + k * STRIDE
    return text, begin, np.minimum(first[1:][text] - begin, WINDOW)


def _sig(x):
    return 0.5 * np.tanh(0.5 * x) + 0.5


# ----------------------------------------------------------------- network

def new_model(known: np.ndarray, seed: int = 5) -> dict[str, np.ndarray]:
    r = np.random.default_rng(seed)
    d = WORD_DIM + CHAR_DIM

    def w(*shape):
        return (r.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)
    m = {"known": known, "word": np.zeros((len(known) + 1, WORD_DIM), np.float32),
         "char": (0.1 * r.standard_normal((CHAR_ROWS, CHAR_DIM))).astype(np.float32)}
    for way in "fb":
        m[f"x_{way}"], m[f"u_{way}"] = w(d, 3 * HIDDEN), w(HIDDEN, 3 * HIDDEN)
        m[f"c_{way}"] = np.zeros(3 * HIDDEN, np.float32)
    m["att"], m["att0"], m["att1"] = w(2 * HIDDEN, ATT), np.zeros(ATT, np.float32), w(ATT)
    m["out"], m["bias"] = w(2 * HIDDEN), np.zeros(1, np.float32)
    return m


def word_rows(m, values):
    """Row of each word hash in the word table; unknown words share the last row, which stays zero."""
    known = m["known"]
    if not len(known):
        return np.zeros(len(values), np.int64)
    at = np.minimum(np.searchsorted(known, values), len(known) - 1)
    return np.where(known[at] == values, at, len(known))


def word_vectors(m, rows, grams, cuts):
    size = np.diff(np.append(cuts, len(grams)))
    chars = np.add.reduceat(m["char"][grams], cuts, axis=0) / size[:, None].astype(np.float32)
    return np.concatenate([m["word"][rows], chars], axis=1)


def _layer(xs, u, mask, keep):
    """Run one direction: xs (T, B, 3H) projected inputs; states (T, B, H)."""
    t, b, _ = xs.shape
    h = np.zeros((b, HIDDEN), np.float32)
    out, kept = np.empty((t, b, HIDDEN), np.float32), []
    for i in range(t):
        p = h @ u
        zr = _sig(xs[i, :, :2 * HIDDEN] + p[:, :2 * HIDDEN])
        z, r = zr[:, :HIDDEN], zr[:, HIDDEN:]
        c = np.tanh(xs[i, :, 2 * HIDDEN:] + r * p[:, 2 * HIDDEN:])
        step = z * mask[i]
        nxt = h + step * (c - h)
        if keep:
            kept.append((h, z, r, c, p[:, 2 * HIDDEN:]))
        out[i] = h = nxt
    return out, kept


def forward(m, proj_f, proj_b, mask, keep=False):
    """Logit per window from projected inputs (T, B, 3H) and mask (T, B)."""
    mk = mask[:, :, None]
    hf, kf = _layer(proj_f, m["u_f"], mk, keep)
    hb, kb = _layer(proj_b[::-1], m["u_b"], mk[::-1], keep)
    h = np.concatenate([hf, hb[::-1]], axis=2)
    a = np.tanh(h @ m["att"] + m["att0"])
    e = a @ m["att1"] + (mask - 1) * 1e9
    w = np.exp(e - e.max(axis=0))
    w /= w.sum(axis=0)
    pool = np.einsum("tb,tbh->bh", w, h)
    logit = pool @ m["out"] + m["bias"][0]
    return (logit, (h, a, w, pool, kf, kb)) if keep else logit


def _layer_back(dh, xs_shape, kept, u, mask):
    t = xs_shape[0]
    dx, du = np.empty(xs_shape, np.float32), np.zeros_like(u)
    carry = np.zeros(dh.shape[1:], np.float32)
    for i in range(t - 1, -1, -1):
        h, z, r, c, pc = kept[i]
        g = dh[i] + carry
        step = z * mask[i]
        dstep = g * (c - h)
        dc = g * step * (1 - c * c)
        dz = dstep * mask[i] * z * (1 - z)
        dr = dc * pc * r * (1 - r)
        dx[i] = np.concatenate([dz, dr, dc], axis=1)
        dp = np.concatenate([dz, dr, dc * r], axis=1)
        du += h.T @ dp
        carry = g * (1 - step) + dp @ u.T
    return dx, du


def gradients(m, x, mask, y):
    """Gradients of the mean logistic loss for inputs x (T, B, D)."""
    pf, pb = x @ m["x_f"] + m["c_f"], x @ m["x_b"] + m["c_b"]
    logit, (h, a, w, pool, kf, kb) = forward(m, pf, pb, mask, keep=True)
    dl = ((_sig(logit) - y) / len(y)).astype(np.float32)
    g = {"out": pool.T @ dl, "bias": np.array([dl.sum()], np.float32)}
    dpool = dl[:, None] * m["out"]
    dh = w[:, :, None] * dpool
    dw = np.einsum("tbh,bh->tb", h, dpool)
    de = w * (dw - (w * dw).sum(axis=0))
    g["att1"] = np.einsum("tb,tba->a", de, a)
    da = de[:, :, None] * m["att1"] * (1 - a * a)
    g["att"] = np.einsum("tbh,tba->ha", h, da)
    g["att0"] = da.sum(axis=(0, 1))
    dh += da @ m["att"].T
    mk = mask[:, :, None]
    dxf, g["u_f"] = _layer_back(dh[:, :, :HIDDEN], pf.shape, kf, m["u_f"], mk)
    dxb, g["u_b"] = _layer_back(dh[::-1, :, HIDDEN:], pb.shape, kb, m["u_b"], mk[::-1])
    dxb = dxb[::-1]
    g["c_f"], g["c_b"] = dxf.sum(axis=(0, 1)), dxb.sum(axis=(0, 1))
    g["x_f"], g["x_b"] = np.einsum("tbd,tbk->dk", x, dxf), np.einsum("tbd,tbk->dk", x, dxb)
    return g, dxf @ m["x_f"].T + dxb @ m["x_b"].T


def _steps(begin, size):
    """Word index (T, B) and mask (T, B) of windows; padding repeats the first word."""
    t = np.arange(int(size.max()))[:, None]
    inside = t < size
    return np.where(inside, begin + t, begin), inside.astype(np.float32)


def window_logits(m, vectors, ids, begin, size) -> np.ndarray:
    pf, pb = vectors @ m["x_f"] + m["c_f"], vectors @ m["x_b"] + m["c_b"]
    out = np.empty(len(begin), np.float32)
    order = np.argsort(-size, kind="stable")          # windows of like length together
    for lo in range(0, len(order), BLOCK):
        part = order[lo:lo + BLOCK]
        word, mask = _steps(begin[part], size[part])
        at = ids[word]
        out[part] = forward(m, pf[at], pb[at], mask)
    return out


def train(texts: list[str], labels: np.ndarray, rate: float | None = None, seed: int = 5) -> dict:
    """Fit on whole texts: each epoch takes the worst windows of every document and some at random.

    One text in five is not trained on: after each epoch these calibrate the
    score (a logistic fit to the worst window, shifted from the sample's to
    the ``rate`` of label 1), and the epoch that fits them best is kept.
    """
    raw = [(t or "").encode() for t in texts]
    data = np.frombuffer(b"".join(raw), np.uint8)
    offsets = np.concatenate(([0], np.cumsum([len(x) for x in raw]))).astype(np.int64)
    rng = np.random.default_rng(seed)
    ids, first, values, grams, cuts = vocabulary(data, offsets)
    pairs = np.unique(ids + len(values) * np.repeat(np.arange(len(first) - 1), np.diff(first)))
    texts_with = np.bincount(pairs % max(len(values), 1), minlength=len(values))
    m = new_model(values[texts_with >= LEAST_TEXTS], seed)
    rows = word_rows(m, values)
    text, begin, size = windows(first)
    tuned = np.zeros(len(labels), bool)                # every fifth of either class
    for c in (0, 1):
        tuned[np.flatnonzero(labels == c)[::5]] = True
    if len(text) == 0 or len(set(labels[~tuned].tolist())) < 2 or len(set(labels[tuned].tolist())) < 2:
        ones = float(labels.sum())
        return {"model": m, "platt": (0.0, float(np.log((ones + 0.5) / (len(labels) - ones + 0.5))))}
    share = labels.mean()
    shift = 0.0 if rate is None else float(np.log(rate / (1 - rate) * (1 - share) / share))
    ends = np.append(cuts, len(grams))
    y = labels.astype(np.float32)[text]
    usable = ~tuned[text]
    memory = {k: np.full(v.shape, 1e-4, np.float32) for k, v in m.items() if k != "known"}
    seen = np.diff(first) > 0
    best = None
    epoch = steps = 0
    while True:
        noise = rng.random(len(text)).astype(np.float32)
        score = noise
        if epoch:
            score = window_logits(m, word_vectors(m, rows, grams, cuts), ids, begin, size)
            top = np.full(len(labels), -np.inf)
            np.maximum.at(top, text, score)
            fold = tuned & seen
            loss, a, b = _platt(top[fold], labels[fold].astype(float))
            if best is None or loss < best[0]:
                best = (loss, {k: v.copy() for k, v in m.items()}, (a, b + shift))
            if epoch >= EPOCHS and steps >= STEPS:     # a small sample is passed more often
                return {"model": best[1], "platt": best[2]}
        order = np.lexsort((-score, text))
        start = np.searchsorted(text[order], np.unique(text))
        rank = np.arange(len(order)) - np.repeat(start, np.diff(np.append(start, len(order))))
        worst = order[rank < (2 if epoch else 3)]
        others = np.flatnonzero((y == 0) & (noise < min(1.0, len(worst) / 2 / len(text))))
        chosen = np.concatenate([worst, others])
        chosen = chosen[usable[chosen]]
        rng.shuffle(chosen)
        epoch, steps = epoch + 1, steps + -(-len(chosen) // BATCH)
        for lo in range(0, len(chosen), BATCH):
            _update(m, memory, chosen[lo:lo + BATCH], ids, begin, size, rows, grams, cuts, ends, y)


def _update(m, memory, part, ids, begin, size, rows, grams, cuts, ends, y) -> None:
    """One step of adaptive gradient descent on the windows of ``part``."""
    word, mask = _steps(begin[part], size[part])
    used, at = np.unique(ids[word], return_inverse=True)
    pieces = [grams[ends[k]:ends[k + 1]] for k in used]
    length = np.array([len(p) for p in pieces])
    own_cuts, own = np.cumsum(length) - length, np.concatenate(pieces)
    vec = word_vectors(m, rows[used], own, own_cuts)
    g, dx = gradients(m, vec[at.reshape(word.shape)], mask, y[part])
    dv = np.zeros_like(vec)
    np.add.at(dv, at.ravel(), (dx * mask[:, :, None]).reshape(-1, dx.shape[2]))
    for k, v in g.items():
        memory[k] += v * v
        m[k] -= RATE * v / np.sqrt(memory[k])
    for k, row, grad in (("word", rows[used], dv[:, :WORD_DIM]),
                         ("char", own, np.repeat(dv[:, WORD_DIM:] / length[:, None], length, axis=0))):
        uniq, back = np.unique(row, return_inverse=True)
        total = np.zeros((len(uniq), grad.shape[1]), np.float32)
        np.add.at(total, back, grad)
        memory[k][uniq] += total * total
        m[k][uniq] -= RATE * (total / np.sqrt(memory[k][uniq]) + DECAY * m[k][uniq])
    m["word"][-1] = 0


def _platt(x: np.ndarray, y: np.ndarray) -> tuple[float, float, float]:
    """Loss, slope (not below 0.1) and offset of a logistic fit by Newton steps, with a light ridge."""
    a, b = 1.0, 0.0
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(a * x + b, -30, 30)))
        w = p * (1 - p) + 1e-9
        ga, gb = ((p - y) * x).sum() + 0.1 * (a - 1), (p - y).sum() + 0.1 * b
        haa, hab, hbb = (w * x * x).sum() + 0.1, (w * x).sum(), w.sum() + 0.1
        det = haa * hbb - hab * hab
        a, b = a - np.clip((hbb * ga - hab * gb) / det, -1, 1), b - np.clip((haa * gb - hab * ga) / det, -1, 1)
        a = max(a, 0.1)
    p = np.clip(1 / (1 + np.exp(-np.clip(a * x + b, -30, 30))), 1e-9, 1 - 1e-9)
    return float(-(y * np.log(p) + (1 - y) * np.log(1 - p)).sum()), float(a), float(b)


# ---------------------------------------------------------------- operators

def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "toxic", modulus: int = 3, remainder: int = 1) -> bytes:
    """Train on labelled documents whose id hash is not ``remainder``; the pickled model (some MB).

    Null labels and ids are not used; several labels of an id count by their
    maximum.  Without labelled rows of both classes the score is constant.
    """
    y = (labels.filter(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
         .filter(~held_out(id_col, modulus, remainder))
         .groupBy(F.col(id_col).alias("fit_id_")).agg(F.max(F.col(label_col).cast("int")).alias("y")))
    rate = y.agg(F.avg("y")).first()[0]
    hashed = F.xxhash64("fit_id_")
    chosen = (y.filter("y = 1").orderBy(hashed, "fit_id_").limit(TRAIN_TOXIC)
              .unionByName(y.filter("y = 0").orderBy(hashed, "fit_id_").limit(TRAIN_CLEAN)))
    rows = (docs.select(F.col(id_col).alias("fit_id_"), F.col(text_col).cast("string").alias("text"))
            .join(F.broadcast(chosen), "fit_id_").groupBy("fit_id_").agg(F.min("text").alias("text"),
                                                                         F.max("y").alias("y")))

    def run(frames):
        import pandas as pd
        got = [f for f in frames]
        t = pd.concat(got).sort_values("fit_id_") if got else pd.DataFrame({"text": [], "y": []})
        yield pd.DataFrame({"model": [pickle.dumps(train(t["text"].tolist(), t["y"].to_numpy(np.int64), rate))]})

    return rows.coalesce(1).mapInPandas(run, "model binary").first()[0]


def score(docs: DataFrame, model: bytes, text_col: str = "text") -> DataFrame:
    """Every row with its score: ``row`` (all columns), score (0 to 1), n_windows.

    Texts without words (null and empty ones too) score 0.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        fitted = pickle.loads(sent.value)
        m, (a, b) = fitted["model"], fitted["platt"]
        for batch in batches:
            out, count = [], []
            for lo, hi, data, off in text_slices(batch, "score_text_"):
                top = np.full(hi - lo, -np.inf)
                n = np.zeros(hi - lo, np.int64)
                ids, first, values, grams, cuts = vocabulary(data, off)
                if len(ids):
                    rows = word_rows(m, values)
                    text, begin, size = windows(first)
                    np.maximum.at(top, text, window_logits(m, word_vectors(m, rows, grams, cuts), ids, begin, size))
                    n = np.bincount(text, minlength=hi - lo)
                out.append(np.where(n > 0, 1 / (1 + np.exp(-np.clip(a * top + b, -30, 30))), 0.0))
                count.append(n)
            empty = [np.zeros(0)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.concatenate(out or empty)),
                 pa.array(np.concatenate(count or empty).astype(np.int64))], names=["row", "score", "n_windows"])

    own = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                      F.col(text_col).cast("string").alias("score_text_"))
    schema = T.StructType([own.schema["row"], T.StructField("score", T.DoubleType()),
                           T.StructField("n_windows", T.LongType())])
    return own.mapInArrow(run, schema)


def keep_clean(docs: DataFrame, labelled: DataFrame, labels: DataFrame, threshold: float = 0.7,
               text_col: str = "text") -> DataFrame:
    """The documents that score below ``threshold``; same columns.  Texts without words stay."""
    return score(docs, fit(labelled, labels), text_col).filter(F.col("score") < threshold).select("row.*")
