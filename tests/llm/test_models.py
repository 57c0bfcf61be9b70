"""Language model, quality and toxicity: exact counts, normalisation, gradients and held-out accuracy."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from cashbook.llm import lm, quality, toxicity

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SF = "/root/testdata/sf0.01"


def held(i, modulus, remainder):
    return i is not None and zlib.crc32(str(i).encode()) % modulus == remainder


# -------------------------------------------------------------- language model

def test_log_probabilities_are_normalised():
    m = lm.new_model(9, np.full(9, 1 / 9), 1)
    p = 10.0 ** lm.log_probabilities(m).astype(float)
    assert p.shape == (100, 9) and np.allclose(p.sum(axis=1), 1, atol=1e-5)


def test_learning_finds_the_next_class():
    """Class c is always followed by c + 1."""
    k = 6
    cells = np.array([((c * (k + 1)) + (c + 1) % k) * k + (c + 2) % k for c in range(k)], dtype=np.int64)
    share = np.full(k, 1 / k)
    m = lm.new_model(k, share, 2)
    for r in range(3):
        m = lm.learn(m, cells, np.full(k, 100), share, 0.1, r)
    table = lm.log_probabilities(m)
    for c in range(k):
        assert table[c * (k + 1) + (c + 1) % k].argmax() == (c + 2) % k


def test_every_cell_is_learned():
    """A cell of one token beside one of a billion moves its context, and only shares count."""
    k = 6
    cells, n = np.array([(0 * (k + 1) + 1) * k + 2, (3 * (k + 1) + 4) * k + 5]), np.array([10**9, 1])
    m, share = lm.new_model(k, np.full(k, 1 / k), 2), np.full(k, 1 / k)
    got = lm.learn(m, cells, n, share, 0.1, 0)
    assert (got["in"][[0, 1, 3, 4]] != m["in"][[0, 1, 3, 4]]).all() and (got["in"][[2, 5, 6]] == m["in"][[2, 5, 6]]).all()
    many = lm.learn(m, cells, 1024 * n, share, 0.1, 0)
    assert all((got[x] == many[x]).all() for x in got)


def test_lm_counts_and_base_scores(docs, rows):
    tokens = [re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOWER)) + [None] for _, t, *_ in rows]
    c = Counter()
    for (i, *_), t in zip(rows, tokens):
        if not held(i, 10, 0):
            c.update(t)
    n, v = sum(c.values()), len(c)
    want = Counter()
    for (i, *_), t in zip(rows, tokens):
        base = sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in t)
        want[(i, held(i, 10, 0), len(t), sum(c[w] > 0 for w in t), n, round(base, 4))] += 1
    got = lm.score_documents(docs).collect()
    assert Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4))
                   for r in got) == want
    assert all(r.score < 0 for r in got)


def test_rare_words_join_to_the_same_counts(docs, monkeypatch):
    """With few words sent to the tasks, the rest come by the join: the same scores."""
    full = {(r.doc_id, r.n_tokens, round(r.base_score, 6)): round(r.score, 4) for r in lm.score_documents(docs).collect()}
    monkeypatch.setattr(lm, "FREQUENT", 64)
    few = {(r.doc_id, r.n_tokens, round(r.base_score, 6)): round(r.score, 4) for r in lm.score_documents(docs).collect()}
    assert full.keys() == few.keys()
    assert all(abs(full[k] - few[k]) < 1e-3 * (1 + abs(full[k])) for k in full)


def test_lm_scores_equal_brute_force(docs, rows, monkeypatch):
    """Every token: the class's normalised probability after two classes, times the word's share of its class."""
    monkeypatch.setattr(lm, "train", lambda cells, k, share, seed=3: lm.new_model(k, share, 5))
    monkeypatch.setattr(lm, "FREQUENT", 90)
    seen = {}

    def word(w):
        if w not in seen:
            data = np.frombuffer(w.encode(), np.uint8)
            h, ending, _ = lm.tokens(data, np.array([0, len(data)]))
            seen[w] = (int(h[:1].view(np.int64)[0]), int(ending[0]))
        return seen[w]
    texts = [(i, re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOWER))) for i, t, *_ in rows]
    training = [t for i, t in texts if not held(i, 10, 0)]
    c = Counter(w for t in training for w in t)
    own = sorted(c, key=lambda w: (-c[w], word(w)[0]))[:lm.OWN]
    number = {w: k for k, w in enumerate(sorted(own, key=lambda w: word(w)[0] % (1 << 64)))}
    end, size = len(own), len(own) + 1 + lm.ENDINGS
    inside, kinds = Counter(), Counter()
    for w in c:
        if w not in number:
            inside[word(w)[1]] += c[w]
            kinds[word(w)[1]] += 1

    def class_of(w):
        return end if w is None else number.get(w, end + 1 + word(w)[1])
    share = Counter(class_of(w) for t in training for w in t + [None])
    share = np.array([share.get(k, 0) + 1.0 for k in range(size)])
    m = lm.new_model(size, share / share.sum(), 5)
    cached = {}

    def log_p(two, one):
        if (two, one) not in cached:
            s = (m["in"][one] @ m["one"] + m["in"][two] @ m["two"]) @ m["out"].T + m["bias"]
            cached[two, one] = (s - np.log(np.exp(s).sum())) / np.log(10)
        return cached[two, one]
    want = []
    for i, t in texts:
        two = one = size
        score = 0.0
        for w in t + [None]:
            k = class_of(w)
            score += log_p(two, one)[k]
            if k > end:
                e = word(w)[1]
                score += math.log10((c.get(w, 0) + 0.1) / (inside[e] + 0.1 * (kinds[e] + 1)))
            two, one = one, k
        want.append((i is None, i or 0, len(t) + 1, score))
    got = sorted((r.doc_id is None, r.doc_id or 0, r.n_tokens, r.score) for r in lm.score_documents(docs).collect())
    for a, b in zip(got, sorted(want)):
        assert a[:3] == b[:3] and abs(a[3] - b[3]) < 1e-4 * (1 + abs(b[3]))


def test_most_frequent_counts_are_bounded(spark):
    from cashbook.llm.common import most_frequent
    df = spark.createDataFrame([(i, 1 + 1000 // (i + 1)) for i in range(500)], "k int, n long")
    for most in (0, 1, 10, 100, 499, 500, 1000):
        got = sorted((r.n for r in most_frequent(df, "n", most).collect()), reverse=True)
        every = sorted((1 + 1000 // (i + 1) for i in range(500)), reverse=True)
        assert len(got) <= most and got == every[:len(got)]
    assert most_frequent(df, "n", 500).count() == 500 and most_frequent(df, "n", 10).count() >= 8
    assert most_frequent(df.limit(0), "n", 10).count() == 0


def test_lm_beats_word_counts_on_held_out_texts(spark):
    got = lm.score_documents(spark.read.parquet(f"{SF}/documents.parquet")).filter("held_out").collect()
    assert sum(r.score for r in got) > sum(r.base_score for r in got) * 0.98


def test_lm_empty(spark, no_docs):
    assert lm.score_documents(no_docs).count() == 0
    one = spark.createDataFrame([(None, None)], "doc_id long, text string")
    r = lm.score_documents(one).first()
    assert (r.n_tokens, r.n_known, r.train_tokens) == (1, 1, 1)


# -------------------------------------------------------------- quality

def test_isotonic():
    v, w = np.array([1.0, 3.0, 2.0, 2.0, 5.0, 4.0]), np.ones(6)
    assert quality.pool_adjacent_violators(v, w).tolist() == [1.0, 7 / 3, 7 / 3, 7 / 3, 4.5, 4.5]


def test_statistics_do_not_cross_texts():
    parts = [b"One two two.\n\nTHREE 4!", b"", b"   \n", "été | straße".encode()]
    joined = np.frombuffer(b"".join(parts), np.uint8)
    off = np.cumsum([0] + [len(p) for p in parts])
    together = quality.statistics(joined, off)
    for p, row in zip(parts, together):
        alone = quality.statistics(np.frombuffer(p, np.uint8), np.array([0, len(p)]))
        assert np.allclose(alone[0], row)


def labelled(spark, name):
    d = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    return d, spark.read.parquet(f"{SF}/{name}.parquet")


def test_quality_on_held_out_labels(spark):
    d, labels = labelled(spark, "labels")
    got = {r.doc_id: r.quality_score for r in quality.quality_scores(d, labels).collect()}
    pairs = [(got[r.doc_id], r["quality"]) for r in labels.collect() if held(r.doc_id, 5, 0) and r["quality"] is not None]
    good, bad = [s for s, y in pairs if y == 1], [s for s, y in pairs if y == 0]
    assert np.mean([(g > b) + 0.5 * (g == b) for g in good for b in bad]) > 0.9
    assert np.mean([g >= 0.3 for g in good]) > 0.95


def test_quality_odd_rows_and_labels(spark, docs, rows, no_docs):
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, None), (None, 1), (3, 0), (4, 1), (999, 1)],
                                   "doc_id long, quality int")
    got = quality.quality_scores(docs, labels).collect()
    assert Counter(r.doc_id for r in got) == Counter(i for i, *_ in rows)
    assert all(0 <= r.quality_score <= 1 for r in got)
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert {r.quality_score for r in quality.quality_scores(docs, none).collect()} == {0.5}
    assert quality.quality_scores(no_docs, labels).count() == 0


# -------------------------------------------------------------- toxicity

def test_gradients_match_differences():
    r = np.random.default_rng(0)
    m = {k: v.astype(np.float64) if v.dtype.kind == "f" else v
         for k, v in toxicity.new_model(np.zeros(0, np.uint64), 1).items()}
    t, b, d = 5, 3, toxicity.WORD_DIM + toxicity.CHAR_DIM
    x = r.standard_normal((t, b, d))
    mask = (np.arange(t)[:, None] < np.array([5, 3, 1])).astype(float)
    y = np.array([1.0, 0.0, 1.0])

    def loss():
        logit = toxicity.forward(m, x @ m["x_f"] + m["c_f"], x @ m["x_b"] + m["c_b"], mask)
        return np.mean(np.logaddexp(0, logit) - y * logit)
    g, _ = toxicity.gradients(m, x, mask, y)
    for k in ("x_f", "u_f", "x_b", "u_b", "c_f", "att", "att1", "out", "bias"):
        at = tuple(r.integers(0, n) for n in m[k].shape)
        old = m[k][at]
        m[k][at] = old + 1e-3
        up = loss()
        m[k][at] = old - 1e-3
        down = loss()
        m[k][at] = old
        assert abs((up - down) / 2e-3 - g[k][at]) < 2e-3, k


def test_windows_cover_every_word():
    first = np.array([0, 0, 1, 48, 49 + 60, 500])
    text, begin, size = toxicity.windows(first)
    for i in range(5):
        seen = set()
        for b, s in zip(begin[text == i], size[text == i]):
            assert s <= toxicity.WINDOW
            seen |= set(range(b, b + s))
        assert seen == set(range(first[i], first[i + 1]))


@pytest.fixture(scope="module")
def toy(spark):
    r = random.Random(1)
    rows, labels = [], []
    for i in range(600):
        w = ["".join(r.choice("abdelmnorst") for _ in range(r.randint(2, 7))) for _ in range(r.randint(5, 120))]
        bad = i % 4 == 0
        for _ in range(3 if bad else 0):
            w[r.randrange(len(w))] = "vexo" + r.choice(["rim", "lat", "nos", "tu"])
        rows.append((i, " ".join(w)))
        labels.append((i, int(bad)))
    return (spark.createDataFrame(rows, "doc_id long, text string"),
            spark.createDataFrame(labels, "doc_id long, toxic int"), dict(labels))


def test_toxicity_on_held_out_labels(toy):
    d, labels, truth = toy
    got = toxicity.score(d, toxicity.fit(d, labels)).collect()
    test = [(r.score, truth[r.row.doc_id]) for r in got if held(r.row.doc_id, 3, 1)]
    assert np.mean([s >= 0.7 for s, y in test if y == 1]) > 0.9
    assert np.mean([s >= 0.7 for s, y in test if y == 0]) < 0.05


def test_toxicity_odd_rows(spark, docs, rows, no_docs):
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, None), (None, 1), (3, 0)], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels)
    got = toxicity.score(docs, model).collect()
    assert Counter((r.row.doc_id, r.row.part) for r in got) == Counter((x[0], x[7]) for x in rows)
    assert all(0 <= r.score <= 1 for r in got)
    assert all(r.score == 0 for r in got if not (r.row.text or "").strip())
    assert toxicity.score(no_docs, model).count() == 0
    assert toxicity.keep_clean(docs, docs, labels).columns == docs.columns
