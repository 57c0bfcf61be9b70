"""Repeated strings, contamination and similar documents against brute force."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from cashbook.llm import suffix_dedup
from cashbook.llm.decontaminate import SuffixAutomaton, clean_documents, contamination
from cashbook.llm.jaccard_join import one_per_group, prefix_length, similar_documents
from cashbook.llm.suffix_dedup import common_prefixes, remove_repeats, repeated_starts, suffix_array

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# ---------------------------------------------------------------- suffix arrays

@pytest.mark.parametrize("seed", range(40))
def test_suffix_array_and_prefixes(seed):
    r = np.random.default_rng(seed)
    text = r.integers(97, 97 + 2 + seed % 3, 300).astype(np.uint8)
    if seed % 4 == 0:
        text = np.tile(text[:30], 10)                # ties at any depth
    depth = int(r.choice([16, 40, 100, 200]))
    order, rank = suffix_array(text, depth)
    raw = text.tobytes()
    cut = [raw[i:i + depth] for i in order]
    assert cut == sorted(cut) and sorted(order.tolist()) == list(range(len(raw)))
    assert [rank[a] == rank[b] for a, b in zip(order, order[1:])] == [a == b for a, b in zip(cut, cut[1:])]
    lanes = np.array([0, 70, 200])
    lcp = common_prefixes(text, order, rank, lanes, depth)
    for k in range(1, len(order)):
        a, b = raw[order[k - 1]:], raw[order[k]:]
        n = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
        assert lcp[k] == min(n, depth)


@pytest.mark.parametrize("seed", range(8))
def test_repeated_starts(seed):
    r = random.Random(seed)
    base = bytes(r.choice(b"ab ") for _ in range(600))
    pieces = []
    for _ in range(6):
        a = r.randint(0, 300)
        pieces.append(r.choice([base[a:a + r.randint(60, 300)], b"xyz" * r.randint(20, 90),
                                bytes(r.choice(b"abc") for _ in range(r.randint(60, 400)))]))
    masks, *_ = repeated_starts(pieces, 50)
    n = Counter(p[i:i + 50] for p in pieces for i in range(len(p) - 49))
    for p, m in zip(pieces, masks):
        assert m.tolist() == [n[p[i:i + 50]] > 1 for i in range(len(p) - 49)]


def expected_removal(rows, length):
    raw = [(i, (t or "").encode()) for i, t, *_ in rows]
    n = Counter(b[k:k + length] for _, b in raw for k in range(len(b) - length + 1))
    out = Counter()
    for i, b in raw:
        gone = [False] * len(b)
        for k in range(len(b) - length + 1):
            if n[b[k:k + length]] > 1:
                gone[k:k + length] = [True] * length
        left = bytes(x for x, g in zip(b, gone) if not g)
        spans = sum(g and not p for g, p in zip(gone, [False] + gone))
        out[(i, len(b), sum(gone), spans, hashlib.sha256(left).hexdigest(), left)] += 1
    return out


@pytest.mark.parametrize("stretches,few", [(3000, 1_000_000), (2, 0)])
def test_remove_repeats(docs, rows, monkeypatch, stretches, few):
    """The second case deals every frequent anchor to several shards and joins everything by shuffle."""
    monkeypatch.setattr(suffix_dedup, "SHARD_STRETCHES", stretches)
    monkeypatch.setattr(suffix_dedup, "BROADCAST_ROWS", few)
    got = Counter(tuple(bytes(x) if isinstance(x, bytearray) else x for x in r)
                  for r in remove_repeats(docs).collect())
    assert got == expected_removal(rows, 200)


def test_remove_repeats_across_the_seams_of_pieces(docs, rows, monkeypatch):
    """Texts far longer than a piece: strings that start on either side of a seam are found."""
    monkeypatch.setattr(suffix_dedup, "PIECE", 256)
    got = Counter(tuple(bytes(x) if isinstance(x, bytearray) else x for x in r)
                  for r in remove_repeats(docs, length=60).collect())
    assert got == expected_removal(rows, 60)


@pytest.mark.parametrize("seed", range(6))
def test_no_string_occurs_twice_in_a_stretch(seed):
    """Which is why an anchor of one distinct stretch needs no suffix array."""
    r = random.Random(seed)
    text = r.choice([b"xyz" * 300, b"ab" * 200 + bytes(r.choices(b"ab", k=500)), bytes(r.choices(b"abc ", k=900))])
    anchor, first, n, at = suffix_dedup.stretches(np.frombuffer(text, np.uint8), 40)
    assert n.sum() == len(text) - 39
    assert ((first + n - 1 <= at) & (at <= first + 40 - suffix_dedup.GRAM)).all()     # in every string of the stretch
    for start, k in zip(first.tolist(), n.tolist()):
        strings = [text[i:i + 40] for i in range(start, start + k)]
        assert len(set(strings)) == k


@pytest.mark.parametrize("seed", range(10))
def test_stretches_that_share_are_kept(seed):
    r = random.Random(seed)
    core = bytes(r.choices(b"abc", k=30))
    pieces, at = [], []
    for _ in range(12):
        left, right = bytes(r.choices(b"ab", k=r.randint(0, 12))), bytes(r.choices(b"ab", k=r.randint(0, 12)))
        pieces.append(left + core + right)
        at.append(len(left))
    kept = suffix_dedup.may_share(pieces, at, 36)
    for i, (p, a) in enumerate(zip(pieces, at)):
        most = max(suffix_dedup._common(p[a:], q[b:]) + suffix_dedup._common(p[:a][::-1], q[:b][::-1])
                   for j, (q, b) in enumerate(zip(pieces, at)) if j != i)
        assert kept[i] or most < 36
    x, y = core, core[:17] + b"!" + core[18:]
    assert suffix_dedup._common(x, y) == 17 and suffix_dedup._common(x, x[:9]) == 9 and suffix_dedup._common(b"", x) == 0


def test_remove_repeats_empty(no_docs):
    assert remove_repeats(no_docs).count() == 0


# ---------------------------------------------------------------- contamination

def words(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(LOWER))


@pytest.mark.parametrize("seed", range(10))
def test_automaton_lengths(seed):
    r = random.Random(seed)
    items = [(str(k), [r.randint(0, 3) for _ in range(r.randint(0, 14))]) for k in range(5)]
    a = SuffixAutomaton(items, 4)
    stream = [r.randint(0, 3) for _ in range(60)]
    found: set = set()
    longest, back = a.stream(stream, found)
    runs = {tuple(w[i:j]) for _, w in items for i in range(len(w)) for j in range(i + 1, len(w) + 1)}
    wins = defaultdict(set)
    for name, w in items:
        k = min(4, len(w))
        for i in range(len(w) - k + 1 if k else 0):
            wins[tuple(w[i:i + k])].add(name)
    names = set()
    for e in range(1, len(stream) + 1):
        assert longest[e - 1] == max([n for n in range(1, e + 1) if tuple(stream[e - n:e]) in runs], default=0)
        ends = [n for n in range(1, 5) if n <= e and tuple(stream[e - n:e]) in wins]
        assert back[e - 1] == max(ends, default=0)
        for n in ends:
            names |= wins[tuple(stream[e - n:e])]
    assert found == names


@pytest.fixture(scope="module")
def bench_rows(rows):
    texts = [t for _, t, *_ in rows if t]
    return [(1, " ".join(texts[0].split()[5:40])), (10, texts[25][:200].upper()), (2, "One, TWO!"), (3, None), (4, ""),
            (2, "one two"), (None, "x"), (5, " ".join(texts[30].split()[:9])), (6, "never seen anywhere " * 6)]


def expected_hits(rows, bench_rows):
    wins = defaultdict(set)
    for i, t in bench_rows:
        w = words(t)
        k = min(10, len(w))
        for j in range(len(w) - k + 1 if k else 0):
            wins[tuple(w[j:j + k])].add("null" if i is None else str(i))
    out = []
    for i, t, *_ in rows:
        w = words(t)
        hit, items = [False] * len(w), set()
        for k in {len(x) for x in wins}:
            for j in range(len(w) - k + 1):
                if tuple(w[j:j + k]) in wins:
                    items |= wins[tuple(w[j:j + k])]
                    hit[j:j + k] = [True] * k
        out.append((i, t, len(w), sum(hit), sorted(items)))
    return out


@pytest.mark.parametrize("block", [1 << 20, 100])
def test_contamination(spark, docs, rows, bench_rows, monkeypatch, block):
    from cashbook.llm import decontaminate
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", block)
    bench = spark.createDataFrame(bench_rows, "item_id long, text string")
    got = contamination(docs, bench).collect()
    want = expected_hits(rows, bench_rows)
    assert Counter((r.row.doc_id, r.row.text, r.n_words, r.n_hit, tuple(r["items"])) for r in got) == Counter(
        (i, t, n, h, tuple(x)) for i, t, n, h, x in want)
    assert any(h for *_, h, _ in want)
    for r in got:
        if not r.n_hit:
            assert r.cleaned == r.row.text
        else:
            assert len(words(r.cleaned)) == r.n_words - r.n_hit


def test_clean_documents(spark, docs, bench_rows, rows):
    bench = spark.createDataFrame(bench_rows, "item_id long, text string")
    out = clean_documents(docs, bench)
    assert out.columns == docs.columns
    keep = [(i, n - h) for i, _, n, h, _ in expected_hits(rows, bench_rows) if n == 0 or h <= 0.5 * n]
    assert Counter((r.doc_id, len(words(r.text))) for r in out.collect()) == Counter(keep)
    assert all(r.n_chars is None or r.n_chars == len(r.text) for r in out.collect())


def test_contamination_empty(spark, docs, no_docs, bench_rows):
    none = spark.createDataFrame([], "item_id long, text string")
    assert contamination(docs, none).filter("n_hit > 0").count() == 0
    assert contamination(no_docs, spark.createDataFrame(bench_rows, "item_id long, text string")).count() == 0


# ---------------------------------------------------------------- similar documents

def shingles(t, width):
    w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOWER))
    if len(w) < width:
        return frozenset([tuple(w)]) if w else frozenset()
    return frozenset(tuple(w[i:i + width]) for i in range(len(w) - width + 1))


def expected_components(rows, width, percent):
    sets = [shingles(t, width) for _, t, *_ in rows]
    label = list(range(len(rows)))

    def find(x):
        while label[x] != x:
            x = label[x]
        return x
    for i in range(len(rows)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                label[find(i)] = find(j)
    groups = defaultdict(list)
    for i in range(len(rows)):
        groups[find(i)].append(i)
    least = {}
    for members in groups.values():
        ids = [rows[i][0] for i in members if rows[i][0] is not None]
        for i in members:
            least[i] = min(ids, default=None) if sets[i] else rows[i][0]
    return sets, least, groups


@pytest.mark.parametrize("width,percent,list_rows", [(4, 85, 1024), (4, 60, 3), (5, 80, 1024)])
def test_similar_documents(docs, rows, monkeypatch, width, percent, list_rows):
    from cashbook.llm import jaccard_join
    monkeypatch.setattr(jaccard_join, "LIST_ROWS", list_rows)
    monkeypatch.setattr(jaccard_join, "BROADCAST_ROWS", 0 if list_rows == 3 else 200_000)
    sets, least, _ = expected_components(rows, width, percent)
    got = Counter(tuple(r) for r in similar_documents(docs, width=width, percent=percent).collect())
    assert got == Counter((rows[i][0], len(sets[i]), least[i]) for i in range(len(rows)))


def test_one_per_group(docs, rows):
    sets, least, groups = expected_components(rows, 5, 80)
    out = one_per_group(docs)
    assert out.columns == docs.columns
    got = out.collect()
    words_of = [(r.doc_id, r.text) for r in got if shingles(r.text, 5)]
    alone = [(r.doc_id, r.text) for r in got if not shingles(r.text, 5)]
    assert Counter(alone) == Counter((i, t) for i, t, *_ in rows if not shingles(t, 5))
    want = []
    for members in groups.values():
        if sets[members[0]]:
            want.append(min((rows[i][0] is None, rows[i][0] or 0) for i in members))
    assert Counter((i is None, i or 0) for i, _ in words_of) == Counter(want)


def test_members_linked_past_their_head(spark):
    """Copies that differ in the last word from each other, but in two shingles from the third text of their group."""
    rows = []
    for k in range(60):
        w = [f"w{k}x{i}" for i in range(19)]
        for j, t in enumerate((w[:17] + ["other"] + w[18:], w, w[:18] + ["last"])):
            rows.append((3 * k + j, " ".join(t)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    sets, least, _ = expected_components(rows, 4, 85)
    assert all(least[3 * k + 2] == 3 * k + 1 for k in range(60))
    got = Counter(tuple(r) for r in similar_documents(df).collect())
    assert got == Counter((rows[i][0], len(sets[i]), least[i]) for i in range(len(rows)))
    assert one_per_group(df, width=4, percent=85).count() == 120


def test_prefixes_meet():
    for n in range(1, 200):
        for m in range(n, 230):
            for percent in (60, 80, 85):
                if 100 * n >= percent * m:               # sizes that can be linked
                    least = -(-percent * (n + m) // (100 + percent))
                    if least <= n:
                        assert n - least < prefix_length(n, percent) and m - least < prefix_length(m, percent)


def test_similar_empty(no_docs):
    assert similar_documents(no_docs).count() == 0 and one_per_group(no_docs).count() == 0
