"""Ranked search, collocations and SimHash against brute force."""
import math
import random
import re
from collections import Counter

import numpy as np
import pytest
import xxhash

from cashbook.llm import phrases, search, simhash

AZ = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# -------------------------------------------------------------------- SimHash

def brute_fingerprint(text, width=4):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", (text or "").translate(AZ)) if w]
    if not words:
        return 0
    runs = [words] if len(words) < width else [words[i:i + width] for i in range(len(words) - width + 1)]
    hashes = [xxhash.xxh64_intdigest(" ".join(r).encode(), 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints, most=4):
    values = sorted(set(prints))
    root = {v: v for v in values}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i, a in enumerate(values):
        for b in values[:i]:
            if (a ^ b).bit_count() <= most:
                root[find(a)] = find(b)
    return {v: find(v) for v in values}


def expected_simhash(rows):
    prints = [brute_fingerprint(r[1]) for r in rows]
    comp = brute_components(prints)
    least = {}
    for r, p in zip(rows, prints):
        if r[0] is not None:
            least[comp[p]] = min(least.get(comp[p], r[0]), r[0])
    return Counter((r[0], f"{p:016x}", least.get(comp[p])) for r, p in zip(rows, prints))


def test_simhash_equals_brute_force(docs, rows):
    found = simhash.simhash_components(docs)
    assert found.columns == ["doc_id", "fingerprint", "component_id"]
    assert Counter(map(tuple, found.collect())) == expected_simhash(rows)


def test_simhash_of_no_rows_and_other_id_types(spark, no_docs):
    assert simhash.simhash_components(no_docs).count() == 0
    rows = [("b", "one two three four five"), ("a", "One two\tthree four  five"), ("c", None), (None, "  ")]
    got = simhash.simhash_components(spark.createDataFrame(rows, "doc_id string, text string")).collect()
    assert {(r.doc_id, r.component_id) for r in got} == {("a", "a"), ("b", "a"), ("c", "c"), (None, "c")}


def test_long_text_counts_every_shingle():
    r = random.Random(5)
    text = " ".join(f"w{r.randint(0, 40)}" for _ in range(3000))           # over 255 shingles a byte lane
    data = np.frombuffer((text + "Q q").encode(), np.uint8)
    off = np.array([0, len(text), len(text), len(data)])
    got = simhash.fingerprints(data, off, 4).tolist()
    assert got == [brute_fingerprint(text), 0, brute_fingerprint("Q q")]


@pytest.mark.parametrize("key_rows", [8, 4096])
def test_linked_fingerprints_with_crowded_keys(spark, monkeypatch, key_rows):
    """Clusters around centres, so that keys hold far more fingerprints than one block."""
    monkeypatch.setattr(simhash, "KEY_ROWS", key_rows)
    r = random.Random(8)
    values = {0, 1, (1 << 64) - 1}
    for _ in range(4):
        centre = r.getrandbits(64)
        for _ in range(60):
            x = centre
            for _ in range(r.randint(0, 7)):
                x ^= 1 << r.randrange(64)
            values.add(x)
    values |= {r.getrandbits(64) for _ in range(50)}
    signed = {v: simhash._signed(v) for v in values}
    prints = spark.createDataFrame([(v,) for v in signed.values()], "fp long")
    label = {row.node: row.label for row in simhash.fingerprint_components(prints).collect()}
    got = {}
    for v, s in signed.items():
        got.setdefault(label.get(s, s), set()).add(v)
    want = {}
    for v, root in brute_components(values).items():
        want.setdefault(root, set()).add(v)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))


def test_every_close_pair_shares_a_variant():
    r = random.Random(2)
    for _ in range(300):
        a = r.getrandbits(64)
        b = a
        for _ in range(4):
            b ^= 1 << r.randrange(64)
        assert any(a & m == b & m for m in (x & (1 << 64) - 1 for x in simhash.VARIANT_MASK))


# --------------------------------------------------------------- ranked search

def brute_terms(text):
    return re.findall(search.TERM_PATTERN, (text or "").translate(AZ))


def brute_search(docs, items, k):
    rows = [(i, Counter(brute_terms(t))) for i, t in docs]
    rows = [(i, c) for i, c in rows if c]
    n_docs, n_terms = len(rows), sum(c.total() for _, c in rows)
    df = Counter(t for _, c in rows for t in c)
    asked = {}
    for i, t in items:
        asked.setdefault(i, set()).update(brute_terms(t))
    out = []
    for item, terms in asked.items():
        scored = []
        for i, c in rows:
            m = 50 + (50 * c.total() * n_docs) // n_terms
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) *
                    ((1_000_000_000 * c[t]) // (1000 * c[t] + 20 * m)) for t in terms if c[t])
            if s > 0:
                scored.append((-s, i is None, i or 0, i))
        out += [(item, rank, x[3], -x[0]) for rank, x in enumerate(sorted(scored)[:k], 1)]
    return Counter(out)


ITEMS = [(1, "Alpha1 beta2 gamma3 Été4 straße5 omega6"), (2, "kappa7 kappa7 zeta8"), (3, None), (4, "  ..;"),
         (5, "x ab nowhere"), (None, "theta9 iota10"), (6, "mu11"), (6, "nu12 mu11")]


@pytest.mark.parametrize("k, shard, first", [(50, 1 << 14, 128), (3, 7, 1), (1, 20, 2)])
def test_search_equals_brute_force(spark, docs, rows, monkeypatch, k, shard, first):
    monkeypatch.setattr(search, "SHARD_DOCS", shard)
    monkeypatch.setattr(search, "FIRST_READ", first)
    items = spark.createDataFrame([(*x, "d") for x in ITEMS], "item_id long, text string, doc_id string")
    found = search.ranked_search(docs, items, k)
    assert found.columns == ["item", "rank", "doc", "score"]
    assert Counter(map(tuple, found.collect())) == brute_search([r[:2] for r in rows], ITEMS, k)


def test_search_in_blocks_of_items(spark, docs, rows, monkeypatch):
    monkeypatch.setattr(search, "BLOCK_PAIRS", 4)
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = Counter(map(tuple, search.ranked_search(docs, items, 10).collect()))
    assert got == brute_search([r[:2] for r in rows], ITEMS, 10)


def test_search_without_rows(spark, docs, no_docs):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert search.ranked_search(no_docs, items).count() == 0
    assert search.ranked_search(docs, items.limit(0)).count() == 0


def test_reading_stops_before_the_end_of_the_lists():
    """The documents with the rare term are short: the rest of the long list cannot matter."""
    n = 100_000
    single = np.random.default_rng(2).integers(300_000, 800_000, n)
    single[:60] = np.arange(800_000, 800_060)
    common = np.argsort(-single, kind="stable")
    reads = []

    class Impacts:
        def __init__(self, values):
            self.values = values

        def __getitem__(self, at):
            if isinstance(at, slice):
                reads.append(at.stop)
            return self.values[at]
    lists = [(9000, np.arange(60), single[:60]), (10, common, single[common])]
    docs, scores = search.resolve([lists[0], (10, common, Impacts(single[common]))], single, 50, 1)
    full = np.zeros(n, dtype=np.int64)
    for w, d, i in lists:
        full[d] += w * i
    assert max(reads) < n // 10
    assert dict(zip(docs.tolist(), scores.tolist())) == {d: int(full[d]) for d in np.argsort(-full)[:50].tolist()}


# ---------------------------------------------------------------- collocations

def brute_collocations(rows, least, top, percent=80):
    counts, total = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(AZ)):
            words = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(words)
            for size in range(1, 5):
                for i in range(len(words) - size + 1):
                    counts[lang, tuple(words[i:i + size])] += 1
    cand = {p: a for p, a in counts.items() if a >= least and len(p[1]) > 1}
    out = {}
    for (lang, p), a in cand.items():
        if any(100 * b >= percent * a for (other, q), b in cand.items() if other == lang and len(q) > len(p)
               and any(q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1))):
            continue
        score, k = min((2_000_000 * a // (counts[lang, p[:k]] + counts[lang, p[k:]]), k) for k in range(1, len(p)))
        out.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), counts[lang, p[:k]], counts[lang, p[k:]]))
    return Counter((lang, rank, p.decode(), -a, left, right, total[lang], -s) for lang, found in out.items()
                   for rank, (s, a, p, left, right) in enumerate(sorted(found)[:top], 1))


def phrase_rows():
    r = random.Random(3)
    vocabulary = ["new", "york", "City", "los", "ángeles", "(a)", "b-c", "of", "the", "\x01odd", "x"]
    weights = [5, 5, 4, 3, 3, 2, 2, 9, 12, 1, 2]
    rows = []
    for i in range(120):
        words = r.choices(vocabulary, weights, k=r.randint(0, 60))
        text = "".join(w + r.choice([" ", " ", " ", "  ", "\t", ", ", ". ", "\n", "!?"]) for w in words)
        rows.append((text, r.choice(["en", "en", "en", "es", None, "und", "", "a\nb"])))
    rows += [("the city of new york " * 40, "en")] * 3 + [(None, "en"), ("", None), (" .,\n", "fr")]
    return rows


@pytest.mark.parametrize("chunk, range_bytes, least", [(1 << 20, 16 << 20, 5), (50, 300, 5), (400, 1000, 2)])
def test_collocations_equal_brute_force(spark, monkeypatch, chunk, range_bytes, least):
    monkeypatch.setattr(phrases, "CHUNK_WORDS", chunk)
    monkeypatch.setattr(phrases, "RANGE_BYTES", range_bytes)
    rows = phrase_rows()
    df = spark.createDataFrame([(t, lang, "w", 1) for t, lang in rows], "text string, lang string, words string, a int")
    found = phrases.collocations(df.repartition(3), least=least, top=40)
    assert found.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    want = brute_collocations(rows, least, 40)
    assert Counter(map(tuple, found.collect())) == want and len(want) > 40


def test_collocations_with_more_words_than_packed_keys_hold(spark, monkeypatch):
    monkeypatch.setattr(phrases, "NUMBER_BITS", 3)
    rows = phrase_rows()
    df = spark.createDataFrame(rows, "text string, lang string")
    assert Counter(map(tuple, phrases.collocations(df, least=9).collect())) == brute_collocations(rows, 9, 2000)


def test_collocations_of_documents_with_odd_rows(docs, rows, no_docs):
    got = Counter(map(tuple, phrases.collocations(docs, least=3).collect()))
    assert got == brute_collocations([r[1:3] for r in rows], 3, 2000)
    assert phrases.collocations(no_docs).count() == 0


def test_scores_beyond_64_bits(spark):
    """2,000,000 a and 100 a may pass 2^63: the merge works in whole numbers of any size."""
    a, left, right = 9 * 10**16, 4 * 10**17 + 7, 10**17 + 1
    both = spark.createDataFrame([(["en", "x", "y"], 0, a, [left], a - 1 - a // 5), (["en", "x", "y"], 1, a, [right], None),
                                  (["en", "z", "z"], 0, a, [left], a - a // 5), (["en", "z", "z"], 1, a, [right], None)],
                                 "words array<string>, side int, a long, parts array<long>, best long")
    got = [tuple(r) for r in phrases._scored(both, 30, 80).collect()]
    assert got == [("en", "x y", a, left, right, 2_000_000 * a // (left + right))]
