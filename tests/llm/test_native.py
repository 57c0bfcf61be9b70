"""Exact dedup, mixing and sharding against plain Python."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from cashbook.llm.exact_dedup import exact_dedup, split_directory
from cashbook.llm.mixing import mix, mixed_documents
from cashbook.llm.sharding import shard

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def expected_dedup(rows):
    groups = defaultdict(list)
    for i, t, *_ in rows:
        groups[re.sub(r"[\x20\x09-\x0D]", "", t or "")].append((i, t))
    out = Counter()
    for norm, members in groups.items():
        members.sort(key=lambda x: (-len(x[1] or ""), x[0] is None, x[0] or 0))
        for k, (i, _) in enumerate(members):
            out[(i, members[0][0], len(members), k == 0, hashlib.sha256(norm.encode()).hexdigest())] += 1
    return out


@pytest.mark.parametrize("key_bits,bucket_rows", [(64, None), (64, 3), (3, 4), (1, 2)])
def test_exact_dedup(docs, rows, key_bits, bucket_rows):
    got = Counter(tuple(r)[:5] for r in exact_dedup(docs, key_bits=key_bits, bucket_rows=bucket_rows).collect())
    assert got == expected_dedup(rows)


def test_owners_settle_their_buckets(docs, monkeypatch):
    """Entries go to their buckets by one exchange on the bucket, and are put together there."""
    from cashbook.llm import exact_dedup as module
    plans = {}
    keep = module.stored
    monkeypatch.setattr(module, "stored", lambda df, tag: plans.setdefault(
        tag, df._jdf.queryExecution().executedPlan().toString()) and keep(df, tag))
    exact_dedup(docs, bucket_rows=3).count()
    last = [x for x in plans["dedup-index"].splitlines() if "Exchange" in x][0]
    assert "hashpartitioning(bucket" in last and "key" not in last.split("hashpartitioning(")[1].split(",")[0]
    depth, directory = split_directory(docs.selectExpr("xxhash64(text) AS key").distinct(), 3)
    assert len(directory) == 1 << depth and len(set(directory)) > 4


def test_exact_dedup_empty(no_docs):
    assert exact_dedup(no_docs).count() == 0


def test_directory_splits_until_within_capacity(spark):
    import numpy as np
    keys = np.random.default_rng(1).integers(-2**63, 2**63 - 1, 3000)
    entries = spark.createDataFrame([(int(k),) for k in keys], "key long")
    depth, directory = split_directory(entries, 100)
    assert len(directory) == 1 << depth
    held = Counter(directory[(int(k) & (2**64 - 1)) >> (64 - depth)] for k in keys)
    assert max(held.values()) <= 100 and len(held) > 30


def test_directory_keeps_a_single_key_chained(spark):
    entries = spark.createDataFrame([(5,)] * 50 + [(-7,)], "key long")
    depth, directory = split_directory(entries, 10)
    assert depth >= 1 and directory[0] != directory[-1]


def targets(sizes, cap=3.0, weights=(1, 2, 3)):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    total, capped = sum(sizes.values()), set()
    while True:
        free = [s for s in names if s not in capped]
        level = (total - sum(cap * sizes[s] for s in capped)) / sum(w[s] for s in free) if free else 0
        over = {s for s in free if level * w[s] > cap * sizes[s] + 1e-9}
        if not over:
            return {s: cap * sizes[s] if s in capped else level * w[s] for s in names}
        capped |= over


@pytest.mark.parametrize("fan_in", [4, 64])
def test_mixing(docs, rows, fan_in):
    sizes = Counter()
    for _, t, _, s, *_ in rows:
        sizes[s] += len(WORD.findall(t or ""))
    want = targets(sizes)
    got = mix(docs, fan_in=fan_in).collect()
    assert Counter((r.doc_id, r.size, r.source) for r in got) == Counter(
        (i, len(WORD.findall(t or "")), s) for i, t, _, s, *_ in rows)
    taken, largest = Counter(), Counter()
    for r in got:
        assert r.source_size == sizes[r.source] and abs(r.target - want[r.source]) < 1e-6
        assert r.taken == r.copies * r["size"] and 0 <= r.taken <= 3 * r["size"]
        taken[r.source] += r.taken
        largest[r.source] = max(largest[r.source], 3 * r["size"])
    for s in sizes:
        assert abs(taken[s] - want[s]) <= largest[s]
    again = mix(docs.repartition(5), fan_in=fan_in).collect()
    assert Counter(map(tuple, got)) == Counter(map(tuple, again))


def test_mixing_keeps_expectations(spark):
    """Over many seeds a document's mean copies approach its source's rate."""
    d = spark.createDataFrame([(i, "w " * (1 + i % 9), "a" if i % 4 else "b") for i in range(120)],
                              "doc_id long, text string, source string").cache()
    total, rate = Counter(), {}
    for seed in range(6):
        for r in mix(d, fan_in=8, seed=1000 * seed).collect():
            total[r.source] += r.copies * r["size"]
            rate[r.source] = r.target
    for s, v in rate.items():
        assert abs(total[s] / 6 - v) < 10


def test_mixed_documents(docs, rows):
    want = {(r.doc_id, r["size"], r.source): r.copies for r in mix(docs).collect()}
    out = mixed_documents(docs)
    assert out.columns == docs.columns
    got = Counter((r.doc_id, r.text, r.source, r.part) for r in out.collect())
    for i, t, _, s, _, _, _, part, *_ in rows:
        n = len(WORD.findall(t or ""))
        assert got[(i, t, s, part)] == (want[(i, n, s)] if n else 1)


def test_mixing_empty(no_docs):
    assert mix(no_docs).count() == 0 and mixed_documents(no_docs).count() == 0


@settings(max_examples=40, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 4), st.integers(0, 50)), min_size=1, max_size=30))
def test_target_rule_sums_to_everything(pairs):
    sizes = Counter()
    for s, n in pairs:
        sizes[f"s{s}"] += n
    if sum(sizes.values()):
        assert abs(sum(targets(sizes).values()) - sum(sizes.values())) < 1e-6


def test_sharding_query_derives_from_whole_rows(spark, monkeypatch):
    from cashbook.llm import queries, sharding
    source, made = "/root/testdata/sf0.001", []
    monkeypatch.setattr(sharding, "shard", lambda *a, **k: made.append(shard(*a, **k)) or made[-1])
    got = queries.op9_sharding(spark, source).collect()
    docs = spark.read.parquet(f"{source}/documents.parquet")
    assert [m.columns for m in made] == [docs.columns + ["shard", "slot"]]
    want = Counter((r.doc_id, len((r.text or "").encode()) + 1, zlib.crc32((r.text or "").encode()), r.shard, r.slot)
                   for r in made[0].collect())
    assert Counter((r.doc_id, r["size"], r.text_crc32, r.shard, r.slot) for r in got) == want
    assert sum(want.values()) == docs.count()


@pytest.mark.parametrize("n_shards,parts", [(4, 4), (16, 16), (1, 1)])
def test_sharding(docs, rows, n_shards, parts):
    out = shard(docs, n_shards, parts=parts)
    assert out.columns == docs.columns + ["shard", "slot"]
    got = out.collect()
    assert Counter(tuple(r)[:8] for r in got) == Counter(tuple(r)[:8] for r in rows)
    size, slots = Counter(), defaultdict(list)
    units = Counter((i, t or "") for i, t, *_ in rows)
    for r in got:
        size[r.shard] += len((r.text or "").encode()) + 1
        slots[r.shard].append(r.slot)
    assert set(size) <= set(range(n_shards))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    total, largest = sum(size.values()), max(n * (len(t.encode()) + 1) for (_, t), n in units.items())
    assert all(abs(size[k] - total / n_shards) <= total / n_shards * 0.02 + largest for k in range(n_shards))


def test_sharding_even_on_many_small_rows(spark):
    d = spark.range(4000).selectExpr("id AS doc_id", "repeat('a', cast(id % 50 as int)) AS text")
    size = Counter()
    for r in shard(d, 8).collect():
        size[r.shard] += len(r.text) + 1
    mean = sum(size.values()) / 8
    assert all(abs(v - mean) <= 0.01 * mean for v in size.values())


def test_sharding_one_text_for_all(spark):
    """A group of equal texts is cut by id when it is larger than a shard."""
    d = spark.range(3000).selectExpr("id AS doc_id", "'the same text' AS text")
    n = Counter(r.shard for r in shard(d, 4).collect())
    assert len(n) == 4 and max(n.values()) - min(n.values()) <= 30


def test_sharding_keeps_columns_of_its_own_names(spark):
    d = spark.createDataFrame([(i, f"text {i}", i * 10, f"s{i}", i, -i) for i in range(20)],
                              "doc_id long, text string, Shard int, slot string, part int, slot_in int")
    out = shard(d, 4)
    assert out.columns == ["doc_id", "text", "Shard_in", "slot_in_in", "part", "slot_in", "shard", "slot"]
    rows = out.collect()
    assert all((r["Shard_in"], r["slot_in_in"], r["part"], r["slot_in"]) == (10 * r.doc_id, f"s{r.doc_id}", r.doc_id, -r.doc_id)
               for r in rows) and len(rows) == 20


def test_ranges_follow_the_bytes(spark, monkeypatch):
    from cashbook.llm import sharding
    monkeypatch.setattr(sharding, "RANGE_BYTES", 500)
    asked = []
    cut = sharding.splitters
    monkeypatch.setattr(sharding, "splitters", lambda keys, n, t: asked.append(n) or cut(keys, n, t))
    d = spark.range(2000).selectExpr("id AS doc_id", "repeat('b', 49) AS text")        # 100,000 bytes
    assert shard(d, 4).select("shard", "slot").distinct().count() == 2000
    monkeypatch.setattr(sharding, "RANGE_BYTES", 1 << 30)
    shard(d, 4)
    assert asked == [4 * 50, 4 * 16]


def test_sharding_empty(no_docs):
    assert shard(no_docs, 16).count() == 0
