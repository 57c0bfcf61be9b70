"""The pipeline: each stage's decisions on its own input, and the whole run."""

import re
from collections import Counter

import corpus_pipeline as P
from cashbook.llm.common import stored, table

SF = "/root/testdata/sf0.01"


def test_stages(spark):
    docs = table(spark, SF, "documents")
    before = docs.collect()
    columns = docs.columns
    assert [n for n, _ in P.STAGES] == ["toxicity", "jaccard_join", "decontamination", "mixing", "sharding"]
    for name, stage in P.STAGES:
        docs = stored(stage(spark, docs, SF), "test-pipeline")
        rows = docs.collect()
        if name != "sharding":
            assert docs.columns == columns
        ids, old = {r.doc_id for r in rows}, {r.doc_id for r in before}
        assert ids <= old
        if name == "toxicity":
            labels = {r.doc_id: r.toxic for r in table(spark, SF, "labels").collect()}
            clean = [i for i in old if labels.get(i) == 0]
            assert sum(i in ids for i in clean) > 0.95 * len(clean)
        if name == "jaccard_join":
            w = [tuple(re.findall(r"[^\x20\x09-\x0D]+", r.text.lower())) for r in rows]
            assert max(Counter(x for x in w if x).values()) == 1
        if name == "mixing":
            assert max(Counter(r.doc_id for r in rows).values()) <= 3
        if name == "sharding":
            assert len(rows) == len(before)
            slots = Counter((r.shard, r.slot) for r in rows)
            assert max(slots.values()) == 1
            assert all(r.slot < n for n in [len(rows)] for r in rows)
            assert docs.columns == columns + ["shard", "slot"]
        before = rows


def test_batches_to_python_tasks_are_bounded(spark):
    """Ten thousand long rows would be one batch on both sides of a task."""
    import pyarrow as pa
    from pyspark.sql import functions as F
    from cashbook.llm import common

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows])], names=["n"])
    common.bounded_batches(spark)
    rows = spark.range(0, 10_000, 1, 1).select("id", F.repeat(F.lit("x"), 2000).alias("text"))
    got = [r.n for r in rows.mapInArrow(sizes, "n long").collect()]
    assert sum(got) == 10_000 and max(got) * 2000 <= 1.25 * common.BATCH_BYTES
    own, spark_set = "16777216", spark.conf.get(common.BATCH_CONF)
    spark.conf.set(common.BATCH_CONF, own)
    try:
        common.bounded_batches(spark)
        assert spark.conf.get(common.BATCH_CONF).startswith(own)
    finally:
        spark.conf.set(common.BATCH_CONF, spark_set)


def test_hashing_keeps_no_more_than_a_slice():
    """Texts of several slices, and a word of more than one: the hashes of the words alone, no longer powers kept."""
    import numpy as np
    from cashbook.llm import common
    words = [b"a", b"bc", b"z" * (common.SLICE_BYTES + 9), b"a", b"q" * 999] * 2 + [b"%d" % i for i in range(300_000)]
    data = np.frombuffer(b" ".join(words), np.uint8)
    starts, ends, _ = common.word_spans(data, np.array([0, len(data)]), common.NOT_SPACE)
    got = common.word_hashes(data, starts, ends)
    assert len(got) == len(words)
    for i in [*range(10), 11, 150_000, len(words) - 1]:
        one = np.frombuffer(words[i], np.uint8)
        assert got[i] == common.word_hashes(one, np.array([0]), np.array([len(one)]))[0]
    assert got[0] == got[3] == got[5] and got[2] == got[7] and len(common.word_hashes(data, starts[:0], ends[:0])) == 0
    assert all(len(x) <= common.SLICE_BYTES + 1 for x in common._POWERS.values())
