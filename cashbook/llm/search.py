"""Ranked lexical search: the best documents for each item, by no-random-access reads (NRA).

One scan counts, for each document, its terms and those that items ask for.
The corpus figures (documents, terms, documents per term) are sums over that
table.  Documents are then searched in shards, each inside one task: the
postings of a shard are sorted by impact term by term, and for each item the
lists of its terms are read from the top, in blocks.  A document's score lies
between the sum of the impacts read for it and that sum plus, for each list in
which it was not met, the last impact read there; a list whose last impact is
below what a single occurrence would give the document cannot hold it any
more.  Reading goes on until no document that may still reach the k-th score
has an open interval: then members, ties and scores are exact.  The best k of
each task meet in one ranking per item.

Only the items' terms are sent to the tasks.  Items are taken in blocks of at
most ``BLOCK_PAIRS`` (item, term) pairs (one item at least), each block with a
scan of its own, so what is sent does not grow with the items or documents.
"""

from __future__ import annotations

import functools
import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cashbook.llm.common import LOWER, byte_class, stored, text_slices, word_spans

#: Terms: maximal runs of letters, digits and characters above ASCII.
TERM = byte_class([(0x00, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7F)])
TERM_PATTERN = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER_AZ, LOWER_AZ = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: (item, term) pairs looked up in one scan of the documents.
BLOCK_PAIRS = 200_000
#: Postings and documents that a task searches at once.
SHARD_POSTINGS, SHARD_DOCS = 1 << 21, 1 << 14
#: Entries read from every list at first, and how much further each next read goes.
FIRST_READ, READ_GROWTH = 128, 4


def term_array(low: np.ndarray, starts: np.ndarray, ends: np.ndarray, keep: np.ndarray) -> pa.Array:
    """The words of a slice as one binary array."""
    off = np.zeros(len(starts) + 1, dtype=np.int32)
    np.cumsum(ends - starts, out=off[1:])
    return pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(off), pa.py_buffer(low[keep[low]])])


def asked_terms(items: DataFrame, item_col: str, text_col: str) -> DataFrame:
    """(item, term), once each; rows that share an item id are one item, a null id is an id like any other."""
    text = F.translate(F.coalesce(F.col(text_col).cast("string"), F.lit("")), UPPER_AZ, LOWER_AZ)
    terms = F.regexp_extract_all(text, F.lit(f"({TERM_PATTERN})"), F.lit(1))
    return items.select(F.col(item_col).alias("item"), F.explode(F.array_distinct(terms)).alias("term")).distinct()


def term_counts(docs: DataFrame, terms: list[str]) -> DataFrame:
    """One row per document with a term: id, n (all its terms), tids and tfs (asked terms and their counts)."""
    sent = docs.sparkSession.sparkContext.broadcast(pa.array([t.encode() for t in terms], pa.binary()))

    def count(batches):
        asked = sent.value
        for batch in batches:
            for lo, hi, data, off in text_slices(batch, "text"):
                low = LOWER[data]
                starts, ends, first = word_spans(low, off, TERM)
                n = np.diff(first)
                found = pc.index_in(term_array(low, starts, ends, TERM), value_set=asked)
                at = found.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
                doc = np.repeat(np.arange(hi - lo), n)
                pairs, tf = np.unique((doc * len(asked) + at)[at >= 0], return_counts=True)
                owner, tid = np.divmod(pairs, max(len(asked), 1))
                ends_of = np.searchsorted(owner, np.arange(hi - lo + 1)).astype(np.int32)
                rows = pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), pa.array(n.astype(np.int64)),
                     pa.ListArray.from_arrays(pa.array(ends_of), pa.array(tid.astype(np.int32))),
                     pa.ListArray.from_arrays(pa.array(ends_of), pa.array(tf.astype(np.int64)))],
                    names=["id", "n", "tids", "tfs"])
                yield rows.filter(pa.array(n > 0))

    kind = docs.schema["id"].dataType.simpleString()
    return docs.mapInArrow(count, f"id {kind}, n long, tids array<int>, tfs array<long>")


def resolve(lists: list[tuple[int, np.ndarray, np.ndarray]], single: np.ndarray, k: int,
            floor: int) -> tuple[np.ndarray, np.ndarray]:
    """Documents of at least the k-th score, with their exact scores, from impact-sorted lists.

    ``lists`` holds (weight, documents, impacts from high to low); ``single``
    the impact of one occurrence in each document, the least it can have in a
    list; ``floor`` a score that k documents are known to reach.
    """
    lower = np.zeros(len(single), dtype=np.int64)
    met = np.zeros((len(lists), len(single)), dtype=bool)
    alive = np.arange(len(single))
    begin, size = 0, FIRST_READ
    while True:
        slack = np.zeros(len(alive), dtype=np.int64)
        for t, (weight, docs, impacts) in enumerate(lists):
            read = docs[begin:begin + size]
            lower[read] += weight * impacts[begin:begin + size]
            met[t, read] = True
            if begin + size < len(docs):
                last = impacts[begin + size - 1]
                may = ~met[t, alive] & (single[alive] <= last)
                slack += np.where(may, weight * last, 0)
        known = lower[alive]
        if len(known) >= k:
            floor = max(floor, int(np.partition(known, len(known) - k)[len(known) - k]))
        floor = max(floor, 1)
        keep = known + slack >= floor
        alive = alive[keep]
        if not slack[keep].any():
            return alive, lower[alive]
        begin, size = begin + size, size * READ_GROWTH


def _best(found: pa.Table, k: int) -> pa.Table:
    order = pc.sort_indices(found, sort_keys=[("score", "descending"), ("id", "ascending")], null_placement="at_end")
    return found.take(order[:k])


def _search(counts: DataFrame, asked: list[list[int]], weight: list[int], n_docs: int, n_terms: int,
            k: int) -> DataFrame:
    """(q, id, score): the best k of each task for each item q."""
    sent = counts.sparkSession.sparkContext.broadcast((asked, weight))

    def run(batches):
        asked, weight = sent.value
        best: dict[int, pa.Table] = {}

        def search(rows: pa.Table):
            rows = rows.combine_chunks()
            if not len(rows):
                return
            tids, tfs = rows.column("tids").combine_chunks(), rows.column("tfs").combine_chunks()
            held = np.diff(tids.offsets.to_numpy())
            doc = np.repeat(np.arange(len(rows)), held)
            tid, tf = tids.flatten().to_numpy(), tfs.flatten().to_numpy()
            m = 50 + (50 * rows.column("n").to_numpy() * n_docs) // n_terms
            impact = (1_000_000_000 * tf) // (1000 * tf + 20 * m[doc])
            single = 1_000_000_000 // (1000 + 20 * m)
            order = np.lexsort((-impact, tid))
            tid, doc, impact = tid[order], doc[order], impact[order]
            cut = np.searchsorted(tid, np.arange(len(weight) + 1))
            for q, terms in enumerate(asked):
                lists = [(weight[t], doc[cut[t]:cut[t + 1]], impact[cut[t]:cut[t + 1]]) for t in terms
                         if weight[t] > 0 and cut[t] < cut[t + 1]]
                if not lists:
                    continue
                old = best.get(q)
                floor = old.column("score")[k - 1].as_py() if old is not None and len(old) == k else 1
                docs, scores = resolve(lists, single, k, floor)
                if not len(docs):
                    continue
                new = pa.table({"id": rows.column("id").take(pa.array(docs)), "score": pa.array(scores)})
                best[q] = _best(new if old is None else pa.concat_tables([old, new]), k)

        held, docs, postings = [], 0, 0
        for batch in batches:
            for lo in range(0, len(batch), 1024):
                part = batch.slice(lo, 1024)
                held.append(part)
                docs += len(part)
                postings += len(part.column(2).flatten())
                if docs >= SHARD_DOCS or postings >= SHARD_POSTINGS:
                    search(pa.Table.from_batches(held))
                    held, docs, postings = [], 0, 0
        if held:
            search(pa.Table.from_batches(held))
        for q, rows in best.items():
            for part in rows.combine_chunks().to_batches():
                yield pa.RecordBatch.from_arrays([pa.array([q] * len(part), pa.int32()), part.column(0),
                                                  part.column(1)], names=["q", "id", "score"])

    kind = counts.schema["id"].dataType.simpleString()
    return counts.filter(F.size("tids") > 0).mapInArrow(run, f"q int, id {kind}, score long")


def ranked_search(docs: DataFrame, items: DataFrame, k: int = 50, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """The ``k`` documents of highest score above 0 for each item: item, rank (from 1), doc, score.

    Equal scores are ranked by ascending id, null ids last.  Every row of
    ``docs`` is a document of its own, repeated ids included.  Rows of
    ``items`` with equal ids are one item.  Null and empty texts have no
    terms: such items have no rows, such documents are never found and count
    nowhere.  Terms held by nearly all documents weigh 0 and are not read.  Empty
    tables give an empty result.  Other columns are not read.
    """
    spark = docs.sparkSession
    pairs = stored(asked_terms(items, item_col, item_text_col), "search-items")
    blocks = max(1, math.ceil(pairs.count() / BLOCK_PAIRS))
    texts = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    item_kind = pairs.schema["item"].dataType.simpleString()
    found = []
    for block in range(blocks):
        some = pairs.filter(F.pmod(F.xxhash64("item"), F.lit(blocks)) == block)
        rows = sorted(some.collect(), key=lambda r: (r["item"] is not None, r["item"], r["term"]))
        if not rows:
            continue
        terms = sorted({r["term"] for r in rows})
        number = {t: i for i, t in enumerate(terms)}
        names = list(dict.fromkeys(r["item"] for r in rows))
        asked: list[list[int]] = [[] for _ in names]
        place = {name: q for q, name in enumerate(names)}
        for r in rows:
            asked[place[r["item"]]].append(number[r["term"]])
        counts = stored(term_counts(texts, terms), "search-counts")
        whole = counts.agg(F.count(F.lit(1)).alias("docs"), F.sum("n").alias("terms")).first()
        if not whole["docs"]:
            continue
        df = dict(counts.select(F.explode("tids").alias("tid")).groupBy("tid").count().collect())
        weight = [math.floor(1000 * math.log((2 * whole["docs"] + 2) / (2 * df.get(t, 0) + 1)))
                  for t in range(len(terms))]
        scored = _search(counts, asked, weight, whole["docs"], whole["terms"], k)
        order = Window.partitionBy("q").orderBy(F.desc("score"), F.asc_nulls_last("id"))
        ranked = scored.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
        name = spark.createDataFrame(list(enumerate(names)), f"q int, item {item_kind}")
        found.append(ranked.join(F.broadcast(name), "q").select("item", "rank", F.col("id").alias("doc"), "score"))
    if not found:
        kind = texts.schema["id"].dataType.simpleString()
        return spark.createDataFrame([], f"item {item_kind}, rank int, doc {kind}, score long")
    return functools.reduce(DataFrame.unionByName, found)
