"""Exact Jaccard join of documents on word shingles: a grouped prefix join.

Steps, all but the last exact filters that lose no link:

1. Shingles in one global order, rare ones first.  The order is by (score,
   hash): the score counts a shingle over all chunks in which it occurs more
   than once; shingles of high score come last.  Any order is right; this
   one keeps common passages out of the prefixes.
2. Equal sets become one member; members of equal size and equal prefix one
   group.  Linked sets share a shingle of their prefixes.
3. First pass over the posting lists: each list gives the edges of a minimum
   spanning forest over the pairs that may be linked (by size, and by a lower
   bound of the set difference from parity bits).  These pairs, and the
   members of a group against its first one, are verified on the whole sets.
4. Second pass, with the components known: all remaining pairs of groups, and
   of members inside a group, in different components that may be linked are
   expanded to members and verified.  Pairs inside one component cannot change
   the result.

Posting lists longer than ``LIST_ROWS`` are cut into blocks, and pairs of
blocks are dealt to different tasks.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cashbook.llm.common import (LOWER, NOT_SPACE, mix64, most_frequent, shingle_hashes, stored, text_slices,
                                 word_hashes, word_spans)
from cashbook.llm.components import components

#: Shingles per chunk in which repeats are counted, the least score that moves
#: a shingle back in the order, and how many such shingles tasks are sent.
CHUNK, LEAST_SCORE, MOST_COMMON = 1 << 20, 16, 1 << 18
#: Rows of a posting list that meet in one task at once.
LIST_ROWS = 1024
#: Parity bits per set, as 64-bit words.
PARITY_WORDS = 8
#: Candidate pairs or texts up to this many are sent to all tasks (a few longs each); more are joined by shuffle.
BROADCAST_ROWS = 200_000


def _sets(data: np.ndarray, offsets: np.ndarray, width: int) -> list[np.ndarray]:
    """The distinct shingle hashes of each text, sorted."""
    low = LOWER[data]
    starts, ends, first = word_spans(low, offsets, NOT_SPACE)
    sh, sh_first = shingle_hashes(word_hashes(low, starts, ends), first, width)
    return [np.unique(sh[sh_first[i]:sh_first[i + 1]]) for i in range(len(offsets) - 1)]


def prefix_length(n: int, percent: int) -> int:
    """Shingles in which a linked set of n shingles must share one: n - ceil(n * percent / 100) + 1."""
    return n - (n * percent + 99) // 100 + 1 if n else 0


def common_shingles(texts: DataFrame, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The most repeated shingles and their scores, sorted by shingle; at most ``MOST_COMMON``.

    Counted over all texts, in chunks of ``CHUNK`` shingles: a shingle adds
    the texts that hold it where there is more than one.  Chunks have a fixed
    size, so a shingle far more frequent than the square root of the number
    of chunks is met.  The list only orders the prefixes; what it leaves out
    costs longer lists, not results.
    """
    def count(batches):
        held, size = [], 0

        def out():
            values, n = np.unique(np.concatenate(held), return_counts=True)
            some = n > 1
            return pa.RecordBatch.from_arrays([pa.array(values[some].view(np.int64)), pa.array(n[some])],
                                              names=["shingle", "n"])
        for batch in batches:
            for _, _, data, off in text_slices(batch, "text"):
                for s in _sets(data, off, width):
                    held.append(s)
                    size += len(s)
                if size >= CHUNK:
                    yield out()
                    held, size = [], 0
        if held:
            yield out()

    scores = stored(texts.select("text").mapInArrow(count, "shingle long, n long")
                    .groupBy("shingle").agg(F.sum("n").alias("score")).filter(F.col("score") >= LEAST_SCORE),
                    "join-scores")
    top = most_frequent(scores, "score", MOST_COMMON).toPandas()
    values = top["shingle"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(values)
    return values[order], top["score"].to_numpy(np.int64)[order]


def _in_order(s: np.ndarray, common: np.ndarray, score: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The set in the global order, and whether each is common."""
    if not len(common) or not len(s):
        return s, np.zeros(len(s), bool)
    at = np.minimum(np.searchsorted(common, s), len(common) - 1)
    rank = np.where(common[at] == s, score[at], 0)
    order = np.lexsort((s, rank))
    return s[order], rank[order] > 0


def _parity(s: np.ndarray, bits: int) -> bytes:
    """Bit i: whether an odd number of shingles fall to i.  Sets differ in at least as many shingles as bits."""
    odd = np.bincount((s >> np.uint64(20)).astype(np.int64) % bits, minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


def _wide_bits(n: int) -> int:
    """Parity bits that tell a set of n shingles well: the power of two from 4 n up, 512 at least."""
    return 1 << max(9, (4 * n - 1).bit_length())


def _gap(x: bytes, y: bytes) -> int:
    """Differing parity bits; the wider one is folded to the other's width."""
    x, y = np.frombuffer(x, np.uint8), np.frombuffer(y, np.uint8)
    while len(x) > len(y):
        x = x[:len(x) // 2] ^ x[len(x) // 2:]
    while len(y) > len(x):
        y = y[:len(y) // 2] ^ y[len(y) // 2:]
    return int(np.bitwise_count(x ^ y).sum())


def document_sets(texts: DataFrame, width: int, percent: int) -> DataFrame:
    """Per row: id, th (text hash), n (set size), member (set hash), grp, prefix, rare (prefix part), parity, wide."""
    sc = texts.sparkSession.sparkContext
    sent = sc.broadcast(common_shingles(texts, width))

    def describe(batches):
        common, score = sent.value
        for batch in batches:
            n, member, grp, prefix, rare, parity, wide = [], [], [], [], [], [], []
            for _, _, data, off in text_slices(batch, "text"):
                for s in _sets(data, off, width):
                    n.append(len(s))
                    if not len(s):
                        member.append(0), grp.append(0), prefix.append(b""), rare.append(0), parity.append(b"")
                        wide.append(b"")
                        continue
                    size = np.uint64(len(s))
                    member.append(int(mix64(np.array([np.add.reduce(mix64(s)) + size])).view(np.int64)[0]))
                    o, is_common = _in_order(s, common, score)
                    p = o[:prefix_length(len(s), percent)]
                    place = mix64(p + np.arange(1, len(p) + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
                    grp.append(int(mix64(np.array([np.add.reduce(place) + size])).view(np.int64)[0]))
                    prefix.append(p.tobytes())
                    rare.append(int(len(p) - is_common[:len(p)].sum()))
                    parity.append(_parity(s, 64 * PARITY_WORDS))
                    wide.append(_parity(s, _wide_bits(len(s))))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(n, pa.int32()), pa.array(member, pa.int64()),
                 pa.array(grp, pa.int64()), pa.array(prefix, pa.binary()), pa.array(rare, pa.int32()),
                 pa.array(parity, pa.binary()), pa.array(wide, pa.binary())],
                names=["id", "th", "n", "member", "grp", "prefix", "rare", "parity", "wide"])

    kind = texts.schema["id"].dataType.simpleString()
    return texts.select("id", "th", "text").mapInArrow(
        describe, f"id {kind}, th long, n int, member long, grp long, prefix binary, rare int, parity binary, "
                  "wide binary")


def _postings(sets: DataFrame) -> DataFrame:
    """(shingle, grp, listed) of all shingles that are in the prefixes of two groups or more."""
    def explode(batches):
        for batch in batches:
            prefix = batch.column(1).to_pylist()
            if not prefix:
                continue
            count = np.array([len(p) // 8 for p in prefix])
            grp = np.repeat(batch.column(0).to_numpy(zero_copy_only=False), count)
            head = np.repeat(batch.column(2).to_numpy(zero_copy_only=False), count)
            place = np.arange(len(grp)) - np.repeat(np.cumsum(count) - count, count)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.frombuffer(b"".join(prefix), np.int64)), pa.array(grp), pa.array(place >= head)],
                names=["shingle", "grp", "common"])

    groups = sets.filter("n > 0").groupBy("grp").agg(F.first("prefix").alias("prefix"), F.first("rare").alias("rare"))
    rows = groups.select("grp", "prefix", "rare").mapInArrow(explode, "shingle long, grp long, common boolean")
    rows = stored(rows, "join-postings")
    lists = (rows.filter("common").groupBy("shingle").agg(F.count(F.lit(1)).alias("listed")).filter("listed > 1"))
    frequent = rows.filter("common").join(lists, "shingle").select("shingle", "grp", "listed")
    # a shingle that is not common has a short list: counted where it is gathered
    whole = F.count(F.lit(1)).over(Window.partitionBy("shingle")).alias("listed")
    seldom = rows.filter("NOT common").select("shingle", "grp", whole).filter("listed > 1")
    return stored(frequent.unionByName(seldom), "join-lists")


def _dealt(lists: DataFrame) -> DataFrame:
    """Rows dealt to tasks by (shingle, pair of blocks): key, and the unit's columns, sorted by key.

    A list of up to ``LIST_ROWS`` rows is one block; a longer one is cut by
    hash, and every pair of its blocks meets once.
    """
    blocks = F.ceil(F.col("listed") / LIST_ROWS).cast("int")
    cut = lists.withColumn("blocks", blocks).withColumn(
        "own", F.pmod(F.xxhash64("grp", "comp"), F.col("blocks")).cast("int"))
    met = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    cut = cut.select("*", met).withColumn(
        "key", F.xxhash64("shingle", F.least("own", "other"), F.greatest("own", "other")))
    return cut.select("key", "grp", "comp", "n", "parity").repartition("key").sortWithinPartitions("key", "grp", "comp")


def _pairs(lists: DataFrame, percent: int, forest: bool) -> DataFrame:
    """Pairs of units (grp, comp) in one list, of different components, that may be linked.

    May be: sizes within the ratio, and parity bits that differ in no more
    places than linked sets can differ.  A unit without parity (several
    members) always may.  With ``forest`` only the edges of a minimum spanning
    forest of each list, nearest pairs first.
    """
    def candidates(key, comp, n, bits, known):
        """Index pairs within equal keys, with distance, lag by lag."""
        a, b, d = [], [], []
        lag, rows = 1, np.arange(len(key) - 1)
        while len(rows):
            rows = rows[(rows + lag < len(key))]
            rows = rows[key[rows] == key[rows + lag]]
            if not len(rows):
                break
            other = rows + lag
            lo, hi = np.minimum(n[rows], n[other]), np.maximum(n[rows], n[other])
            may = (comp[rows] != comp[other]) & (100 * lo >= percent * hi)
            i, j = rows[may], other[may]
            if len(i):
                both = known[i] & known[j]
                gap = np.where(both, np.bitwise_count(bits[i] ^ bits[j]).sum(axis=1), 0)
                # |difference| <= (100 - percent) / (100 + percent) * (sizes' sum)
                ok = gap.astype(np.int64) * (100 + percent) <= (100 - percent) * (n[i] + n[j])
                a.append(i[ok]), b.append(j[ok]), d.append(gap[ok])
            lag += 1
        if not a:
            z = np.zeros(0, np.int64)
            return z, z, z
        return np.concatenate(a), np.concatenate(b), np.concatenate(d).astype(np.int64)

    def spanning(a, b, d, grp):
        """Kruskal over the lists of a batch; ties by group ids, so that lists agree on their edges."""
        low, high = np.minimum(grp[a], grp[b]), np.maximum(grp[a], grp[b])
        order = np.lexsort((high, low, d))
        root: dict[int, int] = {}

        def find(x):
            while root.setdefault(x, x) != x:
                root[x] = root[root[x]]
                x = root[x]
            return x
        keep = []
        for e in order.tolist():
            x, y = find(int(a[e])), find(int(b[e]))
            if x != y:
                root[x] = y
                keep.append(e)
        keep = np.array(keep, dtype=np.int64)
        return a[keep], b[keep]

    def run(batches):
        held = None
        seen: set[tuple[int, int, int, int]] = set()

        def out(t):
            key = t.column("key").to_numpy()
            if len(key) < 2:
                return None
            grp, comp, n = (t.column(c).to_numpy() for c in ("grp", "comp", "n"))
            raw = t.column("parity").to_pylist()
            known = np.array([p is not None for p in raw])
            zero = bytes(8 * PARITY_WORDS)
            bits = np.frombuffer(b"".join(p or zero for p in raw), np.uint64).reshape(-1, PARITY_WORDS)
            a, b, d = candidates(key, comp, n.astype(np.int64), bits, known)
            if forest and len(a):
                a, b = spanning(a, b, d, grp)
            if not len(a):
                return None
            swap = (grp[a] > grp[b]) | ((grp[a] == grp[b]) & (comp[a] > comp[b]))
            a, b = np.where(swap, b, a), np.where(swap, a, b)
            rows = np.unique(np.stack([grp[a], comp[a], grp[b], comp[b]], axis=1), axis=0)
            if len(seen) > 1 << 18:
                seen.clear()
            new = [r for r in map(tuple, rows.tolist()) if r not in seen]
            seen.update(new)
            if not new:
                return None
            cols = np.array(new, dtype=np.int64).T
            return pa.RecordBatch.from_arrays([pa.array(c) for c in cols],
                                              names=["grp_a", "comp_a", "grp_b", "comp_b"])
        for batch in batches:
            t = pa.Table.from_batches([batch])
            held = t if held is None else pa.concat_tables([held, t])
            key = held.column("key").to_numpy()
            end = int(np.searchsorted(key, key[-1])) if len(key) else 0     # the last list may go on
            if end and len(key) >= 20_000:
                if (r := out(held.slice(0, end).combine_chunks())) is not None:
                    yield r
                held = held.slice(end)
        if held is not None and len(held) and (r := out(held.combine_chunks())) is not None:
            yield r

    return _dealt(lists).mapInArrow(run, "grp_a long, comp_a long, grp_b long, comp_b long").distinct()


def _sent_if_few(table: DataFrame) -> DataFrame:
    """The stored table, marked for broadcast where its counted size is within the bound."""
    return F.broadcast(table) if table.count() <= BROADCAST_ROWS else table


def _screened(pairs: DataFrame, members: DataFrame, percent: int) -> DataFrame:
    """Those pairs whose wide parity bits do not rule a link out."""
    def run(batches):
        for batch in batches:
            n = batch.column(4).to_numpy().astype(np.int64) + batch.column(5).to_numpy()
            gap = np.array([_gap(x, y) for x, y in zip(batch.column(6).to_pylist(), batch.column(7).to_pylist())],
                           dtype=np.int64)
            keep = gap * (100 + percent) <= (100 - percent) * n
            yield pa.RecordBatch.from_arrays([batch.column(i) for i in range(4)],
                                             names=["a", "ta", "b", "tb"]).filter(pa.array(keep, pa.bool_()))

    pairs = _sent_if_few(stored(pairs, "join-near"))
    side = members.select("member", "n", "wide")
    both = (side.toDF("a", "na", "wa").join(pairs, "a").join(side.toDF("b", "nb", "wb"), "b")
            .select("a", "ta", "b", "tb", "na", "nb", "wa", "wb"))
    return both.mapInArrow(run, "a long, ta long, b long, tb long")


def _whole_sets(texts: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """(th, shingles) of the wanted text hashes; one row each."""
    def shingles(batches):
        for batch in batches:
            out = []
            for _, _, data, off in text_slices(batch, "text"):
                out += [s.tobytes() for s in _sets(data, off, width)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], names=["th", "shingles"])

    wanted = stored(wanted.distinct(), "join-wanted")
    few = wanted.count() <= BROADCAST_ROWS
    rows = texts.select("th", "text").join(F.broadcast(wanted) if few else wanted, "th", "left_semi")
    one = rows.groupBy("th").agg(F.first("text").alias("text")) if not few else rows
    sets = one.mapInArrow(shingles, "th long, shingles binary")
    # where texts were not gathered by hash above, copies are dropped here
    return stored(sets.groupBy("th").agg(F.first("shingles").alias("shingles")) if few else sets, "join-sets")


def _verify(pairs: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """Those pairs (a, ta, b, tb: members and their texts) whose whole sets are linked."""
    def linked(batches):
        for batch in batches:
            a, b, sa, sb = (batch.column(i) for i in range(4))
            sa, sb, keep = sa.to_pylist(), sb.to_pylist(), []
            for x, y in zip(sa, sb):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([a, b], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    sets = _whole_sets(texts, pairs.select(F.col("ta").alias("th")).union(pairs.select("tb")), width)
    one = sets.select(F.col("th").alias("ta"), F.col("shingles").alias("sa")).join(_sent_if_few(pairs), "ta")
    two = one.join(sets.select(F.col("th").alias("tb"), F.col("shingles").alias("sb")), "tb")
    return stored(two.select("a", "b", "sa", "sb").mapInArrow(linked, "a long, b long"), "join-links")


def jaccard_components(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 4,
                       percent: int = 85) -> DataFrame:
    """One row per input row: id, th (text hash), n (shingles), member (set), label (component).

    A set is the distinct ``width``-word shingles of the text, A-Z
    lower-cased, words split at space and tab to carriage return; with fewer
    words the whole sequence is the one shingle.  Two sets are linked when
    100 * intersection >= percent * union; ``label`` is the same for all rows
    reachable by links.  Null, empty and blank texts have no set and no label
    (null).  Sets and groups are told apart by 64-bit hashes.
    """
    texts = df.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    texts = texts.withColumn("th", F.xxhash64("text"))
    sets = stored(document_sets(texts, width, percent), "join-docs")
    rows = sets.filter("n > 0")
    members = stored(rows.groupBy("member").agg(F.first("grp").alias("grp"), F.first("n").alias("n"),
                                                F.min("th").alias("t"), F.first("parity").alias("parity"),
                                                F.first("wide").alias("wide")), "join-members")
    groups = stored(members.groupBy("grp").agg(
        F.first("n").alias("n"), F.min(F.struct("member", "t", "parity")).alias("head"),
        F.count(F.lit(1)).alias("members")), "join-groups")
    lists = _postings(sets)

    # first pass: one unit a group, stood for by its first member
    units = groups.select("grp", F.col("grp").alias("comp"), "n", F.col("head.parity").alias("parity"))
    found = _pairs(lists.join(units, "grp"), percent, forest=True)
    head = groups.select("grp", F.col("head.member").alias("m"), F.col("head.t").alias("t"))
    near = (found.join(head.select(F.col("grp").alias("grp_a"), F.col("m").alias("a"), F.col("t").alias("ta")), "grp_a")
            .join(head.select(F.col("grp").alias("grp_b"), F.col("m").alias("b"), F.col("t").alias("tb")), "grp_b")
            .select("a", "ta", "b", "tb"))
    inside = (members.join(groups.filter("members > 1").select("grp", "head"), "grp").filter("member <> head.member")
              .select(F.col("head.member").alias("a"), F.col("head.t").alias("ta"),
                      F.col("member").alias("b"), F.col("t").alias("tb")))
    tried = stored(_screened(near.unionByName(inside), members, percent), "join-tried")
    links = _verify(tried, texts, width, percent)
    label = components(links)
    placed = stored(members.drop("wide").join(label.withColumnRenamed("node", "member"), "member", "left")
                    .withColumn("comp", F.coalesce("label", "member")).drop("label"), "join-placed")

    # second pass: units are the members of a group in one component
    parts = placed.groupBy("grp", "comp").agg(
        F.first("n").alias("n"), F.when(F.count(F.lit(1)) == 1, F.first("parity")).alias("parity"))
    open_ = lists.join(parts, "grp")
    mixed = open_.groupBy("shingle").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"),
                                         F.count(F.lit(1)).alias("rows")).filter("lo <> hi").select("shingle", "rows")
    open_ = open_.join(mixed, "shingle").drop("listed").withColumnRenamed("rows", "listed")
    # a group's shingles may be in no list: the units of a group in several components are a list of their own
    torn = parts.groupBy("grp").agg(F.count(F.lit(1)).alias("listed")).filter("listed > 1")
    own = parts.join(torn, "grp").withColumn("shingle", F.xxhash64(F.lit("group"), "grp"))
    open_ = open_.unionByName(own)
    rest = _pairs(open_, percent, forest=False)
    side = placed.select("grp", "comp", "member", "t", "parity")
    full = (rest.join(side.toDF("grp_a", "comp_a", "a", "ta", "pa"), ["grp_a", "comp_a"])
            .join(side.toDF("grp_b", "comp_b", "b", "tb", "pb"), ["grp_b", "comp_b"])
            .select("a", "ta", "b", "tb"))
    known = tried.select("a", "b").union(tried.select("b", "a"))
    todo = stored(_screened(full.join(known, ["a", "b"], "left_anti"), members, percent), "join-rest")
    comp_of = placed.select("member", "comp")
    more = (_verify(todo, texts, width, percent)
            .join(comp_of.toDF("a", "ca"), "a").join(comp_of.toDF("b", "cb"), "b")
            .select(F.col("ca").alias("a"), F.col("cb").alias("b")))
    joined = components(more)
    final = stored(placed.join(joined.withColumnRenamed("node", "comp"), "comp", "left")
                   .select("member", F.coalesce("label", "comp").alias("label")), "join-final")
    return (rows.select("id", "th", "n", "member").join(final, "member").select("id", "th", "n", "member", "label")
            .unionByName(sets.filter("n = 0").select("id", "th", "n", F.lit(None).cast("long").alias("member"),
                                                     F.lit(None).cast("long").alias("label"))))


def similar_documents(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 4,
                      percent: int = 85) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id (smallest id reachable by links, itself included).

    Rows without words are alone.  Null ids take part and are never the
    smallest unless all are null.  Repeated rows share their component.  An
    empty table gives an empty result.
    """
    rows = stored(jaccard_components(df, id_col, text_col, width, percent), "join-rows")
    least = rows.filter(F.col("label").isNotNull()).groupBy("label").agg(F.min("id").alias("least"))
    return (rows.join(least, "label", "left")
            .select(F.col("id").alias("doc_id"), F.col("n").cast("long").alias("n_shingles"),
                    F.when(F.col("label").isNull(), F.col("id")).otherwise(F.col("least")).alias("component_id")))


def one_per_group(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5,
                  percent: int = 80) -> DataFrame:
    """The documents with one row of each component: that of the smallest id, null ids last.

    Rows without words stay, as they are like nothing.  Of rows that agree in
    id and text one stays.  Same columns as ``df``.
    """
    found = stored(jaccard_components(df, id_col, text_col, width, percent), "join-rows")
    first = F.struct(F.col("id").isNull().alias("noid"), F.col("id").alias("id"), F.col("th").alias("th"))
    best = found.filter("label IS NOT NULL").groupBy("label").agg(F.min(first).alias("k"))
    gone = (found.join(best, "label").filter(~(first.eqNullSafe(F.col("k"))))
            .select(F.col("id").alias("gone_id_"), F.col("th").alias("gone_th_")).distinct()
            .join(best.select(F.col("k.id").alias("keep_id_"), F.col("k.th").alias("keep_th_")),
                  F.col("gone_id_").eqNullSafe(F.col("keep_id_")) & (F.col("gone_th_") == F.col("keep_th_")),
                  "left_anti"))
    gone = _sent_if_few(stored(gone, "join-gone"))
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), F.col(id_col).alias("id_"),
                     F.xxhash64(text).alias("th_"), F.regexp_like(text, F.lit(r"[^\x20\x09-\x0D]")).alias("words_"))
    blank = rows.filter("NOT words_").select("row.*")
    chosen = rows.filter("words_").join(gone, F.col("id_").eqNullSafe(F.col("gone_id_"))
                                        & (F.col("th_") == F.col("gone_th_")), "left_anti")
    times = found.groupBy("id", "th").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    if not times.isEmpty():
        chosen = chosen.dropDuplicates(["id_", "th_"])
    return chosen.select("row.*").unionByName(blank)
