"""Removal of repeated byte strings by suffix arrays over shards of the corpus.

A string of ``length`` bytes that starts at two places is repeated.  Every
such string is assigned to one anchor inside it, chosen by its content (the
leftmost of its least hashed grams), so that equal strings have equal
anchors.  Neighbouring strings with one anchor form a stretch.

1. Anchors of all texts are counted; only stretches whose anchor occurs more
   than once can hold repeated strings.  Their bytes are dealt by anchor, so
   equal strings meet in one shard; stretches equal as a whole are collapsed
   in the map task already, with their number.
2. Each shard builds a suffix array of its stretches by Larsson-Sadakane
   refinement (``suffix_array``) and the common prefixes of neighbours by
   Kasai's method (``common_prefixes``): a string is repeated where a
   neighbour shares ``length`` bytes.
3. An anchor with more stretches than a shard holds is dealt to several
   shards.  These exchange their sorted strings, and each finds its own in
   the runs of the others by binary search (``_merge``).
4. Repeated starts go back to their texts, which lose the bytes they cover.

All shuffles carry anchors, stretches that may repeat, or texts that are
touched; a text of any number of copies adds one stretch a task.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cashbook.llm.common import _BASE, _BASE_INV, _BYTE_CODE, _powers, mix64, stored, text_slices

#: Bytes per anchor gram.
GRAM = 16
#: Text is anchored in pieces of this many bytes (bounds positions and memory).
PIECE = 1 << 22
#: Bytes of stretches per suffix array (one anchor's more at most), and stretches of one anchor per shard.
SHARD_BYTES, SHARD_STRETCHES = 1_500_000, 1500
#: Text hashes sent to all tasks instead of a shuffle of all texts: up to 8 MB.
BROADCAST_ROWS = 1_000_000


# ------------------------------------------------------------------ anchors

def stretches(text: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(anchor hash, first start, starts, place of the anchor) of the stretches of one text, in order."""
    if len(text) < length:
        z = np.zeros(0, np.int64)
        return z.view(np.uint64), z, z, z
    parts = []
    for base in range(0, len(text) - length + 1, PIECE):
        parts.append(_piece(text[base:base + PIECE + length - 1], length, base))
    return tuple(np.concatenate(x) for x in zip(*parts))


def _piece(text: np.ndarray, length: int, base: int):
    n, width = len(text), length - GRAM + 1
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTE_CODE[text] * _powers(_BASE, n), out=total[1:])
    gram = mix64((total[GRAM:] - total[:-GRAM]) * _powers(_BASE_INV, n)[:n - GRAM + 1])
    place = np.arange(len(gram), dtype=np.uint64)
    key = (gram & ~np.uint64(0xFFFFFF)) | place              # ties: the leftmost
    m = len(key)
    rows = np.concatenate([key, np.full(-m % width, np.uint64(0xFFFFFFFFFFFFFFFF))]).reshape(-1, width)
    upto = np.minimum.accumulate(rows, axis=1).ravel()
    since = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    least = np.minimum(since[:m - width + 1], upto[width - 1:m])
    first = np.flatnonzero(np.concatenate(([True], least[1:] != least[:-1])))
    at = (least[first] & np.uint64(0xFFFFFF)).astype(np.int64)
    return gram[at], first + base, np.diff(np.append(first, len(least))), at + base


# ------------------------------------------------------- suffix arrays, prefixes

def _packed(text: np.ndarray) -> np.ndarray:
    """The eight bytes from each position, first byte highest; zeros beyond the end."""
    padded = np.concatenate([text, np.zeros(8, np.uint8)])
    out = np.zeros(len(text), np.uint64)
    for k in range(8):
        out = (out << np.uint64(8)) | padded[k:k + len(text)]
    return out


def suffix_array(text: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """(order, rank) of all suffixes by their first ``depth`` bytes (16 at least, or the text's end).

    Refinement: suffixes are grouped by eight bytes; a group is split by the
    ranks of the suffixes h and 2 h places on, so the depth triples every
    round; groups of one are never touched again.  Suffixes equal to
    ``depth`` keep one rank and stand in order of position.  The text has less than 2**21 bytes, so that
    three ranks fit one sort key; a longer one is refined by two ranks.
    """
    n = len(text)
    first = _packed(text)
    order = np.argsort(first)
    rank = np.empty(n + 2 * depth + 16, np.int64)
    rank[n:] = -1

    def number(part, keys, start):
        """Rank = place of the group's first member."""
        new = np.concatenate(([True], keys[1:] != keys[:-1]))
        rank[part] = start[np.maximum.accumulate(np.where(new, np.arange(len(part)), 0))]
        return new

    new = number(order, first[order], np.arange(n))
    known = 8
    places = np.arange(n)
    three = n + 1 < 1 << 21
    while known < depth:
        # the ranks looked up overlap in the last round, so that it reaches depth exactly
        ahead, further = min(known, depth - known), min(2 * known, depth - known)
        single = new & np.append(new[1:], True)
        places = places[~single]
        if not len(places):
            break
        part = order[places]
        key = rank[part] * (n + 1) + rank[part + ahead] + 1
        if three:
            key = key * (n + 1) + rank[part + further] + 1
        by = np.argsort(key)
        part, key = part[by], key[by]
        order[places] = part
        new = number(part, key, places)
        known += further if three else ahead
    rank = rank[:n]
    if three:
        order = np.sort((rank << 21) | np.arange(n)) & ((1 << 21) - 1)
    else:
        order = np.argsort(rank, kind="stable")
    return order, rank


def common_prefixes(text: np.ndarray, order: np.ndarray, rank: np.ndarray, lanes: np.ndarray,
                    most: int) -> np.ndarray:
    """Common prefix of each suffix with its predecessor in ``order``, up to ``most`` bytes.

    Kasai's method: from one position to the next the prefix shrinks by one
    byte at most.  ``lanes`` are the first positions of runs of text; all
    runs advance together, comparing eight bytes at a time.  Suffixes of one
    rank (sorted to ``most`` bytes) have it all in common; as their order
    among themselves is not that of what follows, the position after such a
    one starts from nothing.
    """
    n = len(text)
    words = np.concatenate([_packed(text), np.zeros(most + 16, np.uint64)])
    before = np.full(n, -1, np.int64)
    before[order[1:]] = order[:-1]
    same_rank = (rank[order[1:]] == rank[order[:-1]]) & (n - np.maximum(order[1:], order[:-1]) >= most)
    before[order[1:][same_rank]] = -2
    size = np.append(lanes[1:], n) - lanes
    longest = np.argsort(-size, kind="stable")
    inside = np.arange(int(size.max()) if len(size) else 0) < size[:, None]
    # one row a step, the runs side by side, the longest first
    grid = np.full(inside.shape, -1, np.int64)
    grid[inside] = before
    grid = np.ascontiguousarray(grid[longest].T)
    begin, lives = lanes[longest], inside.sum(axis=0)
    have = np.zeros(len(lanes), np.int64)
    for step, live in enumerate(lives.tolist()):
        row, h = grid[step, :live], have[:live]
        same = row == -2
        h[row < 0] = 0
        todo = np.flatnonzero(row >= 0)
        i, j = begin[todo] + step, row[todo]
        while len(todo):
            a, b = i + h[todo], j + h[todo]
            more = np.minimum(_leading_bytes(words[a] ^ words[b]), np.minimum(n - a, n - b))
            h[todo] += more
            on = (more == 8) & (h[todo] < most)
            todo, i, j = todo[on], i[on], j[on]
        np.minimum(h, most, out=h)
        row[:] = np.where(same, most, h)
        h -= 1
        h[same | (h < 0)] = 0
    out = np.empty_like(grid.T)
    out[longest] = grid.T
    return out[inside][order]


def _leading_bytes(x: np.ndarray) -> np.ndarray:
    """Leading zero bytes of 64-bit words."""
    byte = x.astype(">u8").view(np.uint8).reshape(-1, 8) != 0
    return np.where(x == 0, 8, byte.argmax(axis=1))


def repeated_starts(pieces: list[bytes], length: int) -> tuple[list[np.ndarray], np.ndarray, np.ndarray, np.ndarray]:
    """Which strings of ``length`` bytes of the pieces occur twice in them.

    Returns a mask of starts per piece, and in sorted order of the strings:
    position, whether it begins a new string, and the first position of each piece.
    """
    text = np.frombuffer(b"".join(pieces), np.uint8)
    size = np.array([len(p) for p in pieces])
    first = np.cumsum(size) - size
    order, rank = suffix_array(text, length)
    prefix = common_prefixes(text, order, rank, first, length)
    own = np.repeat(np.arange(len(pieces)), size)
    whole = (first + size)[own] - np.arange(len(text)) >= length       # the string lies inside its piece
    at = np.flatnonzero(whole[order])
    sorted_starts = order[at]
    twice = np.zeros(len(text), bool)
    fresh = np.ones(len(at), bool)
    if len(at) > 1:
        edges = np.stack([at[:-1] + 1, at[1:] + 1], axis=1).ravel()
        shared = np.minimum.reduceat(np.append(prefix, 0), edges)[::2]
        joined = shared >= length
        twice[sorted_starts[1:][joined]] = True
        twice[sorted_starts[:-1][joined]] = True
        fresh[1:] = ~joined
    return [twice[f:f + s - length + 1] for f, s in zip(first, size)], sorted_starts, fresh, first


# ------------------------------------------------------------------ operator

def _anchors(texts: DataFrame, length: int) -> DataFrame:
    """(anchor, th, start) of every stretch of every text."""
    def run(batches):
        for batch in batches:
            th = batch.column(0).to_pylist()
            for lo, hi, data, off in text_slices(batch, "text"):
                a, t, s = [], [], []
                for i in range(hi - lo):
                    anchor, start, *_ = stretches(data[off[i]:off[i + 1]], length)
                    if len(anchor):
                        a.append(anchor.view(np.int64)), s.append(start)
                        t.append(np.full(len(anchor), th[lo + i], np.int64))
                if a:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (a, t, s)],
                                                     names=["anchor", "th", "start"])
    return texts.select("th", "text").mapInArrow(run, "anchor long, th long, start long")


def _cut_out(texts: DataFrame, length: int) -> DataFrame:
    """Stretches of (th, text, starts): rows of (anchor, same, bytes, n, at), and of (th, start, same).

    ``at`` is the place of the anchor in the bytes.

    ``same`` is a hash of anchor and bytes.  A task gives each stretch's bytes
    once, with its number so far, and again when it has let them go.
    """
    def run(batches):
        held: dict[bytes, list] = {}
        size = 0
        for batch in batches:
            th, wanted = batch.column(0).to_pylist(), batch.column(2).to_pylist()
            places = []
            for lo, hi, data, off in text_slices(batch, "text"):
                for i in range(hi - lo):
                    text = data[off[i]:off[i + 1]]
                    anchor, start, n, at = stretches(text, length)
                    keep = np.flatnonzero(np.isin(start, wanted[lo + i]))
                    for k in keep.tolist():
                        s = int(start[k])
                        piece = text[s:s + int(n[k]) + length - 1].tobytes()
                        same = hashlib.blake2b(piece, digest_size=16).digest()
                        places.append((th[lo + i], s, same))
                        have = held.get(same)
                        if have:
                            have[2] += 1
                        else:
                            held[same] = [int(anchor[k:k + 1].view(np.int64)[0]), piece, 1, int(at[k]) - s]
                            size += len(piece)
            yield _rows(places, {})
            if size > 8 * SHARD_BYTES:
                yield _rows([], held)
                held, size = {}, 0
        yield _rows([], held)

    return texts.select("th", "text", "starts").mapInArrow(
        run, "th long, start long, same binary, anchor long, piece binary, n long, at int")


def _rows(places, held) -> pa.RecordBatch:
    p, h = len(places), len(held)
    none = [None] * p
    return pa.RecordBatch.from_arrays(
        [pa.array([x[0] for x in places] + [None] * h, pa.int64()),
         pa.array([x[1] for x in places] + [None] * h, pa.int64()),
         pa.array([x[2] for x in places] + list(held), pa.binary()),
         pa.array(none + [x[0] for x in held.values()], pa.int64()),
         pa.array(none + [x[1] for x in held.values()], pa.binary()),
         pa.array(none + [x[2] for x in held.values()], pa.int64()),
         pa.array(none + [x[3] for x in held.values()], pa.int32())],
        names=["th", "start", "same", "anchor", "piece", "n", "at"])


def _common(x: bytes, y: bytes) -> int:
    """Length of the common beginning, by bisection."""
    low, high = 0, min(len(x), len(y))
    if x[:high] == y[:high]:
        return high
    while high - low > 1:
        mid = (low + high) // 2
        if x[low:mid] == y[low:mid]:
            low = mid
        else:
            high = mid
    return low


def may_share(pieces: list[bytes], at: list[int], length: int) -> list[bool]:
    """For stretches of one anchor, whether each may share a string of ``length`` bytes with another.

    A shared string has the anchor at one place in both, so it lies within
    what they have in common to the left and to the right of it.  The most that
    a stretch has in common with any other on one side is found among its
    neighbours in that side's order.
    """
    most = [0] * len(pieces)
    for side in ([p[a:] for p, a in zip(pieces, at)], [p[:a][::-1] for p, a in zip(pieces, at)]):
        order = sorted(range(len(pieces)), key=side.__getitem__)
        best = [0] * len(pieces)
        for i, j in zip(order, order[1:]):
            n = _common(side[i], side[j])
            best[i], best[j] = max(best[i], n), max(best[j], n)
        most = [m + b for m, b in zip(most, best)]
    return [m >= length for m in most]


def _shards(pieces: DataFrame, length: int) -> DataFrame:
    """Per stretch: same, repeated (mask of starts, a byte each); and the sorted runs of shards that share an anchor.

    Input rows: anchor, shard, of (shards of the anchor), same, piece, n, at.

    Equal strings have their anchor at the same place, so no string occurs
    twice inside one stretch, and a stretch that shares too little with any
    other of its anchor (``may_share``) needs no suffix array: all or none of
    its strings are repeated.
    """
    def run(batches):
        group: dict[bytes, list] = {}                 # of one shard of one anchor
        now, held, size = None, [], 0                 # held: (anchor, of, shard, same, piece, n)
        alone = []                                    # stretches that are repeated as a whole

        def close():
            nonlocal group, size
            if group and next(iter(group.values()))[1] == 1:
                shares = may_share([x[3] for x in group.values()], [x[5] for x in group.values()], length)
                for (same, (_, _, _, piece, n, _)), share in zip(list(group.items()), shares):
                    if not share:
                        del group[same]
                        if n > 1:
                            alone.append((same, b"\x01" * (len(piece) - length + 1)))
            for same, (anchor, of, shard, piece, n, _) in group.items():
                held.append((anchor, of, shard, same, piece, n))
                size += len(piece)
            group = {}

        def flush():
            nonlocal held, size
            rows, runs = list(alone), []
            alone.clear()
            if held:
                masks, ordered, fresh, first = repeated_starts([x[4] for x in held], length)
                masks = [np.ones(len(m), bool) if x[5] > 1 else m for m, x in zip(masks, held)]
                rows += [(x[3], m.view(np.uint8).tobytes()) for x, m in zip(held, masks) if m.any()]
            if any(x[1] > 1 for x in held):
                begins = ordered[fresh]               # one of each distinct string, in order
                owner = np.searchsorted(first, begins, side="right") - 1
                for key in {(x[0], x[1], x[2]) for x in held if x[1] > 1}:
                    own = [i for i, x in enumerate(held) if x[:3] == key]
                    mine = np.isin(owner, own)
                    runs += _runs(key, held, begins[mine], owner[mine], first, length)
            held, size = [], 0
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows] + [None] * len(runs), pa.binary()),
                 pa.array([r[1] for r in rows] + [None] * len(runs), pa.binary()),
                 *[pa.array([None] * len(rows) + [r[i] for r in runs], t)
                   for i, t in enumerate((pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary()))]],
                names=["same", "mask", "anchor", "bucket", "shard", "keys", "refs"])

        for batch in batches:
            cols = [batch.column(i).to_pylist() for i in range(7)]
            for anchor, shard, of, same, piece, n, at in zip(*cols):
                if (anchor, shard) != now:
                    close()
                    now = (anchor, shard)
                    if size >= SHARD_BYTES or len(alone) >= 10_000:
                        yield from flush()
                have = group.get(same)
                if have:
                    have[4] += n
                else:
                    group[same] = [anchor, of, shard, piece, n, at]
        close()
        yield from flush()

    return pieces.select("anchor", "shard", "of", "same", "piece", "n", "at").mapInArrow(
        run, "same binary, mask binary, anchor long, bucket int, shard int, keys binary, refs binary")


def _runs(key, held, begins, owner, first, length) -> list[tuple]:
    """The distinct strings of one shard as sorted runs of 16-byte digests, one run per bucket of digests."""
    anchor, of, shard = key
    keys, refs = [], []
    for b, o in zip(begins.tolist(), owner.tolist()):
        at = b - int(first[o])
        keys.append(hashlib.blake2b(held[o][4][at:at + length], digest_size=16).digest())
        refs.append(held[o][3] + at.to_bytes(4, "big"))
    order = sorted(range(len(keys)), key=keys.__getitem__)
    out = []
    buckets = [k[0] * of // 256 for k in keys]
    for bucket in range(of):
        part = [i for i in order if buckets[i] == bucket]
        if part:
            out.append((anchor, bucket, shard, b"".join(keys[i] for i in part), b"".join(refs[i] for i in part)))
    return out


def _merge(runs: DataFrame) -> DataFrame:
    """(same, at): starts whose string is in the run of another shard of the anchor, found by binary search."""
    def run(batches):
        now, group = None, []

        def found():
            out = []
            packed = [(np.frombuffer(k, "S16"), r) for k, r in group]
            for i, (keys, refs) in enumerate(packed):
                hit = np.zeros(len(keys), bool)
                for j, (other, _) in enumerate(packed):
                    if i != j:
                        at = np.minimum(np.searchsorted(other, keys), len(other) - 1)
                        hit |= other[at] == keys
                for k in np.flatnonzero(hit).tolist():
                    ref = refs[20 * k:20 * k + 20]
                    out.append((ref[:16], int.from_bytes(ref[16:], "big")))
            return pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.binary()),
                                               pa.array([x[1] for x in out], pa.int32())], names=["same", "at"])
        for batch in batches:
            for anchor, bucket, keys, refs in zip(*[batch.column(i).to_pylist() for i in range(4)]):
                if (anchor, bucket) != now:
                    if group:
                        yield found()
                    now, group = (anchor, bucket), []
                group.append((keys, refs))
        if group:
            yield found()

    return (runs.select("anchor", "bucket", "keys", "refs").repartition("anchor", "bucket")
            .sortWithinPartitions("anchor", "bucket").mapInArrow(run, "same binary, at int"))


def _sent_if_few(table: DataFrame) -> DataFrame:
    return F.broadcast(table) if table.count() <= BROADCAST_ROWS else table


def repeated_places(texts: DataFrame, length: int) -> DataFrame:
    """(th, covered): per text hash, (start, parts: (shift, mask of starts, a byte each)) of its repeated strings."""
    anchors = stored(_anchors(texts, length), "suffix-anchors")
    often = anchors.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("anchor")
    wanted = stored(anchors.join(often, "anchor").groupBy("th").agg(F.collect_set("start").alias("starts")),
                    "suffix-wanted")
    touched = texts.select("th", "text").join(_sent_if_few(wanted.select("th")), "th", "left_semi")
    cut = stored(_cut_out(touched.join(wanted, "th"), length), "suffix-stretches")
    pieces = cut.filter("anchor IS NOT NULL").select("anchor", "same", "piece", "n", "at")
    many = (pieces.groupBy("anchor").agg(F.count(F.lit(1)).alias("rows")).filter(F.col("rows") > SHARD_STRETCHES)
            .select("anchor", F.ceil(F.col("rows") / SHARD_STRETCHES).cast("int").alias("of")))
    of = F.coalesce("of", F.lit(1))
    dealt = (pieces.join(_sent_if_few(stored(many, "suffix-many")), "anchor", "left")
             .withColumn("of", of).withColumn("shard", F.pmod(F.xxhash64("same"), F.col("of")).cast("int"))
             .repartition("anchor", "shard").sortWithinPartitions("anchor", "shard"))
    local = stored(_shards(dealt, length), "suffix-shards")
    masks = local.filter("mask IS NOT NULL").select("same", "mask")
    across = _merge(local.filter("anchor IS NOT NULL"))
    places = cut.filter("th IS NOT NULL").select("th", "start", "same").distinct()
    # starts found across shards, as masks of one start
    single = across.select("same", F.col("at").cast("long").alias("shift"), F.lit(b"\x01").alias("mask"))
    # one row a stretch, so that the join gives one row a place
    found = (masks.select("same", F.lit(0).cast("long").alias("shift"), "mask").unionByName(single)
             .groupBy("same").agg(F.collect_list(F.struct("shift", "mask")).alias("parts")))
    return (places.join(found, "same").groupBy("th")
            .agg(F.collect_list(F.struct("start", "parts")).alias("covered")))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   length: int = 200) -> DataFrame:
    """One row per input row: doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept (the remaining bytes).

    A byte goes when a string of ``length`` bytes that covers it also starts
    anywhere else in the column, in the same text too, overlaps included;
    strings do not cross texts.  ``kept`` is binary: cutting may split a
    character.  Null texts are empty.  Texts below ``length`` bytes stay as
    they are.  Repeated rows and equal texts are places of their own.  An
    empty table gives an empty result.  Texts are told apart by 64-bit hashes.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary")
    rows = docs.select(F.col(id_col).alias("doc_id"), text.alias("text")).withColumn("th", F.xxhash64("text"))
    covered = stored(repeated_places(rows, length), "suffix-covered")

    def run(batches):
        for batch in batches:
            places = batch.column(2).to_pylist()
            removed, spans, sha, kept = [], [], [], []
            for lo, hi, data, off in text_slices(batch, "text"):
                for i in range(hi - lo):
                    t = data[off[i]:off[i + 1]]
                    step = np.zeros(len(t) + 1, np.int64)
                    for p in places[lo + i]:
                        for part in p["parts"]:
                            at = np.flatnonzero(np.frombuffer(part["mask"], np.uint8)) + p["start"] + part["shift"]
                            step[at] += 1                     # distinct starts
                            step[at + length] -= 1
                    gone = np.cumsum(step[:-1]) > 0
                    left = t[~gone].tobytes()
                    removed.append(int(gone.sum()))
                    spans.append(int((np.diff(np.concatenate(([0], gone.view(np.int8)))) == 1).sum()))
                    sha.append(hashlib.sha256(left).hexdigest())
                    kept.append(left)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(x) for x in batch.column(1).to_pylist()], pa.int64()),
                 pa.array(removed, pa.int64()), pa.array(spans, pa.int64()), pa.array(sha, pa.string()),
                 pa.array(kept, pa.binary())],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])

    kind = T.StructType([rows.schema["doc_id"], T.StructField("n_bytes", T.LongType()),
                         T.StructField("n_removed", T.LongType()), T.StructField("n_spans", T.LongType()),
                         T.StructField("kept_sha256", T.StringType()), T.StructField("kept", T.BinaryType())])
    hashes = _sent_if_few(covered.select("th"))
    touched = rows.join(hashes, "th", "left_semi").join(covered, "th")
    whole = rows.join(hashes, "th", "left_anti")
    return (touched.select("doc_id", "text", "covered").mapInArrow(run, kind)
            .unionByName(whole.select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"),
                                      F.lit(0).cast("long").alias("n_removed"),
                                      F.lit(0).cast("long").alias("n_spans"),
                                      F.sha2("text", 256).alias("kept_sha256"), F.col("text").alias("kept"))))
