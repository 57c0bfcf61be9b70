"""Benchmark decontamination with a generalised suffix automaton over item words.

The items are dealt to blocks of about ``BLOCK_BYTES`` text bytes, and a task
builds one automaton of each.  Documents stream through ``BLOCKS_A_SCAN``
automata in one scan; with more blocks, further scans add to the hits of the
ones before, so what is sent to the tasks at once has a bound whatever the
benchmark.  A word that is unknown to the items, or a pair of neighbours
that no item has, ends a match, so only runs of known pairs enter an
automaton.  There the longest matching length is tracked word by word; where
it reaches the window, the words back to the window's start are hit.
"""

from __future__ import annotations

import pickle

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cashbook.llm.common import ALNUM, LOWER, stored, text_slices, word_hashes, word_spans

#: Item text bytes per automaton (some hundred MB of states at most), and automata in one scan of the documents.
BLOCK_BYTES, BLOCKS_A_SCAN = 1 << 20, 2


class SuffixAutomaton:
    """Automaton of all word runs of a set of items, with the windows each state completes."""

    def __init__(self, items: list[tuple[str, list[int]]], window: int):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        for _, words in items:
            last = 0
            for w in words:
                last = self._extend(last, w)
        self.window = window
        self.marks: dict[int, list[tuple[int, set[str]]]] = {}
        for name, words in items:
            if words:
                self._mark(name, words)
        # nearest state on the suffix path that completes a window; links go to shorter runs
        self.out = [-1] * len(self.next)
        for s in sorted(range(len(self.next)), key=self.length.__getitem__):
            self.out[s] = s if s in self.marks else (self.out[self.link[s]] if s else -1)

    def _new(self, length: int, link: int, edges: dict[int, int]) -> int:
        self.next.append(edges)
        self.length.append(length)
        self.link.append(link)
        return len(self.next) - 1

    def _split(self, p: int, w: int) -> int:
        """The state of exactly length[p] + 1 reached from p by w; cloned off a longer one if need be."""
        q = self.next[p][w]
        if self.length[q] == self.length[p] + 1:
            return q
        copy = self._new(self.length[p] + 1, self.link[q], dict(self.next[q]))
        self.link[q] = copy
        while p >= 0 and self.next[p].get(w) == q:
            self.next[p][w] = copy
            p = self.link[p]
        return copy

    def _extend(self, last: int, w: int) -> int:
        if w in self.next[last]:                    # an earlier item has this run already
            return self._split(last, w)
        state = self._new(self.length[last] + 1, 0, {})
        p = last
        while p >= 0 and w not in self.next[p]:
            self.next[p][w] = state
            p = self.link[p]
        if p >= 0:
            self.link[state] = self._split(p, w)
        return state

    def _mark(self, name: str, words: list[int]) -> None:
        size = min(self.window, len(words))
        s = n = 0
        for w in words:
            s, n = self.next[s][w], n + 1
            if n >= size:
                while self.length[self.link[s]] >= size:
                    s = self.link[s]
                n = size
                for length, names in self.marks.setdefault(s, []):
                    if length == size:
                        names.add(name)
                        break
                else:
                    self.marks[s].append((size, {name}))

    def stream(self, words: list[int], found: set[str]) -> tuple[list[int], list[int]]:
        """Per word: the longest matching length and how many words back are hit; items go to ``found``."""
        nxt, link, length, out, marks = self.next, self.link, self.length, self.out, self.marks
        s = n = 0
        longest, back = [], []
        for w in words:
            while s and w not in nxt[s]:
                s = link[s]
                n = length[s]
            t = nxt[s].get(w)
            if t is None:
                n = 0
            else:
                s, n = t, n + 1
            longest.append(n)
            reach, o = 0, out[s]
            while o > 0:
                for size, names in marks[o]:
                    if size <= n:
                        found |= names
                        reach = max(reach, size)
                o = out[link[o]]
            back.append(reach)
        return longest, back


def _block(items: list[tuple[str, str]], window: int) -> dict:
    """One automaton with its sorted word hashes and known neighbour pairs."""
    data = np.frombuffer("".join(t for _, t in items).encode(), dtype=np.uint8)
    ends = np.cumsum([0] + [len(t.encode()) for _, t in items])
    low = LOWER[data]
    starts, stops, first = word_spans(low, ends, ALNUM)
    hashes = word_hashes(low, starts, stops)
    vocab, ids = np.unique(hashes, return_inverse=True)
    words = [(name, ids[first[i]:first[i + 1]].tolist()) for i, (name, _) in enumerate(items)]
    inner = np.ones(max(len(ids) - 1, 0), dtype=bool)
    cut = first[1:-1]
    inner[cut[(cut > 0) & (cut < len(ids))] - 1] = False
    pairs = np.unique(ids[:-1][inner] * len(vocab) + ids[1:][inner]) if len(ids) > 1 else np.zeros(0, np.int64)
    sizes = [min(window, len(w)) for _, w in words if w]
    return {"vocab": vocab, "pairs": pairs, "least": min(sizes, default=0),
            "automaton": SuffixAutomaton(words, window)}


def _member(sorted_values: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(sorted_values):
        return np.zeros(len(x), np.int64), np.zeros(len(x), bool)
    at = np.minimum(np.searchsorted(sorted_values, x), len(sorted_values) - 1)
    return at, sorted_values[at] == x


def _scan(blocks: list[dict], data: np.ndarray, offsets: np.ndarray):
    """Words and hits of a slice: (starts, ends, first word per text, hit mask, longest, items per text)."""
    low = LOWER[data]
    starts, ends, first = word_spans(low, offsets, ALNUM)
    hashes = word_hashes(low, starts, ends)
    hit = np.zeros(len(hashes), dtype=bool)
    longest = np.zeros(len(hashes), dtype=np.int64)
    found: dict[int, set[str]] = {}
    for b in blocks:
        if not b["least"]:
            continue
        ids, known = _member(b["vocab"], hashes)
        joined = known[:-1] & known[1:]
        if len(joined):
            joined &= _member(b["pairs"], ids[:-1] * len(b["vocab"]) + ids[1:])[1]
            cut = first[1:-1]
            joined[cut[(cut > 0) & (cut < len(hashes))] - 1] = False
        edge = np.flatnonzero(~joined) + 1
        begin = np.concatenate(([0], edge)).astype(np.int64)
        end = np.concatenate((edge, [len(hashes)])).astype(np.int64)
        runs = (end - begin >= b["least"]) & known[np.minimum(begin, max(len(known) - 1, 0))] if len(known) else []
        for r in np.flatnonzero(runs):
            lo, hi = int(begin[r]), int(end[r])
            names: set[str] = set()
            lengths, back = b["automaton"].stream(ids[lo:hi].tolist(), names)
            longest[lo:hi] = np.maximum(longest[lo:hi], lengths)
            if names:
                found.setdefault(int(np.searchsorted(first, lo, side="right")) - 1, set()).update(names)
                for k in range(hi - lo):
                    if back[k]:
                        hit[lo + k + 1 - back[k]:lo + k + 1] = True
    return starts, ends, first, hit, longest, found


def automata(benchmark: DataFrame, item_col: str, text_col: str, window: int) -> tuple[DataFrame, int]:
    """(block, automaton): one pickled automaton a block, stored; and the number of blocks."""
    items = (benchmark.select(F.coalesce(F.col(item_col).cast("string"), F.lit("null")).alias("name"),
                              F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("words")).distinct())
    size = items.agg(F.sum(F.octet_length("words")).alias("n")).first()["n"] or 0
    n_blocks = max(1, -(-size // BLOCK_BYTES))

    def build(batches):
        now, held = None, []

        def out():
            return pa.RecordBatch.from_arrays(
                [pa.array([now], pa.int32()), pa.array([pickle.dumps(_block(held, window))], pa.binary())],
                names=["block", "automaton"])
        for batch in batches:
            for block, name, words in zip(*(c.to_pylist() for c in batch.columns)):
                if block != now and held:
                    yield out()
                    held = []
                now = block
                held.append((name, words))
        if held:
            yield out()

    dealt = items.select(F.pmod(F.xxhash64("name", "words"), F.lit(n_blocks)).cast("int").alias("block"), "name", "words")
    built = (dealt.repartition(n_blocks, "block").sortWithinPartitions("block", "name", "words")
             .mapInArrow(build, "block int, automaton binary"))
    return stored(built, "scan-automata"), n_blocks


def _stream(sent: list, last: bool):
    """A scan of (row, text, hits, longest, items) through the sent automata.

    Adds to the hits, and with ``last`` derives the result's columns from them.
    """
    def out(batch, cols, kinds):
        return pa.RecordBatch.from_arrays(
            [batch.column(0), *[pa.array(cols[k], t) for k, t in kinds.items()]], names=["row", *kinds])

    def scan(batches):
        blocks = [pickle.loads(b.value) for b in sent]
        for batch in batches:
            cols: dict[str, list] = {k: [] for k in (
                "n_words", "n_hit", "longest", "items", "cleaned", "hits_", "longest_", "items_")}
            before = [batch.column(i).to_pylist() for i in (2, 3, 4)]
            for lo, hi, data, off in text_slices(batch, "scan_text_"):
                starts, ends, first, hit, longest, found = _scan(blocks, data, off)
                for i in range(hi - lo):
                    a, z = int(first[i]), int(first[i + 1])
                    h = hit[a:z]
                    had, length, names = (x[lo + i] for x in before)
                    if had:
                        h |= np.unpackbits(np.frombuffer(had, np.uint8), count=z - a).astype(bool)
                    n_hit = int(h.sum())
                    names = sorted(set(names) | found.get(i, set()))
                    length = max(length, int(longest[a:z].max()) if z > a else 0)
                    if not last:
                        cols["hits_"].append(np.packbits(h).tobytes() if n_hit else None)
                        cols["longest_"].append(length)
                        cols["items_"].append(names)
                        continue
                    cols["n_words"].append(z - a)
                    cols["n_hit"].append(n_hit)
                    cols["longest"].append(length)
                    cols["items"].append(names)
                    cols["cleaned"].append(_without(h, starts[a:z], ends[a:z], data, int(off[i]), int(off[i + 1]))
                                           if n_hit else None)
            if last:
                done = out(batch, cols, {"n_words": pa.int64(), "n_hit": pa.int64(), "longest": pa.int64(),
                                         "items": pa.list_(pa.string()), "cleaned": pa.binary()})
                yield done.set_column(5, "cleaned", done.column(5).cast(pa.string()))
            else:
                kept = out(batch, cols, {"hits_": pa.binary(), "longest_": pa.int64(), "items_": pa.list_(pa.string())})
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *kept.columns[1:]],
                                                 names=["row", "scan_text_", "hits_", "longest_", "items_"])
    return scan


def _without(hit: np.ndarray, starts: np.ndarray, ends: np.ndarray, data: np.ndarray, begin: int, end: int) -> bytes:
    """The text from ``begin`` to ``end`` without its hit runs, from the first letter of a run to its last."""
    edges = np.flatnonzero(np.diff(np.concatenate(([0], hit.view(np.int8), [0]))))
    kept, at = [], begin
    for b, e in zip(edges[::2], edges[1::2]):
        kept.append(data[at:int(starts[b])].tobytes())
        at = int(ends[e - 1])
    kept.append(data[at:end].tobytes())
    return b"".join(kept)


def contamination(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id",
                  item_text_col: str = "text", window: int = 10) -> DataFrame:
    """Every row with its contamination: ``row`` (all columns), n_words, n_hit, longest, items, cleaned.

    Words are runs of ASCII letters, digits and non-ASCII characters, A-Z
    lower-cased.  A window is ``window`` consecutive words of an item; an
    item of fewer words, but not none, is one window.  A word inside any
    occurrence of a window is hit; ``longest`` is the longest matching run of
    words with any item; ``items`` are the ids with an occurring window, as
    strings in order; ``cleaned`` is the text without the hit runs, from the
    first letter of a run to its last.

    Null texts have no words (cleaned: null).  Items that are null, empty or
    repeated are allowed; a null item id is the string ``null``.  With no
    items nothing is hit.
    """
    built, n_blocks = automata(benchmark, item_col, item_text_col, window)
    sc = docs.sparkSession.sparkContext
    own = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                      F.col(text_col).cast("string").alias("scan_text_"), F.lit(None).cast("binary").alias("hits_"),
                      F.lit(0).cast("long").alias("longest_"), F.array().cast("array<string>").alias("items_"))
    starts = range(0, n_blocks, BLOCKS_A_SCAN)
    for first in starts:
        blobs = [r["automaton"] for r in built.filter(F.col("block").between(first, first + BLOCKS_A_SCAN - 1))
                 .orderBy("block").collect()]
        sent = [sc.broadcast(bytes(b)) for b in blobs]
        if first != starts[-1]:
            own = stored(own.mapInArrow(_stream(sent, False), own.schema), "scan-hits")
    schema = T.StructType([own.schema["row"], T.StructField("n_words", T.LongType()),
                           T.StructField("n_hit", T.LongType()), T.StructField("longest", T.LongType()),
                           T.StructField("items", T.ArrayType(T.StringType())),
                           T.StructField("cleaned", T.StringType())])
    return own.mapInArrow(_stream(sent, True), schema).withColumn(
        "cleaned", F.coalesce("cleaned", F.col(f"row.`{text_col}`").cast("string")))


def items_digest(items) -> Column:
    """sha256 of the item ids, comma-joined."""
    return F.sha2(F.concat_ws(",", items).cast("binary"), 256)


def clean_documents(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", max_coverage: float = 0.5,
                    max_run: int | None = None, **kw) -> DataFrame:
    """The documents without benchmark passages; same columns.

    Hit runs are cut out.  A document goes when more than ``max_coverage`` of
    its words are hit, or, where ``max_run`` is given, when a matching run is
    longer than that.  Documents without hits stay as they are.  ``n_chars``,
    where there is such a column, follows the text.
    """
    scanned = contamination(docs, benchmark, text_col, **kw)
    keep = F.col("n_hit") <= max_coverage * F.col("n_words")
    if max_run is not None:
        keep = keep & (F.col("longest") <= max_run)
    hit = F.col("n_hit") > 0
    cols = []
    for c in docs.columns:
        old = F.col(f"row.`{c}`")
        if c == text_col:
            old = F.when(hit, F.col("cleaned")).otherwise(old)
        elif c == "n_chars":
            kind = docs.schema[c].dataType
            old = F.when(hit, F.char_length("cleaned").cast(kind)).otherwise(old)
        cols.append(old.alias(c))
    return scanned.filter((F.col("n_words") == 0) | keep).select(*cols)
