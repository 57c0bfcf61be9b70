"""Phrase collocations from sorted count streams, as external language model estimation lays them out.

1. Runs.  Every word starts a window of up to four words of its piece.  Tasks
   number the words of a chunk in byte order, sort and count its windows by
   number, cut the sorted run at the range splitters and pack each part with
   the words it uses.
2. Counts.  The parts of one range are merged by renumbering their words and
   sorting; all phrases of one to four words are then runs of equal beginnings,
   so one sorted stream counts every order.  Runs at the ends of a range may go
   on in the next one and are added up; the others are complete.
3. Streams.  The phrases that are frequent enough are kept as two sorted
   streams.  In prefix order a phrase follows its beginnings: one pass hands it
   their counts (left) and hands them the count of their best extension to the
   right.  In suffix order the same pass gives the counts of its endings (right)
   and the best extension to the left.
4. The two passes meet in one merge in phrase order, where cuts are scored.

Every part of a frequent phrase is at least as frequent, so the streams miss
nothing.  A phrase inside a longer candidate is inside one that is a single
word longer and at least as frequent, so one-word extensions decide the
containment rule.
"""

from __future__ import annotations

import bisect
import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cashbook.llm.common import LOWER, byte_class, stored, text_slices, word_spans
from cashbook.llm.search import term_array

#: Pieces end at these bytes; words at space and tab as well.
PIECE_END = np.zeros(256, dtype=bool)
PIECE_END[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
PHRASE_WORD = byte_class([(0x20, 0x20), (0x09, 0x0D)]) & ~PIECE_END

ORDER = 4
#: Words per sorted run, and text bytes per range.
CHUNK_WORDS, RANGE_BYTES = 1 << 20, 8 << 20
#: Ranges at most: this bounds the splitters sent to the tasks (a few words each).
MOST_RANGES = 1 << 15
#: Windows looked at per range when splitters are chosen.
SPLIT_WINDOWS = 64
#: Bits of a word's number where three fit into one sort key.
NUMBER_BITS = 21
#: Parts of a language that are ranked before the whole.
LAST_PARTS = 32


# ------------------------------------------------------------------------ runs

def _packed_key(cols: list[np.ndarray]) -> np.ndarray:
    key = cols[0].astype(np.uint64)
    for c in cols[1:]:
        key <<= np.uint64(NUMBER_BITS)
        key |= c.astype(np.uint64)
    return key


def _in_order(cols: list[np.ndarray], most: int) -> tuple[np.ndarray, np.ndarray]:
    """The order of the windows by language and words, and where a new window begins in it.

    ``most`` is the largest number; small ones are packed into two sort keys.
    """
    keys = cols
    if most < 1 << NUMBER_BITS:
        keys = [_packed_key(cols[:2]), _packed_key(cols[2:])]
    order = np.lexsort(keys[::-1])
    new = np.zeros(len(order), dtype=bool)
    new[:1] = True
    for key in keys:
        key = key[order]
        new[1:] |= key[1:] != key[:-1]
    return order, new


def _ranked(words: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Numbers from 1 in byte order, and the distinct words in that order."""
    coded = words.dictionary_encode()
    order = pc.array_sort_indices(coded.dictionary)
    rank = np.empty(len(order) + 1, dtype=np.int32)
    rank[order.to_numpy()] = np.arange(1, len(order) + 1, dtype=np.int32)
    return rank[coded.indices.to_numpy()], coded.dictionary.take(order)


class _Run:
    """The words of up to one chunk, with their languages and pieces."""

    def __init__(self):
        self.words, self.langs, self.pieces, self.size = [], [], [], 0

    def add(self, langs: list[bytes], data: np.ndarray, off: np.ndarray):
        low = LOWER[data]
        starts, ends, first = word_spans(low, off, PHRASE_WORD)
        if not len(starts):
            return
        stops = np.zeros(len(low) + 1, dtype=np.int64)
        np.cumsum(PIECE_END[low], out=stops[1:])
        n = np.diff(first)
        new = np.zeros(len(starts), dtype=bool)
        new[1:] = stops[starts[1:]] != stops[starts[:-1]]
        new[first[:-1][n > 0]] = True
        self.words.append(term_array(low, starts, ends, PHRASE_WORD))
        self.pieces.append(new)
        self.langs.append(pa.array(langs, pa.binary()).take(pa.array(np.repeat(np.arange(len(n)), n))))
        self.size += len(starts)

    def windows(self) -> tuple[pa.Array, list[np.ndarray], np.ndarray]:
        """(words in order, columns of the distinct sorted windows, their counts); 0 stands for no word."""
        words = pa.concat_arrays(self.words)
        langs = pa.concat_arrays(self.langs).dictionary_encode()
        numbers, vocabulary = _ranked(pa.concat_arrays([words, langs.dictionary]))
        lang = numbers[len(words):][langs.indices.to_numpy()]
        numbers = numbers[:len(words)]
        piece = np.cumsum(np.concatenate(self.pieces))
        cols = [lang, numbers]
        for k in range(1, ORDER):
            nxt = np.zeros(len(numbers), dtype=np.int32)
            if k < len(numbers):
                nxt[:-k] = np.where(piece[k:] == piece[:-k], numbers[k:], 0)
            cols.append(nxt)
        order, new = _in_order(cols, len(vocabulary))
        cut = np.flatnonzero(new)
        return vocabulary, [c[order][cut] for c in cols], np.diff(np.append(cut, len(order)))


def _runs(batches):
    """Runs of about ``CHUNK_WORDS`` words of the (lang, text) rows."""
    run = _Run()
    for batch in batches:
        langs = batch.column(0).to_pylist()
        for lo, hi, data, off in text_slices(batch, "text"):
            run.add(langs[lo:hi], data, off)
            if run.size >= CHUNK_WORDS:
                yield run.windows()
                run = _Run()
    if run.size:
        yield run.windows()


def _places(splitters: list[tuple[bytes, ...]], vocabulary: pa.Array, cols: list[np.ndarray]) -> np.ndarray:
    """The first window of each range: where each splitter falls in the sorted windows."""
    known = vocabulary.to_pylist()
    at = [0]
    for splitter in splitters:
        x, y = 0, len(cols[0])
        for i, (word, col) in enumerate(zip(splitter, cols)):
            some = word or i == 0                # a language may be empty, a word is not
            number = bisect.bisect_left(known, word) + 1 if some else 0
            found = not some or (number <= len(known) and known[number - 1] == word)
            x, y = (x + int(np.searchsorted(col[x:y], number, side)) for side in ("left", "right"))
            if not found:                       # between two known words: everything from the next one on
                break
        at.append(x)
    return np.array(at + [len(cols[0])], dtype=np.int64)


def _packed(vocabulary: pa.Array, cols: list[np.ndarray], counts: np.ndarray) -> bytes:
    """Sorted windows with the words they use, compressed.

    Numbers are those of the part's own words, in byte order.
    """
    used, local = np.unique(np.concatenate(cols), return_inverse=True)
    some = used > 0
    local = local.reshape(len(cols), -1) + (0 if len(used) and used[0] == 0 else 1)
    words = vocabulary.take(pa.array(used[some] - 1)).to_pylist()
    head = np.array([len(words), len(counts)], dtype="<u8").tobytes()
    body = np.concatenate([np.array([len(w) for w in words], dtype="<u4"), local.astype("<u4").reshape(-1),
                           counts.astype("<u4")]).tobytes()
    return zstandard.ZstdCompressor(level=1).compress(head + body + b"".join(words))


def _unpacked(blob: bytes) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(blob)
    words, rows = (int(x) for x in np.frombuffer(raw, "<u8", 2))
    body = np.frombuffer(raw, "<u4", words + (ORDER + 2) * rows, 16)
    ends = np.zeros(words + 1, dtype=np.int32)
    np.cumsum(body[:words], out=ends[1:])
    names = pa.Array.from_buffers(pa.binary(), words, [None, pa.py_buffer(ends), pa.py_buffer(raw[16 + body.nbytes:])])
    local, counts = np.split(body[words:], [(ORDER + 1) * rows])
    return names, local.reshape(ORDER + 1, rows), counts


def _splitters(texts: DataFrame, ranges: int, bytes_: int) -> list[tuple[bytes, ...]]:
    """Windows that cut the sorted windows into about equal ranges; they decide balance only, not results."""
    if ranges < 2:
        return []
    words = max(1, bytes_ // 6)
    every = max(1, words // (ranges * SPLIT_WINDOWS))

    def some(batches):
        for vocabulary, cols, counts in _runs(batches):
            at = np.flatnonzero((np.arange(len(counts)) * 0x9E3779B1) % (1 << 32) < (1 << 32) // every)
            names = pa.concat_arrays([pa.array([b""], pa.binary()), vocabulary])
            yield pa.RecordBatch.from_arrays([names.take(pa.array(c[at])) for c in cols],
                                             names=["lang", "w1", "w2", "w3", "w4"])

    # one in 16 texts, chosen by content, is enough to place the splitters where there are many
    thin = 16 if words > 16 * ranges * SPLIT_WINDOWS else 1
    every = max(1, every // thin)
    part = texts.filter(F.pmod(F.xxhash64("text"), F.lit(thin)) == 0)
    seen = part.mapInArrow(some, "lang binary, w1 binary, w2 binary, w3 binary, w4 binary").toPandas()
    rows = sorted(tuple(bytes(w) for w in r) for r in seen.itertuples(index=False))
    return sorted({rows[len(rows) * i // ranges] for i in range(1, ranges)}) if rows else []


# ---------------------------------------------------------------------- counts

def phrase_counts(texts: DataFrame, least: int) -> DataFrame:
    """(words, a) of all phrases of up to four words with a count of ``least`` or more.

    ``words`` starts with the language; the language alone counts all its words.
    """
    spark = texts.sparkSession
    size = texts.agg(F.sum(F.octet_length("text")).alias("b")).first()["b"] or 0
    ranges = min(MOST_RANGES, max(1, math.ceil(size / RANGE_BYTES)))
    sent = spark.sparkContext.broadcast(_splitters(texts, ranges, size))

    def cut(batches):
        for vocabulary, cols, counts in _runs(batches):
            at = _places(sent.value, vocabulary, cols)
            parts = np.flatnonzero(np.diff(at))
            blobs = [_packed(vocabulary, [c[at[p]:at[p + 1]] for c in cols], counts[at[p]:at[p + 1]]) for p in parts]
            yield pa.RecordBatch.from_arrays([pa.array(parts.astype(np.int32)), pa.array(blobs, pa.binary())],
                                             names=["part", "blob"])

    def merged(blobs: list[bytes]):
        """The runs of equal beginnings of one range: words, count, and whether the run is whole."""
        opened = [_unpacked(b) for b in blobs]
        numbers, vocabulary = _ranked(pa.concat_arrays([o[0] for o in opened]))
        numbers = np.concatenate([np.zeros(1, np.int32), numbers])
        rows = np.cumsum([0] + [len(o[2]) for o in opened])
        cols = np.empty((ORDER + 1, rows[-1]), dtype=np.int32)
        counts = np.empty(rows[-1], dtype=np.int64)
        base = 0
        for k, (own, local, n) in enumerate(opened):
            opened[k] = None
            cols[:, rows[k]:rows[k + 1]] = np.where(local > 0, numbers[local + np.uint32(base)], 0)
            counts[rows[k]:rows[k + 1]] = n
            base += len(own)
        order, _ = _in_order(list(cols), len(vocabulary))
        for c in cols:
            c[:] = c[order]
        counts = counts[order]
        new = np.zeros(len(counts), dtype=bool)
        new[0] = True
        for n in range(1, ORDER + 2):
            new[1:] |= cols[n - 1, 1:] != cols[n - 1, :-1]
            begin = np.flatnonzero(new)
            total = np.add.reduceat(counts, begin)
            end_run = np.zeros(len(begin), dtype=bool)
            end_run[[0, -1]] = True
            keep = (cols[n - 1, begin] > 0) & (end_run | (total >= least))
            ids = cols[:n, begin[keep]] - 1
            flat = vocabulary.take(pa.array(ids.T.reshape(-1))).cast(pa.string())
            off = np.arange(0, n * keep.sum() + 1, n, dtype=np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.ListArray.from_arrays(pa.array(off), flat), pa.array(total[keep]), pa.array(~end_run[keep])],
                names=["words", "a", "whole"])

    def merge(batches):
        held, now = [], None
        for batch in batches:
            for part, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if part != now and held:
                    yield from merged(held)
                    held = []
                now = part
                held.append(blob)
        if held:
            yield from merged(held)

    parts = texts.mapInArrow(cut, "part int, blob binary")
    runs = stored(parts.repartitionById(ranges, "part")
                  .mapInArrow(merge, "words array<string>, a long, whole boolean"), "phrase-runs")
    ends = runs.filter("NOT whole").groupBy("words").agg(F.sum("a").alias("a"))
    whole = runs.filter("whole").select("words", "a")
    return whole.unionByName(ends).filter((F.col("a") >= least) | (F.size("words") == 1))


# --------------------------------------------------------------------- streams

def _sorted_stream(df: DataFrame, *more: str) -> DataFrame:
    """Ranges of phrases, sorted; equal phrases are in one range."""
    return df.repartitionByRange("words").sortWithinPartitions("words", *more)


def _pass(counts: DataFrame) -> DataFrame:
    """One pass over the stream (words, a) in order of ``words``, whose first entry is the language.

    Gives (words, a, parts, best): the counts of the beginnings of 1, 2, ...
    words, shorter than the phrase, and the count of the best phrase that is
    one word longer.  Beginnings that lie in an earlier range are unknown
    (null) and come out once more, without a count, with their best extension
    in this range.
    """
    def scan(batches):
        rows: list[list] = []
        stack: list[list] = []            # words, a, counts of the beginnings, best extension

        def close(depth: int):
            while len(stack) > depth:
                rows.append(stack.pop())

        def out():
            batch = pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.list_(pa.string())), pa.array([r[1] for r in rows], pa.int64()),
                 pa.array([r[2] for r in rows], pa.list_(pa.int64())), pa.array([r[3] for r in rows], pa.int64())],
                names=["words", "a", "parts", "best"])
            rows.clear()
            return batch

        for batch in batches:
            for words, a in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                shared = 0
                top = stack[-1][0] if stack else []
                while shared < min(len(top), len(words)) and top[shared] == words[shared]:
                    shared += 1
                close(shared)
                while len(stack) < len(words) - 1:            # beginnings of an earlier range
                    stack.append([words[:len(stack) + 1], None, [s[1] for s in stack[1:]], None])
                if len(stack) > 1:
                    stack[-1][3] = max(stack[-1][3] or 0, a)
                stack.append([words, a, [s[1] for s in stack[1:]], None])
            if len(rows) >= 20_000:
                yield out()
        close(0)
        if rows:
            yield out()

    kind = "words array<string>, a long, parts array<long>, best long"
    passed = stored(_sorted_stream(counts).mapInArrow(scan, kind), "phrase-pass")
    # at most four unknown beginnings a range
    unknown = passed.filter("a IS NULL").select("words").distinct()
    found = stored(counts.join(F.broadcast(unknown), "words", "left_semi"), "phrase-open")
    whole = passed
    for k in range(1, ORDER):
        begin = F.when(F.size("words") > k + 1, F.slice("words", 1, k + 1))
        side = F.broadcast(found.select(F.col("words").alias("begin_"), F.col("a").alias("known_")))
        whole = whole.withColumn("begin_", F.when(F.get("parts", F.lit(k - 1)).isNull(), begin))
        whole = (whole.join(side, "begin_", "left")
                 .withColumn("parts", F.transform("parts", lambda x, i: F.when(
                     (i == k - 1) & x.isNull(), F.col("known_")).otherwise(x))).drop("begin_", "known_"))
    return whole


def _scored(both: DataFrame, least: int, percent: int) -> DataFrame:
    """Merge of the two passes in phrase order: (lang, phrase, a, l, r, score) of the candidates that stay."""
    def merge(batches):
        rows: list[tuple] = []
        now: list = [None]

        def close():
            words, a, left, right, best = now
            if a is None or a < least or len(words) < 3 or 100 * best >= percent * a:
                return
            n = len(words) - 1
            score, k = min((2_000_000 * a // (left[k - 1] + right[n - k - 1]), k) for k in range(1, n))
            rows.append((words[0], " ".join(words[1:]), a, left[k - 1], right[n - k - 1], score))

        def out():
            cols = list(zip(*rows)) or [()] * 6
            batch = pa.RecordBatch.from_arrays(
                [pa.array(c, pa.string() if i < 2 else pa.int64()) for i, c in enumerate(cols)],
                names=["lang", "phrase", "a", "l", "r", "score"])
            rows.clear()
            return batch

        for batch in batches:
            for words, side, a, parts, best in zip(*(batch.column(i).to_pylist() for i in range(5))):
                if now[0] != words:
                    if now[0] is not None:
                        close()
                    now = [words, None, None, None, 0]
                now[4] = max(now[4], best or 0)
                if a is not None:
                    now[1] = a
                    now[2 + side] = parts
            if len(rows) >= 20_000:
                yield out()
        if now[0] is not None:
            close()
        yield out()

    return _sorted_stream(both, "side").mapInArrow(
        merge, "lang string, phrase string, a long, l long, r long, score long")


def collocations(df: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = 30, top: int = 2000,
                 percent: int = 80) -> DataFrame:
    """The first ``top`` phrases of each language: lang, rank, phrase, a, l, r, n, score.

    Texts are lower-cased (A-Z) and split at ``.,;:!?`` and line feed to
    carriage return into pieces, these at space and tab into words.  A phrase
    of two to four words that occurs ``a >= least`` times is cut after its
    first k words; ``l`` and ``r`` count the two parts and the score is
    floor(2000000 a / (l + r)), in whole numbers of any size; the cut of the
    lowest score counts, the first of several.  Phrases inside a longer one
    with at least ``percent`` % of their count are left out.  Order: score, a,
    both from high to low, then the phrase by its bytes.  ``n`` counts all words of the
    language; a null language is ``und``.  Null and empty texts have no
    words; repeated rows count as often as they stand.  An empty table gives an
    empty result.  Other columns are not read.
    """
    texts = df.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).cast("binary").alias("lang"),
                      F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    counts = stored(phrase_counts(texts, least), "phrase-counts")
    phrases = counts.filter(F.size("words") > 1)
    lang = F.element_at("words", 1)
    turned = F.concat(F.array(lang), F.reverse(F.slice("words", F.lit(2), F.size("words"))))
    prefix = _pass(phrases).withColumn("side", F.lit(0))
    suffix = _pass(phrases.select(turned.alias("words"), "a")).withColumn("side", F.lit(1))
    both = prefix.unionByName(suffix.withColumn("words", turned)).select("words", "side", "a", "parts", "best")
    scored = _scored(stored(both, "phrase-sides"), least, percent)
    # a language's best are among the best of its parts: what meets in the last task has a fixed bound
    best = [F.desc("score"), F.desc("a"), F.col("phrase")]
    part = F.pmod(F.xxhash64("phrase"), F.lit(LAST_PARTS))
    some = (scored.withColumn("part", part)
            .withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*best)))
            .filter(F.col("rank") <= top).drop("rank", "part"))
    ranked = (some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*best)).cast("long"))
              .filter(F.col("rank") <= top))
    total = counts.filter(F.size("words") == 1).select(lang.alias("lang"), F.col("a").alias("n"))
    return ranked.join(total, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
