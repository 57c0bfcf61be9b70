"""Sharding by histogram sort, in DataFrame operations only.

Documents are ordered by (hash of the text, hash of the id), so equal texts
are neighbours.  The order is cut where exact byte counts say: each round
counts the bytes below candidate boundaries -- the edges of 2**STEP equal
parts of every cell that still holds a boundary -- over all partitions, and
goes on inside the one part where the boundary falls, until that part is
within the tolerance or is a single key.  Then the rows are exchanged once.

Each shard is cut into ranges of near-equal bytes in the same way, of about
``RANGE_BYTES`` each.  A range is the unit of exchange, so a shard may be larger
than any task.
"""

from __future__ import annotations

from bisect import bisect_left
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cashbook.llm.common import stored

STEP = 8
#: Bytes of a range, and the least and most ranges of a shard (the driver holds one boundary each).
RANGE_BYTES, LEAST_PARTS, MOST_PARTS = 64 << 20, 16, 512
LOW = -(1 << 63)
END = 1 << 63


@dataclass(frozen=True)
class Cell:
    """Keys whose part ``comp`` (0: h, 1: k) has the leading ``depth`` bits of ``low``; for comp 1, h is fixed."""

    comp: int
    depth: int
    low: int
    h: int | None
    below: int        # bytes of all smaller keys

    def edge(self, at: int) -> tuple[int, int]:
        """Boundary key at value ``at`` of the cell's component."""
        if self.comp == 0:
            return at, LOW
        return (self.h, at) if at < END else (self.h + 1, LOW)


def byte_size(text_col: str) -> Column:
    return (F.coalesce(F.octet_length(F.col(text_col).cast("string")), F.lit(0)) + 1).cast("long")


def order_key(id_col: str, text_col: str) -> list[Column]:
    """h, k: both hashes are uniform over the 64-bit range; nulls hash to a fixed value."""
    return [F.xxhash64(F.coalesce(F.col(text_col).cast("string"), F.lit(""))).alias("h"),
            F.xxhash64(F.col(id_col).cast("string")).alias("k")]


def _histogram(keys: DataFrame, cells: list[Cell]) -> dict[Cell, list]:
    """Bytes per 2**STEP parts of every cell: (low, bytes, one key only, one h only), in order."""
    found: dict[Cell, list] = {c: [] for c in cells}
    for comp, depth in sorted({(c.comp, c.depth) for c in cells}):
        own = [c for c in cells if (c.comp, c.depth) == (comp, depth)]
        col, name = (F.col("h"), "h") if comp == 0 else (F.col("k"), "k")
        part = F.shiftright(col, 64 - depth - STEP)
        rows = keys.select("h", "k", "size", part.alias("part"))
        if depth or comp:
            outer = F.shiftright(col, 64 - depth) if depth else F.lit(0).cast("long")
            wanted = F.lit([(c.low >> (64 - depth)) if depth else 0 for c in own]).cast("array<bigint>")
            of_h = F.lit([c.h if comp else 0 for c in own]).cast("array<bigint>")
            listed = (keys.sparkSession.range(1, numPartitions=1)
                      .select(F.explode(F.arrays_zip(wanted.alias("outer"), of_h.alias("at_h"))).alias("c"))
                      .select("c.outer", "c.at_h"))                 # at most one row per boundary
            rows = rows.withColumn("o", outer)
            on = (F.col("o") == F.col("outer")) & ((F.col("h") == F.col("at_h")) if comp else F.lit(True))
            rows = rows.join(F.broadcast(listed), on)
        got = (rows.groupBy(*(["h"] if comp else []), "part")
               .agg(F.sum("size").alias("bytes"), F.min("h").alias("h0"), F.max("h").alias("h1"),
                    F.min("k").alias("k0"), F.max("k").alias("k1")).collect())
        by_cell = {((c.low >> (64 - depth)) if depth else 0, c.h): c for c in own}
        for r in got:
            outer = (r.part >> STEP) if depth else 0
            cell = by_cell[(outer, r.h0 if comp else None)]
            low = r.part << (64 - depth - STEP)
            found[cell].append((low, r.bytes, r.h0 == r.h1 and r.k0 == r.k1, r.h0 if r.h0 == r.h1 else None))
    return {c: sorted(v) for c, v in found.items()}


def splitters(keys: DataFrame, n_ranges: int, tolerance: float) -> tuple[list[tuple[int, int]], int]:
    """Boundary keys of ``n_ranges`` ranges of near-equal bytes, and all bytes.

    Every boundary is exact to ``tolerance`` times a range's share, or to the
    one key that straddles it.
    """
    total = keys.agg(F.sum("size")).first()[0] or 0
    goals = {i: total * i / n_ranges for i in range(1, n_ranges)}
    within = tolerance * total / n_ranges
    at: dict[int, tuple[int, int]] = {}
    open_: dict[int, Cell] = {i: Cell(0, 0, LOW, None, 0) for i in goals} if total else {}
    while open_:
        parts = _histogram(keys, list(dict.fromkeys(open_.values())))
        step: dict[int, Cell] = {}
        for i, cell in open_.items():
            below = cell.below
            for low, size, one_key, one_h in parts[cell]:
                if below + size < goals[i]:
                    below += size
                    continue
                depth, high = cell.depth + STEP, low + (1 << (64 - cell.depth - STEP))
                if one_key or size <= within or (cell.comp == 1 and depth >= 64):
                    nearer = high if below + size - goals[i] < goals[i] - below else low
                    at[i] = cell.edge(nearer)
                elif cell.comp == 0 and one_h is not None:
                    step[i] = Cell(1, 0, LOW, one_h, below)        # copies of one text: go on by id
                else:
                    step[i] = Cell(cell.comp, depth, low, cell.h, below)
                break
            else:
                at[i] = (END, LOW)
        open_ = step
    return [at.get(i, (END, LOW)) for i in goals], total


def range_of(bounds: list[tuple[int, int]]) -> Column:
    """Range number of (h, k): how many boundaries are not above it.

    Boundaries are filed under the leading byte of h, so a row compares only
    with those of its own leading byte.
    """
    n = 1 << STEP
    first = [-(n // 2) + j for j in range(n)]
    heads = [min(h, END - 1) >> (64 - STEP) if h < END else n for h, _ in bounds]
    base = F.lit([bisect_left(heads, j) for j in first])
    hs = [[h for (h, _), x in zip(bounds, heads) if x == j] for j in first]
    ks = [[k for (_, k), x in zip(bounds, heads) if x == j] for j in first]
    slot = (F.shiftright(F.col("h"), 64 - STEP) + (n // 2) + 1).cast("int")
    hs_col = F.element_at(F.array(*[_longs(x) for x in hs]), slot)
    ks_col = F.element_at(F.array(*[_longs(x) for x in ks]), slot)
    passed = F.size(F.filter(F.arrays_zip(hs_col.alias("bh"), ks_col.alias("bk")),
                             lambda b: (b["bh"] < F.col("h")) | ((b["bh"] == F.col("h")) & (b["bk"] <= F.col("k")))))
    return (F.element_at(base, slot) + passed).cast("int")


def _longs(values: list[int]) -> Column:
    return (F.array(*[F.lit(v).cast("long") for v in values]) if values else F.array()).cast("array<bigint>")


def _own_names(columns: list[str]) -> list[str]:
    """The input columns' names beside the two that are added."""
    added = ("shard", "slot")
    taken = {c.lower() for c in columns} | set(added)
    out = []
    for name in columns:
        if name.lower() in added:
            while name.lower() in taken:
                name += "_in"
            taken.add(name.lower())
        out.append(name)
    return out


def shard(df: DataFrame, n_shards: int = 16, id_col: str = "doc_id", text_col: str = "text",
          parts: int | None = None, tolerance: float = 0.01) -> DataFrame:
    """The rows with shard (0 .. n_shards - 1) and slot (gapless from 0 in each shard).

    Size is the UTF-8 bytes of the text plus one (null text: 1).  Each shard is
    exchanged in ``parts`` ranges, by default 16, or more of ``RANGE_BYTES`` each.  Shard sizes
    differ from an even share by about ``tolerance`` / ``parts`` of it, or by
    the one key that straddles a boundary: a document larger than a shard
    leaves shards uneven or empty.  Equal texts are neighbours, but a large
    group may span shards.  Rows that agree in text and id stay together.
    Null ids are equal to each other.  Input columns named shard or slot (in
    any case) are kept with ``_in`` after their names.  An empty table gives
    an empty result.
    """
    own = [F.col(f"`{c}`").alias(n) for c, n in zip(df.columns, _own_names(df.columns))]
    rows = df.select(F.struct(*own).alias("row"), *order_key(id_col, text_col), byte_size(text_col).alias("size"))
    keys = stored(rows.select("h", "k", "size"), "shard-keys")
    if parts is None:
        size = keys.agg(F.sum("size")).first()[0] or 0
        parts = min(MOST_PARTS, max(LEAST_PARTS, -(-size // (n_shards * RANGE_BYTES))))
    bounds, _ = splitters(keys, n_shards * parts, tolerance)
    part = range_of(bounds)
    counts = {r.part: r.n for r in keys.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).collect()}
    before = []                                       # rows of the shard in earlier ranges
    for p in range(n_shards * parts):
        before.append(0 if p % parts == 0 else before[-1] + counts.get(p - 1, 0))
    inside = Window.partitionBy("part").orderBy("h", "k", "size")
    return (rows.withColumn("part", part)
            .withColumn("at", F.row_number().over(inside))
            .select("row.*", F.expr(f"part div {parts}").cast("int").alias("shard"),
                    (F.element_at(F.lit(before).cast("array<bigint>"), F.col("part") + 1) + F.col("at") - 1)
                    .cast("long").alias("slot")))
