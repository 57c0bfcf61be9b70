"""Mixing sources to target weights by pivotal dependent rounding, in DataFrame operations only.

Every document starts with the same expected number of copies as its source
(target / source size, at most the cap).  The whole part is certain.  The
fractional parts are rounded by the pivotal method on word mass: two
documents of a source meet, and mass moves between them at random, with the
odds that keep both expectations, until one of them is taken or left.  The
words taken from a source therefore stay equal to its target up to one last
document.

The meetings form a reduction tree: documents of a source are dealt by hash
into groups of about ``fan_in``; a group is folded in one row and leaves at
most one undecided document, and these meet again on the next level.  A
source of any size is spread over all tasks, and level k holds fan_in**-k of
the rows.
"""

from __future__ import annotations

from math import ceil

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cashbook.llm.common import WORD, stored

#: Relative mass below which a document counts as integral.
EPS = 1e-9


def word_count(text_col: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text_col).cast("string"), F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, cap: float = 3.0, weights: tuple[int, ...] = (1, 2, 3)) -> DataFrame:
    """Per source: source_size, target (column ``src`` is the source).

    Sources in code-point order, null last, weigh ``weights`` in turn and
    share all sizes.  A target stops at cap * source size and the excess is
    shared again by weight: with the sources in order of cap * size / weight,
    the capped ones come first, so running sums find the final level.  The
    windows run over one row per source.
    """
    w = F.element_at(F.lit(list(weights)), ((F.col("at") - 1) % len(weights) + 1).cast("int")).cast("double")
    ordered = Window.orderBy(F.col("src").asc_nulls_last())
    s = (sizes.groupBy("src").agg(F.sum("size").alias("source_size"))
         .withColumn("at", F.row_number().over(ordered)).withColumn("weight", w)
         .withColumn("most", cap * F.col("source_size"))
         .withColumn("ratio", F.col("most") / F.col("weight")))
    by_ratio = Window.orderBy("ratio", "at")
    everything = Window.partitionBy()
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    s = (s.withColumn("total", F.sum("source_size").over(everything))
         .withColumn("all_weight", F.sum("weight").over(everything))
         .withColumn("used", F.coalesce(F.sum("most").over(before), F.lit(0.0)))
         .withColumn("gone", F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
         .withColumn("level", (F.col("total") - F.col("used")) / (F.col("all_weight") - F.col("gone")))
         # the first source whose share at this level is within its cap sets the level of all later ones
         .withColumn("fits", F.col("level") * F.col("weight") <= F.col("most"))
         .withColumn("final", F.min(F.when(F.col("fits"), F.struct("ratio", "at", "level"))).over(everything)))
    target = F.least(F.col("most"), F.coalesce(F.col("final.level") * F.col("weight"), F.col("most")))
    return s.select("src", "source_size", target.alias("target"))


def _fold(group: Column) -> Column:
    """Fold one group: (carry index or -1, carry mass, indices taken).

    Elements have i (index), s (size), m (mass, 0 < m < s) and u (uniform).
    """
    def state(c, m, s, up):
        return F.struct(c.cast("int").alias("c"), m.cast("double").alias("m"),
                        s.cast("double").alias("s"), up.alias("up"))

    none, zero = F.lit(-1), F.lit(0.0)
    start = state(none, zero, zero, F.array().cast("array<int>"))

    def meet(acc, x):
        room_c, room_x = acc["s"] - acc["m"], x["s"] - x["m"]
        to_c, to_x = F.least(room_c, x["m"]), F.least(acc["m"], room_x)
        left_x = x["m"] - room_c                    # carry is filled, x keeps this
        grown_x = x["m"] + acc["m"]                 # x takes all of the carry
        with_c, with_x = F.concat(acc["up"], F.array(acc["c"])), F.concat(acc["up"], F.array(x["i"]))
        gives = x["u"] * (to_c + to_x) < to_x       # x gives to the carry with odds to_x : to_c
        return (F.when(acc["c"] < 0, state(x["i"], x["m"], x["s"], acc["up"]))
                .when(gives & (room_c <= x["m"]) & (left_x <= EPS * x["s"]), state(none, zero, zero, with_c))
                .when(gives & (room_c <= x["m"]), state(x["i"], left_x, x["s"], with_c))
                .when(gives, state(acc["c"], acc["m"] + x["m"], acc["s"], acc["up"]))
                .when((acc["m"] <= room_x) & (x["s"] - grown_x <= EPS * x["s"]), state(none, zero, zero, with_x))
                .when(acc["m"] <= room_x, state(x["i"], grown_x, x["s"], acc["up"]))
                .otherwise(state(acc["c"], acc["m"] - room_x, acc["s"], with_x)))

    return F.aggregate(group, start, meet)


def _uniform(*key) -> Column:
    return F.shiftrightunsigned(F.xxhash64(*key), 11).cast("double") / float(1 << 53)


def pivotal_copies(units: DataFrame, targets: DataFrame, cap: int = 3, fan_in: int = 64,
                   seed: int = 7) -> DataFrame:
    """Copies per unit (columns id, src, size, n): adds source_size, target, copies.

    A unit of n equal rows is rounded as one, of size n * size.
    """
    u = units.alias("u").join(targets.alias("t"), F.col("u.src").eqNullSafe(F.col("t.src")))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    whole = F.least(F.floor(rate), F.lit(cap)).cast("int")
    start = stored(
        u.select("id", F.col("u.src").alias("src"), "size", "n", "source_size", "target",
                 whole.alias("whole"), (F.col("size") * F.col("n")).cast("double").alias("s"),
                 F.when(whole < cap, rate - whole).otherwise(0.0).alias("frac"))
        .withColumn("m", F.col("frac") * F.col("s"))
        .withColumn("open", (F.col("m") > EPS * F.col("s")) & (F.col("s") > 0)), "mix-units")
    keep = ["id", "src", "size", "n", "source_size", "target", "whole", "s"]
    done = [start.filter(~F.col("open")).select(*keep[:-2], F.col("whole").alias("copies"))]
    level, rows = 0, start.filter("open").select(*keep, "m")
    per_source = rows.groupBy("src").agg(F.count(F.lit(1)).alias("left"))
    most = per_source.agg(F.max("left")).first()[0]
    while most:
        last = most <= fan_in
        groups = F.greatest(F.ceil(F.col("left") / float(fan_in ** (level + 1))), F.lit(1))
        sized = (rows.alias("r").join(per_source.alias("c"), F.col("r.src").eqNullSafe(F.col("c.src")))
                 .select("r.*", F.pmod(F.xxhash64("id", "size", F.lit(seed + level)), groups).alias("g")))
        # large documents first: what is left undecided tends to be small
        member = F.struct((-F.col("s")).alias("large"), F.xxhash64("id", "size", F.lit(seed + 100 + level)).alias("order"),
                          *[F.col(k) for k in keep if k != "src"], "m",
                          _uniform("id", "size", F.lit(seed + 200 + level)).alias("u"))
        folded = (sized.groupBy("src", "g").agg(F.sort_array(F.collect_list(member)).alias("members"))
                  .withColumn("r", _fold(F.transform("members", lambda x, i: F.struct(
                      i.alias("i"), x["s"].alias("s"), x["m"].alias("m"), x["u"].alias("u")))))
                  .select("src", "r", F.posexplode("members").alias("at", "x"))
                  .select("src", *[F.col(f"x.{k}").alias(k) for k in keep if k != "src"],
                          (F.col("at") == F.col("r.c")).alias("carry"), F.col("r.m").alias("m"),
                          F.array_contains("r.up", F.col("at")).alias("up")))
        out = stored(folded, f"mix-level{level}")
        done.append(out.filter(~F.col("carry")).select(
            *keep[:-2], (F.col("whole") + F.col("up").cast("int")).alias("copies")))
        rows = out.filter("carry").select(*keep, "m")
        if last:                                      # one group a source: its last document is drawn alone
            alone = _uniform("id", "size", F.lit(seed + 300)) * F.col("s") < F.col("m")
            done.append(rows.select(*keep[:-2], (F.col("whole") + alone.cast("int")).alias("copies")))
            break
        level, most = level + 1, ceil(most / fan_in)
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    return out


def decide(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
           cap: int = 3, weights: tuple[int, ...] = (1, 2, 3), fan_in: int = 64, seed: int = 7) -> DataFrame:
    """Copies per unit of equal (id, src, size): id, src, size, n, source_size, target, copies."""
    rows = df.select(F.col(id_col).alias("id"), F.col(source_col).alias("src"), word_count(text_col).alias("size"))
    units = stored(rows.groupBy("id", "src", "size").agg(F.count(F.lit(1)).alias("n")), "mix-sizes")
    targets = stored(source_targets(units.select("src", (F.col("size") * F.col("n")).alias("size")),
                                    float(cap), weights), "mix-targets")
    return pivotal_copies(units, targets, cap, fan_in, seed)


def mix(df: DataFrame, **kw) -> DataFrame:
    """Decisions per input row: doc_id, source, size, source_size, target, copies, taken.

    Size is the number of words (null text: 0).  Rows that agree in id,
    source and size get the same number of copies.  Rows without words take
    nothing: their copies are the whole part of their source's rate.  Null
    ids and null sources are ordinary values; the null source is last in
    order.  The draw depends on ids, sizes and ``seed`` only, so reruns
    agree.  An empty table gives an empty result.  Keywords as in ``decide``.
    """
    return (decide(df, **kw)
            .select("*", F.explode(F.sequence(F.lit(1), F.col("n").cast("int"))).alias("row"))
            .select(F.col("id").alias("doc_id"), F.col("src").alias("source"), "size", "source_size", "target",
                    F.col("copies").cast("int").alias("copies"),
                    (F.col("copies") * F.col("size")).cast("long").alias("taken")))


def mixed_documents(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    source_col: str = "source", **kw) -> DataFrame:
    """The documents of the mix: every row repeated as often as the mix takes it.  Same columns as ``df``.

    Cases as in ``mix``; a row without words is kept once, as it moves no mass.
    """
    own = [F.col(f"`{c}`") for c in df.columns]
    rows = df.select(F.struct(*own).alias("row"), F.col(id_col).alias("row_id"),
                     F.col(source_col).alias("row_src"), word_count(text_col).alias("row_size"))
    d = decide(df, id_col, text_col, source_col, **kw).select("id", "src", "size", "copies")
    on = (F.col("row_id").eqNullSafe(F.col("id")) & F.col("row_src").eqNullSafe(F.col("src"))
          & (F.col("row_size") == F.col("size")))
    times = F.when(F.col("row_size") == 0, 1).otherwise(F.col("copies").cast("int"))
    return (rows.join(d, on).withColumn("times", times).filter("times > 0")
            .select("row", F.explode(F.sequence(F.lit(1), F.col("times"))).alias("time")).select("row.*"))
