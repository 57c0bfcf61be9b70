"""Quotation linking: quoted passages of messages are linked to the messages they come from.

1. A line's quote level is its number of leading ``>`` marks.  Neighbouring
   lines of one level form a passage; lines of level 0 are the message's own.
2. Every quoted line is normalised (spaces collapsed, lower case) and hashed,
   and finds the latest earlier message of its conversation whose own text
   has that line: both kinds of line are put in one order per (conversation,
   line), so a line that many messages share costs no pairs.
3. A paragraph of a passage (its lines between blank ones) with lines not
   found so was wrapped anew or quotes a part of a line.  The hash of its whole
   normalised text finds the latest earlier message whose own text has that
   run of words, however either is cut into lines.  Runs are hashed only where
   a message has the first words of a paragraph.
4. A passage comes from the message that most of its lines point to, the
   latest on ties.  A message replies to the origin of its level-1 passage
   with the most such lines.
5. Conversations are put in reply order: a message that replies to an earlier
   one follows it directly, with all that continues it; a message without
   quotes continues the message before it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cashbook.llm.common import stored

MARK = r"^[ \t]*>"
MARKS = r"^((?:[ \t]*>)+)[ \t]?"
#: First words of a paragraph that are looked up before whole runs are hashed: the most of these that it has.
ANCHORS = (1, 2, 4, 8)


def _level(line: Column) -> Column:
    return F.length(F.regexp_replace(F.regexp_extract(line, MARKS, 1), "[^>]", ""))


def _normal(line: Column) -> Column:
    return F.lower(F.trim(F.regexp_replace(line, r"\s+", " ")))


def own_text(text: Column) -> Column:
    """The text without quoted lines and without blank lines at either end; null stays null."""
    kept = F.array_join(F.filter(F.split(text, "\n"), lambda x: ~F.regexp_like(x, F.lit(MARK))), "\n")
    bare = F.regexp_replace(F.regexp_replace(kept, r"^(?:[ \t\r]*\n)+", ""), r"(?:\n[ \t\r]*)+$", "")
    return F.when(F.regexp_like(text, F.lit(r"(?m)" + MARK)), bare).otherwise(text)


def _messages(df: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """conv, turn, role, text, uid, pid: stored in order of (conv, turn) by range, so a long conversation is spread."""
    rows = df.select(F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"), F.col(role_col).alias("role"),
                     F.col(text_col).cast("string").alias("text"))
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = (rows.repartitionByRange(parts, "conv", "turn", F.xxhash64("role", "text"))
              .sortWithinPartitions("conv", "turn", "role", "text"))
    return stored(placed.withColumn("uid", F.monotonically_increasing_id())
                  .withColumn("pid", F.spark_partition_id()), "quote-messages")


def _latest(asked: DataFrame, own: DataFrame, on: list[str], carry: list[str]) -> DataFrame:
    """The asked rows with origin: the latest earlier turn with equal ``on`` (and conv) in ``own``, or null.

    Both are put in one order; at one turn quotes come first: a message does not quote its own turn.
    """
    both = (asked.select("conv", *on, "turn", F.lit(0).alias("kind"), *carry)
            .unionByName(own.select("conv", *on, "turn", F.lit(1).alias("kind"), F.col("turn").alias("source")),
                         allowMissingColumns=True))
    earlier = Window.partitionBy("conv", *on).orderBy("turn", "kind").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    return (both.withColumn("origin", F.last("source", ignorenulls=True).over(earlier)).filter("kind = 0")
            .drop("kind", "source"))


def _run_origins(messages: DataFrame, paragraphs: DataFrame) -> DataFrame:
    """(uid, passage, para, run_origin): where the words of a paragraph stand in the own text of an earlier message.

    ``paragraphs`` has uid, conv, turn, passage, para and words.  Those not found are left out.
    """
    def text_of(words: Column, at: Column | int, n: Column) -> Column:
        return F.array_join(F.slice(words, at, n), " ")

    k = F.lit(ANCHORS[0])
    for n in ANCHORS[1:]:
        k = F.when(F.size("words") >= n, n).otherwise(k)
    asked = stored(paragraphs.withColumn("k", k).select(
        "uid", "conv", "turn", "passage", "para", "k", F.size("words").alias("n"),
        F.xxhash64(text_of(F.col("words"), 1, F.col("k"))).alias("anchor"),
        F.sha2(F.array_join("words", " "), 256).alias("run")), "quote-paragraphs")
    anchors = asked.groupBy(F.col("conv").alias("qc"), F.col("k").alias("qk"), F.col("anchor").alias("qa")).agg(
        F.collect_set("n").alias("sizes"))
    convs = asked.groupBy(F.col("conv").alias("qc")).agg(F.collect_set("k").alias("ks"))
    # a quoted line is a word in upper case, which no normalised text has, so that no run goes over it
    lines = F.transform(F.split("text", "\n"),
                        lambda x: F.when(F.regexp_like(x, F.lit(MARK)), "Q").otherwise(_normal(x)))
    said = (messages.filter("turn IS NOT NULL AND text IS NOT NULL")
            .join(convs, F.col("conv").eqNullSafe(F.col("qc")))
            .select("uid", "conv", "turn", "ks",
                    F.split(F.array_join(F.filter(lines, lambda x: x != ""), " "), " ").alias("said")))
    starts = F.flatten(F.transform("ks", lambda k: F.when(F.size("said") >= k, F.transform(
        F.sequence(F.lit(1), F.size("said") - k + 1),
        lambda p: F.struct(k.alias("k"), p.alias("p"), F.xxhash64(text_of(F.col("said"), p, k)).alias("anchor"))))
        .otherwise(F.array().cast("array<struct<k:int,p:int,anchor:bigint>>"))))
    hits = (said.select("uid", "conv", F.explode(starts).alias("s")).select("uid", "conv", "s.*")
            .join(anchors, F.col("conv").eqNullSafe(F.col("qc")) & (F.col("k") == F.col("qk"))
                  & (F.col("anchor") == F.col("qa")))
            .select("uid", F.explode("sizes").alias("n"), "p").distinct()
            .groupBy("uid").agg(F.collect_list(F.struct("p", "n")).alias("hits")))
    whole = F.transform(F.filter("hits", lambda x: x["p"] + x["n"] - 1 <= F.size("said")),
                        lambda x: F.sha2(text_of(F.col("said"), x["p"], x["n"]), 256))
    own = (said.join(hits, "uid").select("conv", "turn", F.explode(F.array_distinct(whole)).alias("run"))
           .distinct())
    return (_latest(asked, own, ["run"], ["uid", "passage", "para"]).filter("origin IS NOT NULL")
            .select("uid", "passage", "para", F.col("origin").alias("run_origin")))


def passages(messages: DataFrame) -> DataFrame:
    """Per quoted passage: uid, conv, turn, passage (its first line), level, lines, hash, origin, hits.

    ``lines`` counts the lines that are not blank, ``hits`` those that point
    to the origin, alone or with their paragraph; origin is null where neither
    a line nor a paragraph is found.
    """
    quoting = messages.filter(F.regexp_like("text", F.lit(r"(?m)" + MARK)))
    line = (quoting.select("uid", "conv", "turn", F.posexplode(F.split("text", "\n")).alias("at", "line"))
            .withColumn("level", _level(F.col("line"))))
    by_message = Window.partitionBy("uid").orderBy("at")
    starts = F.coalesce((F.col("level") != F.lag("level").over(by_message)), F.lit(True))
    marked = (line.withColumn("starts", starts)
              .withColumn("passage", F.max(F.when(F.col("starts"), F.col("at"))).over(by_message))
              .filter("level > 0"))
    blank = F.when(F.col("norm") == "", 1).otherwise(0)
    quoted = stored(marked.withColumn("norm", _normal(F.regexp_replace("line", MARKS, "")))
                    .select("uid", "conv", "turn", "passage", "level", "at", "norm",
                            F.sum(blank).over(by_message).alias("para"))
                    .withColumn("h", F.xxhash64("norm")), "quote-lines")
    asked = quoted.filter("norm <> ''")
    # own lines of the conversations that quote, as far as they are quoted
    needed = asked.select(F.col("conv").alias("qc"), F.col("h").alias("qh"), F.col("norm").alias("qn")).distinct()
    convs = needed.select("qc").distinct()
    own = (messages.filter("turn IS NOT NULL").join(convs, F.col("conv").eqNullSafe(F.col("qc")), "left_semi")
           .select("conv", "turn", F.explode(F.split("text", "\n")).alias("line"))
           .filter(~F.regexp_like("line", F.lit(MARK))).withColumn("norm", _normal(F.col("line")))
           .withColumn("h", F.xxhash64("norm")).select("conv", "turn", "h", "norm").distinct())
    own = own.join(needed, F.col("conv").eqNullSafe(F.col("qc")) & (F.col("h") == F.col("qh"))
                   & (F.col("norm") == F.col("qn")), "left_semi")
    found = stored(_latest(asked, own, ["h", "norm"], ["uid", "passage", "para", "at"])
                   .select("uid", "conv", "turn", "passage", "para", "at", "norm", "origin"), "quote-found")
    in_order = F.transform(F.sort_array(F.collect_list(F.struct("at", "norm"))), lambda x: x["norm"])
    open_ = (found.groupBy("uid", "passage", "para").agg(
        F.first("conv").alias("conv"), F.first("turn").alias("turn"), F.count("origin").alias("hits"),
        F.count(F.lit(1)).alias("lines"), F.split(F.array_join(in_order, " "), " ").alias("words"))
        .filter("hits < lines AND turn IS NOT NULL"))
    if not open_.isEmpty():
        runs = _run_origins(messages, open_)
        found = found.join(runs, ["uid", "passage", "para"], "left").withColumn(
            "origin", F.coalesce("run_origin", "origin"))
    pointed = (found.filter("origin IS NOT NULL").groupBy("uid", "passage", "origin")
               .agg(F.count(F.lit(1)).alias("hits"))
               .groupBy("uid", "passage").agg(F.max(F.struct("hits", "origin")).alias("best")))
    text = F.array_join(in_order, " ")
    whole = quoted.groupBy("uid", "passage").agg(
        F.first("conv").alias("conv"), F.first("turn").alias("turn"), F.first("level").alias("level"),
        F.sum(F.when(F.col("norm") != "", 1).otherwise(0)).alias("lines"), F.sha2(F.trim(text), 256).alias("hash"))
    return whole.join(pointed, ["uid", "passage"], "left").select(
        "uid", "conv", "turn", "passage", "level", "lines", "hash", F.col("best.origin").alias("origin"),
        F.coalesce("best.hits", F.lit(0)).alias("hits"))


def _paths(starts: DataFrame) -> DataFrame:
    """(conv, s, path): where the run that starts at turn s hangs; pairs (replied turn, start) from the top.

    ``starts`` has conv, s, p (the turn replied to) and up (start of p's run,
    null for the main run).  Paths double in length every round.
    """
    t = stored(starts.select("conv", "s", "up", F.array("p", "s").alias("path")), "quote-paths")
    while not t.filter("up IS NOT NULL").isEmpty():
        above = t.select(F.col("conv").alias("c2"), F.col("s").alias("s2"), F.col("up").alias("up2"),
                         F.col("path").alias("path2"))
        t = stored(t.join(above, F.col("conv").eqNullSafe(F.col("c2")) & (F.col("up") == F.col("s2")), "left")
                   .select("conv", "s", F.col("up2").alias("up"),
                           F.when(F.col("path2").isNotNull(), F.concat("path2", "path"))
                           .otherwise(F.col("path")).alias("path")), "quote-paths")
    return t.select("conv", "s", "path")


def link_quotations(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                    text_col: str = "text") -> DataFrame:
    """One row per message: conv_id, position, turn, role, reply_to, n_quotes, n_linked, max_level, body.

    ``position`` counts from 0 in reply order; ``reply_to`` is the turn that
    the message quotes, null without a linked quote; ``n_quotes`` and
    ``n_linked`` count its passages with words and those with an origin;
    ``max_level`` is the deepest quote level; ``body`` the text without quotes.

    Null texts have no quotes and a null body.  A null conversation id is one
    conversation.  Messages without a turn come first and are never origins.
    Messages that share a turn stay together in order of role and text.  An
    empty table gives an empty result.
    """
    messages = _messages(df, conv_col, turn_col, role_col, text_col)
    found = stored(passages(messages), "quote-passages")
    per_message = found.groupBy("uid").agg(
        F.sum(F.when(F.col("lines") > 0, 1).otherwise(0)).alias("n_quotes"),
        F.sum(F.when(F.col("origin").isNotNull(), 1).otherwise(0)).alias("n_linked"),
        F.max("level").alias("max_level"),
        F.max(F.when((F.col("level") == 1) & F.col("origin").isNotNull(), F.struct("hits", "origin"))).alias("best"))
    rows = stored(messages.join(per_message, "uid", "left").select(
        "uid", "pid", "conv", "turn", "role", own_text(F.col("text")).alias("body"),
        F.col("best.origin").alias("reply_to"), F.coalesce("n_quotes", F.lit(0)).cast("long").alias("n_quotes"),
        F.coalesce("n_linked", F.lit(0)).cast("long").alias("n_linked"),
        F.coalesce("max_level", F.lit(0)).cast("int").alias("max_level")), "quote-rows")

    # a run starts at each reply; every other message belongs to the run of the message before it
    reply = F.when(F.col("reply_to").isNotNull(), F.col("turn"))
    last = rows.groupBy("conv", "pid").agg(F.max(reply).alias("last"))
    before = Window.partitionBy("conv").orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)
    carried = last.withColumn("carry", F.max("last").over(before)).select(
        F.col("conv").alias("c"), F.col("pid").alias("p"), "carry")
    inside = Window.partitionBy("conv", "pid").orderBy("uid").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    runs = (rows.select("uid", "pid", "conv", "turn", "reply_to", F.max(reply).over(inside).alias("own"))
            .join(carried, F.col("conv").eqNullSafe(F.col("c")) & (F.col("pid") == F.col("p")))
            .select("uid", "conv", "turn", "reply_to", F.greatest("own", "carry").alias("run")))
    runs = stored(runs, "quote-runs")
    of_turn = runs.filter("turn IS NOT NULL").groupBy(F.col("conv").alias("c"), F.col("turn").alias("t")).agg(
        F.max("run").alias("up"))
    starts = (runs.filter("reply_to IS NOT NULL").groupBy("conv", F.col("turn").alias("s"))
              .agg(F.max("reply_to").alias("p"))
              .join(of_turn, F.col("conv").eqNullSafe(F.col("c")) & (F.col("p") == F.col("t")), "left"))
    paths = _paths(starts.select("conv", "s", "p", "up")).select(F.col("conv").alias("c"), "s", "path")
    key = F.when(F.col("path").isNull(), F.array("turn")).otherwise(F.concat("path", F.array("turn")))
    keyed = (runs.join(paths, F.col("conv").eqNullSafe(F.col("c")) & (F.col("run") == F.col("s")), "left")
             .select("uid", "conv", key.alias("key")))
    # a place in the whole order, less the place where the conversation starts
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = stored(keyed.repartitionByRange(parts, "conv", "key", "uid").sortWithinPartitions("conv", "key", "uid")
                     .select("uid", "conv", F.spark_partition_id().alias("part"),
                             F.monotonically_increasing_id().alias("at")), "quote-order")
    sizes = ordered.groupBy("part").agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("lowest"))
    sizes = sizes.select(F.col("part").alias("q"), "lowest", F.coalesce(F.sum("n").over(
        Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("offset"))
    place = ordered.join(F.broadcast(sizes), F.col("part") == F.col("q")).select(
        "uid", "conv", (F.col("at") - F.col("lowest") + F.col("offset")).alias("place"))
    first = place.groupBy(F.col("conv").alias("c")).agg(F.min("place").alias("first"))
    position = place.join(first, F.col("conv").eqNullSafe(F.col("c"))).select(
        "uid", (F.col("place") - F.col("first")).cast("long").alias("position"))
    return rows.join(position, "uid").select(
        F.col("conv").alias("conv_id"), "position", "turn", "role", "reply_to", "n_quotes", "n_linked", "max_level",
        "body")
