"""The registered queries of the operators: each applies one to its whole table."""

from __future__ import annotations

from pyspark.sql import functions as F

from cashbook.llm.common import held_out, stored, table


def op1_quotation_linking(spark, sf):
    from cashbook.llm.quotation import link_quotations
    return link_quotations(table(spark, sf, "conversations"))


def op2_suffix_dedup(spark, sf):
    from cashbook.llm.suffix_dedup import remove_repeats
    return remove_repeats(table(spark, sf, "documents")).drop("kept")


def op3_exact_dedup(spark, sf):
    from cashbook.llm.exact_dedup import exact_dedup
    return exact_dedup(table(spark, sf, "documents")).drop("bucket")


def op4_lm_scoring(spark, sf):
    from cashbook.llm.lm import score_documents
    return score_documents(table(spark, sf, "documents"))


def op5_decontamination(spark, sf):
    from cashbook.llm.decontaminate import contamination, items_digest
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return contamination(docs, table(spark, sf, "benchmark")).select(
        F.col("row.doc_id").alias("doc_id"), "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        items_digest(F.col("items")).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def op6_jaccard_join(spark, sf):
    from cashbook.llm.jaccard_join import similar_documents
    return similar_documents(table(spark, sf, "documents"))


def op7_mixing(spark, sf):
    from cashbook.llm.mixing import mix
    return mix(table(spark, sf, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op8_quality(spark, sf):
    from cashbook.llm.quality import quality_scores
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return quality_scores(docs, table(spark, sf, "labels")).select(
        "doc_id", held_out("doc_id", 5, 0).alias("held_out"), F.col("quality_score").alias("score"),
        (F.col("quality_score") >= 0.3).cast("int").alias("predicted"))


def op10_toxicity(spark, sf):
    from cashbook.llm.toxicity import fit, score
    docs = table(spark, sf, "documents").select("doc_id", "text")
    model = fit(docs, table(spark, sf, "labels"))
    return score(docs, model).select(
        F.col("row.doc_id").alias("doc_id"), held_out("row.doc_id", 3, 1).alias("held_out"), "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op9_sharding(spark, sf):
    from cashbook.llm.sharding import byte_size, shard
    shards = stored(shard(table(spark, sf, "documents"), 16), "shards")
    crc = F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary"))
    return shards.select("doc_id", byte_size("text").alias("size"), crc.alias("text_crc32"),
                         F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op11_ranked_search(spark, sf):
    from cashbook.llm.search import ranked_search
    found = ranked_search(table(spark, sf, "documents"), table(spark, sf, "benchmark"))
    return found.select(F.col("item").alias("item_id"), "rank", F.col("doc").alias("doc_id"), "score")


def op12_collocations(spark, sf):
    from cashbook.llm.phrases import collocations
    return collocations(table(spark, sf, "documents"))


def op13_simhash(spark, sf):
    from cashbook.llm.simhash import simhash_components
    return simhash_components(table(spark, sf, "documents"))


QUERIES = {
    "op1_quotation_linking": op1_quotation_linking,
    "op2_suffix_dedup": op2_suffix_dedup,
    "op3_exact_dedup": op3_exact_dedup,
    "op4_lm_scoring": op4_lm_scoring,
    "op5_decontamination": op5_decontamination,
    "op6_jaccard_join": op6_jaccard_join,
    "op7_mixing": op7_mixing,
    "op8_quality": op8_quality,
    "op9_sharding": op9_sharding,
    "op10_toxicity": op10_toxicity,
    "op11_ranked_search": op11_ranked_search,
    "op12_collocations": op12_collocations,
    "op13_simhash": op13_simhash,
}

_SIZES = r"""SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size FROM documents"""

ORACLE_SQL = {
    "op3_exact_dedup": r"""
WITH d AS (SELECT doc_id, length(coalesce(text, '')) AS points,
                  regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm FROM documents),
     w AS (SELECT doc_id, points, norm, count(*) OVER (PARTITION BY norm) AS group_size,
                  row_number() OVER (PARTITION BY norm ORDER BY points DESC, doc_id NULLS LAST) AS pos,
                  first_value(doc_id) OVER (PARTITION BY norm ORDER BY points DESC, doc_id NULLS LAST) AS keep_id
           FROM d)
SELECT doc_id, keep_id, group_size, pos = 1 AS kept, sha256(norm) AS text_sha256 FROM w""",
    "op11_ranked_search": r"""
WITH t AS (SELECT doc_id, row_number() OVER () AS row_no, regexp_extract_all(
             translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS words FROM documents),
     d AS (SELECT row_no, doc_id, words, len(words) AS n FROM t WHERE len(words) > 0),
     c AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM d),
     q AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(
             translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
     w AS (SELECT row_no, doc_id, n, unnest(words) AS term FROM d),
     p AS (SELECT row_no, doc_id, n, term, count(*) AS tf FROM w
           WHERE term IN (SELECT term FROM q) GROUP BY row_no, doc_id, n, term),
     f AS (SELECT term, CAST(floor(1000 * ln((2 * any_value(docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS weight
           FROM p, c GROUP BY term),
     i AS (SELECT row_no, doc_id, term,
                  (1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + ((50 * n * docs) // terms))) AS impact
           FROM p, c),
     s AS (SELECT item_id, row_no, doc_id, CAST(sum(weight * impact) AS BIGINT) AS score
           FROM q JOIN i USING (term) JOIN f USING (term) GROUP BY item_id, row_no, doc_id),
     r AS (SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER)
                  AS rank, doc_id, score FROM s WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM r WHERE rank <= 50""",
    "op12_collocations": r"""
WITH t AS (SELECT row_number() OVER () AS row_no, coalesce(lang, 'und') AS lang,
                  translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
           FROM documents),
     p AS (SELECT lang, unnest(regexp_split_to_array(text, '[.,;:!?\x0A-\x0D]')) AS piece FROM t),
     w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS words FROM p),
     g AS (SELECT lang, words, unnest(range(1, len(words) + 1)) AS start FROM w WHERE len(words) > 0),
     n AS (SELECT lang, count(*) AS n FROM g GROUP BY lang),
     o AS (SELECT lang, words[start:start + size - 1] AS phrase
           FROM g, (VALUES (1), (2), (3), (4)) AS sizes(size) WHERE start + size - 1 <= len(words)),
     f AS (SELECT lang, phrase, count(*) AS a FROM o GROUP BY lang, phrase HAVING count(*) >= 30),
     cand AS (SELECT * FROM f WHERE len(phrase) >= 2),
     cuts AS (SELECT c.lang, c.phrase, c.a, k, x.a AS l, y.a AS r,
                     CAST((2000000 * CAST(c.a AS HUGEINT)) // (x.a + y.a) AS BIGINT) AS score
              FROM cand c, (VALUES (1), (2), (3)) AS ks(k), f x, f y
              WHERE k < len(c.phrase) AND x.lang = c.lang AND x.phrase = c.phrase[1:k]
                AND y.lang = c.lang AND y.phrase = c.phrase[k + 1:]),
     best AS (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS pos FROM cuts),
     inner_ AS (SELECT lang, a, phrase[s:s + size - 1] AS part
                FROM cand, (VALUES (2), (3)) AS sizes(size), (VALUES (1), (2), (3)) AS starts(s)
                WHERE size < len(phrase) AND s + size - 1 <= len(phrase)),
     gone AS (SELECT DISTINCT c.lang, c.phrase FROM cand c JOIN inner_ i
              ON i.lang = c.lang AND i.part = c.phrase AND 100 * i.a >= 80 * c.a),
     kept AS (SELECT b.* FROM best b WHERE pos = 1 AND NOT EXISTS
              (SELECT 1 FROM gone WHERE gone.lang = b.lang AND gone.phrase = b.phrase)),
     r AS (SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC,
                                           array_to_string(phrase, ' ')) AS rank,
                  array_to_string(phrase, ' ') AS phrase, a, l, r, score FROM kept)
SELECT lang, rank, phrase, a, l, r, n, score FROM r JOIN n USING (lang) WHERE rank <= 2000""",
}
