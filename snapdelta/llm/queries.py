"""The registered queries of the operators: each over its whole table, with production parameters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from snapdelta.llm import (
    decontaminate,
    lexical_search,
    line_dedup,
    mixing,
    near_dedup,
    pii,
    resampling,
    runs,
    secret_scan,
    sharding,
    suffix_tree,
    token_counts,
    vector_dedup,
)
from snapdelta.llm.frames import given
from snapdelta.session import work_folder

TOKENIZER = "byte_bpe_50k.json"
TOKEN_LIMIT = 512
#: A shared folder whose token counts outlive the session; without it a run starts with an empty cache.
TOKEN_CACHE = "spark.snapdelta.tokenCache"


def _joined(spans: Column, span: str = "kind") -> Column:
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x[span], x["start"].cast("string"), x["end"].cast("string"))), ",")


def _count(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")


def op1_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    docs = given(spark, folder, "documents")
    cache = spark.conf.get(TOKEN_CACHE, None) or work_folder(spark, "token-counts")
    return token_counts.count_tokens(docs, cache, public_tokenizers.path(TOKENIZER), TOKEN_LIMIT)


def op2_vector_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return vector_dedup.near_vectors(given(spark, folder, "embeddings"))


def op3_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    found = secret_scan.scan_secrets(given(spark, folder, "documents"))
    base = F.filter("spans", lambda span: span["kind"] != "novel")
    counts = [_count(F.col("spans"), kind) for kind in ("assign", "access", "hex")]
    return found.select("doc_id", *counts, F.sha2(_joined(base), 256).alias("base_sha256"), _joined(F.col("spans")).alias("spans"))


def op4_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.contaminated(given(spark, folder, "documents"), given(spark, folder, "benchmark"))


def op5_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    found = pii.find_personal_data(given(spark, folder, "documents"))
    rank = len(pii.KINDS)
    base = F.transform("base", lambda x: F.struct(x["start"].alias("start"), x["rank"].alias("rank"), x["kind"].alias("kind"), x["end"].alias("end")))
    terms = F.transform("terms", lambda x: F.struct(x["start"].alias("start"), F.lit(rank).alias("rank"), F.lit("term").alias("kind"), x["end"].alias("end")))
    return found.select(
        "doc_id",
        *[_count(F.col("base"), kind) for kind in pii.KINDS],
        F.sha2(_joined(F.col("base")), 256).alias("base_sha256"),
        _joined(F.array_sort(F.concat(base, terms))).alias("spans"),
    )


def op6_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix_by_source(given(spark, folder, "documents"))


def op7_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.assign_shards(given(spark, folder, "documents"))


def op8_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_dedup.near_duplicates(given(spark, folder, "documents")).drop("node")


def op9_suffix_tree(spark: SparkSession, folder: str) -> DataFrame:
    return suffix_tree.score_texts(given(spark, folder, "documents"))


def op10_quality(spark: SparkSession, folder: str) -> DataFrame:
    return resampling.classify(given(spark, folder, "documents"), given(spark, folder, "labels"))


def op11_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = line_dedup.without_common_lines(given(spark, folder, "documents"))
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def _planted(docs: DataFrame) -> DataFrame:
    """(doc_id, text): of every tenth text by the CRC of its id, the end repeats a stretch of its words."""
    digest = F.crc32(F.col("doc_id").cast("string"))
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda word: word != "")
    held = docs.select("doc_id", "text", digest.alias("h")).withColumn("words", F.when((F.col("h") % 10 == 0) & F.col("text").isNotNull(), words))
    n, g = F.size("words"), F.floor(F.col("h") / 10)
    held = held.withColumn("n", F.when(F.col("words").isNotNull() & (n > 0), n)).withColumn("a", (g % F.col("n")).cast("int"))
    held = held.withColumn("p", (1 + F.floor((F.col("n") - F.col("a")) / (3 + g % 8))).cast("int"))
    own = F.transform("words", lambda word, at: F.when(at < F.col("a"), word).otherwise(F.get("words", F.col("a") + F.pmod(at - F.col("a"), F.col("p")))))
    return held.select("doc_id", F.when(F.col("n").isNotNull(), F.array_join(own, " ")).otherwise(F.col("text")).alias("text"))


def op12_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    found = runs.find_runs(_planted(given(spark, folder, "documents")))
    best = F.reduce(
        F.slice("runs", 2, F.greatest(F.size("runs"), F.lit(1))),
        F.get("runs", F.lit(0)),
        lambda held, run: F.when(run["length"] > held["length"], run).otherwise(held),
    )
    lines = F.transform("runs", lambda run: F.concat(F.concat_ws(",", *[run[name].cast("string") for name in ("start", "length", "period")]), F.lit("\n")))
    return found.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        *[F.col(f"best.{name}").alias(name) for name in ("start", "length", "period")],
        F.expr("best.length * 1000 div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op13_lexical_search(spark: SparkSession, folder: str) -> DataFrame:
    index = lexical_search.build_index(given(spark, folder, "documents"))
    return lexical_search.search(index, given(spark, folder, "benchmark"))


QUERIES = {
    function.__name__: function
    for function in (
        op1_token_counts,
        op2_vector_dedup,
        op3_secret_scan,
        op4_decontamination,
        op5_personal_data,
        op6_mixing,
        op7_sharding,
        op8_near_dedup,
        op9_suffix_tree,
        op10_quality,
        op11_line_dedup,
        op12_periodic_runs,
        op13_lexical_search,
    )
}

ORACLES = {
    "op2_vector_dedup": """
        WITH RECURSIVE
        v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
              WHERE list_max(embedding) <> 0 OR list_min(embedding) <> 0),
        link AS (SELECT a.vec_id AS x, b.vec_id AS y FROM v a JOIN v b ON a.vec_id <> b.vec_id
                 WHERE list_cosine_similarity(a.e, b.e) >= 0.95),
        reach(x, y) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT r.x, l.y FROM reach r JOIN link l ON r.y = l.x),
        least AS (SELECT x, min(y) AS component_id FROM reach GROUP BY x),
        n AS (SELECT x, count(*) AS n_links FROM link GROUP BY x)
        SELECT e.vec_id, coalesce(n.n_links, 0) AS n_links, least.component_id, e.vec_id = least.component_id AS kept
        FROM embeddings e JOIN least ON least.x = e.vec_id LEFT JOIN n ON n.x = e.vec_id
    """,
    "op6_mixing": r"""
        WITH d AS (SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size,
                          md5('1|' || doc_id || '|' || md5(coalesce(text, ''))) AS key FROM documents),
        s AS (SELECT source, sum(size) AS source_size, [3, 1, 2][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS w
              FROM d GROUP BY source),
        o AS (SELECT *, 2 * source_size AS most, 1.5 * (sum(source_size) OVER ()) AS total, sum(w) OVER () AS all_w,
                     row_number() OVER (ORDER BY CAST(2 * source_size AS DOUBLE) / w, source NULLS LAST) AS nth FROM s),
        c AS (SELECT *, coalesce(sum(most) OVER (ORDER BY nth ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS most_before,
                     coalesce(sum(w) OVER (ORDER BY nth ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS w_before FROM o),
        f AS (SELECT *, min(CAST((total - most_before) * w / (all_w - w_before) >= most AS int)) OVER (ORDER BY nth) = 1 AS full_up FROM c),
        left_over AS (SELECT max(total) - coalesce(sum(most) FILTER (full_up), 0) AS words, max(all_w) - coalesce(sum(w) FILTER (full_up), 0) AS w FROM f),
        t AS (SELECT f.source, CAST(source_size AS BIGINT) AS source_size,
                     CASE WHEN full_up THEN CAST(most AS DOUBLE) ELSE CAST(l.words AS DOUBLE) * f.w / CAST(l.w AS DOUBLE) END AS target
              FROM f, left_over l),
        p AS (SELECT *, CAST(floor(target) AS BIGINT) // greatest(source_size, 1) AS rounds, CAST(floor(target) AS BIGINT) % greatest(source_size, 1) AS rest FROM t),
        b AS (SELECT d.*, coalesce(sum(size) OVER (PARTITION BY source ORDER BY key ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM d)
        SELECT b.doc_id, CAST(b.size AS BIGINT) AS size, p.source_size, p.target,
               CAST(p.rounds * b.size + greatest(0, least(b.size, p.rest - b.below)) AS BIGINT) AS taken
        FROM b JOIN p ON b.source IS NOT DISTINCT FROM p.source
    """,
    "op11_line_dedup": r"""
        WITH d AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
        l AS (SELECT r, generate_subscripts(lines, 1) AS i, unnest(lines) AS line FROM d),
        k AS (SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                                  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
        often AS (SELECT key FROM k WHERE key <> '' GROUP BY key HAVING count(DISTINCT r) >= 10),
        s AS (SELECT r, count(*) AS n_lines, count(often.key) AS n_dropped,
                     sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (often.key IS NULL), '')) AS kept_sha256
              FROM k LEFT JOIN often ON k.key = often.key GROUP BY r)
        SELECT doc_id, n_lines, n_dropped, kept_sha256 FROM d JOIN s USING (r)
    """,
    "op13_lexical_search": r"""
        WITH d AS (SELECT row_number() OVER () AS r, doc_id,
                          regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                             '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents),
        q AS (SELECT row_number() OVER () AS item, item_id,
                     list_distinct(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS terms FROM benchmark),
        asked AS (SELECT item, item_id, unnest(terms) AS term FROM q),
        c AS (SELECT count(*) AS n_docs, CAST(sum(len(terms)) AS BIGINT) AS n_terms FROM d WHERE len(terms) > 0),
        t AS (SELECT r, unnest(terms) AS term FROM d),
        tf AS (SELECT r, term, count(*) AS tf FROM t WHERE term IN (SELECT term FROM asked) GROUP BY r, term),
        w AS (SELECT term, CAST(floor(1000 * ln((2 * max(n_docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM tf, c GROUP BY term),
        m AS (SELECT r, doc_id, 100 - 50 + (50 * len(terms) * n_docs) // n_terms AS m FROM d, c),
        s AS (SELECT item, item_id, r, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m))) AS BIGINT) AS score
              FROM asked JOIN w USING (term) JOIN tf USING (term) JOIN m USING (r) GROUP BY item, item_id, r, doc_id),
        o AS (SELECT *, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST, r) AS nth FROM s WHERE score > 0)
        SELECT item_id, CAST(nth AS INTEGER) AS rank, doc_id, score FROM o WHERE nth <= 50
    """,
}
