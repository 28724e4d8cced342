"""The queries of the corpus operators, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from millrace.llm import html, importance, packing, pieces, repetition, simhash, suffix, topk, toxicity, warc


def tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix.cut_spans(table(spark, sf_dir, "documents"))


def op2_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.warc_round_trip(table(spark, sf_dir, "pages"))


def op4_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.exact_top_k(table(spark, sf_dir, "embeddings"), every=50, k=5, scale=256)


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer("word_bpe_49k.json"))


def op6_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.main_text(table(spark, sf_dir, "pages"))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_components(table(spark, sf_dir, "documents"))


def op8_repetition(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repetition.repetition_rules(table(spark, sf_dir, "documents"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encode_texts(table(spark, sf_dir, "documents"), tokenizer("piece_bpe_32k.model"), with_ids=False)


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_suffix, op2_importance, op3_warc, op4_topk, op5_packing, op6_html, op7_simhash, op8_repetition, op9_toxicity, op10_pieces)
}

QUERIES["pipeline"] = pipeline

def rules_sql() -> str:
    """The repetition rules over words in rows: n-grams as texts, counted and marked by windows."""
    word = "'[^\\x20\\x09-\\x0D]+'"
    grams = lambda n: f"""
        g{n} AS (SELECT r, pos, count(*) OVER (PARTITION BY r, gram) > 1 AS again FROM (SELECT r, pos, n, list(w) OVER (PARTITION BY r ORDER BY pos ROWS BETWEEN CURRENT ROW AND {n - 1} FOLLOWING) AS gram FROM ws) WHERE pos + {n} <= n + 1),
        m{n} AS (SELECT ws.r, coalesce(bool_or(again) OVER (PARTITION BY ws.r ORDER BY ws.pos ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW), false) AS hit, length(w) AS size FROM ws LEFT JOIN g{n} ON g{n}.r = ws.r AND g{n}.pos = ws.pos),
        c{n} AS (SELECT r, count(*) FILTER (WHERE hit) AS repeated, coalesce(sum(size) FILTER (WHERE hit), 0) AS chars FROM m{n} GROUP BY r)"""  # noqa: E731
    limits = repetition.MAX_NGRAM_SHARE
    share = lambda n: f"coalesce(c{n}.chars, 0)::DOUBLE / word_chars"
    return f"""
        WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
        base AS (SELECT r, doc_id, text, regexp_extract_all(text, {word}) AS words, regexp_extract_all(text, '[#*$%&|<>]') AS symbols FROM d),
        ws AS (SELECT r, generate_subscripts(words, 1) AS pos, unnest(words) AS w, len(words) AS n FROM base),
        lines AS (SELECT r, generate_subscripts(ls, 1) AS line_no, unnest(ls) AS line FROM (SELECT r, string_split(text, chr(10)) AS ls FROM base)),
        known AS (SELECT r, line, row_number() OVER (PARTITION BY r, line ORDER BY line_no) > 1 AS dup FROM lines WHERE regexp_matches(line, {word})),
        dups AS (SELECT r, count(*) AS n, sum(length(regexp_replace(line, '[\\x20\\x09-\\x0D]', '', 'g'))) AS chars FROM known WHERE dup GROUP BY r),
        {", ".join(grams(n) for n in (3, *limits))},
        x AS (
            SELECT doc_id, len(words) AS n_words, coalesce(list_sum(list_transform(words, lambda w: length(w))), 0) AS word_chars, len(symbols) AS n_symbols, coalesce(dups.n, 0) AS n_dup_lines,
                   coalesce(c3.repeated, 0) AS n_repeat_words, coalesce(dups.chars, 0) AS dup_line_chars, {", ".join(f"c{n}.chars AS chars{n}" for n in limits)}
            FROM base LEFT JOIN dups USING (r) LEFT JOIN c3 USING (r) {" ".join(f"LEFT JOIN c{n} USING (r)" for n in limits)}
        ), y AS (
            SELECT *, CASE WHEN word_chars = 0 THEN 0.0::DOUBLE ELSE greatest({", ".join(share(n).replace(f"c{n}.chars", f"chars{n}") for n in limits)}) END AS dup_ngram_share, n_words < {repetition.MIN_WORDS} OR 100 * n_repeat_words > {repetition.MAX_REPEAT_PERCENT} * n_words AS base_failed,
                   dup_line_chars > {repetition.MAX_LINE_SHARE}::DOUBLE * word_chars OR (word_chars > 0 AND ({" OR ".join(f"{share(n).replace(f'c{n}.chars', f'chars{n}')} > {most}::DOUBLE" for n, most in limits.items())})) AS over
            FROM x
        )
        SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines, CAST(n_repeat_words AS BIGINT) AS n_repeat_words,
               CAST(dup_line_chars AS BIGINT) AS dup_line_chars, dup_ngram_share, base_failed, NOT base_failed AND NOT over AS kept FROM y
    """


ORACLE_SQL: dict[str, str] = {
    "op4_topk": """
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS x
            FROM embeddings
            WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), s AS (
            SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(list_zip(q.x, c.x), lambda z: z[1] * z[2])) AS BIGINT) AS score
            FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0
        ), r AS (
            SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s
        )
        SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
    """,
    "op8_repetition": rules_sql(),
}
