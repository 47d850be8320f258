"""The queries of the operators over their whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from monthgrain.llm import (
    alignment,
    bpe,
    chat,
    exact,
    fingerprint,
    jaccard,
    licenses,
    lines,
    mixing,
    pages,
    quality,
    resampling,
    toxicity,
)
from monthgrain.llm.labelled import held_out

Query = Callable[[SparkSession, str], DataFrame]
#: The public vocabularies, at the same place on all machines.
VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
BYTE_LEVEL = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    trees = quality.train(docs, table(spark, sf_dir, "labels"))
    return quality.score(docs, trees).select(
        "doc_id",
        held_out().alias("held_out"),
        "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"),
    )


def op2_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.edited_neighbours(table(spark, sf_dir, "documents"))


#: The tree of sources: bulk and two smaller domains, English first, all sources alike.
DOMAIN = (
    "CASE WHEN source = 'src0' THEN 'bulk' "
    "WHEN try_cast(regexp_extract(source, '([0-9]+)', 1) AS int) % 2 = 1 THEN 'odd' ELSE 'even' END"
)
WEIGHTS = {
    "domain": "CASE domain WHEN 'bulk' THEN 2 WHEN 'odd' THEN 5 ELSE 3 END",
    "lang": "CASE lang WHEN 'en' THEN 6 WHEN 'de' THEN 3 ELSE 2 END",
    "source": "CASE WHEN source LIKE '%1' THEN 2 ELSE 1 END",
}
#: The share of all tokens that is taken.
BUDGET = (3, 5)


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    return mixing.mix(docs, DOMAIN, WEIGHTS, BUDGET).select(
        "doc_id", "domain", "lang", "source", "n_tokens", "copies"
    )


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).select(
        "doc_id",
        held_out().alias("held_out"),
        "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
        F.size("passages").cast("long").alias("n_passages"),
    )


def op5_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return licenses.scan(docs, licenses.train(docs))


def op6_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_groups(table(spark, sf_dir, "documents"), jaccard.Join(3, 90, 100))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return lines.drop_repeated_lines(docs).select(
        "doc_id",
        "n_lines",
        "n_removed",
        F.length(F.coalesce("text", F.lit(""))).cast("long").alias("n_chars"),
        F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256"),
    )


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_duplicates(table(spark, sf_dir, "documents"))


def op9_chat_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and one more, of control strings alone."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    more = spark.sql(
        "SELECT -1L AS conv_id, turn, role, '</s>[INST] ok [/INST]' AS text "
        "FROM VALUES (0L, 'user'), (1L, 'assistant') AS t(turn, role)"
    )
    return chat.read_back(chat.windows(turns.unionByName(more)))


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.decode(bpe.encode(docs, VOCABULARY), VOCABULARY).select(
        "doc_id",
        F.col("n_tokens"),
        F.sha2("token_ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op11_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages_table = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return pages.extract(pages_table)


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return alignment.link_counts(docs, BYTE_LEVEL, PIECES)


def op13_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    target = table(spark, sf_dir, "benchmark").select("text")
    return resampling.resample(docs, target).drop("n_words")


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_quality,
        op2_fingerprints,
        op3_mixing,
        op4_toxicity,
        op5_licenses,
        op6_ngram_jaccard,
        op7_line_dedup,
        op8_exact_dedup,
        op9_chat_windows,
        op10_bpe,
        op11_pages,
        op12_alignment,
        op13_resampling,
    )
}

_MIX_LEVEL = """
    {name}_n AS (
        SELECT {own}, 2 * sum(tokens) AS room, CAST({weight} AS BIGINT) AS weight, {total} AS total
        FROM leaves {join} GROUP BY ALL),
    {name}_o AS (
        SELECT *, coalesce(sum(room) OVER (PARTITION BY {parent} ORDER BY room / weight, {name}
                   ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below,
               sum(weight) OVER (PARTITION BY {parent} ORDER BY room / weight, {name}
                   ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rest
        FROM {name}_n WHERE weight > 0),
    {name}_f AS (SELECT *, room * rest <= (total - below) * weight AS is_full FROM {name}_o),
    {name}_s AS (
        SELECT {own}, CAST(if(is_full, room, (total - sum(if(is_full, room, 0)) OVER same) * weight
               // greatest(sum(if(is_full, 0, weight)) OVER same, 1)) AS BIGINT) AS share_{name}
        FROM {name}_f WINDOW same AS (PARTITION BY {parent})),
"""


def _mix_sql() -> str:
    domain = DOMAIN.replace("try_cast", "TRY_CAST")
    levels = [
        _MIX_LEVEL.format(
            name="domain",
            own="domain",
            weight=WEIGHTS["domain"],
            parent="0",
            join="",
            total="(SELECT sum(tokens) * 3 // 5 FROM leaves)",
        ),
        _MIX_LEVEL.format(
            name="lang",
            own="domain, lang",
            weight=WEIGHTS["lang"],
            parent="domain",
            join="JOIN domain_s USING (domain)",
            total="share_domain",
        ),
        _MIX_LEVEL.format(
            name="source",
            own="domain, lang, source",
            weight=WEIGHTS["source"],
            parent="domain, lang",
            join="JOIN lang_s USING (domain, lang)",
            total="share_lang",
        ),
    ]
    return f"""
    WITH docs AS (
        SELECT doc_id, lang, source, coalesce({domain}, '') AS domain,
               CAST(coalesce(len(regexp_extract_all(text, '[^ \\t\\n\\x0B\\f\\r]+')), 0) AS BIGINT)
                   AS tokens
        FROM documents),
    leaves AS (SELECT domain, lang, source, sum(tokens) AS tokens FROM docs GROUP BY ALL
               HAVING sum(tokens) > 0),
    {"".join(levels)}
    shares AS (SELECT domain, lang, source, share_source // tokens AS whole,
                      share_source % tokens AS part
               FROM leaves JOIN source_s USING (domain, lang, source)),
    placed AS (SELECT docs.*, whole, part, md5('0-' || whole || '-' || doc_id) AS place
               FROM docs LEFT JOIN shares USING (domain, lang, source)),
    summed AS (SELECT *, sum(tokens) OVER (PARTITION BY domain, lang, source ORDER BY place, doc_id)
                         - tokens AS before FROM placed)
    SELECT doc_id, domain, lang, source, tokens AS n_tokens,
           CAST(coalesce(whole + CAST(before < part AS INT), 0) AS BIGINT) AS copies
    FROM summed
    """


#: The same rows in DuckDB's SQL, where SQL can tell them.
SQL: dict[str, str] = {
    "op3_mixing": _mix_sql(),
    "op7_line_dedup": """
        WITH cut AS (
            SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS own FROM documents),
        every AS (SELECT doc_id, unnest(own) AS x, generate_subscripts(own, 1) AS i FROM cut),
        filled AS (SELECT * FROM every WHERE trim(x) <> ''),
        windows AS (
            SELECT doc_id, i, lead(i, 1) OVER w AS i1, lead(i, 2) OVER w AS i2,
                   [x, lead(x, 1) OVER w, lead(x, 2) OVER w] AS key
            FROM filled WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
        ranked AS (
            SELECT *, row_number() OVER (PARTITION BY key ORDER BY doc_id, i) AS nth
            FROM windows WHERE i2 IS NOT NULL),
        gone AS (SELECT DISTINCT doc_id, unnest([i, i1, i2]) AS i FROM ranked WHERE nth > 1),
        marked AS (
            SELECT every.*, gone.i IS NOT NULL AS is_gone
            FROM every LEFT JOIN gone ON every.doc_id = gone.doc_id AND every.i = gone.i),
        made AS (
            SELECT doc_id, count(*) FILTER (trim(x) <> '') AS n_lines,
                   count(*) FILTER (is_gone) AS n_removed,
                   coalesce(string_agg(x, chr(10) ORDER BY i) FILTER (NOT is_gone), '') AS made_text
            FROM marked GROUP BY doc_id)
        SELECT doc_id, n_lines, n_removed, length(made_text) AS n_chars,
               sha256(made_text) AS text_sha256
        FROM made
    """,
    "op8_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
               doc_id = max(doc_id) OVER same AS kept,
               sha256(coalesce(text, '')) AS text_sha256
        FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
    """,
}
