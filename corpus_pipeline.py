"""The corpus pipeline: five stages over documents, each written and read again."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from monthgrain.llm import bpe, jaccard, lines, mixing, passages, quality
from monthgrain.llm.filters import may_meet
from monthgrain.llm.queries import BUDGET, DOMAIN, VOCABULARY, WEIGHTS, table
from monthgrain.llm.scratch import kept, scope, stored

#: Documents whose probability of good quality is lower are rejected.
LEAST_QUALITY = 0.5
#: Shingles of five words, similarity 0.8.
NEAR = jaccard.Join(5, 80, 100)


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the quality classifier rejects.

    Null and empty texts are scored like others; rows without an id are kept or rejected by
    their text alone.
    """
    trees = quality.train(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    name = _free(docs, "score")
    return quality.score(docs, trees, name=name).where(F.col(name) >= LEAST_QUALITY).drop(name)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the later occurrences of windows of three lines, then of runs of 50 words.

    What near copies share with each other stays, so that the next stage meets them whole and
    drops all but one; what they share with other documents goes. That is for texts of twice a
    run of words or more: in a shorter one a repeated run is most of the text, and it goes. Documents of which nothing
    but white space is left, or was there, go too: they have nothing to train on. Rows without
    an id are cut as if they came before all others, and are nobody's near copies.
    """
    kin = _free(docs, "kin")
    columns = [F.col(f"`{c}`") for c in docs.columns]
    with scope(spark):  # each copy of the texts goes once the next one is written
        with scope(spark):
            known = kept(_with_kin(docs, kin), "kin")
        cut = kept(lines.drop_repeated_lines(known, kin_col=kin).select(*columns, kin), "lines")
    cut = passages.drop_repeated_passages(cut, kin_col=kin).select(*columns)
    cut = cut.withColumn("n_chars", F.length("text").cast("long"))
    return cut.where(F.col("text").rlike(r"[^\x20\x09-\x0D]"))


def _with_kin(docs: DataFrame, kin: str) -> DataFrame:
    """``docs`` with the number of their group of near copies, null where a row would be alone in it.

    Only texts that may be in a group move.
    """
    groups = jaccard.jaccard_groups(docs, NEAR).where("component_id IS NOT NULL")
    full = f"min(component_id) FILTER (WHERE n_shingles >= {2 * passages.RUN}) AS `{kin}`"
    ids = groups.groupBy("doc_id").agg(F.expr(full), F.count("*").alias("n"))
    ids = stored(ids.where(F.col(kin).isNotNull()), "ids")
    several = ids.groupBy(kin).agg(F.sum("n").alias("n")).where("n > 1").select(kin)
    members = stored(ids.join(stored(several, "several"), kin).select("doc_id", kin), "members")
    near, alone = may_meet(docs, members, "doc_id")
    return near.join(members, "doc_id", "left").select(*docs.columns, kin).unionByName(
        alone, allowMissingColumns=True
    )


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one of the least id.

    Documents without an id, or without words, are in no group and stay. Rows of one id are
    one document: they stay or go together.
    """
    groups = jaccard.jaccard_groups(docs, NEAR)
    gone = stored(groups.where("component_id <> doc_id").select("doc_id").distinct(), "gone")
    return docs.join(gone, "doc_id", "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of each source to its share of ``BUDGET`` of the tokens; one taken twice has two rows.

    Null names of languages and sources count as empty ones; texts without tokens are not taken.
    """
    mixed = mixing.mix(docs, DOMAIN, WEIGHTS, BUDGET)
    taken = mixed.where("copies > 0").withColumn("copies", F.expr("sequence(1L, copies)"))
    return taken.withColumn("copies", F.explode("copies")).select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, with the digest of the text they decode to.

    Null texts count as empty; they and empty ones have no tokens.
    """
    return bpe.encode(docs, VOCABULARY, decoded=True).select(
        "doc_id",
        "lang",
        "source",
        "n_tokens",
        "token_ids",
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def _free(df: DataFrame, name: str) -> str:
    taken = {c.lower() for c in df.columns}
    while name in taken:
        name += "_"
    return name


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", keep_good),
    ("line dedup", drop_lines),
    ("n-gram Jaccard join", drop_near_copies),
    ("mixing to target weights", mix_sources),
    ("BPE encoding", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each result is written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        with scope(spark):  # what a stage stores on its way goes once its result is written
            docs = kept(stage(spark, docs, sf_dir), f"stage{k + 1}")
    return docs


#: A trained classifier and a tokenizer have no SQL; the tests compare with brute force.
ORACLE_SQL = None
