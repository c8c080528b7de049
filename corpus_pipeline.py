"""From raw documents to packed sequences: toxic documents out, near copies out, secrets masked, sources mixed, texts packed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridmend.llm import mixing, ngram_join, packing, queries, secret_scan, toxicity
from gridmend.llm.tables import saved, table


def _apart(docs: DataFrame) -> DataFrame:
    """The documents as one column ``document``, so that what a stage adds cannot clash with theirs."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("document"))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below 0.5. A text without words scores 0 and stays; so do all where the labels cannot train a model."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    others = _apart(docs).select(F.col("document").dropFields("text").alias("others"), F.col("document.text").alias("text"))
    clean = toxicity.score(others, model, "toxic").where("toxic < 0.5")
    return clean.select(*[F.col("text") if c == "text" else F.col(f"others.`{c}`") for c in docs.columns])


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by 5-word shingles at a similarity of 0.8: that of the smallest doc_id (NULL last), one row of equal ones.

    Texts without words are linked with nothing and stay, all of them.
    """
    of_group = F.min(F.struct(F.col("doc_id").isNull(), F.col("doc_id").alias("id"), F.col("text_hash").alias("hash"))).alias("first")
    firsts = ngram_join.join(docs, n=5, percent=80).where("component IS NOT NULL").groupBy("component").agg(of_group).select("first.id", "first.hash")
    text = F.col("document.text")
    marked = _apart(docs).withColumns({"words": mixing.word_count(text) > 0, "text_hash": F.xxhash64(text), "doc_id": F.col("document.doc_id")})
    held = marked.where("words").join(firsts, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("text_hash") == F.col("hash")), "left_semi")
    one = held.groupBy("doc_id", "text_hash").agg(F.min("document").alias("document"))
    return marked.where("NOT words").select("document.*").unionByName(one.select("document.*"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, with the secrets in its text replaced by a mark."""
    return secret_scan.redact(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it; documents of no words once."""
    mixed = mixing.mix(docs, keep=docs.columns)
    times = F.when(F.col("size") > 0, (F.col("taken") / F.col("size")).cast("int")).otherwise(F.lit(1))
    return mixed.where(times > 0).select("document", F.explode(F.sequence(F.lit(1), times))).select("document.*")


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in sequences."""
    return packing.pack(docs, queries.vocabulary("word_bpe_49k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_copies),
    ("secret_scan", mask_secrets),
    ("source_mix", mix_sources),
    ("packing", pack_sequences),
]

#: Trained models, shingle links and token ids are beyond SQL; the tests check single operators and two of the stages, none calls run().
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
