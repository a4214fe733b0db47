"""The corpus pipeline: scored, deduplicated, cut, mixed and packed documents.

Every stage takes the rows that its predecessor kept (the columns of ``documents``), works on all of them and returns
what is left; the last returns the packed pieces. Between stages the rows are written as Parquet and read again.

Defined cases: each stage's module states its own for nulls, empty and repeated rows; an empty table passes through
all stages and gives no pieces; columns beyond those of ``documents`` are carried along up to the packing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomtext.llm.common import documents, fresh_name, materialize
from loomtext.llm.mixing import count_words, mix, repeated
from loomtext.llm.packing import pack_documents
from loomtext.llm.quality import THRESHOLD, score_documents, train
from loomtext.llm.repeats import remove_repeats
from loomtext.llm.superminhash import near_duplicates


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of calibrated quality 0.7 or more."""
    model = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    score = fresh_name(docs, "quality_score")
    return score_documents(docs, model, name=score).filter(F.col(score) >= THRESHOLD).select(*docs.columns)


def near_duplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the least id, of each group of near-duplicates; of rows that share id and text, one."""
    found = near_duplicates(docs, percent=80).filter("doc_id = component_id")
    # Texts of one id are told apart by their hash. Those without words are linked with nothing, so each is kept.
    alone = F.when(F.col("group").isNull(), F.col("text_hash"))
    name = fresh_name(docs, "text_hash")
    kept = found.groupBy("doc_id", "group", alone.alias("alone")).agg(F.min("text_hash").alias(name)).select("doc_id", name)
    named = docs.withColumn(name, F.xxhash64("text")).join(kept, ["doc_id", name], "left_semi").dropDuplicates(["doc_id", name])
    return named.select(*docs.columns).unionByName(docs.filter("doc_id is null"))


def suffix_array(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the strings of 50 bytes or more that an earlier document has."""
    cut = remove_repeats(docs)
    return cut.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else cut


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as its source's target asks for."""
    rest = F.struct(*[c for c in docs.columns if c != "text"]).alias("rest")
    out = repeated(mix(docs.select("doc_id", "source", "text", rest, count_words(F.col("text")).alias("size"))))
    out = out.select(*[F.col(c) if c == "text" else F.col("rest")[c].alias(c) for c in docs.columns])
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 2048 tokens, each with its sequence and the place in it."""
    import public_tokenizers

    return pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality classifier", quality),
    ("near-duplicates", near_duplicate),
    ("suffix-array dedup", suffix_array),
    ("source mixing", mixing),
    ("best-fit packing", packing),
]
#: Neither the classifier nor the tokenizer can be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for _, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), "pipeline")
    return docs
