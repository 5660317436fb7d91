"""A corpus in, packed training sequences out.

Stages: documents whose language cannot be told go; one document of each group of near-duplicates stays; passages of 20 words
or more that were there before go; what is left is packed into sequences of 4096 tokens. Every stage but the last
returns the columns of documents. Between stages the documents are written and read again, since each stage
reads them more than once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postloom.llm import langid, packing, setsketch, superkmers
from postloom.llm.common import id_key
from postloom.llm.queries import vocabulary_path
from postloom.session import cut

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: Below this share even the likeliest language is a guess.
LEAST_SCORE = 0.3
#: Near-duplicates: words of a shingle are those of the operator, similarity in percent.
SIMILAR_PERCENT = 80


def in_known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language: `und` and guesses go."""
    model = langid.train(docs.where(~langid.held_out()))
    judged = langid.identify(docs.select(*COLUMNS), model)
    return judged.where((F.col("lang_pred") != langid.UNKNOWN) & (F.col("score") >= LEAST_SCORE)).select(*COLUMNS)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near-duplicates; rows that share an id stay or go together."""
    found = setsketch.near_duplicates(docs, SIMILAR_PERCENT)
    kept = found.where("id = component_id").select("id").distinct()
    return docs.select(*COLUMNS, id_key("doc_id").alias("id")).join(kept, "id", "left_semi").select(*COLUMNS)


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages that came before; those left without a word go."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    about = docs.select(id_key("doc_id").alias("id"), F.xxhash64(text).alias("key"), "doc_id", "lang", "source").dropDuplicates(["id", "key"])
    left = superkmers.without_repeats(docs).where("n_words > n_removed").select("id", "key", "text")
    return left.join(about, ["id", "key"]).withColumn("n_chars", F.char_length("text").cast("long")).select(*COLUMNS)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces placed in sequences."""
    return packing.pack_documents(docs, vocabulary_path())


STAGES = [
    ("language ID", in_known_language),
    ("MinHash near-dedup", one_of_each_group),
    ("substring dedup", without_repeats),
    ("best-fit packing", packed),
]
#: The packing and the language model cannot be said in SQL; tests compare the stages with brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
