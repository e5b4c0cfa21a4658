"""A training corpus from the documents table: five stages, each a DataFrame job
whose result is written as Parquet and read again as the next one's documents.

1. toxicity: documents predicted toxic go.
2. near_duplicates: of each component of the five-word shingle join one document
   stays, the one with the smallest doc_id, null last (all rows of that id with
   equal text are one); documents without words stay.
3. repeats: byte ranges of 200 and more that occur elsewhere are cut; a document
   of which nothing is left goes; n_chars follows the text.
4. mix: sources to their target weights; a document comes once for each pass
   over its source that takes at least half of its words.
5. packing: into sequences of 4096 tokens; returns the packed pieces.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterlens.llm import mixing, ngram_join, packing, repeat_index, toxic_segments
from rosterlens.llm.queries import WORD_VOCABULARY
from rosterlens.llm.work import keep


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxic_segments.without_toxic(docs, labels)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.one_of_each(docs)


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    had = "had_text"
    while had in map(str.lower, docs.columns):  # a name that no column has
        had += "_"
    marked = docs.withColumn(had, F.octet_length(F.coalesce("text", F.lit(""))) > 0)
    cut = repeat_index.cut_repeats(marked).where(~F.col(had) | (F.octet_length("text") > 0))
    return cut.withColumn("n_chars", F.coalesce(F.length("text").cast(docs.schema["n_chars"].dataType), F.col("n_chars"))).select(*(F.col(f"`{c}`") for c in docs.columns))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs, public_tokenizers.path(WORD_VOCABULARY))


STAGES = [("toxicity", toxicity), ("near_duplicates", near_duplicates), ("repeats", repeats), ("mix", mix), ("packing", pack)]
#: The scores, the repeats' bytes and the tokens are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = keep(stage(spark, docs, sf_dir), name)
    return docs
