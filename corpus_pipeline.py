"""From raw documents to a mixed training corpus: five operators of `ebbtide.llm` in a row.

A stage takes the documents that the one before kept and returns the columns of documents; the
last one adds `copies`, how often the mix repeats a document.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbtide.llm import decontaminate, language_id, line_dedup, mixing, simhash
from ebbtide.llm.batches import passing, remove, written

# What a prediction has to reach: with several languages, a little over a guess.
LEAST_SCORE = 0.3


def identify_language(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents without a letter, null texts, and those of no certain language go; a null `lang` is filled in."""
    network = language_id.train(docs, language_id.Settings())
    found = language_id.predict(docs, network).where((F.col("_lang_pred") != language_id.NONE) & (F.col("_score") >= LEAST_SCORE))
    return found.withColumn("lang", F.coalesce("lang", "_lang_pred")).select(*docs.columns)


def drop_lines(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Lines that an earlier document holds go; a document goes if nothing but white space is left of it."""
    rows = line_dedup.dedup_corpus(docs, least=10)
    left = F.length(F.btrim(F.col("text"), F.lit(" \t\n\x0b\x0c\r"))) > 0
    kept = rows.where((F.col("_n_dropped") == 0) | left)
    return kept.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """The document with the smallest id of each group stays."""
    return simhash.one_of_each(docs, width=4, radius=4)


def drop_benchmark(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that hold a benchmark item, also with other values, go."""
    items = spark.read.parquet(f"{folder}/benchmark.parquet")
    found = decontaminate.contaminated(docs, items, size=12, least_cover=0.25, any_case=True, partial=True)
    return found.where(F.size("_item_ids") == 0).select(*docs.columns)


def mix(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that the mix takes, with `copies`."""
    return mixing.mixed_rows(docs, weights=(1, 2, 3), most=3).withColumnRenamed("_copies", "copies")


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", drop_lines),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_benchmark),
    ("mixing", mix),
]

# A trained network and hashes of other libraries are no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each one's result written and read again.

    What a stage writes beside its result is removed when it is done, its input when it has been read.
    """
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), []
    for _, stage in STAGES:
        with passing(spark) as made:
            docs = written(stage(spark, docs, sf_dir))
            result = made.pop()
        remove(spark, before)
        before = [result]
    return docs
