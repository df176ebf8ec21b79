"""From raw documents to packed windows: language identification, near-dedup, surrogates
for personal data, mixing to target weights, packing.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return
the columns of documents. ``run`` writes each stage's result to the shared folder and
gives it to the next. Rows with null ids are treated like others; a null or blank text has
no clear language and goes at the first.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from webloom.llm import langid, minhash, mixing, packing, pii
from webloom.llm.common import bound_batches, load, written
from webloom.llm.queries import good_ids

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is clear stay; ``lang`` becomes the language found. Null
    and blank texts and ties go, repeated rows are treated alike, an empty table gives no
    rows."""
    docs = docs.select(*COLUMNS)
    dictionaries = langid.profiles(docs, good_ids(spark, sf_dir))
    found = docs.withColumn("found", langid.language_of("text", dictionaries))
    return found.where("found.language is not null").select("doc_id", "text", F.col("found.language").alias("lang"), "source", "n_chars")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, the one of least id. A document
    is an id with a text: rows that share an id but not the text are told apart, rows that
    share both are one, and rows without an id take part, after all others. Null texts
    and texts without words are in no group; an empty table gives none."""
    row = F.struct(F.col("doc_id").isNull().alias("last"), F.coalesce("doc_id", F.lit(0)).alias("doc_id"), F.xxhash64("text").alias("h"))
    docs = docs.select(*COLUMNS).withColumn("row", row)
    gone = minhash.near_duplicates(docs, "row").select("row")
    # one shuffle of the texts: the join leaves them partitioned and sorted by the row's key
    return docs.join(gone, "row", "left_anti").dropDuplicates(["row"]).select(*COLUMNS)


def replace_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in the text gives way to surrogates; ``n_chars`` follows the text.
    Every row stays; null and empty texts stay as they are, repeated rows are treated alike
    and an empty table gives no rows."""
    bound_batches(spark)
    docs = docs.select(*COLUMNS).withColumn("s", pii.surrogate_text("text", pii.session_key(spark)))
    return docs.select("doc_id", F.col("s.text").alias("text"), "lang", "source", F.length("s.text").cast("long").alias("n_chars"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as its rate says, so that the domains meet their targets.
    Null and empty texts have no tokens and the rate of the bare prior; rows that are alike
    in all columns are kept or repeated alike; an empty table gives no rows."""
    docs = docs.select(*COLUMNS)
    return mixing.mixed(docs, mixing.train_domains(docs, load(spark, sf_dir, "labels")))


def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The layout of windows, see ``packing.pack``: every token of every document once.
    Null and empty texts stand in no window, repeated rows and null ids are packed like
    others, ties of the order go by id; an empty table gives no rows."""
    return packing.pack(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", identify_language),
    ("near_dedup", drop_near_duplicates),
    ("pii", replace_personal_data),
    ("mixing", mix_sources),
    ("packing", pack_windows),
]
#: Compression, MinHash, keyed permutations, model fitting and tokenization are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
