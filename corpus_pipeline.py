"""A training corpus from `documents`: language, quality, near-duplicates, personal data, packed sequences.

Each stage takes (spark, docs, sf_dir) and works on all rows that its predecessor kept. All but the last return the
columns of documents, whatever further columns there are and whatever their names, except names that begin with `lw:`.

What a stage does with odd rows. Language: a null text, or one without a letter, goes; of languages equally near the
first in order counts, and a text between two goes. Quality: a text without words goes. Both judge repeated rows and
null ids row by row. Near-duplicates: of equal rows of an id one stays, of equally good documents the smallest id;
rows with a null id, and texts without words, stay; rows of an id with different texts count as documents of their
own. Personal data: row by row, ties of position by kind in order of name. Packing: a null text counts as empty, rows
are packed one by one in order of arrival. Very long texts are read whole in every stage. An empty table stays empty
through all stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakewarden.llm import langid, minhash, packing, pii, quality
from lakewarden.llm.common import materialize, release, small_batches
from lakewarden.llm.queries import tokenizer_path


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents whose language can be told."""
    small_batches(spark)
    return langid.keep_known(docs, langid.fit(docs))


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents that the weak-label scorer finds good."""
    small_batches(spark)
    return quality.keep_good(docs, quality.fit(docs))


def no_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near-duplicates: five-word shingles, similarity 0.8 or more."""
    small_batches(spark)
    return minhash.keep_one(docs, percent=80)


def no_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace personal data in the texts by its kind; n_chars follows."""
    small_batches(spark)
    out = pii.redact(docs)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of at most 4096 tokens."""
    small_batches(spark)
    # workers are reused and hold what other stages keep too, so this one keeps less
    return packing.pack_documents(docs, tokenizer_path("word_bpe_49k.json"), cache_rows=60_000)


STAGES = [
    ("language_id", known_language),
    ("quality", good_quality),
    ("near_dedup", no_near_duplicates),
    ("pii", no_personal_data),
    ("packing", packed),
]

#: SQL can't express a fitted model or an encoder; tests compare each stage with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; what each but the last keeps is written to the shared folder once."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        kept = materialize(stage(spark, docs, sf_dir))
        release(docs)  # the table before, unless it is the input
        docs = kept
    return STAGES[-1][1](spark, docs, sf_dir)
