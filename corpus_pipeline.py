"""The training-data pipeline: documents in, packed token sequences out.

Each stage takes (spark, docs, sf_dir); all but the last return the columns of documents. A stage's result is written as Parquet
in the shared folder and read again as the next one's input, so a lost executor never recomputes an earlier stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from palisade.llm import decontaminate, near_dedup, packing, surrogates, toxicity
from palisade.llm.common import prepare_arrow, table
from palisade.session import prepare, written

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score reaches the threshold go."""
    prepare_arrow(prepare(spark))
    docs = docs.select(*COLUMNS)
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.scored(docs, model).where(F.col("score") < toxicity.THRESHOLD).select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays: shingles of five words, similarity of 0.8 or more."""
    prepare_arrow(prepare(spark))
    return near_dedup.one_of_each(docs.select(*COLUMNS))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which a twentieth or more of the words lies in benchmark windows go."""
    prepare_arrow(prepare(spark))
    return decontaminate.clean_documents(docs.select(*COLUMNS), table(spark, sf_dir, "benchmark"))


def replace_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data become surrogates; n_chars follows the text."""
    prepare_arrow(prepare(spark))
    found = surrogates.replaced(docs.select(*COLUMNS))
    changed = F.when(F.col("n_entities") > 0, F.char_length("text")).otherwise(F.col("n_chars"))
    return found.select("doc_id", "text", "lang", "source", changed.cast(dict(docs.dtypes)["n_chars"]).alias("n_chars"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of all documents in sequences."""
    prepare_arrow(prepare(spark))
    return packing.packed_documents(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_duplicates),
    ("decontaminate", drop_contaminated),
    ("surrogates", replace_personal_data),
    ("packing", pack_sequences),
]

# Trained scores, sketches, keyed permutations and a tokenizer: not for SQL. tests/llm holds it against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for number, (name, stage) in enumerate(STAGES, start=1):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES):
            docs = written(docs, f"stage-{name}")
    return docs
