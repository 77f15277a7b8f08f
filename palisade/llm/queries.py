"""The register of the corpus queries: the contract's digest columns from each operator's own output."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from palisade.llm import (
    decontaminate,
    filter_audit,
    language,
    line_dedup,
    main_text,
    near_dedup,
    neighbours,
    packing,
    secret_scan,
    substring_dedup,
    surrogates,
    toxicity,
    vector_codes,
)
from palisade.llm.common import prepare_arrow, table
from palisade.session import prepare

Plan = Callable[[SparkSession, str], DataFrame]

PLANS: dict[str, Plan] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None) -> Callable[[Plan], Plan]:
    def add(plan: Plan) -> Plan:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return plan(prepare_arrow(prepare(spark)), sf_dir)

        PLANS[name] = run
        if oracle is not None:
            ORACLES[name] = oracle
        return plan

    return add


@query("op1_decontaminate", decontaminate.ORACLE_SQL)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op6_best_fit_packing")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed_documents(table(spark, sf_dir, "documents"))


@query("op7_hyperminhash_near_dedup", near_dedup.ORACLE_SQL)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_dedup.near_duplicates(table(spark, sf_dir, "documents"), shingle=2)
    return found.select("doc_id", "n_shingles", "component_id",
                        F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)).alias("kept"))


@query("op8_toxicity")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op9_byte_network_language")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.languages(table(spark, sf_dir, "documents"))


@query("op4_trigram_secret_scan", secret_scan.oracle_sql())
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.digest(secret_scan.secrets(table(spark, sf_dir, "documents")))


@query("op5_substring_dedup", substring_dedup.ORACLE_SQL)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.deduplicated(table(spark, sf_dir, "documents")).drop("kept")


@query("op2_learned_partitions")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings"), lambda vec_id: vec_id % neighbours.QUERY_EVERY == 0)


@query("op3_consensus_main_text")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text.main_texts(table(spark, sf_dir, "pages"))


@query("op10_surrogates")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return surrogates.replaced(docs)


@query("op11_filter_audit", filter_audit.ORACLE_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(filter_audit.failure_counts(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")))


@query("op12_line_dedup", line_dedup.ORACLE_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.digest(table(spark, sf_dir, "documents"))


@query("op13_vector_codes", vector_codes.ORACLE_SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.compressed(table(spark, sf_dir, "embeddings"))
