"""The register of named queries: a Spark plan and, where SQL can say it, an oracle text."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from palisade.session import prepare

Plan = Callable[[SparkSession, str], DataFrame]

PLANS: dict[str, Plan] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None) -> Callable[[Plan], Plan]:
    def add(plan: Plan) -> Plan:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return plan(prepare(spark), sf_dir)

        if name in PLANS:
            raise ValueError(f"query {name} is registered twice")
        PLANS[name] = run
        if oracle is not None:
            ORACLES[name] = oracle
        return plan

    return add
