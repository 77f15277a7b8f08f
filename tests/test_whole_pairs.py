"""Intelligence tables hold findings of assets that the asset table does not know."""

import pytest

import __spark_entry__ as contract


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """One asset, and a finding that is also sighted on the next one, which has no row of its own."""
    folder = tmp_path_factory.mktemp("unknown")
    texts = {
        "region": "SELECT 0L AS r_regionkey, 'EUROPE' AS r_name",
        "nation": "SELECT 0L AS n_nationkey, 'FRANCE' AS n_name, 0L AS n_regionkey",
        "customer": "SELECT 1L AS c_custkey, 0L AS c_nationkey, 10.5D AS c_acctbal, 'BUILDING' AS c_mktsegment",
        "orders": "SELECT 4L AS o_orderkey, 1L AS o_custkey, 'O' AS o_orderstatus, '1-URGENT' AS o_orderpriority, "
                  "TIMESTAMP_NTZ '1997-01-01' AS o_orderdate",
        "lineitem": "SELECT 4L AS l_orderkey, 3L AS l_linenumber, 2L AS l_partkey, 1L AS l_suppkey, 5D AS l_quantity, "
                    "1000D AS l_extendedprice, 0.05D AS l_discount, 0.02D AS l_tax, 'N' AS l_returnflag, 'O' AS l_linestatus, "
                    "TIMESTAMP_NTZ '1997-02-01' AS l_shipdate",
        "part": "SELECT 2L AS p_partkey, 'STEEL' AS p_type, 5 AS p_size, 'Brand#1' AS p_brand, 'bolt' AS p_name",
    }
    for name, text in texts.items():
        spark.sql(text).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


@pytest.mark.parametrize("name", ["findings_enriched", "components", "remediation_actions"])
def test_unknown_asset_keeps_its_rows(name, spark, tables):
    rows = contract.queries()[name](spark, tables).select("assetId").distinct().collect()
    assert sorted(r.assetId for r in rows) == ["asset-1", "asset-2"]


def test_unknown_asset_is_in_every_section(spark, tables):
    assert {r.assets for r in contract.queries()["report_documents"](spark, tables).collect()} == {2}


def test_known_assets_only_elsewhere(spark, tables):
    rows = contract.queries()["asset_posture"](spark, tables).collect()
    assert [r.assetId for r in rows] == ["asset-1"]
