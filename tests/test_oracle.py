"""Registered queries against their SQL oracle on the driver tables.

The default choice covers each area once; PALISADE_ORACLE=all runs every query that has an oracle.
"""

import math
import os

import duckdb
import pytest

import __spark_entry__ as contract

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()
CHOSEN = """latest_relations instances asset_summary critical_findings cve_summary remediation_summary dotted_path
timestamp_text safe_coercion severity_rules priority_rules derived_actions event_types cvss_vectors evidence_patterns
json_or_scalar_lists work_list_candidates work_list_page resume_pending fetch_status remediation_findings
remediation_plan_summary remediation_plan_cves findings_enriched vulnerabilities scan_history components
remediation_actions remediation_campaigns asset_posture risk_concentration completeness history_states
history_states_strict context_violations null_profile uniqueness_checks content_checks key_comparison key_lookup
findings_presented asset_dimensions assets_in_scope related_remediations risk_histogram digest_top_findings
envelope_validity leaf_paths document_cves finding_details finding_occurrences primary_provider normalized_findings
fixed_schema_table dataset_catalog stream_daily_counts stream_history_states stream_strict_states
stream_dedup dataset_profile dataset_samples""".split()
NAMES = sorted(contract.oracle_sql()) if os.environ.get("PALISADE_ORACLE") == "all" else CHOSEN


@pytest.fixture(scope="module")
def con(sf_dir):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return connection


def shown(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(round(value, 6))
    return f"{type(value).__name__}:{value}"


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_oracle(name, spark, sf_dir, con):
    frame = contract.queries()[name](spark, sf_dir)
    cursor = con.execute(contract.oracle_sql()[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(frame.columns) == sorted(columns)
    order = sorted(columns)
    ours = sorted(tuple(shown(row[c]) for c in order) for row in frame.collect())
    places = [columns.index(c) for c in order]
    theirs = sorted(tuple(shown(row[i]) for i in places) for row in cursor.fetchall())
    assert len(ours) == len(theirs)
    assert ours == theirs


def test_every_oracle_has_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry_runs(spark):
    assert contract.entry(spark).count() > 0
