"""The audit by fingerprints against sets in Python."""

import random

import pytest

from palisade.operators import quality

DOMAINS = {"pairs": ("t", ("k", "v")), "keys": ("t", ("k",)), "others": ("u", ("k",))}


def _sets(tables):
    return {domain: {tuple("" if row[n] is None else str(row[n]) for n in names) for row in tables[table]}
            for domain, (table, names) in DOMAINS.items()}


def _frames(spark, tables):
    return {name: spark.createDataFrame([(r["k"], r["v"]) for r in rows], "k string, v bigint") for name, rows in tables.items()}


def _case(seed):
    pick = random.Random(seed)

    def rows(n):  # a third of all rows is one key, nulls and repeated rows among them
        return [{"k": pick.choice(["hot", "hot", None, "", *(f"k{i}" for i in range(40))]), "v": pick.choice([None, 0, 1, 2])} for _ in range(n)]

    raw = {"t": rows(200), "u": rows(50)}
    kept = {"t": [r for r in raw["t"] if pick.random() > 0.1] + rows(5), "u": raw["u"] + raw["u"][:9]}
    return raw, kept


@pytest.mark.parametrize("buckets", [1, 64])
def test_audit_equals_sets(spark, buckets):
    raw, kept = _case(7)
    keys = quality.audited_keys(_frames(spark, raw), _frames(spark, kept), DOMAINS, buckets)
    left, right = _sets(raw), _sets(kept)
    got = {r["domain"]: r for r in quality.mapping_report(keys, DOMAINS).collect()}
    for domain in DOMAINS:
        e, a = left[domain], right[domain]
        row = got[domain]
        assert (row["availableRaw"], row["structured"], row["matched"], row["missing"], row["unexpected"]) == (
            len(e), len(a), len(e & a), len(e - a), len(a - e))
        assert row["coveragePct"] == round(100.0 * len(e & a) / len(e), 2)
    assert {r["status"] for r in got.values()} == {"INCOMPLETE"}
    shown = quality.mapping_examples(keys, 3).where("domain = 'pairs' AND kind = 'missing'").count()
    assert shown == min(3, len(left["pairs"] - right["pairs"]))


def test_equal_and_empty_sides(spark):
    raw, _ = _case(3)
    frames = _frames(spark, raw)
    # The same rows in another order open no bucket at all.
    sides = [quality.tagged_keys(side, DOMAINS, 64) for side in (frames, {n: f.orderBy("v") for n, f in frames.items()})]
    assert quality.differing_buckets(*sides).count() == 0
    report = quality.mapping_report(quality.audited_keys(frames, frames, DOMAINS), DOMAINS)
    assert {(r["status"], r["missing"], r["unexpected"]) for r in report.collect()} == {("COMPLETE", 0, 0)}
    nothing = {n: f.where("false") for n, f in frames.items()}
    rows = quality.mapping_report(quality.audited_keys(nothing, nothing, DOMAINS), DOMAINS).collect()
    assert [(r["availableRaw"], r["coveragePct"], r["status"]) for r in rows] == [(0, 100.0, "COMPLETE")] * 3
    # An invalid document leaves the report incomplete.
    broken = quality.mapping_report(quality.audited_keys(nothing, nothing, DOMAINS), DOMAINS, invalid=frames["u"])
    assert {r["status"] for r in broken.collect()} == {"INCOMPLETE"}
