"""The registered corpus queries over whole driver tables, against SQL or brute force."""

from collections import Counter, defaultdict

import brute
import duckdb
import numpy as np
import pytest

import __spark_entry__ as contract
from palisade.llm import surrogates

NAMES = sorted(n for n in contract.queries() if n.startswith("op"))


def table(sf_dir, name, columns):
    return duckdb.sql(f"SELECT {columns} FROM '{sf_dir}/{name}.parquet'").fetchall()


def run(spark, sf_dir, start):
    name = next(n for n in NAMES if n.startswith(start))
    return contract.queries()[name](spark, sf_dir)


def test_one_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in NAMES) == list(range(1, 14))
    assert "pipeline" in contract.queries()


@pytest.mark.parametrize("name", [n for n in NAMES if n in contract.oracle_sql()])
def test_query_equals_sql(name, spark, sf_dir):
    connection = duckdb.connect()
    for other in ("documents", "benchmark", "labels", "embeddings"):
        connection.execute(f"CREATE VIEW {other} AS SELECT * FROM '{sf_dir}/{other}.parquet'")
    frame = contract.queries()[name](spark, sf_dir)
    cursor = connection.execute(contract.oracle_sql()[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(frame.columns) == sorted(columns)
    assert Counter(tuple(r) for r in frame.select(*columns).collect()) == Counter(map(tuple, cursor.fetchall()))


def test_recall_of_the_search(spark, sf_dir):
    got = defaultdict(list)
    for r in run(spark, sf_dir, "op2_").collect():
        got[r["query_id"]].append((r["rank"], r["vec_id"], r["score"]))
    exact = brute.nearest_rows(table(sf_dir, "embeddings", "vec_id, embedding"))
    assert set(got) == set(exact)
    hits = 0
    for query, best in exact.items():
        own = sorted(got[query])
        assert [r for r, _, _ in own] == list(range(1, len(best) + 1))
        assert [(v, s) for _, v, s in own] == sorted(((v, s) for _, v, s in own), key=lambda x: (-x[1], x[0]))
        hits += len({v for _, v, _ in own} & {v for v, _ in best})
    assert hits >= 0.9 * sum(map(len, exact.values()))


def test_main_texts_of_all_pages(spark, sf_dir):
    import html
    import re

    got = {r["page_id"]: (r["text"], r["n_chars"]) for r in run(spark, sf_dir, "op3_").collect()}
    for page_id, source in table(sf_dir, "pages", "page_id, html"):
        inner = re.search(r"<article>(.*?)(?:</article>|\Z)", source, re.S)[1]
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]*>", "", b)).split()) for b in re.split(r"</?(?:p|h1|br)>", inner)]
        text = " ".join(filter(None, blocks))
        assert got[page_id] == (text, len(text))


def test_held_out_quality(spark, sf_dir):
    langs = dict(table(sf_dir, "documents", "doc_id, lang"))
    rows = run(spark, sf_dir, "op9_").collect()
    assert {r["doc_id"] for r in rows} == set(langs)
    held = [r for r in rows if r["held_out"] and langs[r["doc_id"]]]
    assert np.mean([r["lang_pred"] == langs[r["doc_id"]] for r in held]) >= 0.9
    toxic = dict(table(sf_dir, "labels", "doc_id, toxic"))
    scores = {r["doc_id"]: r["score"] for r in run(spark, sf_dir, "op8_").collect()}
    assert set(scores) == set(langs)
    learned = [d for d in toxic if not brute.held_out(d)]
    assert np.mean([(scores[d] >= 0.3) == bool(toxic[d]) for d in learned]) >= 0.85


def test_surrogates_of_all_documents(spark, sf_dir):
    rows = {r["doc_id"]: r for r in run(spark, sf_dir, "op10_").collect()}
    first, other = {}, {}
    for doc_id, text in table(sf_dir, "documents", "doc_id, text"):
        new, found = surrogates.rewritten(text, surrogates.KEY, {})
        assert rows[doc_id]["text"] == new and rows[doc_id]["n_entities"] == len(found)
        for a, b, kind in found:
            canon = surrogates.canonical(kind, text[a:b])
            mine = surrogates.surrogate(kind, canon, surrogates.KEY)
            assert first.setdefault((kind, canon), mine) == mine and other.setdefault((kind, mine), canon) == canon and mine != canon
        if not found:
            assert new == text
