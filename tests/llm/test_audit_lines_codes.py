"""The filter audit, line deduplication and vector codes against plain versions on every defined case."""

import random
from collections import Counter
from fractions import Fraction
from itertools import permutations
from math import factorial

import brute
import numpy as np
import pyarrow as pa
import pytest
from conftest import DOCS, sentence, table

from palisade.llm import filter_audit, line_dedup, vector_codes
from palisade.llm.common import prepare_arrow
from palisade.session import prepare


@pytest.fixture(scope="module", autouse=True)
def session(spark):
    prepare_arrow(prepare(spark))


def rows(frame):
    return Counter(map(tuple, frame.collect()))


LABELS = {"doc_id": "long", "quality": "int", "toxic": "int"}


def test_audit(spark, corpus):
    rng = random.Random(2)
    loud = [(100 + k, rng.choice(["LOUD ", "a#b ", "same words ", "quiet "]) * rng.choice([1, 30, 80]) + sentence(rng, rng.choice([0, 60, 200])))
            for k in range(60)]
    docs = [(d, t, rng.choice([None, "", "s1", "s2", "É"])) for d, t in [*corpus, *loud, *loud[:5], (None, loud[0][1]), (9999, loud[0][1])]]
    labels = [(d, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for d, _, _ in docs[::2]] + [(100, 1, None), (100, 0, 1), (None, 1, 1)]
    frame = table(spark, DOCS, [(d, t, None, s, None) for d, t, s in docs]).repartition(7)
    counts = filter_audit.failure_counts(frame, table(spark, LABELS, labels))
    found = filter_audit.audit(counts)
    assert found.columns == ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    assert rows(found) == Counter(brute.audit_rows(docs, labels))
    assert len({r["failed"] for r in counts.collect()}) > 10
    every = filter_audit.coalitions(counts, 5).collect()
    assert len(every) == 32 * len({r["part"] for r in every}) and all(r["removed"] == 0 for r in every if r["coalition"] == 0)


def test_audit_of_nothing(spark, no_docs, docs):
    none = table(spark, LABELS, [])
    assert filter_audit.audit(filter_audit.failure_counts(no_docs, none)).count() == 0
    assert all(r["good_lost"] == r["toxic_lost"] == 0 for r in filter_audit.audit(filter_audit.failure_counts(docs, none)).collect())


@pytest.mark.parametrize("n", [1, 2, 3, 5])
def test_least_squares_give_shapley_shares(n):
    """The coefficients against the average over all orders, on random set functions."""
    rng = random.Random(n)
    table_ = filter_audit.shapley_coefficients(n)
    for _ in range(20):
        value = [0] + [rng.randint(0, 10**12) for _ in range((1 << n) - 1)]
        for i in range(n):
            gains = 0
            for order in permutations(range(n)):
                before = sum(1 << k for k in order[: order.index(i)])
                gains += value[before | 1 << i] - value[before]
            assert sum(c * v for c, v in zip(table_[i], value, strict=True)) == gains
        assert sum(Fraction(c * v, factorial(n)) for row in table_ for c, v in zip(row, value, strict=True)) == value[-1]


def lined(corpus):
    rng = random.Random(5)
    common = ["Copyright of this page: all rights", "  ÉA long common line of the CORPUS\t", "exactly twenty chars", "nineteen chars here"]
    docs = list(corpus)
    for k in range(200, 260):
        lines = [sentence(rng, rng.randint(0, 8)) for _ in range(rng.randint(0, 6))]
        for line in common:
            for _ in range(rng.choice([0, 1, 1, 3])):
                lines.insert(rng.randint(0, len(lines)), rng.choice([line, line.upper() if line.isascii() else line, f"\x0b{line} \r"]))
        docs.append((k, "\n".join(lines)))
    twice = "a line that two documents hold only"
    docs += [(300, f"{twice}\n{twice}\nx"), (301, twice), (300, f"{twice}\n{twice}\nx"), (302, common[0]), (None, common[0]), (None, f"{twice}\n"), (303, "\n\n")]
    docs += [(304, "\n".join(["hot line of the whole table"] * 50)), *[(400 + k, "hot line of the whole table\nand more") for k in range(300)]]
    return docs


def test_lines(spark, corpus):
    docs = lined(corpus)
    frame = table(spark, DOCS, [(d, t, None, None, None) for d, t in docs]).repartition(6)
    assert rows(line_dedup.digest(frame)) == Counter(brute.line_rows(docs))
    bitmaps = line_dedup.keep_bitmaps(frame).collect()
    assert all(int((~line_dedup.unpacked(r["keep"], r["n_lines"])).sum()) == r["n_dropped"] > 0 for r in bitmaps)


def test_lines_of_nothing(no_docs):
    assert line_dedup.digest(no_docs).count() == 0


@pytest.mark.parametrize("seed", range(12))
def test_stream_is_the_same_wherever_it_is_cut(seed):
    """Any cut into tasks and batches gives the lines that a whole pass gives."""
    rng = random.Random(seed)
    lines = [(rng.choice([1, 1, 1, 2, 3]), 0, rng.randint(0, rng.choice([3, 40])), 7, k, 99) for k in range(150)]
    lines.sort(key=lambda r: (r[0], r[1], -r[2]))
    holders = {}
    for h1, _, doc, *_ in lines:
        holders.setdefault(h1, set()).add(doc)
    expected = Counter(r[2:] for r in lines if len(holders[r[0]]) >= 3 and r[2] < max(holders[r[0]]))
    ends = [k for k in range(1, len(lines)) if lines[k][:3] != lines[k - 1][:3]]  # one document's lines stay together
    tasks = sorted({0, len(lines), *rng.sample(ends, min(len(ends), rng.randint(0, 4)))})
    names = ["h1", "h2", "id", "row", "place", "n_lines"]
    types = [pa.int64()] * 4 + [pa.int32()] * 2
    out = []
    for a, b in zip(tasks, tasks[1:], strict=False):
        cuts = sorted({a, b, *(rng.randint(a, b) for _ in range(rng.randint(0, 5)))})
        batches = [pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*lines[x:y], strict=True), types, strict=True)], names)
                   for x, y in zip(cuts, cuts[1:], strict=False)]
        mine = [r for batch in line_dedup.stream(3)(iter(batches)) for r in batch.to_pylist()]
        assert sum(r["kind"] == line_dedup.SUMMARY for r in mine) <= 2
        out += mine
    keys = {}
    for r in out:
        if r["kind"] == line_dedup.SUMMARY:
            docs, largest = keys.get(r["h1"], (0, r["id"]))
            keys[r["h1"]] = docs + r["docs"], max(largest, r["id"])
    gone = Counter((r["id"], r["row"], r["place"], r["n_lines"]) for r in out if r["kind"] == line_dedup.DROPPED or (
        r["kind"] == line_dedup.OPEN and keys[r["h1"]][0] >= 3 and r["id"] < keys[r["h1"]][1]))
    assert gone == expected


VECTORS = {"vec_id": "long", "embedding": "array<double>", "label": "int"}


@pytest.mark.parametrize("scale", [1.0, 3e7, 1e200])
def test_codes(spark, scale):
    """Up to one limb, two limbs in int64, and many limbs in Python's integers."""
    rng = np.random.default_rng(3)
    vectors = (np.round(rng.normal(size=(150, 32)), 2) * scale).tolist()
    data = [(int(k) * 3 - 20, v, None if k % 5 == 0 else k % 3) for k, v in enumerate(vectors)]
    data += [data[0], (data[1][0], vectors[7], 1), (None, vectors[3], 2), (900, None, 1), (901, [], 1), (902, [0.5] * 31, 9), (903, [None] + [0.0] * 31, 1),
             (904, [float("nan")] * 32, 1), (905, [float("inf")] + [0.0] * 31, 1), (906, [0.0] * 32, None), (-500, [-0.001] * 32, 4)]
    frame = table(spark, VECTORS, data).repartition(4)
    found = vector_codes.compressed(frame)
    assert found.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert rows(found) == Counter(brute.code_rows(data))


def test_codes_of_few_and_none(spark):
    few = [(4, [0.25] * 16, 1), (2, [1.0] * 16, None), (2, [0.5] * 16, None)]
    assert rows(vector_codes.compressed(table(spark, VECTORS, few))) == Counter(brute.code_rows(few))
    for none in ([], [(1, None, 1)], [(None, [1.0] * 16, 1)]):
        assert vector_codes.compressed(table(spark, VECTORS, none)).count() == 0


@pytest.mark.parametrize("size", [2**10, 2**25, 2**27, 2**40, 2**70])
def test_dots_are_exact(size):
    rng = random.Random(size)
    x, c = ([[[rng.randint(-size, size) for _ in range(4)] for _ in range(n)] for _ in range(2)] for n in (9, 5))
    kind = np.int64 if size < 2**62 else object
    found = vector_codes.dots(np.array(x, dtype=kind), np.array(c, dtype=kind), size)
    assert found.tolist() == [[[sum(a * b for a, b in zip(u, v, strict=True)) for v in q] for u in p] for p, q in zip(x, c, strict=True)]


def test_limbs_keep_products_below_the_mantissa():
    for length in (1, 4, 7, 64, 1000):
        bits = vector_codes.limb_bits(length)
        assert length * (2**bits) ** 2 <= 2**53
        x = np.array([-(2**40), -1, 0, 1, 2**40 - 1])
        parts = vector_codes.limbs(x, bits, vector_codes.limb_count(2**40, bits))
        assert sum(p.astype(object) * 2 ** (bits * k) for k, p in enumerate(parts)).tolist() == x.tolist()
