"""Operators with exact answers against their brute-force versions: nulls, empty and long texts, ties, repeated rows, empty
tables and further columns with clashing names."""

import random
import zlib
from collections import Counter

import brute
import pytest
from conftest import sentence, table

from palisade.llm import decontaminate, near_dedup, neighbours, packing, secret_scan, substring_dedup
from palisade.llm.common import prepare_arrow
from palisade.session import prepare


@pytest.fixture(scope="module", autouse=True)
def session(spark):
    prepare_arrow(prepare(spark))


def rows(frame):
    return Counter(map(tuple, frame.collect()))


ITEMS = {"item_id": "long", "text": "string"}


def items_of(corpus):
    rng = random.Random(3)
    texts = dict(corpus)
    passage = texts[-5].split()
    return [(1, " ".join(passage[:30])), (2, " ".join(passage[:30])), (10, " ".join(passage[20:33])), (3, "ha Ha, HA!"), (4, None), (5, ""),
            (6, "!!"), (7, sentence(rng, 40)), (8, texts[30][:200]), (9, "É É ßen"), (11, "ha " * 14)]


def test_contamination(spark, docs, corpus):
    items = items_of(corpus)
    found = decontaminate.contamination(docs, table(spark, ITEMS, items))
    assert rows(found) == Counter(brute.contamination_rows(corpus, items))
    left = Counter(tuple(r) for r in decontaminate.clean_documents(docs, table(spark, ITEMS, items)).select("doc_id", "text").collect())
    bad = Counter((d, t) for (d, t), r in zip(corpus, brute.contamination_rows(corpus, items), strict=True) if not r[-1])
    assert left == bad


def test_contamination_of_empty_tables(spark, docs, no_docs, corpus):
    none = table(spark, ITEMS, [])
    assert rows(decontaminate.contamination(docs, none)) == Counter(brute.contamination_rows(corpus, []))
    assert decontaminate.contamination(no_docs, table(spark, ITEMS, items_of(corpus))).count() == 0


def test_proximity(spark):
    docs = table(spark, {"doc_id": "long", "text": "string"}, [(1, "red a b green c blue"), (2, "red x x x x x green"), (3, "blue green red"), (4, None)])
    index = decontaminate.build_index(decontaminate.keyed(docs))
    groups = spark.createDataFrame([(1, ["red", "green"]), (2, ["blue", "red", "green"]), (3, ["x"]), (4, ["red", "zzz"])], "group_id int, terms array<string>")
    found = {(r["group_id"], r["key"]["id"]) for r in decontaminate.near(index, groups, 3).collect()}
    assert found == {(1, 1), (1, 3), (2, 3), (3, 2)}


def test_secrets(spark, docs, no_docs, corpus):
    found = secret_scan.digest(secret_scan.secrets(docs))
    assert Counter(tuple(r)[:5] for r in found.collect()) == Counter(brute.secret_row(d, t) for d, t in corpus)
    more = next(r["spans"] for r in found.collect() if r["doc_id"] == 71)
    assert "web_token:" in more
    assert secret_scan.secrets(no_docs).count() == 0


def test_trigram_queries():
    sets = lambda p: {frozenset(s) for s in secret_scan.trigram_query(p)}
    assert sets("abc|xyzw") == {frozenset({"abc"}), frozenset({"xyz", "yzw"})}
    assert sets("ab?cd[0-9]+") == {frozenset({"abc", "bcd"}), frozenset({"acd"})}
    assert sets("[0-9a-f]+") == set() and sets("ab[x-z]*") == set() and sets("(abc)*") == set()
    assert sets("ABC.+") == {frozenset({"abc"})}


@pytest.mark.parametrize("hot", [500, 1])
def test_substring_dedup(docs, corpus, hot, monkeypatch):
    monkeypatch.setattr(substring_dedup, "HOT_CONTEXTS", hot)
    found = substring_dedup.deduplicated(docs)
    assert rows(found.drop("kept")) == Counter(brute.substring_rows(corpus))


def test_substring_dedup_of_nothing(no_docs):
    assert substring_dedup.deduplicated(no_docs).count() == 0


def test_automaton():
    rng = random.Random(1)
    for _ in range(200):
        texts = [[rng.randint(0, 2) for _ in range(rng.randint(0, 12))] for _ in range(4)]
        automaton = substring_dedup.Automaton()
        for t in texts[:3]:
            automaton.add(t)
        known = {tuple(t[i:j]) for t in texts[:3] for i in range(len(t)) for j in range(i, len(t) + 1)}
        expected = [max(n for n in range(k + 2) if tuple(texts[3][k + 1 - n : k + 1]) in known | {()}) for k in range(len(texts[3]))]
        assert automaton.matched(texts[3]) == expected


@pytest.mark.parametrize("size", [2, 5])
def test_near_duplicates(docs, corpus, size):
    found = near_dedup.near_duplicates(docs, shingle=size)
    known = [(d, t) for d, t in corpus if d is not None]
    once = {d: (n, c) for d, n, c in brute.near_rows(list(dict(known).items()), size)}
    got = Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in found.collect() if r["doc_id"] is not None)
    assert got == Counter((d, *once[d]) for d, _ in known)
    nameless = [r["component_id"] for r in found.collect() if r["doc_id"] is None]
    assert sorted(nameless, key=str) == [30, None]


def test_one_of_each(docs, no_docs, corpus):
    kept = [r["doc_id"] for r in near_dedup.one_of_each(docs).collect()]
    expected = {d for d, _, c in brute.near_rows([x for x in dict(corpus).items() if x[0] is not None], 5) if c == d}
    assert Counter(d for d in kept if d is not None) == Counter(expected)
    assert kept.count(None) == 2
    assert near_dedup.one_of_each(no_docs).count() == 0


def test_estimate_and_registers(spark):
    import numpy as np
    from pyspark.sql import functions as F

    rng = np.random.default_rng(0)
    every = np.sort(rng.integers(0, 2**63, 3000, dtype=np.uint64) * np.uint64(2))
    for share in (0.5, 0.8, 0.95):
        cut = int(2000 * (1 - share) / (1 + share))
        a, b = every[:2000], every[cut : 2000 + cut]
        regs = [near_dedup.registers(x).view("<i8").tolist() for x in (a, b)]
        frame = spark.createDataFrame([(*regs, 2000)], "ra array<long>, rb array<long>, n long")
        found = frame.select(near_dedup.estimated(F.col("ra"), F.col("rb"), F.col("n"), F.col("n"))).first()[0]
        assert abs(found - (2000 - cut) / (2000 + cut)) < 0.16
    assert len(set(near_dedup.registers(every[:1]).tolist())) == 1


def test_near_copies_of_one_base_in_large_components(spark, monkeypatch):
    """A chain of copies around one base, with strays that link to one member only: blocks of two documents, no draws."""
    rng = random.Random(8)
    base = sentence(rng, 150).split()

    def edited(words, n):
        words = list(words)
        for _ in range(n):
            words[rng.randrange(len(words))] = rng.choice("abcdefghij") * 3
        return words

    texts = [edited(base, rng.randint(0, 9)) for _ in range(40)]
    texts += [edited(rng.choice(texts), 7) for _ in range(40)]
    docs = [(k, " ".join(t)) for k, t in enumerate(texts)]
    monkeypatch.setattr(near_dedup, "BLOCK", 2)
    monkeypatch.setattr(near_dedup, "LARGE", 4)
    monkeypatch.setattr(near_dedup, "DRAWS", 0)
    found = near_dedup.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string"), shingle=2)
    assert Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in found.collect()) == Counter(brute.near_rows(docs))


def packed_ok(found, corpus, capacity):
    """Pieces cover their documents, sequences are gapless and within capacity."""
    cache = packing.WordCache()
    expected = Counter()
    for d, t in corpus:
        ids = cache.whole(t or "") + (0).to_bytes(4, "little")
        n = len(ids) // 4
        first = n if n <= capacity else n % capacity
        at = k = 0
        while at < n:
            size = first if at == 0 and first else capacity
            expected[d, k, at, size, zlib.crc32(ids[4 * at : 4 * (at + size)])] += 1
            at, k = at + size, k + 1
    assert Counter(tuple(r)[:5] for r in found) == expected
    by = {}
    for r in found:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for own in by.values():
        end = 0
        for offset, length in sorted(own):
            assert offset == end
            end += length
        assert end <= capacity
    return len(by)


def test_packing(spark, docs, no_docs, corpus):
    found = packing.packed_documents(docs, capacity=256).collect()
    used = packed_ok(found, corpus, 256)
    assert used <= 1.05 * sum(r["length"] for r in found) / 256 + 2
    assert packing.packed_documents(no_docs).count() == 0


def test_packing_in_many_groups(docs, corpus):
    from palisade.session import written

    found = packing.pack(written(packing.pieces(docs, 256), "pieces"), 256, open_bins=4, group_tokens=3000, group_rows=50).collect()
    packed_ok(found, corpus, 256)


def test_best_fit_takes_the_tightest_and_closes_the_fullest():
    bins, places, left = packing.best_fit([6, 5, 4, 5], 10, 9)
    assert (bins, places, left) == ([0, 1, 0, 1], [0, 0, 6, 5], [])
    bins, _, left = packing.best_fit([6, 7, 8, 4], 10, 2)
    assert bins == [0, 1, 2, 0] and set(left) == {2}


def test_word_cache_gives_the_tokenizers_ids():
    rng = random.Random(2)
    cache = packing.WordCache(most=50)
    letters = [chr(c) for c in range(256)] + list(" \n'tsllve ab1²") * 8 + ["漢", "😀", "е"]
    for _ in range(2000):
        text = "".join(rng.choice(letters) for _ in range(rng.randint(0, 25)))
        assert cache.ids(text) == cache.whole(text)


def test_ids_are_those_of_a_tokenizer_made_apart():
    import numpy as np
    import public_tokenizers
    from tokenizers import Tokenizer

    apart = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    cache = packing.WordCache()
    assert apart.encode("a<|endoftext|>b", add_special_tokens=False).ids == [64, 50256, 65]
    for text in ["a<|endoftext|>b", "<|endoftext|>", "é <|endoftext|> 漢 <|endoftext|", "x <|endoftext|>" * 500, "<|endof text|>", "plain é", "漢"]:
        ids = np.asarray(apart.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()
        assert cache.ids(text) == cache.whole(text) == ids


VECTORS = {"vec_id": "long", "embedding": "array<float>", "label": "int"}


def test_nearest_is_exact_when_all_parts_are_asked(spark):
    rng = random.Random(5)
    vec = lambda: [rng.choice([-1.0, 0.0, 0.5, 2.0]) for _ in range(4)]
    data = [(k, vec()) for k in range(150)] + [(k, [1.0, 1.0, 0.0, 0.0]) for k in range(200, 260)]
    data += [(300, None), (320, []), (340, [0.0] * 4), (360, [1.0, None, 0.0, 0.0]), (380, [float("nan"), 1.0, 0.0, 0.0]),
             (400, [float("inf"), 1.0, 0.0, 0.0]), (None, [1.0] * 4), (5, data[5][1]), (420, [1.0, 2.0])]
    frame = table(spark, VECTORS, [(i, v, None) for i, v in data])
    found = neighbours.nearest(frame, lambda v: v % 20 == 0, parts=4, probes=4)
    got = {}
    for r in sorted(found.collect(), key=lambda r: (r["query_id"], r["rank"])):
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    assert got == brute.nearest_rows([(i, v) for i, v in dict(data).items() if i != 420])


def test_nearest_of_few_and_of_none(spark):
    two = table(spark, VECTORS, [(0, [1.0, 0.0], 1), (1, [0.0, 1.0], 1)])
    assert [tuple(r) for r in neighbours.nearest(two, lambda v: v % 20 == 0).collect()] == [(0, 1, 1, 0.0)]
    assert neighbours.nearest(table(spark, VECTORS, []), lambda v: v % 20 == 0).collect() == []


def test_estimate_keeps_what_reaches_the_threshold(spark):
    """Pairs of exactly four fifths, from the smallest sets that are estimated on."""
    import numpy as np
    from pyspark.sql import functions as F

    rng = np.random.default_rng(4)
    rows = []
    for n in (64, 66, 80, 120, 200, 400, 900):
        for _ in range(250):
            union = -(-n * 10 // 9)
            hashes = rng.integers(0, 2**64, size=union, dtype=np.uint64)
            both = -(-80 * union // 100)
            x = np.sort(hashes[: both + (union - both) // 2])
            y = np.sort(np.concatenate([hashes[:both], hashes[both + (union - both) // 2 :]]))
            rows.append((len(x), len(y), *[near_dedup.registers(s).view("<u8").astype(np.int64).tolist() for s in (x, y)]))
    frame = spark.createDataFrame(rows, "na long, nb long, ra array<long>, rb array<long>")
    kept = frame.where(near_dedup._likely(F.col("ra"), F.col("rb"), F.col("na"), F.col("nb"), 80)).count()
    assert kept == len(rows)
    far = [(500, 500, *[near_dedup.registers(np.sort(rng.integers(0, 2**64, size=500, dtype=np.uint64))).view("<u8").astype(np.int64).tolist() for _ in "ab"])
           for _ in range(50)]
    assert spark.createDataFrame(far, frame.schema).where(near_dedup._likely(F.col("ra"), F.col("rb"), F.col("na"), F.col("nb"), 80)).count() == 0
