"""Members that stay apart make each pair once, whatever the number of groups they share."""

from palisade.llm import near_dedup


def test_pair_of_several_groups_is_made_once(spark):
    bands = {1: [5, 6, 7, 8], 2: [0, 6, 7, 8], 3: [9, 9, 9, 8], 4: [5, 6, 7, 8]}
    comps = {1: 1, 2: 2, 3: 3, 4: 1}
    small = spark.createDataFrame(
        [(i, key, rep, comps[rep], 10, keys) for rep, keys in bands.items() for i, key in enumerate(keys)],
        "band int, key long, rep long, comp long, n long, bands array<long>")
    found = near_dedup._met(small, 80).collect()
    assert sorted((r.a, r.b) for r in found) == [(2, 1), (3, 1), (3, 2), (4, 2), (4, 3)]
