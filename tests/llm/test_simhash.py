import numpy as np
import pytest
import xxhash

from dockflow.llm import simhash
from dockflow.llm.common import connected_components
from tests.llm.frames import documents, empty, lower, words


def plain_fingerprint(text):
    w = words(lower(text))
    grams = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] if len(w) > 2 else [" ".join(w)] if w else []
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints, radius):
    group = list(range(len(prints)))
    for i, a in enumerate(prints):
        for j in range(i):
            if bin(a ^ prints[j]).count("1") <= radius and group[i] != group[j]:
                group = [group[j] if g == group[i] else g for g in group]
    return group


def test_documents_agree_with_the_plain_definition(spark):
    docs = documents(spark)
    rows = simhash.near_duplicates(docs).collect()
    assert len(rows) == docs.count()
    texts = docs.select("doc_id", "text").collect()
    prints = [plain_fingerprint(r["text"]) for r in texts]
    group = plain_components(prints, 2)
    expected = []
    for r, p, g in zip(texts, prints, group, strict=True):
        ids = [t["doc_id"] for t, h in zip(texts, group, strict=True) if h == g and t["doc_id"] is not None]
        expected.append((r["doc_id"], f"{p:016x}", min(ids, default=None)))
    key = lambda x: tuple((v is not None, v) for v in x)
    assert sorted(((r["doc_id"], r["fingerprint"], r["component_id"]) for r in rows), key=key) == sorted(expected, key=key)


@pytest.mark.parametrize("tile_rows", [2, 7, 4096])
@pytest.mark.parametrize("radius", [0, 1, 2, 3])
def test_links_are_complete_in_tiles_of_any_size(spark, tile_rows, radius):
    random = np.random.default_rng(tile_rows + radius)
    centres = random.integers(0, 1 << 63, 12, dtype=np.uint64)
    prints = {0}
    for c in centres:
        for _ in range(25):
            flips = random.choice(64, random.integers(0, 5), replace=False)
            prints.add(int(c) ^ sum(1 << int(b) for b in flips))
    prints = sorted(prints)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    frame = spark.createDataFrame([(p, i) for i, p in enumerate(signed)], "fp bigint, doc_id bigint")
    found = {r["fp"]: r["component_id"] for r in simhash.components(frame, radius, tile_rows).collect()}
    group = plain_components(prints, radius)
    first = {g: min(i for i, h in enumerate(group) if h == g) for g in set(group)}
    assert found == {p: first[g] for p, g in zip(signed, group, strict=True)}


def test_one_of_each_group_stays(spark):
    docs = documents(spark)
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    ids = sorted((r["doc_id"] for r in kept.collect()), key=lambda i: (i is None, i))
    # 2 repeats 1 in other case and white space; 3, 4, 5 and a null text have no word; 9 repeats 8.
    assert ids == [1, 1, 3, 6, 7, 8, 11, 12, 13, 14, 15, None]


def test_long_chains_are_one_component(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(500, 500), (300, 301)], "a bigint, b bigint")
    found = {r["node"]: r["root"] for r in connected_components(links).collect()}
    assert found == {**{i: 0 for i in range(201)}, 300: 300, 301: 300}


def test_empty_table(spark):
    assert simhash.near_duplicates(empty(spark)).count() == 0
    assert simhash.keep_one(empty(spark)).count() == 0
