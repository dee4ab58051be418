import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from dockflow.llm import similar
from tests.llm.frames import LONG, documents, empty


def jaccard(a, b):
    """By the shingles themselves."""

    def grams(text):
        words = text.lower().split()
        return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()

    a, b = grams(a), grams(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def changed(words, rng, share):
    """Some words are replaced, dropped or doubled."""
    out = []
    for w in words:
        if rng.random() >= share:
            out.append(w)
        elif rng.random() < 0.6:
            out.append(f"n{rng.randrange(9000)}")
    return out


def pairs(seed, count):
    """Texts and changed copies of them, 40 to 900 words, and their true similarity."""
    rng = random.Random(seed)
    rows, truth = [], []
    for i in range(count):
        words = [f"w{rng.randrange(3000)}" for _ in range(rng.randrange(40, 900))]
        other = changed(words, rng, rng.choice([0.002, 0.005, 0.01, 0.02, 0.03, 0.05, 0.08]))
        a, b = " ".join(words), " ".join(other).upper() if i % 2 else " ".join(other)
        rows += [(2 * i, a), (2 * i + 1, b)]
        truth.append(jaccard(a, b))
    return rows, truth


def test_similarity_is_that_of_the_shingles():
    rows, truth = pairs(3, 120)
    error = []
    for (_, a), (_, b), t in zip(rows[::2], rows[1::2], truth, strict=True):
        hashes = [similar.shingles(x.encode()) for x in (a, b)]
        n, wide = tuple(map(len, hashes)), tuple(similar.wide_fingerprint(h).tobytes() for h in hashes)
        assert similar.similarity(n, wide, tuple(h.tobytes() for h in hashes)) == pytest.approx(t)
        error.append(similar.similarity(n, wide, (None, None)) - t)
    assert abs(np.mean(error)) < 0.02 and np.std(error) < 0.05


def test_recall_by_similarity_and_clean_documents(spark):
    rows, truth = pairs(8, 1200)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(6)
    root = {r["doc_id"]: r["root"] for r in similar.similar_documents(docs).collect()}
    together = [root[2 * i] == root[2 * i + 1] for i in range(len(truth))]
    for low, high, least in ((0.8, 0.9, 0.9), (0.9, 1.01, 0.97)):
        found = [t for t, s in zip(together, truth, strict=True) if low <= s < high]
        print(f"recall {low}-{high}: {sum(found)} of {len(found)}")
        assert len(found) > 40 and sum(found) >= least * len(found)
    # What is less similar, and texts of other pairs, stay apart.
    assert not any(t for t, s in zip(together, truth, strict=True) if s < 0.8)
    assert len(set(root.values())) == len(rows) - sum(together)


def test_short_texts_are_compared_exactly(spark):
    rng = random.Random(5)
    rows = []
    for _ in range(60):
        words = [f"w{rng.randrange(50)}" for _ in range(rng.randrange(1, 60))]
        rows += [(len(rows), " ".join(words)), (len(rows) + 1, " ".join([*words, "end"])), (len(rows) + 2, " ".join(words[:-1]))]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    root = {r["doc_id"]: r["root"] for r in similar.similar_documents(docs).collect()}
    for i in range(0, len(rows), 3):
        for j in (i + 1, i + 2):
            if jaccard(rows[i][1], rows[j][1]) < 0.8 and jaccard(rows[i + 1][1], rows[i + 2][1]) < 0.8:
                assert root[i] != root[j]
            if jaccard(rows[i][1], rows[j][1]) == 1:
                assert root[i] == root[j]


def test_a_large_group_of_near_copies(spark):
    rng = random.Random(6)
    base = [f"w{rng.randrange(4000)}" for _ in range(300)]
    rows = [(i, " ".join([*base[: 50 + i % 200], f"x{i}", *base[51 + i % 200 :]])) for i in range(800)]
    rows += [(1000 + i, " ".join(f"v{rng.randrange(9000)}" for _ in range(200))) for i in range(100)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    kept = sorted(r["doc_id"] for r in similar.keep_one_similar(docs).collect())
    assert kept == [0, *range(1000, 1100)]


def test_odd_documents(spark):
    docs = documents(spark).withColumn("node", F.lit("extra"))
    rows = similar.similar_documents(docs).collect()
    assert len(rows) == docs.count()
    groups = {}
    for r in rows:
        groups.setdefault(r["root"], set()).add(r["doc_id"])
    assert {8, 9} in groups.values() and {3, 4, 5, None} in groups.values()
    kept = similar.keep_one_similar(docs)
    assert kept.columns == docs.columns
    assert kept.count() == len(groups)
    assert kept.where(F.col("text") == LONG).first()["doc_id"] == 8
    assert similar.keep_one_similar(empty(spark)).count() == 0


def test_small_tiles_together_give_the_links_of_each():
    rng = np.random.default_rng(4)
    prints, tile = [], []
    for number, size in enumerate(rng.integers(2, similar.STRIP, 60)):
        base = rng.integers(0, 2, 64 * similar.WIDTH, dtype=np.uint8)
        for _ in range(size):
            flips = rng.random(len(base)) < rng.choice([0.02, 0.1, 0.3])
            prints.append(np.packbits(base ^ flips, bitorder="little").view("<u8"))
            tile.append(3 * number)
    prints, tile, n = np.stack(prints), np.array(tile), rng.integers(20, 60, len(tile)).astype(float)

    def groups(links):
        label = np.arange(len(prints))
        for a, b in links:
            label[label == label[a]] = label[b]
        return {tuple(np.flatnonzero(label == x)) for x in label}

    a, b, _ = similar.small_links(prints, n, tile, 0.8)
    apart = []
    for number in np.unique(tile):
        rows = np.flatnonzero(tile == number)
        i, j, _ = similar.tile_links(prints[rows], n[rows], np.zeros(len(rows), int), 0.8)
        apart += zip(rows[i], rows[j], strict=True)
    assert len(apart) > 300
    assert groups(zip(a, b, strict=True)) == groups(apart)


def test_refuted_links_leave_others():
    # Three rows whose links are all unsure: each may turn out to be the true one.
    a, b, estimate = np.array([0, 0, 1, 1, 2, 2]), np.array([1, 2, 0, 2, 0, 1]), np.array([0.88, 0.8, 0.88, 0.85, 0.8, 0.85])
    kept = similar._best(3, a, b, estimate, 0.8)
    assert sorted(zip(*(x.tolist() for x in kept[:2]), strict=True)) == [(0, 1), (0, 2), (1, 2)]
    # Sure links need no second way; what they join counts as one.
    kept = similar._best(3, a, b, np.array([0.95, 0.8, 0.95, 0.92, 0.8, 0.92]), 0.8)
    assert sorted(zip(*(x.tolist() for x in kept[:2]), strict=True)) == [(0, 1), (1, 2)]


def test_groups_near_the_threshold(spark):
    rng = random.Random(12)
    rows = []
    for _ in range(8):
        base = [f"w{rng.randrange(5000)}" for _ in range(300)]
        for _ in range(60):
            words = list(base)
            for at in rng.sample(range(300), rng.randrange(2, 6)):
                words[at] = f"n{rng.randrange(90000)}"
            rows.append((len(rows), " ".join(words)))
    group = list(range(len(rows)))

    def top(i):
        while group[i] != i:
            i = group[i]
        return i

    links = [(i, j) for i in range(len(rows)) for j in range(i - i % 60, i) if jaccard(rows[i][1], rows[j][1]) >= 0.8]
    for i, j in links:
        group[top(i)] = top(j)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    root = {r["doc_id"]: r["root"] for r in similar.similar_documents(docs).collect()}
    together = sum(root[i] == root[j] for i, j in links)
    print(f"links {together} of {len(links)}, groups {len(set(root.values()))}, true {len({top(i) for i in group})}")
    assert together >= 0.99 * len(links)
    assert all(top(i) == top(j) for i in range(len(rows)) for j in range(i) if root[i] == root[j])


def test_crowded_cells_are_cut(spark):
    rows, _ = pairs(21, 60)
    nodes = similar.sketches(spark.createDataFrame(rows, "doc_id bigint, text string")).dropDuplicates(["node"])
    whole = similar.tiles(nodes).groupBy("unit").agg(F.collect_set("node").alias("nodes"), F.max("side").alias("side"))
    cut = similar.tiles(nodes, 1).groupBy("unit").agg(F.collect_set("node").alias("nodes"), F.max("side").alias("side"))

    def together(tiles):
        return {(a, b) for r in tiles.collect() for a in r["nodes"] for b in r["nodes"] if a < b}

    assert together(whole) == together(cut) and together(whole)
    assert {r["side"] for r in whole.collect()} == {0}
