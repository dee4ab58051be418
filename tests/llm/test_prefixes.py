import random

import numpy as np
import pytest

from dockflow.llm import prefixes, similar
from tests.llm.test_similar import changed, jaccard, pairs


def texts_of_few_words(rng, count):
    """Texts of phrases that many share, and copies that differ at an end or in the middle, around the threshold."""
    phrases = [[f"p{rng.randrange(60)}" for _ in range(rng.randrange(5, 30))] for _ in range(12)]
    out = []
    for _ in range(count):
        words = [w for _ in range(rng.randrange(1, 6)) for w in rng.choice(phrases)] + [f"w{rng.randrange(500)}" for _ in range(30)]
        cut = rng.randrange(1, max(2, len(words) // 4))
        out += [words, words[cut:], words[: len(words) - cut], changed(words, rng, 0.02)]
    return out


def test_no_link_at_the_threshold_is_left_out(spark):
    rng = random.Random(31)
    rows = [t for _, t in pairs(8, 500)[0]]
    for words in texts_of_few_words(rng, 60):
        rows.append(" ".join(words))
    for n in (2004, 5004):  # as near the threshold as sets of a size can come, on either side
        words = [f"w{i}" for i in range(n)]
        rows += [" ".join(words), " ".join(words[: int(0.8 * (n - 4)) + 4]), " ".join(words[: int(0.8 * (n - 4)) + 3])]
    rows += ["", "a", "A b", "a  b"]
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id bigint, text string").repartition(5)
    root = {r["doc_id"]: r["root"] for r in similar.similar_documents(docs).collect()}

    sets = [similar.shingles(t.encode()) for t in rows]
    group = list(range(len(rows)))

    def top(i):
        while group[i] != i:
            i = group[i]
        return i

    links = 0
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if min(len(a), len(b)) >= 0.8 * max(len(a), len(b)):
                both = len(np.intersect1d(a, b, assume_unique=True))
                if both >= 0.8 * (len(a) + len(b) - both):
                    group[top(i)] = top(j)
                    links += 1
    assert links > 300 and jaccard(rows[-10], rows[-9]) >= 0.8 > jaccard(rows[-10], rows[-8])
    assert len({(root[i], top(i)) for i in range(len(rows))}) == len({top(i) for i in range(len(rows))}) == len(set(root.values()))


@pytest.mark.parametrize("least", [0.5, 0.8, 1.0])
def test_prefixes_and_bitmaps_lose_no_pair(least):
    rng = np.random.default_rng(5)
    keys, held = np.sort(rng.choice(400, 60, replace=False)).astype("<u8"), rng.integers(3, 9, 60)
    near = 0
    for _ in range(3000):
        a = np.unique(rng.integers(0, 400, rng.integers(1, 60))).astype("<u8")
        b = np.unique(np.concatenate([a[rng.random(len(a)) < 0.9], rng.integers(0, 400, rng.integers(0, 6)).astype("<u8")]))
        if not len(b):
            continue
        both = len(np.intersect1d(a, b))
        difference = prefixes.least_difference(prefixes.parities(a).tobytes(), prefixes.parities(b).tobytes())
        assert difference <= len(a) + len(b) - 2 * both
        if both >= least * (len(a) + len(b) - both):
            near += 1
            heads = [prefixes.prefix(x, keys, held, least) for x in (a, b)]
            assert len(np.intersect1d(*heads))
    assert near > 20


def test_crowded_lists_are_cut_and_groups_are_not_compared(spark):
    rng = random.Random(7)
    rows = [(i, " ".join(words)) for i, words in enumerate(texts_of_few_words(rng, 40))]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    often = prefixes.frequent(docs, similar.shingles)
    assert len(often[0]) > 50
    prints = similar.sketches(docs, often).dropDuplicates(["node"]).withColumn("root", similar.F.col("node"))

    def found(nodes, piece):
        got = prefixes.candidates(nodes, often[0], 0.8, piece).collect()
        assert len(got) == len(set(got))
        return set(got)

    whole = found(prints, prefixes.PIECE)
    assert whole and whole == found(prints, 1)
    units = prefixes.units(prints, often[0], 1)
    assert {r["side"] for r in units.selectExpr("place & 3 AS side").distinct().collect()} == {0, 1, 2}
    assert found(prints.withColumn("root", similar.F.lit(1).cast("bigint")), 4) == set()


def test_pairs_of_a_list_come_once_and_in_parts(monkeypatch):
    monkeypatch.setattr(prefixes, "PAIRS", 7)
    rng = np.random.default_rng(2)
    unit, root = np.sort(rng.integers(0, 9, 60)), rng.integers(0, 4, 60)
    order = np.lexsort([root, unit])
    unit, root = unit[order], root[order]
    parts = [list(zip(i.tolist(), j.tolist(), strict=True)) for i, j in prefixes._pairs(unit, root)]
    assert max(map(len, parts)) <= 7
    wanted = [(i, j) for i in range(60) for j in range(i + 1, 60) if unit[i] == unit[j] and root[i] != root[j]]
    assert sorted(p for part in parts for p in part) == wanted


def rows_from_python(plan):
    """Rows that the Python operators of an executed plan have given back."""
    name, made = plan.nodeName(), plan.metrics().get("pythonNumRowsReceived")
    rows = [made.get().value()] if made.isDefined() and name == "MapInArrow" else []
    if name == "AdaptiveSparkPlan":
        below = [plan.executedPlan()]
    elif name.endswith("QueryStage"):
        below = [plan.plan()]
    else:
        below = [plan.children().apply(k) for k in range(plan.children().size())]
    return rows + [r for b in below for r in rows_from_python(b)]


def test_near_copies_below_the_threshold_give_no_rows_for_every_pair(spark):
    rng = random.Random(3)
    base = [f"w{i}" for i in range(200)]
    texts = []
    for i in range(320):
        words = list(base)
        for k, at in enumerate(rng.sample(range(200), 3)):
            words[at] = f"own{i}of{k}"
        texts.append(" ".join(words))

    def measured(count):
        docs = spark.createDataFrame(list(enumerate(texts[:count])), "doc_id bigint, text string").repartition(4)
        often = prefixes.frequent(docs, similar.shingles)
        prints = similar.sketches(docs, often).withColumn("root", similar.F.col("node"))
        doc = {r["node"]: r["doc_id"] for r in prints.select("node", "doc_id").collect()}
        pairs = prefixes.candidates(prints, often[0], 0.8)
        found = {tuple(sorted((doc[r["a"]], doc[r["b"]]))) for r in pairs.collect()}
        return found, max(rows_from_python(pairs._jdf.queryExecution().executedPlan()))

    (_, few), (found, many) = measured(80), measured(320)
    assert 0 < many < 8 * few  # four times the texts are sixteen times the pairs
    sets = [similar.shingles(t.encode()) for t in texts]
    links = set()
    for j, b in enumerate(sets):
        for i, a in enumerate(sets[:j]):
            both = len(np.intersect1d(a, b, assume_unique=True))
            if both >= 0.8 * (len(a) + len(b) - both):
                links.add((i, j))
    assert links and links <= found and len(found) < 320 * 319 / 4


def test_runs_of_a_key_stay_whole_and_batches_do_not_matter(spark):
    rng = np.random.default_rng(9)
    keys = np.sort(rng.integers(0, 12, 200))
    table = prefixes.pa.table({"key": keys, "row": np.arange(200)})
    for size in (1, 2, 7, 50, 300):
        parts = [t.column("key").to_numpy() for t in prefixes._whole(iter(table.to_batches(max_chunksize=size)), "key")]
        assert np.array_equal(np.concatenate(parts), keys)
        assert all(a[-1] != b[0] for a, b in zip(parts, parts[1:], strict=False))
    assert list(prefixes._whole(iter([]), "key")) == []

    rows = [(i, " ".join(words)) for i, words in enumerate(texts_of_few_words(random.Random(11), 30))]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    often = prefixes.frequent(docs, similar.shingles)
    prints = similar.sketches(docs, often).dropDuplicates(["node"]).withColumn("root", similar.F.col("node"))
    option, found = "spark.sql.execution.arrow.maxRecordsPerBatch", []
    before = spark.conf.get(option)
    try:
        for size in (before, "3"):
            spark.conf.set(option, size)
            found.append({tuple(r) for r in prefixes.candidates(prints, often[0], 0.8, 4).collect()})
    finally:
        spark.conf.set(option, before)
    assert found[0] and found[0] == found[1]


def test_bitmaps_of_all_widths_are_compared_as_one_by_one():
    rng = np.random.default_rng(4)
    odd = [prefixes.parities(rng.integers(0, 1 << 62, n).astype("<u8")).tobytes() for n in rng.integers(0, 400, 60)]
    a, b = rng.integers(0, 60, 500), rng.integers(0, 60, 500)
    wanted = []
    for x, y in ((np.frombuffer(odd[i], "<u8"), np.frombuffer(odd[j], "<u8")) for i, j in zip(a, b, strict=True)):
        x, y = (x, y) if len(x) <= len(y) else (y, x)
        folded = [0] * len(x)
        for k, word in enumerate(y.tolist()):
            folded[k % len(x)] ^= word
        wanted.append(sum((p ^ q).bit_count() for p, q in zip(folded, x.tolist(), strict=True)))
    assert prefixes.least_differences(odd, a, b).tolist() == wanted
