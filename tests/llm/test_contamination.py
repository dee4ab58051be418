import random

import numpy as np
from pyspark.sql import functions as F

from dockflow.llm import contamination
from tests.conftest import MEDIUM
from tests.llm.frames import documents, empty


def plain_lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b):
            last, row[j + 1] = row[j + 1], last + 1 if x == y else max(row[j + 1], row[j])
    return row[-1]


def test_common_subsequence():
    rng = random.Random(3)
    for _ in range(300):
        a, b = ([rng.randrange(6) for _ in range(rng.randrange(1, 70))] for _ in range(2))
        masks = {}
        for place, term in enumerate(a):
            masks[term] = masks.get(term, 0) | 1 << place
        assert contamination.common_subsequence(masks, len(a), b) == plain_lcs(a, b)


def test_decomposition_is_the_exact_one(spark):
    """With a basis as wide as the vocabulary the latent space is exact: compare cosines with a dense decomposition."""
    rng = random.Random(5)
    vocabulary = [f"t{i}" for i in range(30)]
    texts = [" ".join(rng.choices(vocabulary, k=rng.randrange(1, 200))) for _ in range(40)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id bigint, text string").repartition(3)
    items = contamination.items_of([(0, " ".join(vocabulary))])
    terms = contamination.encoded_terms(docs, items.vocabulary)
    weights = contamination.inverse_frequencies(terms, 30)
    counts = np.array([sum(t in text.split() for text in texts) for t in vocabulary])
    assert np.allclose(weights, np.log1p(40 / counts))
    vectors, values = contamination.decomposition(terms, weights, rank=30)
    rows = []
    for text in texts:
        words = text.split()
        for at in range(0, len(words), contamination.WINDOW):
            row = np.zeros(30)
            for w in words[at : at + contamination.WINDOW]:
                row[items.vocabulary[w.encode()]] += 1
            row *= weights
            rows.append(row / np.linalg.norm(row))
    _, sigma, v = np.linalg.svd(np.array(rows), full_matrices=False)
    assert np.allclose(values, sigma, rtol=1e-3)
    assert np.allclose(vectors @ np.diag(values) @ vectors.T, v.T @ np.diag(sigma) @ v, atol=1e-2)
    few, _ = contamination.decomposition(terms, weights, rank=3)
    assert few.shape == (30, 3) and np.allclose(few.T @ few, np.eye(3), atol=1e-4)


def given(spark):
    return spark.read.parquet(f"{MEDIUM}/documents.parquet"), spark.read.parquet(f"{MEDIUM}/benchmark.parquet")


def plain_leaks(docs, benchmark):
    """Pairs that share a run of six words: in the given tables only planted passages do."""
    runs = {}
    for item, text in benchmark:
        words = contamination.words_of(text)
        for i in range(len(words) - 5):
            runs.setdefault(tuple(words[i : i + 6]), set()).add(item)
    found = set()
    for doc, text in docs:
        words = contamination.words_of(text)
        for i in range(len(words) - 5):
            found |= {(doc, item) for item in runs.get(tuple(words[i : i + 6]), ())}
    return found


def test_planted_passages_are_found_and_nothing_else(spark):
    docs, benchmark = given(spark)
    found = {(r["doc_id"], r["item_id"]) for r in contamination.leaks(docs, benchmark).collect()}
    expected = plain_leaks(docs.select("doc_id", "text").collect(), benchmark.collect())
    assert found == expected and len(found) > 20
    in_blocks = {(r["doc_id"], r["item_id"]) for r in contamination.leaks(docs, benchmark, block_items=15).collect()}
    assert in_blocks == expected
    clean = contamination.decontaminated(docs, benchmark)
    assert clean.columns == docs.columns
    assert {r["doc_id"] for r in clean.select("doc_id").collect()} == {
        r["doc_id"] for r in docs.select("doc_id").collect()
    } - {d for d, _ in expected}


def test_paraphrases_are_found(spark):
    docs, benchmark = given(spark)
    rng = random.Random(9)
    clean = contamination.decontaminated(docs, benchmark).where("length(text) > 1500").orderBy("doc_id").limit(30).collect()
    rows, expected = [], set()
    for (item, text), doc in zip(benchmark.collect()[:30], clean, strict=True):
        words = text.split()
        changed = [w for w in words if rng.random() > 0.12]
        for _ in range(len(changed) // 10):
            changed.insert(rng.randrange(len(changed)), rng.choice(["the", "new", "often", "xyzzy"]))
        at = rng.randrange(200, 900)
        rows.append((doc["doc_id"], doc["text"][:at] + " " + " ".join(changed).upper() + " " + doc["text"][at:]))
        expected.add((doc["doc_id"], item))
    table = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = {(r["doc_id"], r["item_id"]) for r in contamination.leaks(table.union(docs.select("doc_id", "text").where("doc_id < 0")), benchmark).collect()}
    assert found <= expected and len(found) >= 0.9 * len(expected)


def test_odd_tables(spark):
    docs = documents(spark)
    items = spark.createDataFrame(
        [(1, "quick brown fox jumps over the lazy dog"), (1, "quick brown fox jumps over the lazy dog"), (2, None), (3, ""), (4, "two one"), (5, "one two"), (None, "all rights reserved cc by"), (6, " ".join(f"w{i}" for i in range(600)))],
        "item_id bigint, text string",
    ).withColumn("terms", F.lit(0))
    found = sorted(((r["doc_id"], r["item_id"]) for r in contamination.leaks(docs, items).collect()), key=str)
    assert found == sorted([(1, 1)] * 4 + [(2, 1)] * 2 + [(7, 5), (8, 6), (9, 6), (13, None)], key=str)
    kept = contamination.decontaminated(docs, items)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"] for r in kept.collect()), key=str) == sorted([1, 3, 4, 5, 6, 11, 12, 14, 15, None, None], key=str)


def test_empty_tables(spark):
    docs, benchmark = given(spark)
    assert contamination.leaks(docs, benchmark.where("false")).count() == 0
    assert contamination.leaks(empty(spark), benchmark).count() == 0
    assert contamination.decontaminated(docs, benchmark.where("false")).count() == docs.count()


def test_an_item_in_a_third_of_the_documents_is_found_in_each(spark):
    rng = random.Random(11)
    vocabulary = [f"v{i}" for i in range(3000)]
    item = " ".join(rng.sample(vocabulary, 34))
    rows, held = [], set()
    for i in range(400):
        words = rng.choices(vocabulary, k=rng.randrange(60, 200))
        if i % 3 == 0:
            at = rng.randrange(len(words))
            words[at:at] = item.split()
            held.add(i)
        rows.append((i, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    benchmark = spark.createDataFrame([(7, item), (8, "v1 v2 v3 v4"), (9, " ".join(rng.sample(vocabulary, 40)))], "item_id bigint, text string")
    assert {(r["doc_id"], r["item_id"]) for r in contamination.leaks(docs, benchmark).collect()} == {(i, 7) for i in held}
    assert contamination.decontaminated(docs, benchmark).count() == 400 - len(held)


def test_every_near_copy_reaches_the_word_check(spark):
    """Copies with 65 to 80 % of the words that the subsequence would accept, with the answer check left out."""
    docs, benchmark = given(spark)
    rng = random.Random(21)
    clean = [r["text"].split() for r in docs.where("length(text) > 1500 AND length(text) < 9000").orderBy("doc_id").collect()]
    rows, expected = [], set()
    for item, text in [tuple(r) for r in benchmark.collect()] * 9:
        words = text.split()
        kept = [w for w in words if rng.random() < rng.choice([0.65, 0.7, 0.8])]
        whole = contamination.words_of(text)
        if plain_lcs(whole, contamination.words_of(" ".join(kept))) >= 0.6 * len(whole):
            around = rng.choice(clean)
            at = rng.randrange(len(around))
            expected.add((len(rows), item))
            rows.append((len(rows), " ".join([*around[:at], *kept, *around[at:]])))
    table = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    found = {(r["doc_id"], r["item_id"]) for r in contamination.leaks(table, benchmark, least_answer=0.0).collect()}
    assert len(expected) > 200 and len(expected - found) <= 0.01 * len(expected)


def test_short_items_are_found_in_long_texts(spark):
    rng = random.Random(22)
    vocabulary = [f"v{i}" for i in range(500)]
    items = [(i, " ".join(rng.sample(vocabulary, 3 + i % 2))) for i in range(20)]
    rows = []
    for i, text in items:
        words = rng.choices([f"u{i}" for i in range(50)] + vocabulary, k=300)
        rows.append((i, " ".join([*words[:100], text, *words[100:]])))
    docs, benchmark = spark.createDataFrame(rows, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string")
    held = {(d, i) for d, text in rows for i, item in items if f" {item} " in f" {text} "}
    assert held >= {(i, i) for i, _ in items}
    assert {(r["doc_id"], r["item_id"]) for r in contamination.leaks(docs, benchmark).collect()} == held


def test_clean_documents_hold_the_words_of_short_items_and_questions(spark):
    """Common words in order, here and there, are no copy; a short common question counts with its answer only."""
    rng = random.Random(31)
    common = "what is it the of and who he she was in on at to a by for with from as".split()
    items = [
        (1, "what is it"),
        (2, "the of and it"),
        (3, "Who is he? The first president of a distant republic, elected in winter."),
        (4, "Who was she? Marchioness Ottoline"),
    ]
    rows = []
    for i in range(60):
        words = rng.choices(common, k=300)
        words[100:100] = ["who", "is", "he"]
        rows.append((i, words))
    rows[3][1][150:150] = "who was she then marchioness ottoline".split()
    rows[4][1][150:150] = "who is he the first president of a distant republic elected in winter".split()
    texts = [(i, " ".join(words)) for i, words in rows]
    expected = {(d, i) for d, t in texts for i in (1, 2) if f" {items[i - 1][1]} " in f" {t} "} | {(3, 4), (4, 3)}
    docs = spark.createDataFrame(texts, "doc_id bigint, text string").repartition(3)
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    found = {(r["doc_id"], r["item_id"]) for r in contamination.leaks(docs, benchmark).collect()}
    assert found == expected


def test_a_very_long_item_beside_short_ones(spark):
    rng = random.Random(32)
    long = " ".join(f"w{rng.randrange(60_000)}" for _ in range(60_000))
    short = [(i, " ".join(f"x{rng.randrange(5000)}" for _ in range(12))) for i in range(300)]
    rows = [(1, f"before {long} after"), (2, "u " * 50 + short[7][1] + " v" * 50), (3, long[: len(long) // 3])]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    benchmark = spark.createDataFrame([*short, (900, long)], "item_id bigint, text string")
    found = {(r["doc_id"], r["item_id"]) for r in contamination.leaks(docs, benchmark).collect()}
    assert found == {(1, 900), (2, 7)}


def test_words_in_blocks_of_many_terms_keep_their_keys():
    """Terms beyond 2^20 don't share sort keys with others."""
    runs = contamination.Ragged.of([[3_000_000, 5, 3_000_001], [5]])
    flat = np.array([1, 3_000_000, 5, 3_000_001, 5], dtype="<i4")
    found = contamination.verbatim(flat, np.arange(5), runs, np.ones(3_000_002))
    assert sorted(zip(*(x.tolist() for x in found), strict=True)) == [(0, 1), (1, 2), (1, 4)]
    keys = np.sort((flat.astype(np.int64) << 32) + np.arange(5))
    assert len({int(k) >> 32 for k in keys}) == 4


def test_a_question_without_its_answer_is_found(spark):
    rng = random.Random(23)
    vocabulary = [f"v{i}" for i in range(2000)]
    asked = [rng.sample(vocabulary, n) for n in (30, 12, 10, 4, 40)]
    answers = [["paris"], rng.sample(vocabulary, 20), ["answer:", "blue", "green"], ["seven"], rng.sample(vocabulary, 9)]
    items = [(i, " ".join(a) + ("? " if i != 2 else " ") + " ".join(b)) for i, (a, b) in enumerate(zip(asked, answers, strict=True))]
    rows = []
    for i in range(5):
        words = rng.choices(vocabulary, k=200)
        rows.append((i, " ".join([*words[:70], *asked[i], *words[70:]])))
    some = asked[0][:27] + ["xyzzy"] + asked[0][28:]  # nearly the question
    rows += [(5, " ".join(rng.choices(vocabulary, k=90) + some)), (6, " ".join(rng.choices(vocabulary, k=90) + asked[0][:15]))]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(2)
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    found = {(r["doc_id"], r["item_id"]) for r in contamination.leaks(docs, benchmark).collect()}
    assert found == {(i, i) for i in range(5)} | {(5, 0)}
    assert [r["doc_id"] for r in contamination.decontaminated(docs, benchmark).collect()] == [6]


def test_sums_of_short_groups_are_those_of_a_plain_loop():
    rng = np.random.default_rng(11)
    table = rng.standard_normal((50, 7)).astype(np.float32)
    lengths = rng.integers(1, 17, 300)
    first, index = np.cumsum(lengths) - lengths, rng.integers(0, 50, lengths.sum())
    factor = rng.random(len(index)).astype(np.float32)
    for given in (None, factor):
        found = contamination._added(table, index, first, given)
        weights = np.ones(len(index)) if given is None else given
        plain = [(table[index[a : a + n]] * weights[a : a + n, None]).sum(axis=0) for a, n in zip(first, lengths, strict=True)]
        assert found.dtype == np.float32 and np.allclose(found, plain, atol=1e-5)
    assert contamination._added(table, index[:0], first[:0]).shape == (0, 7)
