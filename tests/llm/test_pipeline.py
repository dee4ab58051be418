import pytest

import corpus_pipeline
from dockflow.llm import contamination
from dockflow.llm.common import stored
from tests.conftest import MEDIUM, SMALL
from tests.llm.frames import documents, empty


def least_of_similar(rows):
    """The smallest doc_id of every group of documents that links of similarity 0.8 or more connect."""
    sets = [set(zip(*((t or "").lower().split()[i:] for i in range(5)))) or {(t or "").lower()} for _, t in rows]
    holders, group = {}, list(range(len(rows)))

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    for i, grams in enumerate(sets):
        shared = {}
        for g in grams:
            for j in holders.setdefault(g, []):
                shared[j] = shared.get(j, 0) + 1
            holders[g].append(i)
        for j, both in shared.items():
            if both >= 0.8 * (len(grams) + len(sets[j]) - both):
                group[root(i)] = root(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        least[root(i)] = min(doc_id, least.get(root(i), doc_id))
    return least


def test_stage_by_stage(spark):
    docs = spark.read.parquet(f"{MEDIUM}/documents.parquet")
    columns, before, bad = docs.columns, docs, {r["doc_id"] for r in spark.read.parquet(f"{MEDIUM}/labels.parquet").where("toxic = 1").collect()}
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stored(stage(spark, before, MEDIUM), name)
        assert after.columns == columns
        kept[name] = [(r["doc_id"], r["text"]) for r in after.select("doc_id", "text").collect()]
        before = after
    assert len(set(kept["quality"])) == len(kept["quality"]) < docs.count()
    assert len({d for d, _ in kept["quality"]} & bad) <= 0.1 * len(bad)
    least = least_of_similar(kept["quality"])
    alone, left = set(least.values()), {d for d, _ in kept["near_dedup"]}
    assert left >= alone  # no document goes that is not similar to one that stays
    assert len(left) - len(alone) <= 0.1 * (len(kept["quality"]) - len(alone))
    runs = {}
    for r in spark.read.parquet(f"{MEDIUM}/benchmark.parquet").collect():
        words = contamination.words_of(r["text"])
        runs.update({tuple(words[i : i + 6]): r["item_id"] for i in range(len(words) - 5)})
    for d, t in kept["near_dedup"]:
        words = contamination.words_of(t)
        held = any(tuple(words[i : i + 6]) in runs for i in range(len(words) - 5))
        assert held == ((d, t) not in kept["decontamination"])
    counts = {d: sum(x == d for x, _ in kept["mixing"]) for d, _ in kept["decontamination"]}
    assert max(counts.values()) <= 3 and {d for d, _ in kept["mixing"]} <= set(counts)
    rows = corpus_pipeline.STAGES[-1][1](spark, before, MEDIUM).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(d for d, _ in kept["mixing"])


def test_run_is_the_stages_together(spark):
    rows = corpus_pipeline.run(spark, SMALL).orderBy("start").collect()
    assert rows and rows[0]["start"] == 0
    assert all(a["start"] + a["n_tokens"] == b["start"] for a, b in zip(rows, rows[1:], strict=False))


@pytest.mark.parametrize("stage", range(4))
def test_odd_documents_go_through(spark, stage):
    docs = documents(spark)
    after = corpus_pipeline.STAGES[stage][1](spark, docs, SMALL)
    assert after.columns == docs.columns
    after.collect()
    assert corpus_pipeline.STAGES[stage][1](spark, empty(spark), SMALL).count() == 0


def test_stages_call_their_operators():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "near_dedup", "decontamination", "mixing", "tokens"]
