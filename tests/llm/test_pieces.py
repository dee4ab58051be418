import hashlib
import random

import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from dockflow.llm import pieces
from tests.llm.frames import TEXTS, documents, empty

MODEL = "piece_bpe_32k.model"
ODD = [
    *(t[1] for t in TEXTS),
    "".join(chr(c) for c in range(1, 128)),
    " ",
    "   ",
    "▁",
    " ▁ a▁b  ▁▁c ▁",
    "a\x00b \x00",
    "<s> </s> <unk> <0x0A> ▁<0xE2>",
    "x  y   z    w" + " " * 100 + "v ",
    "\n\t\r\n  \n",
    "é ́x Σας İstanbul ﬁ ½ 漢字かな   　 ᠎ ﻿ x 👩‍👩‍👧 \U0010fffd",
    "ab" * 20_000,
    "a" * 3000 + " " * 3000,
]


@pytest.fixture(scope="module")
def sp():
    return sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(MODEL))


def plain(sp, doc_id, text):
    ids = sp.encode(text or "", add_eos=True)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return doc_id, len(ids), sha(" ".join(map(str, ids))), sha(sp.decode(ids))


def key(row):
    return row[0] is not None, row[0] or 0, row[1:]


def words_joined(sp, text):
    return [i for w in pieces.segmented(sp, pieces.marked(text)) for i in w]


def test_words_give_the_ids_of_the_whole_text(sp):
    for text in ODD:
        assert words_joined(sp, text) == sp.encode(text or ""), text


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from(" ▁ab.\n\x00é漢"), st.characters(exclude_categories=["Cs"])), max_size=60))
def test_any_text(text):
    sp = pieces.library(MODEL)
    assert words_joined(sp, text) == sp.encode(text)
    assert pieces.digests(iter([]), MODEL, 2)[0] == 1


@pytest.mark.parametrize("slices,block_chars", [(1, 1), (3, 200), (1024, 1 << 24)])
def test_agrees_with_the_library(spark, sp, slices, block_chars):
    docs = documents(spark)
    more = spark.createDataFrame([(100 + i, t) for i, t in enumerate(ODD)], "doc_id bigint, text string")
    docs = docs.unionByName(more, allowMissingColumns=True).unionByName(more.limit(3), allowMissingColumns=True)
    expected = sorted((plain(sp, r["doc_id"], r["text"]) for r in docs.collect()), key=key)
    found = pieces.encoded_pieces(docs, MODEL, slices=slices, block_chars=block_chars).collect()
    assert sorted(map(tuple, found), key=key) == expected


def test_a_text_longer_than_a_run(sp):
    rng = random.Random(1)
    text = " ".join(rng.choice(["", "naïve", "words", "x.", "\n", "▁y", "漢字"]) for _ in range(5000))
    ids = [pieces.segmented(sp, [w])[0] for w in pieces.marked(text)]
    for size in (1, 7, 1000):
        runs = (pieces.np.array([i for w in ids[k : k + size] for i in w]) for k in range(0, len(ids), size))
        assert pieces.digests(runs, MODEL, 2) == plain(sp, 0, text)[1:]


def test_each_word_is_segmented_once_in_its_slice(spark, monkeypatch):
    seen = []
    original = pieces.segmented
    monkeypatch.setattr(pieces, "segmented", lambda sp, words: seen.extend(words) or original(sp, words))
    tables = []
    for part, text in enumerate(["a b a c", "b c d d", "a"]):
        batch = pieces.pa.RecordBatch.from_pylist([{"doc_id": part, "text": text}])
        tables += pieces._blocks(iter([batch]), part, 1, 1 << 20, pieces.WORDS)
    answers = list(pieces._table(iter(tables), MODEL))
    assert len(answers) == 3
    assert sorted(seen) == ["a", "b", "c", "d"]


def test_texts_in_another_order_are_noticed():
    def records(texts, kind):
        batch = pieces.pa.RecordBatch.from_pylist([{"doc_id": 1, "text": t} for t in texts])
        return [r for b in pieces._blocks(iter([batch]), 0, 1, 1 << 20, kind) for r in b.to_pylist()]

    batch = pieces.pa.RecordBatch.from_pylist([{"doc_id": 1, "text": "a b"}])
    answered = pieces._table(pieces._blocks(iter([batch]), 0, 1, 1 << 20, pieces.WORDS), MODEL)
    answers = [r for b in answered for r in b.to_pylist()]
    assert len(list(pieces.ids_of_texts([*records(["a b"], pieces.TEXTS), *answers], MODEL))) == 1
    with pytest.raises(ValueError, match="store the table"):
        list(pieces.ids_of_texts([*records(["b a"], pieces.TEXTS), *answers], MODEL))


def test_empty_table(spark):
    assert pieces.encoded_pieces(empty(spark), MODEL).collect() == []


def test_other_vocabularies_are_refused(monkeypatch):
    class Crossing:
        def get_piece_size(self):
            return 1

        is_byte = is_control = lambda self, i: False

        def id_to_piece(self, i):
            return "of▁the"

    monkeypatch.setattr(pieces, "library", lambda model: Crossing())
    with pytest.raises(ValueError, match="crosses a marker"):
        pieces.check_separable(MODEL)
