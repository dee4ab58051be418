import io
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import zstandard
from tokenizers import Tokenizer

from dockflow.llm import tokens
from dockflow.llm.common import fresh_path, stored
from tests.llm.frames import TEXTS, documents, empty

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


ODD = [
    *(t[1] for t in TEXTS),
    "".join(chr(c) for c in range(1, 128)),
    " ".join(f"a{chr(c)}b" for c in range(1, 0x250)),
    "é ́x Σας İstanbul ﬁ ½ 漢字かな   　 ᠎ ﻿ x",
    "it's IT'S we'Ll ''s 's. a., b,. C. x..",
]


def test_words_give_the_ids_of_the_whole_text(library):
    encoder = tokens.WordEncoder(PATH)
    for text in ODD:
        expected = library.encode(text or "", add_special_tokens=False).ids
        assert np.frombuffer(encoder.encode((text or "").encode()), "<u2").tolist() == expected, text


def test_documents_come_back_in_order(spark, library):
    docs = documents(spark)
    rows = tokens.encoded(docs, frame_ids=1000).orderBy("start", "n_tokens").collect()
    assert len(rows) == docs.count()
    place, seen = 0, []
    for r in rows:
        assert r["start"] == place
        place += r["n_tokens"]
        seen.append((r["doc_id"], r["n_tokens"], r["ids_crc32"]))
    expected = []
    for t in docs.collect():
        ids = [*library.encode(t["text"] or "", add_special_tokens=False).ids, 2]
        expected.append((t["doc_id"], len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
    key = lambda x: (x[0] is not None, x)
    assert sorted(seen, key=lambda x: (x[0] is not None, x[0] or 0, *x[1:])) == sorted(
        expected, key=lambda x: (x[0] is not None, x[0] or 0, *x[1:])
    )
    assert [key(s)[0] for s in seen] == sorted(key(s)[0] for s in seen)  # null ids first
    ids = [s[0] for s in seen if s[0] is not None]
    assert ids == sorted(ids)


def test_a_request_reads_only_its_frames(spark, library):
    docs = documents(spark)
    manifest = stored(tokens.write_shards(docs, fresh_path(spark, "shards"), frame_ids=500), "manifest")
    found = tokens.read_documents(spark, manifest, [7, 8, 77])
    assert set(found) == {7, 8}
    assert found[7][0].tolist() == [*library.encode("one two", add_special_tokens=False).ids, 2]
    out = io.BytesIO()
    writer = tokens.ShardWriter(out, frame_ids=10)
    for i in range(20):
        writer.add(i, np.arange(7, dtype="<u2").tobytes())
    writer.close()
    reader = tokens.ShardReader(pa.BufferReader(out.getvalue()))
    assert reader.read(12)[0].tolist() == list(range(7)) and reader.frames_read <= 2
    assert reader.read(99) == []


def test_a_shard_is_plain_zstandard_and_damage_is_seen():
    out = io.BytesIO()
    writer = tokens.ShardWriter(out, frame_ids=4)
    data = np.arange(11, dtype="<u2").tobytes()
    writer.add(None, data)
    writer.add(5, b"")
    writer.close()
    whole = out.getvalue()
    with zstandard.ZstdDecompressor().stream_reader(io.BytesIO(whole), read_across_frames=True) as stream:
        assert stream.read() == data
    damaged = bytearray(whole)
    damaged[10] ^= 0xFF
    reader = tokens.ShardReader(pa.BufferReader(bytes(damaged)))
    with pytest.raises((ValueError, zstandard.ZstdError)):
        list(reader.pieces(0))
    with pytest.raises(ValueError):
        tokens.ShardReader(pa.BufferReader(whole[:-4] + b"xxxx"))


def test_the_memo_is_bounded(monkeypatch, library):
    monkeypatch.setattr(tokens, "MEMO_WORDS", 50)
    encoder = tokens.WordEncoder(PATH)
    text = " ".join(f"word{i}x" for i in range(300))
    assert np.frombuffer(encoder.encode(text.encode()), "<u2").tolist() == library.encode(text, add_special_tokens=False).ids
    assert len(encoder) <= 51


def test_empty_table(spark):
    assert tokens.encoded(empty(spark)).count() == 0
