"""SentencePiece encoding over a table of distinct marked words.

The library marks blanks in the text (``▁``). Where no piece of a vocabulary continues past a marker, merges can't cross the
place before a marker, so a text is encoded word by word: each distinct marked word of the corpus is segmented once, and
ids return to the texts by position. Texts stay in blocks. A block's words, each once, go to slices of the word table by
hash; a slice segments what it has not seen and answers every block; a block with its answers gives the ids of its texts.
"""

import hashlib
import re
import struct
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache
from itertools import count, groupby
from operator import itemgetter

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dockflow.llm.common import importable, stored

MARK = "▁"
WORD = re.compile(f"{MARK}+[^{MARK}]*")
BLOCK_CHARS = 64 << 20  # characters of text in a block, or one text
SLICES = 1024  # of the word table; a task holds the distinct words of one slice at a time
RUN = 1 << 18  # words of a text that are turned into ids and decoded at a time


@lru_cache(maxsize=2)
def library(model: str) -> sentencepiece.SentencePieceProcessor:
    return sentencepiece.SentencePieceProcessor(model_file=model if "/" in model else public_tokenizers.path(model))


def check_separable(model: str) -> None:
    """Refuse a vocabulary that is not encoded word by word: pieces across markers, or a text that is not kept as it is."""
    sp = library(model)
    for i in range(sp.get_piece_size()):
        if not sp.is_byte(i) and not sp.is_control(i) and re.search(f"[^{MARK}]{MARK}", sp.id_to_piece(i)):
            raise ValueError(f"{model}: piece {sp.id_to_piece(i)!r} crosses a marker")
    probe = "  ﬁ ½  É é a "
    if sp.decode(sp.encode(probe)) != probe:
        raise ValueError(f"{model}: texts are normalised")


def marked(text: str | None) -> list[str]:
    """The marked words of a text, each without its first marker, which the library puts before what it encodes.

    The blanks of a text are markers, and one stands before it.
    """
    if not text:
        return []
    if text[0] == " " or text[-1] == " " or "  " in text or MARK in text:  # runs of markers belong to one word
        return [w[1:] for w in WORD.findall(MARK + text.replace(" ", MARK))]
    return text.split(" ")


def segmented(sp: sentencepiece.SentencePieceProcessor, words: list[str]) -> list[list[int]]:
    """The ids of each marked word; the library takes an empty text for none, here it is a marker by itself."""
    single = [sp.piece_to_id(MARK)]
    return [ids if w else single for w, ids in zip(words, sp.encode(words, num_threads=1), strict=True)]


def _lists(parts: list[bytes]) -> bytes:
    """Byte strings in one frame: their lengths, then their contents."""
    head = np.array([len(p) for p in parts], "<u4").tobytes()
    return zstandard.ZstdCompressor(level=3).compress(struct.pack("<I", len(parts)) + head + b"".join(parts))


def _unlisted(frame: bytes) -> list[bytes]:
    data = zstandard.ZstdDecompressor().decompress(frame)
    (n,) = struct.unpack_from("<I", data)
    ends = np.cumsum(np.frombuffer(data, "<u4", n, 4)).tolist()
    at = 4 + 4 * n
    return [data[at + a : at + b] for a, b in zip([0, *ends], ends, strict=False)]


def _planes(numbers: np.ndarray) -> bytes:
    """Numbers below 2^32 by planes of bytes, which compress far better than the numbers."""
    planes = numbers.astype("<u4").view("u1").reshape(-1, 4).T
    return zstandard.ZstdCompressor(level=3).compress(planes.tobytes())


def _unplaned(frame: bytes) -> np.ndarray:
    data = np.frombuffer(zstandard.ZstdDecompressor().decompress(frame), "u1").reshape(4, -1)
    return np.ascontiguousarray(data.T).view("<u4").ravel()


# Records of a block. TEXTS: the places of the texts' words in the block's list of words, and the list's order by slices;
# WORDS: its words of one slice; IDS: the ids of these. All carry a digest of the list.
TEXTS, WORDS, IDS = range(3)
RECORD = (
    "block bigint, kind int, digest bigint, slice int, doc_ids array<bigint>, counts array<bigint>, places binary, "
    "words binary"
)
SCHEMA = pa.schema(
    {"block": pa.int64(), "kind": pa.int32(), "digest": pa.int64(), "slice": pa.int32()}
    | {"doc_ids": pa.list_(pa.int64()), "counts": pa.list_(pa.int64()), "places": pa.binary(), "words": pa.binary()}
)


def _record(**fields) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist([fields], SCHEMA)


def _block(number: int, numbers: dict[str, int], texts: list, slices: int, kind: int) -> Iterator[dict]:
    """The records of one kind of a block of texts: (doc_id, places of its words in order of first sight)."""
    at = np.concatenate([places for _, places in texts])
    often = np.argsort(-np.bincount(at, minlength=len(numbers)), kind="stable")  # frequent words get small places
    rank = np.empty_like(often)
    rank[often] = np.arange(len(often))
    words = list(map(str.encode, numbers))
    to = np.fromiter((xxhash.xxh3_64_intdigest(w) % slices for w in words), np.int64, len(words))
    by_slice = np.lexsort((rank, to))
    digest = xxhash.xxh3_64()
    for i in often.tolist():
        digest.update(words[i] + b" ")
    here = {"block": number, "kind": kind, "digest": digest.intdigest() >> 1}
    if kind == TEXTS:
        counts = [len(places) for _, places in texts]
        yield {
            **here,
            "doc_ids": [doc_id for doc_id, _ in texts],
            "counts": counts,
            "places": _planes(rank[at]),
            "words": _planes(rank[by_slice]),
        }
    else:
        edges = np.flatnonzero(np.diff(to[by_slice], prepend=-1, append=-1))
        for a, b in zip(edges, edges[1:], strict=False):
            mine = by_slice[a:b].tolist()
            yield {**here, "slice": int(to[mine[0]]), "words": _lists([words[i] for i in mine])}


def _blocks(
    batches: Iterator[pa.RecordBatch], part: int, slices: int, chars: int, kind: int
) -> Iterator[pa.RecordBatch]:
    """Cut a task's texts into blocks, in the order they come."""
    block, held, texts = 0, 0, []
    numbers: dict[str, int] = defaultdict(count().__next__)
    for batch in batches:
        for doc_id, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            words = marked(text)
            texts.append((doc_id, np.fromiter(map(numbers.__getitem__, words), np.int64, len(words))))
            held += len(text or "")
            if held >= chars:
                for record in _block((part << 32) + block, numbers, texts, slices, kind):
                    yield _record(**record)
                block, held, texts = block + 1, 0, []
                numbers = defaultdict(count().__next__)
    if texts:
        for record in _block((part << 32) + block, numbers, texts, slices, kind):
            yield _record(**record)


def _width(model: str) -> str:
    return "<u2" if library(model).get_piece_size() <= 1 << 16 else "<u4"


def _table(batches: Iterator[pa.RecordBatch], model: str) -> Iterator[pa.RecordBatch]:
    """Answer the words of every block, slice by slice; a word is segmented when the slice first sees it."""
    sp, width = library(model), _width(model)
    records = (r for batch in batches for r in batch.to_pylist())
    for _, run in groupby(records, key=itemgetter("slice")):
        table: dict[bytes, bytes] = {}
        for r in run:
            words = _unlisted(r["words"])
            fresh = [w for w in words if w not in table]
            for w, ids in zip(fresh, segmented(sp, [w.decode() for w in fresh]), strict=True):
                table[w] = np.array(ids, width).tobytes()
            yield _record(**{**r, "kind": IDS, "words": _lists([table[w] for w in words])})


OUTPUT = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"


class WordIds:
    """The ids of a block's words by their places."""

    def __init__(self, texts: dict, answers: list[dict], width: str):
        order = _unplaned(texts["words"])
        ids: list[bytes] = [b""] * len(order)
        found = (w for r in sorted(answers, key=itemgetter("slice")) for w in _unlisted(r["words"]))
        for place, w in zip(order.tolist(), found, strict=True):
            ids[place] = w
        size = np.dtype(width).itemsize
        self.lengths = np.array([len(w) // size for w in ids], np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.lengths)])[:-1]
        self.ids = np.frombuffer(b"".join(ids), width).astype(np.int64)

    def of(self, places: np.ndarray) -> np.ndarray:
        """The ids of the words one after another."""
        lengths = self.lengths[places]
        ends = np.cumsum(lengths)
        at = np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - lengths - self.starts[places], lengths)
        return self.ids[at]


def ids_of_texts(records: list[dict], model: str) -> Iterator[tuple[int | None, Iterator[np.ndarray]]]:
    """The texts of a block: doc_id, and its ids in runs that end with a word."""
    (texts,) = (r for r in records if r["kind"] == TEXTS)
    answers = [r for r in records if r["kind"] == IDS]
    if any(r["digest"] != texts["digest"] for r in answers):
        raise ValueError("the texts came in another order when they were read again: store the table first")
    found, places = WordIds(texts, answers, _width(model)), _unplaned(texts["places"]).astype(np.int64)
    start = 0
    for doc_id, n in zip(texts["doc_ids"], texts["counts"], strict=True):
        yield doc_id, (found.of(places[a : min(a + RUN, start + n)]) for a in range(start, start + n, RUN))
        start += n


@lru_cache(maxsize=2)
def _decimals(model: str) -> list[str]:
    return [str(i) for i in range(library(model).get_piece_size())]


def digests(runs: Iterator[np.ndarray], model: str, end_id: int) -> tuple[int, str, str]:
    """Number of ids with the end id, digest of their decimals, digest of the text they decode to.

    A run begins with a marker, which the library takes off the first word only: a later run gets its blank back.
    """
    sp, decimals = library(model), _decimals(model)
    n, ids_digest, text_digest = 1, hashlib.sha256(), hashlib.sha256()
    for k, run in enumerate(runs):
        ids = run.tolist()
        ids_digest.update((" ".join(map(decimals.__getitem__, ids)) + " ").encode())
        text_digest.update(((" " if k else "") + sp.decode(ids)).encode())
        n += len(ids)
    ids_digest.update(str(end_id).encode())
    return n, ids_digest.hexdigest(), text_digest.hexdigest()


def _answered(records: list[dict], model: str, end_id: int) -> pa.Table:
    rows = [(doc_id, *digests(runs, model, end_id)) for doc_id, runs in ids_of_texts(records, model)]
    names = [c.split()[0] for c in OUTPUT.split(", ")]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string()]
    return pa.table({c: pa.array(v, k) for c, v, k in zip(names, zip(*rows, strict=True), kinds, strict=True)})


def encoded_pieces(
    docs: DataFrame,
    model: str = "piece_bpe_32k.model",
    end_id: int = 2,
    slices: int = SLICES,
    block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """Encode every text of (doc_id, text), append ``end_id``, decode again: one row per document with the digests.

    A null text is empty: the end id alone. Repeated rows and null doc_ids give a row each; extra columns are ignored; an
    empty table gives an empty one. Memory of a task: one block (``block_chars``, or one text) or the distinct words of
    one of the ``slices``. A text without blanks is one word.

    Texts are read twice, for their words and for the places of these, which moves far less than storing both. Blocks
    follow the order of the texts, which files keep; a table that comes out of a shuffle is stored first.
    """
    importable(docs.sparkSession)
    check_separable(model)
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    if "Exchange" in texts._jdf.queryExecution().executedPlan().toString():
        texts = stored(texts, "texts")

    def blocks(kind: int) -> DataFrame:
        return texts.mapInArrow(
            lambda b: _blocks(b, TaskContext.get().partitionId(), slices, block_chars, kind), RECORD
        )

    answers = (
        blocks(WORDS)
        .repartition("slice")
        .sortWithinPartitions("slice")
        .mapInArrow(lambda b: _table(b, model), RECORD)
    )
    grouped = blocks(TEXTS).unionByName(answers).groupBy("block")
    return grouped.applyInArrow(lambda t: _answered(t.to_pylist(), model, end_id), OUTPUT)
