"""Token ids in shard files of independent zstandard frames with a trailing seek table.

A shard is a sequence of zstandard frames, each compressed on its own, followed by two skippable frames that any
zstandard decoder passes over: the document index, and the seek table of the public seekable format (one entry per
frame: compressed size, size, and the low 32 bits of the content's XXH64; then the number of frames, a descriptor and a
magic number). A reader takes the seek table from the end of the file, finds its documents in the index, and reads,
verifies and decompresses only the frames that hold them.
"""

import struct
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import xxhash
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from dockflow.llm.common import fresh_path, stored

# Fixed values of the public seekable zstandard format.
SKIPPABLE_SEEK_TABLE = 0x184D2A5E
SEEK_TABLE_MAGIC = 0x8F92EAB1
CHECKSUM_FLAG = 0x80
# A skippable frame of this library: the document index.
SKIPPABLE_INDEX = 0x184D2A51
NO_DOC_ID = -(1 << 63)  # stands for a null doc_id in the index

END_ID = 2
FRAME_IDS = 1 << 16
MEMO_WORDS = 1_000_000


class WordEncoder(dict):
    """Ids of words as little-endian bytes, remembered; at most ``MEMO_WORDS`` words, then it starts anew.

    The vocabulary splits at white space and drops it, so a text's ids are the ids of its words in order. Words end at
    ASCII white space here; one that holds another white space, or anything but ASCII letters, takes the library's whole
    path. A word of ASCII letters is one piece, in lower case, that only needs the library's merges.
    """

    def __init__(self, path: str, width: int = 2):
        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.code = {2: "H", 4: "I"}[width]

    def packed(self, ids: list[int]) -> bytes:
        return struct.pack(f"<{len(ids)}{self.code}", *ids)

    def __missing__(self, word: bytes) -> bytes:
        bare = word.rstrip(b".,")
        if len(word) - len(bare) == 1 and bare.isalpha():  # bytes: ASCII letters
            found = self[bare] + self[word[-1:]]
        elif word.isalpha():
            lower = word.lower()
            if lower != word:
                found = self[lower]
            else:
                found = self.packed([t.id for t in self.model.tokenize(word.decode())])
        else:
            found = self.packed(self.tokenizer.encode(word.decode(), add_special_tokens=False).ids)
        if len(self) >= MEMO_WORDS:
            self.clear()
        self[word] = found
        return found

    def encode(self, text: bytes | None) -> bytes:
        return b"".join(map(self.__getitem__, (text or b"").split()))  # bytes: ASCII white space


@lru_cache(maxsize=2)
def encoder_of(vocabulary: str) -> WordEncoder:
    """One encoder a worker process, so that later tasks find the words of earlier ones."""
    return WordEncoder(vocabulary if "/" in vocabulary else public_tokenizers.path(vocabulary))


@dataclass
class ShardWriter:
    """Writes documents in the order they come; memory holds one frame and the index."""

    out: object
    width: int = 2
    frame_ids: int = FRAME_IDS
    level: int = 3
    buffer: list = field(default_factory=list)
    held: int = 0
    frames: list = field(default_factory=list)
    ids: list = field(default_factory=list)
    counts: list = field(default_factory=list)

    def add(self, doc_id: int | None, data: bytes) -> None:
        self.ids.append(NO_DOC_ID if doc_id is None else doc_id)
        self.counts.append(len(data) // self.width)
        limit, view = self.frame_ids * self.width, memoryview(data)
        while len(view):
            part = view[: limit - self.held]
            self.buffer.append(part)
            self.held += len(part)
            view = view[len(part) :]
            if self.held == limit:
                self.flush()

    def flush(self) -> None:
        if self.held:
            content = b"".join(self.buffer)
            frame = zstandard.ZstdCompressor(level=self.level, write_content_size=True).compress(content)
            self.out.write(frame)
            self.frames.append((len(frame), len(content), xxhash.xxh64_intdigest(content) & 0xFFFFFFFF))
            self.buffer, self.held = [], 0

    def close(self) -> None:
        self.flush()
        index = struct.pack("<QQ", len(self.ids), self.width)
        index += np.array(self.ids, dtype="<i8").tobytes() + np.array(self.counts, dtype="<u8").tobytes()
        index = zstandard.ZstdCompressor(level=self.level, write_checksum=True).compress(index)
        self.out.write(struct.pack("<II", SKIPPABLE_INDEX, len(index)) + index)
        table = b"".join(struct.pack("<III", *f) for f in self.frames)
        table += struct.pack("<IBI", len(self.frames), CHECKSUM_FLAG, SEEK_TABLE_MAGIC)
        self.out.write(struct.pack("<II", SKIPPABLE_SEEK_TABLE, len(table)) + table)


class ShardReader:
    """Random access to one shard: the seek table and index are read, then only requested frames."""

    def __init__(self, source):
        self.source, size = source, source.size()
        n, flags, magic = struct.unpack("<IBI", self._at(size - 9, 9))
        if magic != SEEK_TABLE_MAGIC or flags != CHECKSUM_FLAG:
            raise ValueError("not a shard: its seek table is missing")
        start = size - 9 - 12 * n - 8
        entries = np.frombuffer(self._at(start + 8, 12 * n), dtype="<u4").reshape(-1, 3).astype(np.int64)
        self.packed, self.sizes, self.sums = entries[:, 0], entries[:, 1], entries[:, 2]
        self.offsets = np.concatenate([[0], np.cumsum(self.packed)])
        at = int(self.offsets[-1])
        magic, length = struct.unpack("<II", self._at(at, 8))
        if magic != SKIPPABLE_INDEX or at + 8 + length != start:
            raise ValueError("not a shard: its document index is missing")
        index = zstandard.ZstdDecompressor().decompress(self._at(at + 8, length))
        docs, self.width = struct.unpack_from("<QQ", index)
        self.doc_ids = np.frombuffer(index, "<i8", docs, 16)
        self.counts = np.frombuffer(index, "<u8", docs, 16 + 8 * docs).astype(np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.counts)])
        self.begins = np.concatenate([[0], np.cumsum(self.sizes)]) // self.width  # first id of each frame
        self.frames_read = 0
        self.kept = (-1, b"")

    def _at(self, offset: int, length: int) -> bytes:
        self.source.seek(offset)
        return self.source.read(length)

    def frame(self, k: int) -> bytes:
        if self.kept[0] != k:
            content = zstandard.ZstdDecompressor().decompress(self._at(int(self.offsets[k]), int(self.packed[k])))
            if xxhash.xxh64_intdigest(content) & 0xFFFFFFFF != self.sums[k] or len(content) != self.sizes[k]:
                raise ValueError(f"frame {k} is damaged")
            self.kept = (k, content)
            self.frames_read += 1
        return self.kept[1]

    def pieces(self, position: int) -> Iterator[np.ndarray]:
        """The ids of one document, a frame's share at a time."""
        lo, hi = int(self.starts[position]), int(self.starts[position + 1])
        k = bisect_right(self.begins, lo) - 1
        while lo < hi:
            begin, end = int(self.begins[k]), min(hi, int(self.begins[k + 1]))
            yield np.frombuffer(self.frame(k), f"<u{self.width}", end - lo, (lo - begin) * self.width)
            lo, k = end, k + 1

    def read(self, doc_id: int) -> list[np.ndarray]:
        """The ids of every document of this doc_id."""
        first, last = bisect_left(self.doc_ids, doc_id), bisect_right(self.doc_ids, doc_id)
        return [np.concatenate([np.empty(0, "<u2"), *self.pieces(i)]) for i in range(first, last)]


def filesystem(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def write_shards(
    docs: DataFrame,
    folder: str,
    vocabulary: str = "word_bpe_49k.json",
    end_id: int = END_ID,
    frame_ids: int = FRAME_IDS,
) -> DataFrame:
    """Encode every text, append ``end_id``, write shards in ascending doc_id order; the manifest, one row per shard.

    Shards are ranges of (doc_id, row number): null doc_ids come first, rows of one doc_id stay in input order and may
    be spread over shards. A null text is empty. A shard is written under a name of its attempt and then renamed, so a
    repeated or second attempt of a task leaves the same file. Memory: one frame, one document and the shard's index.
    """
    rows = docs.select(F.col("doc_id").cast("bigint"), "text", F.monotonically_increasing_id().alias("row"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(vocabulary)
        end = encoder.packed([end_id])
        task = TaskContext.get()
        name = f"{folder}/shard-{task.partitionId():06d}.tok.zst"
        system, local = filesystem(name)
        system.create_dir(local.rpartition("/")[0], recursive=True)
        attempt = f"{local}.{task.taskAttemptId()}"
        with system.open_output_stream(attempt) as out:
            writer = ShardWriter(out, frame_ids=frame_ids)
            for batch in batches:
                texts = batch.column("text").cast(pa.binary()).to_pylist()
                for doc_id, text in zip(batch.column("doc_id").to_pylist(), texts, strict=True):
                    writer.add(doc_id, encoder.encode(text) + end)
            writer.close()
        system.move(attempt, local)
        row = {"shard": [task.partitionId()], "path": [name], "docs": [len(writer.ids)], "ids": [sum(writer.counts)]}
        yield pa.RecordBatch.from_pydict(row, MANIFEST)

    sorted_rows = rows.repartitionByRange("doc_id", "row").sortWithinPartitions("doc_id", "row")
    return sorted_rows.mapInArrow(run, "shard bigint, path string, docs bigint, ids bigint")


MANIFEST = pa.schema([("shard", pa.int64()), ("path", pa.string()), ("docs", pa.int64()), ("ids", pa.int64())])
READ = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint, shard bigint, first_frame bigint"
READ_ARROW = pa.schema([(c.split()[0], pa.int64()) for c in READ.split(", ")])


def read_shards(manifest: DataFrame) -> DataFrame:
    """Every document as its shard's file has it: where its ids start, how many there are, and their checksum."""
    before = F.sum("ids").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1))
    placed = manifest.where("docs > 0").withColumn("before", F.coalesce(before, F.lit(0)))  # one row per shard

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard in batch.to_pylist():
                system, local = filesystem(shard["path"])
                with system.open_input_file(local) as source:
                    reader = ShardReader(source)
                    sums = []
                    for i in range(len(reader.doc_ids)):
                        crc = 0
                        for piece in reader.pieces(i):
                            crc = zlib.crc32(piece.astype("<u4").tobytes(), crc)
                        sums.append(crc)
                starts = reader.starts[:-1]
                frames = np.searchsorted(reader.begins, starts, "right") - 1
                columns = [
                    pa.array(reader.doc_ids, mask=reader.doc_ids == NO_DOC_ID),
                    pa.array(starts + shard["before"]),
                    pa.array(reader.counts),
                    pa.array(sums, pa.int64()),
                    pa.array(np.full(len(sums), shard["shard"])),
                    pa.array(frames.astype(np.int64)),
                ]
                yield pa.RecordBatch.from_arrays(columns, schema=READ_ARROW)

    spread = placed.repartition(max(1, manifest.count()), "shard")  # a task per shard, whatever its row's size
    return spread.mapInArrow(run, READ)


def read_documents(spark: SparkSession, manifest: DataFrame, doc_ids: Iterable[int]) -> dict[int, list[np.ndarray]]:
    """The ids of a few requested documents, decompressing only the frames that hold them."""
    wanted, found = sorted(set(doc_ids)), {}
    for row in manifest.where("docs > 0").toLocalIterator():
        system, local = filesystem(row["path"])
        with system.open_input_file(local) as source:
            reader = ShardReader(source)
            for doc_id in wanted:
                if rows := reader.read(doc_id):
                    found.setdefault(doc_id, []).extend(rows)
    return found


def encoded(docs: DataFrame, folder: str | None = None, **how) -> DataFrame:
    """Write the documents as shards, then read the shards back: doc_id, start, n_tokens, ids_crc32, shard, first_frame.

    An empty table gives no rows. Repeated rows are documents of their own. Other columns are not read.
    """
    folder = folder or fresh_path(docs.sparkSession, "token-shards")
    return read_shards(stored(write_shards(docs, folder, **how), "manifest"))
