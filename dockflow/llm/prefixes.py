"""Exact similarity join of sets of shingles: prefix and position filters, bitmaps of parities, then the sets themselves.

All sets are put into one order, rare shingles first. Two sets whose Jaccard index reaches the threshold hold a common
shingle within the first ``n - ceil(least * n) + 1`` of either, so each set is posted under those only, and no pair is
lost whatever the order is. The order only decides the work: what many texts hold comes last, by a bounded sample.
"""

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dockflow.llm.common import stored

SAMPLE = 1 << 14  # texts whose shingles are counted
OFTEN, MOST = 3, 1 << 17  # a shingle of so many of them is frequent; so many of the most frequent ones are ordered
PIECE = 1 << 15  # a posting list of more rows of different groups is cut, and every two pieces of it are compared
PAIRS = 1 << 20  # pairs that are looked at once
GATHERED = 1 << 10  # a list of more rows that meet is a block of its own
SLACK = 1e-6  # of sums of whole numbers and rounded products; what it lets through is decided by the sets
FEWEST = 64  # bits of a bitmap

Hashes = Callable[[bytes | None], np.ndarray]


def frequent(docs: DataFrame, hashes: Hashes) -> tuple[np.ndarray, np.ndarray]:
    """Sorted frequent shingles of a sample of the texts, and the texts of the sample that hold each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [hashes(text) for text in batch.column("text").cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([np.empty(0, "<u8"), *sets]).view("<i8"))], ["shingle"])

    parts = max(1, -(-docs.count() // SAMPLE))
    digest = F.xxhash64("text")
    some = docs.where(F.pmod(F.xxhash64(digest), F.lit(parts)) == 0).select("text", digest.alias("digest"))
    counts = some.dropDuplicates(["digest"]).select("text").mapInArrow(run, "shingle bigint").groupBy("shingle").count()
    rows = counts.where(F.col("count") >= OFTEN).orderBy(F.desc("count"), "shingle").limit(MOST).collect()
    keys, held = np.array([r[0] for r in rows], "<i8").view("<u8"), np.array([r[1] for r in rows], dtype=np.int64)
    order = np.argsort(keys)
    return keys[order], held[order]


def _held(hashes: np.ndarray, keys: np.ndarray, held: np.ndarray) -> np.ndarray:
    """The count of each shingle; zero of those that are not among the sorted keys."""
    if not len(keys):
        return np.zeros(len(hashes), dtype=held.dtype)
    at = np.minimum(np.searchsorted(keys, hashes), len(keys) - 1)
    return np.where(keys[at] == hashes, held[at], np.zeros(1, dtype=held.dtype))


def prefix(hashes: np.ndarray, keys: np.ndarray, held: np.ndarray, least: float) -> np.ndarray:
    """The shingles that a set is posted under, in the order of all sets; ``hashes`` are sorted."""
    length = min(len(hashes), len(hashes) - int(np.ceil(least * len(hashes) - SLACK)) + 1)
    count = _held(hashes, keys, held)
    return hashes[np.argsort(count, kind="stable")][:length]


def parities(hashes: np.ndarray) -> np.ndarray:
    """A bitmap of a power of two of bits, two a shingle or more: each says if its number of shingles is odd."""
    width = max(FEWEST, 1 << max(0, 2 * len(hashes) - 1).bit_length())
    odd = np.bincount((hashes & np.uint64(width - 1)).astype(np.int64), minlength=width) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little")


def least_differences(odd: list[bytes], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For pairs of bitmaps (by number): no fewer shingles are in one set only than bits differ.

    The wider bitmap is folded to the other's width; pairs of the same widths are compared together.
    """
    words = np.array([len(x) // 8 for x in odd], dtype=np.int64)
    start = np.cumsum(words) - words
    flat = np.frombuffer(b"".join(odd), "<u8")
    short, wide = np.where(words[a] <= words[b], a, b), np.where(words[a] <= words[b], b, a)
    out = np.zeros(len(a), dtype=np.int64)
    for few, many in np.unique(np.stack([words[short], words[wide]], axis=1), axis=0).tolist():
        same = np.flatnonzero((words[short] == few) & (words[wide] == many))
        step = max(1, PAIRS // many)
        for part in (same[at : at + step] for at in range(0, len(same), step)):
            narrow = flat[start[short[part], None] + np.arange(few)]
            folded = flat[start[wide[part], None] + np.arange(many)].reshape(len(part), -1, few)
            differ = np.bitwise_xor.reduce(folded, axis=1) ^ narrow
            out[part] = np.bitwise_count(differ).sum(axis=1, dtype=np.int64)
    return out


def least_difference(a: bytes, b: bytes) -> int:
    """``least_differences`` of one pair."""
    return int(least_differences([a, b], np.array([0]), np.array([1]))[0])


POST = "shingle bigint, node bigint, root bigint, place bigint"


def posts(nodes: DataFrame, keys: np.ndarray, only_frequent: bool = False) -> DataFrame:
    """One row per node and shingle that it is posted under; place is size << 32 | position << 2."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            heads = batch.column("head").to_pylist()
            length = np.array([len(h) // 8 for h in heads], dtype=np.int64)
            flat = np.frombuffer(b"".join(heads), "<u8")
            position = np.arange(len(flat)) - np.repeat(np.cumsum(length) - length, length)
            node, root, n = (np.repeat(batch.column(c).to_numpy(), length) for c in ("node", "root", "n"))
            columns = [flat.view("<i8"), node, root, (n << 32) + (position << 2)]
            if only_frequent:
                often = _held(flat, keys, np.ones(len(keys), bool))
                columns = [c[often] for c in columns]
            for at in range(0, len(columns[0]), PAIRS):
                arrays = [pa.array(c[at : at + PAIRS]) for c in columns]
                yield pa.RecordBatch.from_arrays(arrays, [c.split()[0] for c in POST.split(", ")])

    return nodes.select("node", "root", "n", "head").mapInArrow(run, POST)


def units(nodes: DataFrame, keys: np.ndarray, piece: int = PIECE) -> DataFrame:
    """(unit, node, root, place): the rows of every posting list, or of two pieces (sides 1 and 2) of a crowded one.

    Rows of one root are not compared, so a list is crowded by its pairs of different roots. Only lists of frequent
    shingles are counted, of which there are ``MOST`` at most; the side is added to the place.
    """
    of_root = posts(nodes, keys, only_frequent=True).groupBy("shingle", "root").agg(F.count("*").cast("double").alias("n"))
    pairs = of_root.groupBy("shingle").agg((F.sum("n") * F.sum("n") - F.sum(F.col("n") * F.col("n"))).alias("pairs"))
    crowded = pairs.select("shingle", F.ceil(F.sqrt("pairs") / piece).cast("int").alias("pieces")).where("pieces > 1")
    crowded = F.broadcast(stored(crowded, "crowded"))
    whole = posts(nodes, keys).join(crowded, "shingle", "left_anti")
    whole = whole.select(F.col("shingle").alias("unit"), "node", "root", "place")
    cut = posts(nodes, keys, only_frequent=True).join(crowded, "shingle")
    cut = cut.withColumn("mine", F.pmod(F.xxhash64("node"), F.col("pieces")).cast("int"))
    cut = cut.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)))
    side = F.when(F.col("mine") == F.col("other"), 0).when(F.col("mine") < F.col("other"), 1).otherwise(2)
    cut = cut.select(
        F.xxhash64("shingle", F.least("mine", "other"), F.greatest("mine", "other")).alias("unit"),
        "node",
        "root",
        (F.col("place") + side).alias("place"),
    )
    return whole.union(cut)


def _pairs(unit: np.ndarray, root: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows of one unit and different roots, some at a time; rows come by unit and root."""
    n = len(unit)
    last = np.append(np.flatnonzero(unit[1:] != unit[:-1]) + 1, n)
    end = np.repeat(last, np.diff(last, prepend=0))
    last = np.append(np.flatnonzero((unit[1:] != unit[:-1]) | (root[1:] != root[:-1])) + 1, n)
    begin = np.repeat(last, np.diff(last, prepend=0))
    some = np.flatnonzero(end > begin)
    total = np.cumsum(end[some] - begin[some])
    done = 0
    while done < (total[-1] if len(total) else 0):
        until = min(done + PAIRS, int(total[-1]))
        lo, hi = np.searchsorted(total, done, "right"), np.searchsorted(total, until, "left") + 1
        rows, ends = some[lo:hi], total[lo:hi]
        before = ends - (end[rows] - begin[rows])
        count = np.minimum(ends, until) - np.maximum(before, done)
        skipped = np.maximum(done - before, 0)
        step = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        yield np.repeat(rows, count), np.repeat(begin[rows] + skipped, count) + step
        done = until


def _near(unit: np.ndarray, root: np.ndarray, place: np.ndarray, least: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The pairs of one unit and different roots whose sizes and positions leave room for the threshold."""
    n, position, side = place >> 32, (place & 0xFFFFFFFF) >> 2, place & 3
    rest = n - position  # the shingles from this one on
    for i, j in _pairs(unit, root):
        common = np.minimum(rest[i], rest[j])
        near = common * (1 + least) >= least * (n[i] + n[j]) - SLACK
        near &= np.minimum(n[i], n[j]) >= least * np.maximum(n[i], n[j]) - SLACK
        near &= (side[i] != side[j]) | (side[i] == 0)
        yield i[near], j[near]


def _whole(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Tables of whole runs of one key: the last run of a batch may go on in the next one."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(key).to_numpy()
        change = np.flatnonzero(keys[1:] != keys[:-1])
        cut = int(change[-1]) + 1 if len(change) else 0
        if cut:
            held.append(batch.slice(0, cut))
        if held and (cut or held[-1].column(key)[-1].as_py() != keys[0]):
            yield pa.Table.from_batches(held)
            held = []
        held.append(batch.slice(cut))
    if held:
        yield pa.Table.from_batches(held)


MET = "block bigint, unit bigint, node bigint, place bigint"


def _met(least: float):
    """The rows of every unit that have a near one of another root there, with the block that they are compared in."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _whole(batches, "unit"):
            unit, node, root, place = (table.column(c).to_numpy() for c in ("unit", "node", "root", "place"))
            met = np.zeros(len(unit), bool)
            for i, j in _near(unit, root, place, least):
                met[i] = met[j] = True
            unit, node, place = unit[met], node[met], place[met]
            if not len(unit):
                continue
            begin = np.flatnonzero(np.append(True, unit[1:] != unit[:-1]))
            count = np.diff(np.append(begin, len(unit)))
            block = np.where(count <= GATHERED, np.minimum.reduceat(node, begin), unit[begin])
            columns = np.repeat(block, count), unit, node, place
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], [c.split()[0] for c in MET.split(", ")])

    return run


def _possible(least: float):
    """Pairs of a block's units that are near and whose bitmaps leave room for the threshold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _whole(batches, "block"):
            block, node, root, n = (table.column(c).to_numpy() for c in ("block", "node", "root", "n"))
            odd, posts = table.column("odd").to_pylist(), table.column("posts").combine_chunks()
            row = np.repeat(np.arange(len(node)), posts.value_lengths().to_numpy())
            unit, place = (posts.flatten().field(c).to_numpy() for c in ("unit", "place"))
            order = np.lexsort([root[row], unit, block[row]])
            row, unit, place = row[order], unit[order], place[order]
            run_of = np.cumsum(np.append(True, (unit[1:] != unit[:-1]) | (block[row[1:]] != block[row[:-1]])))
            for i, j in _near(run_of, root[row], place, least):
                if not len(i):
                    continue
                pairs = np.unique(np.minimum(row[i], row[j]) * len(node) + np.maximum(row[i], row[j]))
                a, b = pairs // len(node), pairs % len(node)
                # both >= least * (a + b - both) with both = (a + b - difference) / 2
                both = n[a] + n[b]
                keep = (both - least_differences(odd, a, b)) * (1 + least) >= 2 * least * both - SLACK
                a, b = node[a[keep]], node[b[keep]]
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], ["a", "b"])

    return run


def candidates(nodes: DataFrame, keys: np.ndarray, least: float, piece: int = PIECE) -> DataFrame:
    """Pairs (a, b) of nodes of different roots, all that reach the threshold among them.

    ``nodes`` has node, root, n, head (``prefix``) and odd (``parities``); no two nodes hold the same set.
    Rows of posting lists, not pairs, are moved: near copies below the threshold share many shingles, and are as many pairs
    under each as the square of their number. Lists of one least node make a block, to which each node brings its bitmap
    once, and only pairs that the bitmaps leave come out.
    """
    rows = units(nodes, keys, piece).repartition("unit").sortWithinPartitions("unit", "root")
    met = rows.mapInArrow(_met(least), MET).repartition("node")
    posts = met.groupBy("node", "block").agg(F.collect_list(F.struct("unit", "place")).alias("posts"))
    blocks = posts.join(nodes.select("node", "root", "n", "odd"), "node")
    blocks = blocks.repartition("block").sortWithinPartitions("block")
    return blocks.mapInArrow(_possible(least), "a bigint, b bigint").distinct()
