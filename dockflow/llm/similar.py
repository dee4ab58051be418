"""Near duplicates at a word similarity, by the tiled comparison of wide fingerprints.

The similarity is the Jaccard index of the sets of five-word shingles. Texts at 0.8 differ in about 15 % of the bits of a
fingerprint, too many for cells of equal bits in 64 of them. So a text has 512 bits, and lies in the cell of each of several
choices of 14 bits; texts at 0.8 share one of 24 cells with probability 0.92, at 0.9 with 0.99. A cell is a tile: its texts
are compared by exclusive-or and bit counts, strips whose population counts differ beyond the radius being skipped. The
distance is the angle between the sets and, with their sizes, an estimate of the index. A pair whose estimate is near the
threshold is decided by the shingles themselves: short texts carry them along, longer ones are read again.

The tiles find most links and leave groups that are mostly whole, but they miss some links. So an exact join by prefixes
of the sets (``prefixes.py``) goes over all texts of different groups then, and no link at the threshold is left out.
"""

from collections.abc import Iterator
from functools import cache
from itertools import groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dockflow.llm import prefixes
from dockflow.llm.common import connected_components, stored, unused

WORDS, LEAST = 5, 0.8
WIDTH = 8  # words of 64 bits in a wide fingerprint
CELLS, CELL_BITS = 24, 14
TILE_ROWS = 4096  # a larger cell is cut into tiles, and every two of them are compared
STRIP = 64  # rows of a tile that are compared at once
PIVOTS = 16  # rows that are compared with their whole tile first
RADIUS = 115  # differing bits beyond which no estimate comes near the threshold
SHORT = 32  # shingles; texts of so many are compared by them
SHORT_SLACK = 0.25  # estimates of few shingles are coarser
UNSURE = 0.1  # an estimate so near the threshold is no decision (three to four of its deviations)
FORESTS = 3  # so many links across every cut of a tile's links go to the decision by shingles
SEED, CHUNK = 42, 4096


def shingles(text: bytes | None, words: int = WORDS) -> np.ndarray:
    """Sorted hashes of the different shingles of a text; of its whole words if it has fewer."""
    tokens = (text or b"").lower().split()  # bytes: A-Z only, and the six ASCII white spaces
    if not tokens:
        return np.empty(0, "<u8")
    n = max(1, len(tokens) - words + 1)
    digest = xxhash.xxh64_intdigest
    return np.unique(np.array([digest(b" ".join(tokens[i : i + words]), SEED) for i in range(n)], dtype="<u8"))


def wide_fingerprint(hashes: np.ndarray) -> np.ndarray:
    """``WIDTH`` fingerprints of a set of hashes: a bit is set if it is in over half of the mixed hashes."""
    votes = np.zeros(64 * WIDTH, dtype=np.int64)
    steps = np.arange(1, WIDTH + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for at in range(0, len(hashes), CHUNK):
        x = hashes[at : at + CHUNK, None] + steps
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
        x ^= x >> np.uint64(31)
        votes += np.unpackbits(x.view(np.uint8), axis=1, bitorder="little").sum(0, dtype=np.uint32)
    return np.packbits(votes * 2 > len(hashes), bitorder="little").view("<u8")


@cache
def _choices() -> np.ndarray:
    """The bits of every cell, chosen once for all runs."""
    rng = np.random.default_rng(SEED)
    return np.stack([rng.choice(64 * WIDTH, CELL_BITS, replace=False) for _ in range(CELLS)])


def cells_of(prints: np.ndarray) -> np.ndarray:
    """The cell of each choice for every fingerprint (a row each): the choice's number and the bits there."""
    bits = np.unpackbits(prints.view(np.uint8), axis=1, bitorder="little")
    cells = np.empty((len(prints), CELLS), dtype=np.int64)
    for k, chosen in enumerate(_choices()):
        cells[:, k] = (k << CELL_BITS) + bits[:, chosen].astype(np.int64) @ (1 << np.arange(CELL_BITS))
    return cells


KIND = "doc_id bigint, digest bigint, node bigint, n bigint, wide binary, few binary, head binary, odd binary"
NONE = np.empty(0, "<u8"), np.empty(0, np.int64)


def sketches(docs: DataFrame, often: tuple[np.ndarray, np.ndarray] = NONE, least: float = LEAST) -> DataFrame:
    """One row per document: digest of its text, its node (a hash of its set of shingles), and what it is compared by."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes, sizes, wide, few, heads, odd = [], [], [], [], [], []
            for text in batch.column("text").cast(pa.binary()).to_pylist():
                hashes = shingles(text)
                prints = wide_fingerprint(hashes)
                short = len(hashes) <= SHORT
                nodes.append(xxhash.xxh64_intdigest(hashes.tobytes(), len(hashes)))
                sizes.append(len(hashes))
                wide.append(prints.tobytes())
                few.append(hashes.tobytes() if short else None)
                heads.append(prefixes.prefix(hashes, *often, least).tobytes())
                odd.append(prefixes.parities(hashes).tobytes())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("digest"),
                    pa.array(np.array(nodes, "<u8").view("<i8")),
                    pa.array(sizes, pa.int64()),
                    pa.array(wide, pa.binary()),
                    pa.array(few, pa.binary()),
                    pa.array(heads, pa.binary()),
                    pa.array(odd, pa.binary()),
                ],
                [c.split()[0] for c in KIND.split(", ")],
            )

    rows = docs.select(F.col("doc_id").cast("bigint"), "text", F.xxhash64("text").alias("digest"))
    return rows.mapInArrow(run, KIND)


def similarity(n: tuple[int, int], wide: tuple[bytes, bytes], few: tuple[bytes | None, bytes | None]) -> float:
    """Jaccard index of two texts: exact if both are short, else from the share of differing bits."""
    a, b = n
    if not a or not b:
        return float(a == b)
    if few[0] is not None and few[1] is not None:
        both = len(np.intersect1d(*(np.frombuffer(x, "<u8") for x in few), assume_unique=True))
    else:
        differ = int(np.bitwise_count(np.frombuffer(wide[0], "<u8") ^ np.frombuffer(wide[1], "<u8")).sum())
        both = max(0.0, float(np.cos(np.pi * differ / (64 * WIDTH)))) * (a * b) ** 0.5
    return both / (a + b - both)


def _estimates(distance: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    both = np.maximum(0.0, np.cos(np.pi * distance / (64 * WIDTH))) * np.sqrt(a * b)
    return both / np.maximum(a + b - both, 1e-9)


def joined(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The labels after both ends of every link have got one, the least."""
    while True:
        low = np.minimum(label[a], label[b])
        after = label.copy()
        np.minimum.at(after, label[a], low)
        np.minimum.at(after, label[b], low)
        after = after[after]
        if np.array_equal(after, label):
            return label
        label = after


def spanning(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which of the links (best first) make a spanning forest of the best ones."""
    label, kept = np.arange(n), np.zeros(len(a), dtype=bool)
    while True:
        left, right = label[a], label[b]
        open_ = np.flatnonzero(left != right)
        if not len(open_):
            return kept
        # The best link of every component joins it to another.
        _, first = np.unique(np.concatenate([left[open_], right[open_]]), return_index=True)
        best = np.unique(open_[first % len(open_)])
        kept[best] = True
        label = joined(label, a[best], b[best])


def _grouped(prints: np.ndarray, n: np.ndarray, least: float) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """Groups around a few pivots: a label per row (-1: in none), and links of estimates that are sure.

    Rows of one group are connected already and need no comparison with each other, so a large group of near copies costs
    a comparison with its pivot, not one of all pairs.
    """
    label, found = np.full(len(prints), -1), []
    free = np.full(len(prints), len(prints) > 4 * STRIP)  # a small tile is compared at once
    for _ in range(PIVOTS):
        if not free.any():
            break
        pivot = int(np.flatnonzero(free)[0])
        distance = np.bitwise_count(prints ^ prints[pivot]).sum(1, dtype=np.int64)
        sizes = np.minimum(n, n[pivot]) >= least * np.maximum(n, n[pivot])
        near = free & sizes & (n > SHORT) & (n[pivot] > SHORT) & (_estimates(distance, n, n[pivot]) >= least + UNSURE)
        near[pivot] = True
        found += [(int(i), pivot) for i in np.flatnonzero(near) if i != pivot]
        free[near] = False
        if near.sum() > 1:
            label[near] = pivot
    return label, found


def tile_links(prints: np.ndarray, n: np.ndarray, side: np.ndarray, least: float) -> tuple[np.ndarray, ...]:
    """Rows a and b and estimate of the links of a tile, or of two tiles (sides 1 and 2), as forests."""
    label, sure = _grouped(prints, n, least)
    weight = np.bitwise_count(prints).sum(1, dtype=np.int64)
    order = np.argsort(weight, kind="stable")
    second = order[side[order] != 1]
    first = order[side[order] <= 1]
    first = first[np.argsort(label[first], kind="stable")]  # strips of one group, in order of population counts
    edges = np.array(sure, dtype=np.int64).reshape(-1, 2)
    links = (edges[:, 0], edges[:, 1], np.ones(len(edges)))
    cuts = np.flatnonzero(np.diff(label[first])) + 1
    for group in np.split(first, cuts):
        others = second[label[second] != label[group[0]]] if len(group) and label[group[0]] >= 0 else second
        for at in range(0, len(group), STRIP):
            strip = group[at : at + STRIP]
            lo = np.searchsorted(weight[others], weight[strip[0]] - RADIUS, "left")
            hi = np.searchsorted(weight[others], weight[strip[-1]] + RADIUS, "right")
            for part in range(lo, hi, TILE_ROWS):
                other = others[part : min(part + TILE_ROWS, hi)]
                links = tuple(np.concatenate(x) for x in zip(links, _compared(prints, n, strip, other, least), strict=True))
            if len(links[0]) > 16 * len(prints):
                links = _best(len(prints), *links, least)
    return _best(len(prints), *links, least)


def _compared(prints: np.ndarray, n: np.ndarray, strip: np.ndarray, other: np.ndarray, least: float) -> tuple[np.ndarray, ...]:
    """Links of two lists of rows by exclusive-or and bit counts."""
    distance = np.zeros((len(strip), len(other)), dtype=np.int16)
    for word in range(WIDTH):
        distance += np.bitwise_count(prints[strip, word, None] ^ prints[None, other, word])
    i, j = np.nonzero(distance <= RADIUS)
    return _alike(distance[i, j], n, strip[i], other[j], least)


def _alike(distance: np.ndarray, n: np.ndarray, i: np.ndarray, j: np.ndarray, least: float) -> tuple[np.ndarray, ...]:
    """The pairs (i, j) whose estimate reaches the threshold or comes near it."""
    low, high, estimate = np.minimum(n[i], n[j]), np.maximum(n[i], n[j]), _estimates(distance, n[i], n[j])
    alike = (i != j) & (low >= least * high) & (estimate >= least - UNSURE - SHORT_SLACK * (low <= SHORT))
    estimate = np.where(high <= SHORT, np.minimum(estimate, least), estimate)  # two short texts: their shingles decide
    return i[alike], j[alike], estimate[alike]


def small_links(prints: np.ndarray, n: np.ndarray, tile: np.ndarray, least: float) -> tuple[np.ndarray, ...]:
    """As ``tile_links`` for many small tiles at once; ``tile`` numbers the tile of each row, rows of a tile adjoin."""
    found = []
    for step in range(1, int(np.unique(tile, return_counts=True)[1].max())):
        a = np.flatnonzero(tile[step:] == tile[:-step])
        distance = np.bitwise_count(prints[a] ^ prints[a + step]).sum(1, dtype=np.int64)
        near = distance <= RADIUS
        found.append(_alike(distance[near], n, a[near], a[near] + step, least))
    return _best(len(prints), *(np.concatenate(x) for x in zip(*found, strict=True)), least)


def _best(n: int, a: np.ndarray, b: np.ndarray, estimate: np.ndarray, least: float) -> tuple[np.ndarray, ...]:
    """A spanning forest of the links, sure ones first, and further forests of the unsure links between what those join.

    An unsure link may be refuted by the shingles. So every cut that no sure link crosses keeps its best ``FORESTS`` links
    or all it has, instead of one.
    """
    a, b = np.minimum(a, b), np.maximum(a, b)
    _, once = np.unique(a * n + b, return_index=True)
    once = once[np.argsort(-estimate[once], kind="stable")]
    a, b, estimate = a[once], b[once], estimate[once]
    sure = estimate >= least + UNSURE
    kept = spanning(n, a, b)
    label = joined(np.arange(n), a[kept & sure], b[kept & sure])
    for _ in range(FORESTS - 1):
        rest = np.flatnonzero(~kept & (label[a] != label[b]))
        kept[rest[spanning(n, label[a[rest]], label[b[rest]])]] = True
    return a[kept], b[kept], estimate[kept]


def _tiles(least: float):
    """Links (a, b, sure) of the tiles of a partition; rows of a tile come together, small tiles are taken together."""
    names = ["unit", "side", "node", "n", "wide", "few"]

    def compare(rows: list[tuple], tile: list[int] | None = None) -> pa.RecordBatch:
        _, side, node, n, wide, few = zip(*rows, strict=True)
        prints, sizes = np.frombuffer(b"".join(wide), "<u8").reshape(-1, WIDTH), np.array(n, dtype=float)
        if tile is None:
            a, b, estimate = tile_links(prints, sizes, np.array(side), least)
        else:
            a, b, estimate = small_links(prints, sizes, np.array(tile), least)
        keep, sure = np.ones(len(a), bool), estimate >= least + UNSURE
        for k, (i, j) in enumerate(zip(a.tolist(), b.tolist(), strict=True)):
            if few[i] is not None and few[j] is not None:
                found = similarity((n[i], n[j]), (wide[i], wide[j]), (few[i], few[j]))
                keep[k], sure[k] = found >= least, True
        low, high = (f(np.array(node)[a], np.array(node)[b]) for f in (np.minimum, np.maximum))
        return pa.RecordBatch.from_arrays([pa.array(x[keep]) for x in (low, high, sure)], ["a", "b", "sure"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (r for batch in batches for r in zip(*(batch.column(c).to_pylist() for c in names), strict=True))
        small, numbers = [], []
        for number, (_, group) in enumerate(groupby(rows, key=itemgetter(0))):
            tile = list(group)
            if len(tile) > STRIP or any(row[1] for row in tile):
                yield compare(tile)
            elif len(tile) > 1:
                small += tile
                numbers += [number] * len(tile)
            if len(small) > TILE_ROWS:
                yield compare(small, numbers)
                small, numbers = [], []
        if small:
            yield compare(small, numbers)

    return run


def _exact(least: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = (batch.column(c).cast(pa.binary()).to_pylist() for c in ("text_a", "text_b"))
            keep = []
            for a, b in zip(*texts, strict=True):
                a, b = shingles(a), shingles(b)
                both = len(np.intersect1d(a, b, assume_unique=True))
                keep.append(both >= least * (len(a) + len(b) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def tiles(nodes: DataFrame, tile_rows: int = TILE_ROWS) -> DataFrame:
    """(unit, side, node, n, wide, few): the rows of every tile (side 0) or of two tiles of one cell (sides 1 and 2)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = np.frombuffer(b"".join(batch.column("wide").to_pylist()), "<u8").reshape(-1, WIDTH)
            starts = pa.array(np.arange(len(prints) + 1, dtype=np.int32) * CELLS)
            yield batch.append_column("cells", pa.ListArray.from_arrays(starts, pa.array(cells_of(prints).ravel())))

    kept = ["node", "n", "wide", "few"]
    placed = nodes.select(*kept).mapInArrow(run, "node bigint, n bigint, wide binary, few binary, cells array<bigint>")
    counts = placed.select(F.explode("cells").alias("cell")).groupBy("cell").count()
    crowded = counts.where(F.col("count") > tile_rows)
    crowded = crowded.select("cell", F.ceil(F.col("count") / tile_rows).cast("int").alias("cut"))
    # There are CELLS << CELL_BITS cells (393,216) however large the corpus is, so these rows fit every executor, and
    # the rows of the tiles are shuffled once, by unit.
    rows = placed.select(*kept, F.explode("cells").alias("cell")).join(F.broadcast(crowded), "cell", "left")
    rows = rows.withColumn("pieces", F.coalesce("cut", F.lit(1)))
    rows = rows.withColumn("mine", F.pmod(F.xxhash64("node"), F.col("pieces")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)))
    return rows.select(
        F.xxhash64("cell", F.least("mine", "other"), F.greatest("mine", "other")).alias("unit"),
        F.when(F.col("mine") == F.col("other"), 0).when(F.col("mine") < F.col("other"), 1).otherwise(2).alias("side"),
        *kept,
    )


def similar_links(nodes: DataFrame, texts: DataFrame, least: float = LEAST, tile_rows: int = TILE_ROWS) -> DataFrame:
    """Links (a, b) between nodes of at least this similarity; ``texts`` has a text (doc_id, digest) for every node."""
    units = tiles(nodes, tile_rows).repartition("unit").sortWithinPartitions("unit", "side", "node")
    found = units.mapInArrow(_tiles(least), "a bigint, b bigint, sure boolean")
    alike = stored(found.groupBy("a", "b").agg(F.max("sure").alias("sure")), "similar")

    unsure = _decided(alike.where("NOT sure").select("a", "b"), nodes, texts, least)
    return alike.where("sure").select("a", "b").union(unsure)


def _decided(pairs: DataFrame, nodes: DataFrame, texts: DataFrame, least: float) -> DataFrame:
    """The pairs (a, b) of nodes that reach the threshold by the shingles of their texts."""
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct().join(nodes, "node").select("node", "doc", "of")
    same = F.col("doc").eqNullSafe(F.col("doc_id")) & (F.col("of") == F.col("digest"))
    read = wanted.join(texts, same).groupBy("node").agg(F.first("text").alias("text"))
    for end in ("a", "b"):
        pairs = pairs.join(read.select(F.col("node").alias(end), F.col("text").alias(f"text_{end}")), end)
    return pairs.select("a", "b", "text_a", "text_b").mapInArrow(_exact(least), "a bigint, b bigint")


def grouped_nodes(nodes: DataFrame, texts: DataFrame, often: np.ndarray, least: float, tile_rows: int) -> DataFrame:
    """(node, root) of the linked nodes: groups by tiles, then by the links between those groups, of which none is lost."""
    first = stored(connected_components(similar_links(nodes, texts, least, tile_rows)), "groups")
    roots = first.select(F.col("node").alias("linked"), F.col("root").alias("_root"))
    placed = nodes.join(roots, F.col("node") == F.col("linked"), "left")
    placed = stored(placed.select("node", F.coalesce("_root", "node").alias("root"), "n", "head", "odd"), "placed")
    pairs = stored(prefixes.candidates(placed, often, least), "candidates")
    between = stored(_decided(pairs, nodes, texts, least), "between")
    for end in ("a", "b"):
        named = first.select(F.col("node").alias(end), F.col("root").alias(f"root_{end}"))
        between = between.join(named, end, "left").withColumn(f"root_{end}", F.coalesce(f"root_{end}", end))
    last = connected_components(between.selectExpr("root_a AS a", "root_b AS b"))
    last = stored(last.select(F.col("node").alias("group"), F.col("root").alias("joined")), "joined")
    # A group's root is its node of least number, so the least root of joined groups is that of the whole.
    old = first.join(last, F.col("root") == F.col("group"), "left").select("node", F.coalesce("joined", "root").alias("root"))
    new = last.join(first, F.col("group") == F.col("node"), "left_anti")
    return old.union(new.select(F.col("group").alias("node"), F.col("joined").alias("root")))


def similar_documents(docs: DataFrame, least: float = LEAST, tile_rows: int = TILE_ROWS) -> DataFrame:
    """One row per document: doc_id, digest, root (of its group of near duplicates).

    A null text is empty; texts without words are one group. Equal texts share a node. Repeated rows keep a row each, a
    null doc_id takes part, an empty table gives no rows. Other columns are not read.
    """
    often = prefixes.frequent(docs, shingles)
    prints = stored(sketches(docs, often, least), "sketches")
    kept = [c.split()[0] for c in KIND.split(", ")[3:]]
    one = F.min(F.struct("doc_id", "digest"))
    nodes = prints.groupBy("node").agg(one.alias("one"), *[F.first(c).alias(c) for c in kept])
    nodes = stored(nodes.select("*", F.col("one.doc_id").alias("doc"), F.col("one.digest").alias("of")).drop("one"), "nodes")
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64("text").alias("digest"), "text")
    roots = grouped_nodes(nodes, texts, often[0], least, tile_rows).withColumnRenamed("node", "linked")
    placed = prints.select("doc_id", "digest", "node").join(roots, F.col("node") == F.col("linked"), "left")
    return placed.select("doc_id", "digest", F.coalesce("root", "node").alias("root"))


def keep_one_similar(docs: DataFrame, **how) -> DataFrame:
    """The documents without near duplicates: of each group the row of its smallest doc_id stays, once.

    A group of nothing but null doc_ids keeps one row. Rows that agree in doc_id and text are one. Columns stay.
    """
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "digest"))
    best = similar_documents(docs, **how).groupBy("root").agg(first.alias("best"))
    doc, text, wanted, wanted_text = unused(docs, "_doc", "_text", "_wanted", "_wanted_text")
    chosen = best.select(F.col("best.doc_id").alias(wanted), F.col("best.digest").alias(wanted_text))
    marked = docs.withColumns({doc: F.col("doc_id").cast("bigint"), text: F.xxhash64("text")})
    same = F.col(doc).eqNullSafe(F.col(wanted)) & (F.col(text) == F.col(wanted_text))
    return marked.join(chosen, same, "left_semi").dropDuplicates([doc, text]).drop(doc, text)
