"""SimHash near duplicates: fingerprints within a radius of differing bits, compared exactly in tiles.

Every pair of fingerprints that differ in at most ``radius`` bits is found. The 64 bits are cut into ``radius + 2``
blocks; a pair within the radius agrees on at least two of them, so fingerprints meet in the cells of every choice of
two blocks. A cell is a tile; one with more than ``tile_rows`` fingerprints is cut into tiles by population count, and
two tiles are compared only if their population counts differ by at most the radius, since a bit flip changes the count
by one. Tiles are compared with numpy exclusive-or and bit counts.
"""

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dockflow.llm.common import connected_components, stored, unused

SEED = 42
CHUNK = 1 << 16


def fingerprint(text: bytes | None, words: int = 3) -> int:
    """The signed 64-bit fingerprint of one text; 0 if it has no word."""
    tokens = (text or b"").lower().split()  # bytes: A-Z only, and the six ASCII white spaces
    if not tokens:
        return 0
    if len(tokens) <= words:
        grams = [b" ".join(tokens)]
    else:
        grams = list(map(b" ".join, zip(*(tokens[i:] for i in range(words)), strict=False)))
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(gram, SEED) for gram in grams], dtype="<u8")
    votes = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), CHUNK):
        part = hashes[at : at + CHUNK].view(np.uint8).reshape(-1, 8)
        votes += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(votes * 2 > len(hashes), bitorder="little").view("<i8")[0])


def with_fingerprints(docs: DataFrame, words: int = 3) -> DataFrame:
    """(doc_id, digest, fp): digest is Spark's hash of the text, for telling rows of one doc_id apart."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            found = pa.array([fingerprint(text, words) for text in texts], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("digest"), found], ["doc_id", "digest", "fp"]
            )

    rows = docs.select(F.col("doc_id").cast("bigint"), "text", F.xxhash64("text").alias("digest"))
    return rows.mapInArrow(run, "doc_id bigint, digest bigint, fp bigint")


def masks(radius: int) -> list[int]:
    """Signed masks: every choice of two of the ``radius + 2`` blocks of bits."""
    edges = np.linspace(0, 64, radius + 3).round().astype(int)
    blocks = [((1 << int(hi - lo)) - 1) << int(lo) for lo, hi in zip(edges, edges[1:], strict=False)]
    chosen = [a | b for a, b in combinations(blocks, 2)]
    return [m - (1 << 64) if m >> 63 else m for m in chosen]


def tiles(prints: DataFrame, radius: int, tile_rows: int) -> DataFrame:
    """(unit, side, fp): the rows of every tile or pair of tiles to compare.

    side is 0 where all rows of the unit are compared with each other, else 1 and 2 for the two tiles.
    """
    choices = F.array(
        *[
            F.struct(F.lit(i).alias("mask"), F.col("fp").bitwiseAND(F.lit(m)).alias("cell"))
            for i, m in enumerate(masks(radius))
        ]
    )
    cells = prints.select("fp", F.bit_count("fp").alias("pop"), F.inline(choices))
    counts = cells.groupBy("mask", "cell").count().where("count > 1")
    shared = cells.join(counts, ["mask", "cell"])
    small = shared.where(F.col("count") <= tile_rows).select(
        F.xxhash64("mask", "cell").alias("unit"), "mask", "cell", F.lit(0).alias("side"), "fp"
    )
    large = shared.where(F.col("count") > tile_rows).drop("count")
    pieces = (
        large.groupBy("mask", "cell", "pop")
        .agg(F.ceil(F.count("*") / tile_rows).cast("int").alias("k"))
        .groupBy("mask", "cell")
        .agg(F.map_from_entries(F.collect_list(F.struct("pop", "k"))).alias("ks"))  # 65 entries at most
    )
    mine = "struct(pop AS pop, CAST(pmod(xxhash64(fp), ks[pop]) AS INT) AS piece)"
    partners = f"""flatten(transform(
        filter(sequence(greatest(pop - {radius}, 0), least(pop + {radius}, 64)), p -> map_contains_key(ks, p)),
        p -> transform(sequence(1, ks[p]), j -> struct(p AS pop, j - 1 AS piece))))"""
    cut = (
        large.join(pieces, ["mask", "cell"])
        .withColumn("mine", F.expr(mine))
        .withColumn("other", F.explode(F.expr(partners)))
        .select(
            F.expr("xxhash64(mask, cell, least(mine, other), greatest(mine, other))").alias("unit"),
            "mask",
            "cell",
            F.expr("CASE WHEN mine = other THEN 0 WHEN mine < other THEN 1 ELSE 2 END").alias("side"),
            "fp",
        )
    )
    return small.union(cut)


def _near(a: np.ndarray, b: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    return np.nonzero(np.bitwise_count(a[:, None] ^ b[None, :]) <= radius)


def _forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The links as (node, smallest node of its component): as many rows as nodes, in place of all pairs."""
    nodes, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    left, right = ends[: len(a)], ends[len(a) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[left], label[right])
        after = label.copy()
        np.minimum.at(after, label[left], low)
        np.minimum.at(after, label[right], low)
        after = after[after]
        if np.array_equal(after, label):
            return nodes, nodes[label]
        label = after


def _compare_unit(fp: np.ndarray, side: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links of one tile or pair of tiles as a forest, in strips of the first tile."""
    first, second = (fp[side == 1], fp[side == 2]) if side.any() else (fp, fp)
    first, second = (x[np.argsort(np.bitwise_count(x), kind="stable")] for x in (first, second))
    weight = np.bitwise_count(second).astype(np.int64)
    nodes, roots = (np.empty(0, dtype=np.uint64),) * 2
    for at in range(0, len(first), 256):
        strip = first[at : at + 256]
        low, high = int(np.bitwise_count(strip[0])) - radius, int(np.bitwise_count(strip[-1])) + radius
        lo, hi = np.searchsorted(weight, low, "left"), np.searchsorted(weight, high, "right")
        if lo < hi:
            i, j = _near(strip, second[lo:hi], radius)
            nodes, roots = _forest(
                np.concatenate([nodes, strip[i]]), np.concatenate([roots, second[lo:hi][j]])
            )
    return nodes, roots


def _links(radius: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []

        def compare(rows: tuple[np.ndarray, ...]) -> pa.RecordBatch:
            keys, side, fp = rows
            found: list[tuple[np.ndarray, np.ndarray]] = []
            change = np.flatnonzero(np.any(keys[1:] != keys[:-1], axis=1)) + 1
            starts = np.concatenate([[0], change])
            lengths = np.diff(np.concatenate([starts, [len(fp)]]))
            run_of = np.repeat(np.arange(len(starts)), lengths)
            tiny = (lengths <= 32) & (np.maximum.reduceat(side, starts) == 0)
            few = np.flatnonzero(tiny[run_of])
            for step in range(1, int(lengths[tiny].max(initial=1))):
                a, b = few[:-step], few[step:]
                same = run_of[a] == run_of[b]
                a, b = a[same], b[same]
                near = np.bitwise_count(fp[a] ^ fp[b]) <= radius
                found.append((fp[a[near]], fp[b[near]]))
            for k in np.flatnonzero(~tiny):
                part = slice(starts[k], starts[k] + lengths[k])
                found.append(_compare_unit(fp[part], side[part], radius))
            a, b = (np.concatenate([x[i] for x in found]) if found else np.empty(0, np.uint64) for i in (0, 1))
            return pa.RecordBatch.from_arrays([pa.array(x.view(np.int64)) for x in (a, b)], ["a", "b"])

        for batch in batches:
            rows = (
                np.stack([batch.column(c).to_numpy().astype(np.int64) for c in ("unit", "mask", "cell")], axis=1),
                batch.column("side").to_numpy(),
                batch.column("fp").to_numpy().view(np.uint64),
            )
            if held:
                rows = tuple(np.concatenate(x) for x in zip(*held, rows, strict=True))
            if not len(rows[2]):
                continue
            last = np.flatnonzero(np.any(rows[0] != rows[0][-1], axis=1))
            cut = int(last[-1]) + 1 if len(last) else 0  # the unit at the end may go on in the next batch
            held = [tuple(x[cut:] for x in rows)]
            if cut:
                yield compare(tuple(x[:cut] for x in rows))
        if held:
            yield compare(held[0])

    return run


def links(prints: DataFrame, radius: int = 2, tile_rows: int = 4096) -> DataFrame:
    """Links (a, b) between distinct fingerprints at most ``radius`` bits apart, complete up to connection."""
    units = tiles(prints, radius, tile_rows)
    keys = ["unit", "mask", "cell"]
    return units.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(_links(radius), "a bigint, b bigint")


def components(prints: DataFrame, radius: int = 2, tile_rows: int = 4096) -> DataFrame:
    """(fp, root, component_id) of prints (doc_id, fp): the smallest fingerprint and doc_id that links reach."""
    each = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("first_doc")), "prints")
    roots = connected_components(links(each.select("fp"), radius, tile_rows))
    placed = each.join(roots, each["fp"] == roots["node"], "left").select(
        "fp", "first_doc", F.coalesce("root", "fp").alias("root")
    )
    placed = stored(placed, "placed")
    least = placed.groupBy("root").agg(F.min("first_doc").alias("component_id"))
    return placed.join(least, "root").select("fp", "root", "component_id")


def near_duplicates(docs: DataFrame, words: int = 3, radius: int = 2, tile_rows: int = 4096) -> DataFrame:
    """One row per document: doc_id, digest, fp, root, fingerprint (16 hexadecimal digits) and component_id.

    root tells components apart; component_id does so unless a doc_id is repeated.

    A null text counts as empty; a text without words has fingerprint zero, which links like any other. Repeated rows
    and repeated doc_ids keep a row each. A null doc_id takes part and is never the smallest; a component of nothing
    but null doc_ids has a null component_id. An empty table gives no rows. Other columns are not read.
    """
    prints = stored(with_fingerprints(docs, words), "fingerprints")
    found = components(prints.select("doc_id", "fp"), radius, tile_rows)
    return prints.join(found, "fp").select(
        "doc_id", "digest", "fp", "root", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def keep_one(docs: DataFrame, **how) -> DataFrame:
    """The documents without near duplicates: of each component the row of its smallest doc_id stays, once.

    A component of nothing but null doc_ids keeps one row. All columns and their order stay.
    """
    found = near_duplicates(docs, **how)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "digest"))
    best = found.groupBy("root").agg(first.alias("best"))
    doc, text, wanted, wanted_text = unused(docs, "_doc", "_text", "_wanted", "_wanted_text")
    chosen = best.select(F.col("best.doc_id").alias(wanted), F.col("best.digest").alias(wanted_text))
    marked = docs.withColumns({doc: F.col("doc_id").cast("bigint"), text: F.xxhash64("text")})
    same = F.col(doc).eqNullSafe(F.col(wanted)) & (F.col(text) == F.col(wanted_text))
    return marked.join(chosen, same, "left_semi").dropDuplicates([doc, text]).drop(doc, text)
