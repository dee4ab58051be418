"""Mixing sources to target weights by balanced sampling (cube method, Deville and Tillé 2004).

A source's target over its size is the mean number of copies of its documents: every document is taken its whole part
of times, and the fraction left is its inclusion probability for one copy more. The flight phase moves the vector of
probabilities inside the null space of two constraints (words taken and documents taken stay as they are) until one
more probability is 0 or 1, and again, until at most two are left. Blocks of documents fly side by side, each leaving
two; what they leave is gathered into new blocks, and so on, until one block per source is left. Its last two
documents land: words stay balanced first, then chance decides the last one.
"""

import hashlib
from collections.abc import Iterator
from random import Random

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dockflow.llm.common import row_digest, stored, unused

WEIGHTS = (5.0, 2.0, 1.0)
WORD = r"[^\x20\x09-\x0D]+"
SETTLED = 1e-9
UNIT = ["doc_id", "size", "digest", "row"]  # what tells a unit from others of its source, the same for any file splits


def targets(sizes: list[float], weights: list[float], most: float = 3.0) -> list[float]:
    """Shares of the sum of sizes by weight; none above ``most`` times its size, the excess goes to the others by weight."""
    total, result = float(sum(sizes)), [0.0] * len(sizes)
    free = [i for i, size in enumerate(sizes) if size > 0]
    while free:
        rest = total - sum(result)
        unit = rest / sum(weights[i] for i in free)
        full = {i for i in free if unit * weights[i] > most * sizes[i]}
        if not full:
            for i in free:
                result[i] = unit * weights[i]
            break
        for i in full:
            result[i] = most * sizes[i]
        free = [i for i in free if i not in full]
    return result


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: float = 3.0) -> DataFrame:
    """(source, source_size, target, ratio), one row per source; the list of sources is small and passes the driver."""
    rows = sizes.groupBy("source").agg(F.sum("size").alias("n")).collect()
    rows.sort(key=lambda r: (r["source"] is None, r["source"] or ""))
    wanted = targets([r["n"] for r in rows], [weights[i % len(weights)] for i in range(len(rows))], most)
    table = [(r["source"], r["n"], t, t / r["n"] if r["n"] else 0.0) for r, t in zip(rows, wanted, strict=True)]
    return sizes.sparkSession.createDataFrame(table, "source string, source_size bigint, target double, ratio double")


def _step(x: list, chance: float) -> tuple[float, float, float]:
    """Probabilities of three documents after a move that keeps the sum of words and of documents."""
    (p, a), (q, b), (r, c) = x
    u = (b - c, c - a, a - b)  # null space of [[a, b, c], [1, 1, 1]]
    if u == (0, 0, 0):
        u = (1, -1, 0)
    up = min((1 - v) / d if d > 0 else v / -d for v, d in zip((p, q, r), u, strict=True) if d)
    down = min(v / d if d > 0 else (1 - v) / -d for v, d in zip((p, q, r), u, strict=True) if d)
    move = up if chance * (up + down) < down else -down
    return tuple(v + move * d for v, d in zip((p, q, r), u, strict=True))


def flight(probabilities: list[float], sizes: list[int], random: Random) -> list[float]:
    """The probabilities after the flight phase: all 0 or 1 but for two at most."""
    result, held = list(probabilities), []
    for i, p in enumerate(probabilities):
        if SETTLED < p < 1 - SETTLED:
            held.append(i)
        else:
            result[i] = round(p)
        while len(held) == 3:
            moved = _step([(result[k], sizes[k]) for k in held], random.random())
            rest = []
            for k, v in zip(held, moved, strict=True):
                if SETTLED < v < 1 - SETTLED:
                    result[k] = v
                    rest.append(k)
                else:
                    result[k] = float(round(v))
            held = rest
    return result


def landing(probabilities: list[float], sizes: list[int], before: list[float], random: Random) -> list[float]:
    """What the flight left becomes 0 or 1, then the words that this adds or takes are set right.

    Two documents first keep their words in balance, then chance decides with the probability left. A source's last
    document may be very long; so, as long as it brings the words nearer to ``before``, the document that fits the
    difference best changes sides.
    """
    result = list(probabilities)
    held = [i for i, p in enumerate(result) if SETTLED < p < 1 - SETTLED]
    if len(held) == 2 and sizes[held[0]] and sizes[held[1]]:
        (i, j), u = held, (sizes[held[1]], -sizes[held[0]])
        up = min((1 - result[i]) / u[0], result[j] / -u[1])
        down = min(result[i] / u[0], (1 - result[j]) / -u[1])
        move = up if random.random() * (up + down) < down else -down
        for k, d in zip((i, j), u, strict=True):
            v = result[k] + move * d
            result[k] = v if SETTLED < v < 1 - SETTLED else float(round(v))
    for k in held:
        if 0 < result[k] < 1:
            result[k] = float(random.random() < result[k])
    free = [i for i, p in enumerate(before) if SETTLED < p < 1 - SETTLED and sizes[i]]
    over = sum((result[i] - before[i]) * sizes[i] for i in free)
    while True:
        sides = [i for i in free if result[i] == (over > 0)]
        best = min(sides, key=lambda i: (abs(abs(over) - sizes[i]), i), default=None)
        if best is None or abs(abs(over) - sizes[best]) >= abs(over):
            return result
        over -= sizes[best] if result[best] else -sizes[best]
        result[best] = 1.0 - result[best]


def _seeded(*parts: object) -> Random:
    return Random(int.from_bytes(hashlib.blake2b(repr(parts).encode(), digest_size=8).digest(), "little"))


def _fly(level: int, seed: int, last: bool):
    """Fly the blocks of a partition; rows come sorted, a block's rows together."""

    def finish(rows: list, key: tuple) -> pa.RecordBatch:
        random = _seeded(seed, level, *key)
        sizes = [r[1] for r in rows]
        result = flight([r[2] for r in rows], sizes, random)
        if last:
            result = landing(result, sizes, [r[2] for r in rows], random)
        return pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], pa.int64()), pa.array(result, pa.float64())], ["at", "p"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, parts, key = [], [], None
        fixed = ["source", "block", "size", "p"]
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in fixed]
            for at, (source, block, size, p) in enumerate(zip(*columns, strict=True)):
                if (source, block) != key:
                    if held:
                        yield from _rows(parts, finish(held, key))
                    held, parts, key = [], [], (source, block)
                held.append((len(held), size, p))
                if not parts or parts[-1][0] is not batch:
                    parts.append((batch, at, at))
                parts[-1] = (batch, parts[-1][1], at)
        if held:
            yield from _rows(parts, finish(held, key))

    return run


def _rows(parts: list, flown: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    done = 0
    for batch, first, end in parts:
        n = end - first + 1
        rows = batch.slice(first, n)
        yield rows.set_column(rows.schema.get_field_index("p"), "p", flown.column("p").slice(done, n))
        done += n


def balanced(units: DataFrame, block_rows: int = 4096, seed: int = 42) -> DataFrame:
    """Units (source, doc_id, size, digest, row, p and others) with p moved to 0 or 1, each source's words and documents in balance.

    A block is a share of a source by hash, so a source of any size is many blocks; only one that is down to
    ``block_rows`` undecided units is a single block, and lands.
    """
    done, level = [], 0
    open_rows = stored(units, "units")
    while True:
        counts = open_rows.groupBy("source").agg(F.ceil(F.count("*") / block_rows).cast("bigint").alias("blocks"))
        most = counts.agg(F.max("blocks")).first()[0] or 0
        if not most:
            break
        last = most == 1
        dealt = (
            open_rows.join(counts, open_rows["source"].eqNullSafe(counts["source"]))
            .select(open_rows["*"], F.expr(f"pmod(xxhash64({', '.join(UNIT)}, {level}), blocks)").alias("block"))
            .repartition("source", "block")
            .sortWithinPartitions("source", "block", *UNIT)
        )
        flown = stored(dealt.mapInArrow(_fly(level, seed, last), dealt.schema), f"flight-{level}").drop("block")
        done.append(flown.where("p = 0 OR p = 1"))
        if last:
            break
        open_rows, level = stored(flown.where("p > 0 AND p < 1"), f"open-{level}"), level + 1
    result = done[0] if done else open_rows
    for other in done[1:]:
        result = result.union(other)
    return result


def mixed(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: float = 3.0, seed: int = 42) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, copies, taken, digest, row.

    size counts the words of the text (null: 0). Sources take part in code-point order, null last. A source without
    words has target 0 and gives nothing; a document of no words is taken as its source's share says, and adds no word.
    Repeated rows are documents of their own, told apart by a running number (``row``). An empty table gives no rows.
    Reruns agree, also with other file splits or other numbers of tasks: units are dealt and ordered by their own values.
    """
    sized = docs.select(
        F.col("doc_id").cast("bigint"),
        F.col("source").cast("string"),
        F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("bigint").alias("size"),
        row_digest(docs).alias("digest"),
    )
    counted = sized.groupBy(*sized.columns).count()
    sized = stored(counted.withColumn("row", F.explode(F.sequence(F.lit(1), "count"))).drop("count"), "sizes")
    plan = source_targets(sized, weights, most)  # a row per source: Spark knows its size
    units = sized.join(plan, sized["source"].eqNullSafe(plan["source"])).select(
        sized["*"],
        "source_size",
        "target",
        F.floor("ratio").cast("bigint").alias("whole"),
        (F.col("ratio") - F.floor("ratio")).alias("p"),
    )
    return balanced(units, seed=seed).select(
        "doc_id",
        "source",
        "size",
        "source_size",
        "target",
        (F.col("whole") + F.col("p").cast("bigint")).alias("copies"),
        ((F.col("whole") + F.col("p").cast("bigint")) * F.col("size")).alias("taken"),
        "digest",
        "row",
    )


def mixed_documents(docs: DataFrame, **how) -> DataFrame:
    """The documents of the mix, all columns as they are: each row as often as the mix takes it, so maybe not at all."""
    doc, row, wanted, wanted_row, n, copy = unused(docs, "_doc", "_row", "_wanted", "_wanted_row", "_n", "_copy")
    copies = mixed(docs, **how).groupBy(F.col("doc_id").alias(wanted), F.col("digest").alias(wanted_row))
    copies = copies.agg(F.sum("copies").alias(n)).where(F.col(n) > 0)
    marked = docs.withColumns({doc: F.col("doc_id").cast("bigint"), row: row_digest(docs)})
    same = F.col(doc).eqNullSafe(F.col(wanted)) & (F.col(row) == F.col(wanted_row))
    # Rows that are equal in all columns have one key, and the copies of all of them.
    taken = marked.join(copies, same).dropDuplicates([doc, row])
    return taken.select(*docs.columns, F.explode(F.sequence(F.lit(1), n)).alias(copy)).drop(copy)
