"""Chat formatting: logged snapshots of a conversation are collapsed to the longest ones, which are rendered.

A chat is often logged again after every turn, so most logged conversations are prefixes of longer ones. The hash of a
prefix is the sum of a hash of each turn and its place, so it can be summed in pieces: turns are numbered and summed
within chunks of a conversation, and the chunks' totals are added up, so that no task holds a conversation whole. The
hashes of whole conversations that are found among the proper prefixes of others go (anti-join); of equal conversations
one stays. Only DataFrame functions are used.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dockflow.llm.common import stored

CHUNK_TURNS = 256
# How roles are written.
ROLES = {"system": "system", "user": "user", "human": "user", "assistant": "assistant", "bot": "assistant"}
HEAD, TAIL = "<|", "<|end|>"


def _role() -> Column:
    """The role in its written form; an unknown one as it is, null as user."""
    known = F.create_map(*[F.lit(x) for pair in ROLES.items() for x in pair])
    lowered = F.lower(F.trim(F.coalesce("role", F.lit("user"))))
    return F.coalesce(known[lowered], lowered)


def turns(conversations: DataFrame) -> DataFrame:
    """Every different turn once: conv_id, turn, role, text, with its chunk of turn numbers and its place in the chunk.

    Turns are ordered by number (null first), role, and text.
    """
    rows = conversations.select(
        F.col("conv_id").cast("bigint"), F.col("turn").cast("bigint"), _role().alias("role"), F.coalesce("text", F.lit("")).alias("text")
    ).distinct()
    chunked = rows.withColumn("chunk", F.expr(f"coalesce(floor(turn / {CHUNK_TURNS}), -9223372036854775807L)"))
    order = Window.partitionBy("conv_id", "chunk").orderBy(F.asc_nulls_first("turn"), "role", "text")
    return chunked.withColumn("at", F.row_number().over(order))


def _added_up(chunks: DataFrame, columns: list[str]) -> DataFrame:
    """Chunks with the sums of the chunks of their conversation before them; a row per chunk, not per turn."""
    before = Window.partitionBy("conv_id").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    return chunks.select("conv_id", "chunk", *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(c) for c in columns])


def _with_chunks(rows: DataFrame, chunks: DataFrame) -> DataFrame:
    other = chunks.withColumnsRenamed({"conv_id": "_conv", "chunk": "_chunk"})
    same = F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("chunk") == F.col("_chunk"))
    return rows.join(other, same).drop("_conv", "_chunk")


def prefixes(rows: DataFrame) -> DataFrame:
    """(conv_id, n, h1, h2) of every prefix of every conversation: its turns and two sums of hashes."""
    digest = rows.select("conv_id", "chunk", "at", F.xxhash64("role", "text").alias("d1"), F.xxhash64("text", F.lit(1), "role").alias("d2"))
    counts = digest.groupBy("conv_id", "chunk").agg(F.count("*").alias("before"))
    placed = _with_chunks(digest, _added_up(counts, ["before"])).withColumn("n", F.col("before") + F.col("at"))
    terms = placed.select(
        "conv_id",
        "chunk",
        "n",
        F.xxhash64("n", "d1", "d2").cast("decimal(38,0)").alias("t1"),
        F.xxhash64("d2", "n", "d1").cast("decimal(38,0)").alias("t2"),
    )
    totals = terms.groupBy("conv_id", "chunk").agg(F.sum("t1").alias("s1"), F.sum("t2").alias("s2"))
    running = Window.partitionBy("conv_id", "chunk").orderBy("n").rowsBetween(Window.unboundedPreceding, 0)
    summed = terms.select(
        "conv_id", "chunk", "n", F.sum("t1").over(running).alias("r1"), F.sum("t2").over(running).alias("r2")
    )
    return _with_chunks(summed, _added_up(totals, ["s1", "s2"])).select(
        "conv_id", "n", (F.col("r1") + F.col("s1")).alias("h1"), (F.col("r2") + F.col("s2")).alias("h2")
    )


def maximal(rows: DataFrame) -> DataFrame:
    """(conv_id, n_turns, n_equal) of conversations that prefix no longer one; of equal ones the smallest conv_id."""
    every = stored(prefixes(rows), "prefixes")
    keys = ["n", "h1", "h2"]
    whole = every.groupBy("conv_id").agg(F.max(F.struct(*keys)).alias("w")).select("conv_id", "w.*")
    distinct = stored(whole.groupBy(*keys).agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_equal")), "whole")
    # A prefix that is shared by many conversations is one row here, so no join key repeats.
    longest = whole.select(F.col("conv_id").alias("_conv"), F.col("n").alias("_n"))
    proper = (
        every.join(longest, F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("n") < F.col("_n")))
        .select(*keys)
        .distinct()
    )
    return distinct.join(proper, keys, "left_anti").select("conv_id", F.col("n").alias("n_turns"), "n_equal")


def chat_format(conversations: DataFrame) -> DataFrame:
    """Maximal conversations, rendered: conv_id, part, n_turns, n_equal, text.

    A turn is rendered as ``<|role|>``, a line break, its text, and ``<|end|>`` with a line break. A conversation of more
    than ``CHUNK_TURNS`` turns is rendered in parts of at most so many turn numbers, to be put together in their order;
    shorter ones with turn numbers from 0 are one part, 0. A repeated turn (same number, role and text) counts once; a
    null role is user, a null text empty, a null turn number comes first. Rows without conv_id are a conversation of
    their own, with a null conv_id. An empty table gives no rows. Other columns are not read.
    """
    rows = stored(turns(conversations), "turns")
    kept = maximal(rows).withColumnRenamed("conv_id", "_conv")
    shown = F.concat(F.lit(HEAD), "role", F.lit("|>\n"), "text", F.lit(f"{TAIL}\n"))
    parts = (
        rows.join(kept, F.col("conv_id").eqNullSafe(F.col("_conv")))
        .groupBy("conv_id", "chunk", "n_turns", "n_equal")
        .agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", shown.alias("shown")))), lambda s: s["shown"]), "").alias("text"))
    )
    number = Window.partitionBy("conv_id").orderBy("chunk")
    return parts.select("conv_id", (F.row_number().over(number) - 1).alias("part"), "n_turns", "n_equal", "text")


ORACLE = r"""
WITH rows_ AS (
    SELECT DISTINCT conv_id, turn,
           CASE lower(trim(coalesce(role, 'user'))) WHEN 'human' THEN 'user' WHEN 'bot' THEN 'assistant'
                ELSE lower(trim(coalesce(role, 'user'))) END AS role,
           coalesce(text, '') AS text
    FROM conversations),
numbered AS (
    SELECT *, row_number() OVER w AS n, count(*) OVER (PARTITION BY conv_id) AS n_turns,
           string_agg(md5(role || chr(1) || text), '') OVER w AS prefix
    FROM rows_ WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)),
whole AS (
    SELECT prefix, min(conv_id) AS conv_id, any_value(n_turns) AS n_turns, count(*) AS n_equal
    FROM numbered WHERE n = n_turns GROUP BY prefix),
kept AS (
    SELECT * FROM whole WHERE prefix NOT IN (SELECT prefix FROM numbered WHERE n < n_turns)),
parts AS (
    SELECT r.conv_id, coalesce(CAST(floor(r.turn / 256) AS BIGINT), -9223372036854775807) AS chunk, k.n_turns, k.n_equal,
           string_agg('<|' || r.role || '|>' || chr(10) || r.text || '<|end|>' || chr(10), '' ORDER BY r.n) AS text
    FROM numbered r JOIN kept k ON r.conv_id IS NOT DISTINCT FROM k.conv_id
    GROUP BY ALL)
SELECT conv_id, CAST(row_number() OVER (PARTITION BY conv_id ORDER BY chunk) - 1 AS INTEGER) AS part, n_turns, n_equal, text
FROM parts
"""
