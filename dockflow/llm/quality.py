"""Document quality as a grade: ordinal regression with a cumulative link over hashed text.

Ratings become ordered grades (0 toxic, 1 poor, 2 good). One weight per hashed word, word beginning or word shape is
shared by all grades; ordered thresholds cut the score: P(grade <= j) = logistic(threshold_j - score). The expected grade
ranks documents, and the tail probability P(grade >= j) selects them.
"""

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dockflow.llm.common import unused

GRADES = 3
BITS = 18
SAMPLE_PER_GRADE = 2_000  # labelled rows of each grade that the fit may see
LEAST_DOCS = 10  # of the sample must hold a feature that gets a weight
STEPS = 400
RATE, RIDGE = 1.0, 5e-6
BEGINNING = 4  # bytes of a word's beginning
SHAPES, BEGINNINGS = 0x5EED, 0xBE61  # start values of hashes, which keep kinds of features apart
REPEATS = {1: 11, 2: 12, 3: 13}  # features of a word that repeats the one so many words before


def _shape_table() -> bytes:
    table = bytearray(b"a" * 256)
    for code in range(128):
        c = chr(code)
        table[code] = code if not c.isalnum() else ord("0" if c.isdigit() else "A" if c.isupper() else "a")
    return bytes(table)


SHAPE = _shape_table()


def _collapsed(text: bytes) -> bytes:
    for c in (b"a", b"A", b"0"):
        for run in (16, 4, 2):
            while c * run in text:
                text = text.replace(c * run, c)
    return text


def features(text: bytes | None) -> tuple[np.ndarray, np.ndarray]:
    """Hashed words, word beginnings, word shapes and repetition of a whole text, each with the root of its share."""
    text = text or b""
    words, shapes = text.lower().split(), _collapsed(text.translate(SHAPE)).split()
    n = len(words)
    if not n:
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.float32)
    hashed = np.fromiter(map(crc32, words), dtype=np.int64, count=n)
    begun = np.fromiter(map(crc32, [w[:BEGINNING] for w in words], repeat(BEGINNINGS)), dtype=np.int64, count=n)
    shaped = np.fromiter(map(crc32, shapes, repeat(SHAPES)), dtype=np.int64, count=n)
    kinds = [hashed, begun, shaped]
    for lag, mark in REPEATS.items():  # words that stood ``lag`` words before
        kinds.append(np.full(int((hashed[lag:] == hashed[:-lag]).sum()), mark))
    found, counts = np.unique(np.concatenate(kinds) & ((1 << BITS) - 1), return_counts=True)
    return found, np.sqrt(counts / n).astype(np.float32)


@dataclass
class Ordinal:
    """Weights and ordered thresholds."""

    weights: np.ndarray
    thresholds: np.ndarray

    def tails(self, score: np.ndarray) -> np.ndarray:
        """P(grade >= j) for j = 1, 2, ... in columns."""
        return 1 / (1 + np.exp(np.clip(self.thresholds[None, :] - score[:, None], -60, 60)))

    def score(self, text: bytes | None) -> float:
        found, values = features(text)
        return float(self.weights[found] @ values)


def fit(rows: list[tuple[int, np.ndarray, np.ndarray]], weight_of: dict[int, float]) -> Ordinal:
    """Maximum likelihood with a ridge, by Adam steps over the whole sample; thresholds stay ordered by their gaps."""
    grade = np.array([g for g, _, _ in rows])
    index = np.concatenate([f for _, f, _ in rows]).astype(np.int32)
    value = np.concatenate([v for _, _, v in rows]).astype(np.float32)
    row = np.repeat(np.arange(len(rows), dtype=np.int32), [len(f) for _, f, _ in rows])
    common = np.bincount(index, minlength=1 << BITS) >= min(LEAST_DOCS, max(1, len(rows) // 2))
    used = common[index]
    places = np.flatnonzero(common)
    index, value, row = np.searchsorted(places, index[used]).astype(np.int32), value[used], row[used]
    share = np.array([weight_of[g] for g in grade])
    share = share / share.sum()
    below = np.array([share[grade <= j].sum() for j in range(GRADES - 1)]).clip(0.001, 0.999)
    first = np.log(below / (1 - below))
    # Parameters: weights, the first threshold, and the logarithms of the gaps to the next ones.
    x = np.concatenate([np.zeros(len(places)), first[:1], np.log(np.maximum(np.diff(first), 0.05))])
    m, v = np.zeros_like(x), np.zeros_like(x)
    n = len(places)
    for step in range(1, STEPS + 1):
        score = np.bincount(row, weights=x[:n][index] * value, minlength=len(rows))
        gaps = np.exp(x[n + 1 :])
        cuts = np.concatenate([[-np.inf], x[n] + np.concatenate([[0.0], np.cumsum(gaps)]), [np.inf]])
        high, low = (1 / (1 + np.exp(np.clip(score - cuts[grade + k], -60, 60))) for k in (1, 0))
        inside = np.maximum(high - low, 1e-12)
        d_high, d_low = high * (1 - high) / inside, low * (1 - low) / inside  # of log P by the upper and lower cut
        d_score = share * (d_high - d_low)  # minus the likelihood's slope
        gradient = np.zeros_like(x)
        gradient[:n] = np.bincount(index, weights=d_score[row] * value, minlength=n) + RIDGE * x[:n]
        slope = np.zeros(GRADES - 1)
        for j in range(GRADES - 1):
            slope[j] = -(share * d_high)[grade == j].sum() + (share * d_low)[grade == j + 1].sum()
        gradient[n] = slope.sum()
        gradient[n + 1 :] = gaps * np.cumsum(slope[::-1])[::-1][1:]
        m, v = 0.9 * m + 0.1 * gradient, 0.99 * v + 0.01 * gradient**2
        rate = RATE * min(1.0, 2 * (1 - step / (STEPS + 1)))
        x -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    weights = np.zeros(1 << BITS, dtype=np.float32)
    weights[places] = x[:n]
    return Ordinal(weights, x[n] + np.concatenate([[0.0], np.cumsum(np.exp(x[n + 1 :]))]))


def graded(labels: DataFrame) -> DataFrame:
    """(doc_id, grade): 0 toxic, 1 poor, 2 good. A null toxic mark is none; without quality there is no grade.

    Of several ratings of a document the lowest counts.
    """
    grade = F.when(F.col("toxic") == 1, 0).when(F.col("quality") == 0, 1).when(F.col("quality").isNotNull(), 2)
    rated = labels.select(F.col("doc_id").cast("bigint"), grade.alias("grade")).where("doc_id IS NOT NULL AND grade IS NOT NULL")
    return rated.groupBy("doc_id").agg(F.min("grade").alias("grade"))


def train(docs: DataFrame, labels: DataFrame, sample_per_grade: int = SAMPLE_PER_GRADE) -> Ordinal | None:
    """The model, or None if no document is rated.

    The fit sees the first ``sample_per_grade`` rated documents of each grade by hash, with whole texts; weights make up
    for the grades' true shares. A repeated doc_id is one row, with its text of the smallest hash, so that at most ``sample_per_grade``
    rows of each grade leave Spark.
    """
    rated = graded(labels)
    counts = {r["grade"]: r["count"] for r in rated.groupBy("grade").count().collect()}
    first = [F.xxhash64("doc_id", F.lit("sample")), "doc_id"]
    picked = [rated.where(F.col("grade") == g).orderBy(*first).limit(sample_per_grade).collect() for g in sorted(counts)]
    # At most sample_per_grade ids a grade: small enough to stand beside every part of the documents.
    ids = docs.sparkSession.createDataFrame([tuple(r) for rows in picked for r in rows], "doc_id bigint, grade int")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        least: dict[int, tuple[int, int, bytes | None]] = {}  # as many as sampled ids at most
        for batch in batches:
            keys = (batch.column(c).to_pylist() for c in ("doc_id", "digest", "grade"))
            for at, (doc, digest, grade) in enumerate(zip(*keys, strict=True)):
                if doc not in least or digest < least[doc][0]:
                    text = batch.column("text")[at].as_py()
                    least[doc] = (digest, grade, None if text is None else text.encode())
        for doc, (digest, grade, text) in least.items():
            found, values = features(text)
            made = ([doc], [digest], [grade], [found.astype("<i4").tobytes()], [values.astype("<f4").tobytes()])
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.binary())
            columns = [pa.array(m, k) for m, k in zip(made, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "digest", "grade", "index", "value"])

    texts = docs.select(F.col("doc_id").cast("bigint"), "text", F.xxhash64("text").alias("digest"))
    each = texts.join(F.broadcast(ids), "doc_id").select("doc_id", "digest", "grade", "text")
    each = each.mapInArrow(run, "doc_id bigint, digest bigint, grade int, index binary, value binary")
    one = each.groupBy("doc_id").agg(F.min_by(F.struct("grade", "index", "value"), "digest").alias("r"))
    made = one.select("r.*").collect()
    rows = [(r[0], np.frombuffer(r[1], "<i4"), np.frombuffer(r[2], "<f4")) for r in made]
    if not any(len(r[1]) for r in rows):
        return None
    rows.sort(key=lambda r: (r[0], r[1].tobytes(), r[2].tobytes()))
    seen = np.bincount([r[0] for r in rows], minlength=GRADES)
    return fit(rows, {g: counts.get(g, 0) / seen[g] for g in range(GRADES) if seen[g]})


def tail_probabilities(model: Ordinal, text: Column) -> Column:
    """P(grade >= 1) and P(grade >= 2) of a text, as a struct."""
    kind = pa.struct([("p_fair", pa.float64()), ("p_good", pa.float64())])

    @F.arrow_udf("struct<p_fair: double, p_good: double>")
    def tails(texts: pa.Array) -> pa.Array:
        score = np.array([model.score(t) for t in texts.cast(pa.binary()).to_pylist()], dtype=float)
        p = model.tails(score)
        return pa.StructArray.from_arrays([pa.array(p[:, 0]), pa.array(p[:, 1])], fields=list(kind))

    return tails(text)


def graded_documents(docs: DataFrame, labels: DataFrame, threshold: float = 0.5, **how) -> DataFrame:
    """The documents with expected_grade, p_fair, p_good and keep (p_good at least ``threshold``).

    A null text is empty; a text without words has score 0, so the thresholds alone decide. If no document is rated, the
    three numbers are null and every document is kept. Repeated rows keep a row each; all columns of the documents stay,
    but for any that have one of the four names, which are replaced. An empty table gives no rows.
    """
    model = train(docs, labels, **how)
    docs = docs.drop(*(c for c in docs.columns if c in ("expected_grade", "p_fair", "p_good", "keep")))
    if model is None:
        none = F.lit(None).cast("double")
        return docs.withColumns({"expected_grade": none, "p_fair": none, "p_good": none, "keep": F.lit(True)})
    (tails,) = unused(docs, "_tails")
    fair, good = F.col(f"{tails}.p_fair"), F.col(f"{tails}.p_good")
    scored = docs.withColumn(tails, tail_probabilities(model, F.col("text")))
    found = {"expected_grade": fair + good, "p_fair": fair, "p_good": good, "keep": good >= threshold}
    return scored.withColumns(found).drop(tails)


def select_quality(docs: DataFrame, labels: DataFrame, threshold: float = 0.5, **how) -> DataFrame:
    """The documents whose p_good is at least ``threshold``, all columns as they are; all, if no document is rated."""
    model = train(docs, labels, **how)
    return docs if model is None else docs.where(tail_probabilities(model, F.col("text"))["p_good"] >= threshold)
