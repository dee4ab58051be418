"""Benchmark decontamination by latent semantic retrieval.

Every text is cut into passages of a fixed number of words. The TF-IDF matrix of all passages over the benchmark's words
gets a randomised singular value decomposition: two passes over the passages multiply a random and then an orthonormal
basis by the matrix and its transpose, task by task, and only sums by word leave a task. The leading dimensions hardly see
rare words, so what the decomposition leaves of each word is kept too, as a random projection. In the space of both,
overlapping passages are compared with the items by cosine; what is near is checked by the longest common subsequence of words, and
by how many of the answer's words are there unless the item or its question is all but whole, so paraphrases that keep most words in order count and a common topic
does not. Verbatim copies are found word by word besides, whatever their words weigh and however short they are.
"""

import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain, count, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dockflow.llm.common import stored, unused
from dockflow.llm.licenses import TABLE

WINDOW, STRIDE = 32, 16  # words; a window is two strides
RANK, OVERSAMPLE, SKETCH = 16, 8, 160
LEAST_COSINE = 0.3  # what is near is checked word by word
LEAST_LCS, LEAST_ANSWER = 0.6, 0.5
SURE_LCS = 0.9  # of an item, or of its question alone: there without a look at the answer
LEAST_QUESTION = 3  # words of a question that is looked for by itself
SHORT_ITEM = 8  # words; a shorter item or question must be there word by word
RARE_SHARE = 0.01  # a shorter question counts without its answer if chance gives its words to fewer documents than this
BLOCK_ITEMS = 20_000  # items searched at once: bounds what tasks and the driver hold
TERMS_PER_ROW = 256  # rows of the basis that travel together
CHUNK = 1 << 18
PAIRS = 1 << 16  # candidates that are checked at once
COLUMNS = 16  # words of an item that are looked up at once
NEAR, ASKED, WHOLE = range(3)  # a near window; a verbatim question that needs its answer; a verbatim copy that counts
CELLS = 1 << 23  # cosines that are computed at once
STRIDES = 1 << 12  # strides whose words are added up at once
ANSWER = re.compile(r"(?:answer\s*:|\?)(?=\s*\S)(?!.*(?:answer\s*:|\?)\s*\S)(.*)", re.IGNORECASE | re.DOTALL)


def words_of(text: str | None) -> list[bytes]:
    """Words in lower case: runs of ASCII letters and digits and of any character beyond ASCII."""
    return (text or "").lower().encode().translate(TABLE).split()


@dataclass
class Items:
    """One block of benchmark items, as every task holds it."""

    ids: list[int]
    texts: list[list[int]]  # term numbers
    answers: list[list[int]]
    questions: list[int]  # words ahead of the answer; 0 if there is no answer or too few words are ahead of it
    vocabulary: dict[bytes, int]
    segments: np.ndarray  # item number, first and end word of each segment of an item that paraphrases are looked for


def items_of(rows: list[tuple[int, str | None]]) -> Items:
    vocabulary: dict[bytes, int] = {}
    ids, texts, answers, questions, segments = [], [], [], [], []
    for item_id, text in rows:
        words = words_of(text)
        if not words:
            continue
        numbers = [vocabulary.setdefault(w, len(vocabulary)) for w in words]
        found = ANSWER.search(text or "")
        answers.append([vocabulary[w] for w in words_of(found[1])] if found else [])
        asked = len(words_of(text[: found.start(1)])) if found else 0
        questions.append(asked if LEAST_QUESTION <= asked < len(numbers) else 0)
        for n in (len(numbers), questions[-1]):  # the whole item, and its question alone
            if n < SHORT_ITEM:
                continue
            for start in range(0, max(1, n - STRIDE), WINDOW):
                start = max(0, min(start, n - WINDOW))
                segments.append((len(ids), start, min(start + WINDOW, n)))
        ids.append(item_id)
        texts.append(numbers)
    return Items(ids, texts, answers, questions, vocabulary, np.array(segments, dtype=np.int64).reshape(-1, 3))


def encoded_terms(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """(doc_id, digest, n_words, terms, gaps): the benchmark's words in each text and the steps between their places."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get = vocabulary.get
        for batch in batches:
            counts, terms, gaps = [], [], []
            for text in batch.column("text").to_pylist():
                words = words_of(text)
                found = np.fromiter(map(get, words, repeat(-1)), dtype="<i4", count=len(words))
                at = np.flatnonzero(found >= 0).astype("<i4")
                steps = at.copy()
                steps[1:] -= at[:-1]
                counts.append(len(words))
                terms.append(found[at].tobytes())
                gaps.append(steps.tobytes())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("digest"),
                    pa.array(counts, pa.int64()),
                    pa.array(terms, pa.binary()),
                    pa.array(gaps, pa.binary()),
                ],
                ["doc_id", "digest", "n_words", "terms", "gaps"],
            )

    rows = docs.select(F.col("doc_id").cast("bigint"), "text", F.xxhash64("text").alias("digest"))
    return rows.mapInArrow(run, "doc_id bigint, digest bigint, n_words bigint, terms binary, gaps binary")


def _flat(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Terms of all documents of a batch, their places, and the number of terms of each document."""
    terms, gaps = (batch.column(c).to_pylist() for c in ("terms", "gaps"))
    lengths = np.array([len(t) // 4 for t in terms], dtype=np.int64)
    flat = np.frombuffer(b"".join(terms), "<i4")
    steps = np.frombuffer(b"".join(gaps), "<i4").astype(np.int64)
    ends = np.cumsum(lengths)
    total = np.cumsum(steps)
    before = np.where(ends > lengths, total[np.maximum(ends - lengths, 1) - 1], 0) if len(total) else np.zeros_like(ends)
    return flat, total - np.repeat(before, lengths), lengths


def inverse_frequencies(terms: DataFrame, size: int) -> np.ndarray:
    """Weights of terms: the logarithm of one and documents over documents with the term, counted over every document.

    No term weighs nothing: a passage that many documents hold makes its words common, and is still to be found.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, n = np.zeros(size, dtype=np.int64), 0
        for batch in batches:
            n += batch.num_rows
            for t in batch.column("terms").to_pylist():
                counts[np.unique(np.frombuffer(t, "<i4"))] += 1
        held = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(held, -1)), pa.array(np.append(counts[held], n))], ["term", "n"])

    rows = terms.select("terms").mapInArrow(run, "term bigint, n bigint").groupBy("term").agg(F.sum("n")).collect()
    counts, n = np.zeros(size), 0
    for term, found in rows:
        if term < 0:
            n = found
        else:
            counts[term] = found
    return np.log1p(max(n, 1) / np.maximum(counts, 1))


def gram_times(terms: DataFrame, weights: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """A'(A basis) for the TF-IDF matrix A of all passages, rows of unit length.

    A task adds up its passages and gives one row per ``TERMS_PER_ROW`` words that it met; rows of the same words are added
    up in turn, streaming.
    """
    size, width = basis.shape

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size, width), dtype=np.float32)
        for batch in batches:
            flat, at, lengths = _flat(batch)
            used = weights[flat] > 0
            passage = (np.repeat(np.arange(len(lengths)) << 32, lengths) + at // WINDOW)[used]
            flat = flat[used]
            for lo, hi in _cuts(passage):
                start = np.zeros(hi - lo, dtype=np.int64)  # passages come in order
                np.cumsum(passage[lo + 1 : hi] != passage[lo : hi - 1], out=start[1:])
                cell, count = np.unique(start * size + flat[lo:hi], return_counts=True)
                row, term = np.divmod(cell, size)
                value = (count * weights[term]).astype(np.float32)
                first = np.searchsorted(row, np.arange(start[-1] + 1))
                value /= np.sqrt(np.add.reduceat(value * value, first))[row]
                product = np.ascontiguousarray(_added(basis, term, first, value).T)
                met, at_met = (np.arange(size), term) if size <= len(term) else np.unique(term, return_inverse=True)
                for k in range(width):
                    total[met, k] += np.bincount(at_met, value * product[k][row], len(met))
        yield from _rows(total)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, data in zip(batch.column("part").to_pylist(), batch.column("data").to_pylist(), strict=True):
                rows = np.frombuffer(data, "<f4").astype(np.float64)
                sums[part] = sums[part] + rows if part in sums else rows
        for part, rows in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([part]), pa.array([rows.tobytes()])], ["part", "data"])

    def _rows(total: np.ndarray) -> Iterator[pa.RecordBatch]:
        for part in range(0, size, TERMS_PER_ROW):
            rows = total[part : part + TERMS_PER_ROW]
            if rows.any():
                yield pa.RecordBatch.from_arrays([pa.array([part]), pa.array([rows.tobytes()])], ["part", "data"])

    basis, weights = basis.astype(np.float32), weights.astype(np.float32)
    summed = terms.select("terms", "gaps").mapInArrow(multiply, "part bigint, data binary").repartition("part")
    result = np.zeros((size, width))
    for part, data in summed.mapInArrow(add, "part bigint, data binary").collect():  # words x rank numbers in all
        rows = np.frombuffer(data, "<f8").reshape(-1, width)
        result[part : part + len(rows)] = rows
    return result


def _added(table: np.ndarray, index: np.ndarray, first: np.ndarray, factor: np.ndarray | None = None) -> np.ndarray:
    """Sums of the rows ``index`` of a table, times their factors, over short groups that begin at ``first``.

    The first rows of all groups are added, then the second ones, and so on: many times faster than ``reduceat`` by group.
    """
    lengths = np.diff(first, append=len(index))
    order = np.argsort(-lengths, kind="stable")
    starts, ascending = first[order], -lengths[order]
    total = np.zeros((len(first), table.shape[1]), dtype=table.dtype)
    for k in range(int(lengths.max(initial=0))):
        at = starts[: np.searchsorted(ascending, -k, "left")] + k
        rows = table.take(index[at], axis=0)
        if factor is not None:
            rows *= factor[at, None]
        total[: len(at)] += rows
    result = np.empty_like(total)
    result[order] = total
    return result


def _cuts(group: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of about ``CHUNK`` rows that do not split a group."""
    lo, n = 0, len(group)
    while lo < n:
        hi = min(lo + CHUNK, n)
        if hi < n:
            hi = int(np.searchsorted(group, group[hi], "left"))
            if hi <= lo:
                hi = int(np.searchsorted(group, group[lo], "right"))
        yield lo, hi
        lo = hi


def decomposition(terms: DataFrame, weights: np.ndarray, rank: int = RANK, seed: int = 42) -> tuple[np.ndarray, np.ndarray]:
    """Leading right singular vectors and singular values, from a randomised decomposition.

    The range of A'A is found with a random basis, then the problem is solved inside it (Rayleigh and Ritz).
    """
    size = len(weights)
    width = min(rank + OVERSAMPLE, size)
    random = np.random.default_rng(seed).standard_normal((size, width))
    basis, _ = np.linalg.qr(gram_times(terms, weights, random))
    small = basis.T @ gram_times(terms, weights, basis)
    values, vectors = np.linalg.eigh((small + small.T) / 2)
    top = np.argsort(-values)[:rank]
    top = top[values[top] > 1e-9 * max(values.max(), 1e-30)]
    return basis @ vectors[:, top], np.sqrt(values[top])


def latent_terms(vectors: np.ndarray, weights: np.ndarray, seed: int = 43) -> np.ndarray:
    """Words in the space of retrieval: the leading dimensions, then a projection of the rest that keeps its length.

    Cosines there are those of TF-IDF, up to the projection's error.
    """
    random = np.random.default_rng(seed).standard_normal((len(weights), SKETCH)) / np.sqrt(SKETCH)
    parts = [vectors, random - vectors @ (vectors.T @ random)]
    return (weights[:, None] * np.concatenate(parts, axis=1)).astype(np.float32)


def _unit(rows: np.ndarray) -> np.ndarray:
    norm = np.sqrt((rows * rows).sum(axis=1, keepdims=True))
    return rows / np.where(norm > 0, norm, 1)


def common_subsequence(masks: dict[int, int], length: int, words: list[int]) -> int:
    """Length of the longest common subsequence; masks give the places of each word in the item as bits."""
    rest = all_ = (1 << length) - 1
    for word in words:
        if mask := masks.get(word):
            both = rest & mask
            rest = ((rest + both) | (rest - both)) & all_
    return length - rest.bit_count()


@dataclass
class Ragged:
    """Lists of words of any lengths, one after another."""

    flat: np.ndarray
    starts: np.ndarray
    lengths: np.ndarray

    @classmethod
    def of(cls, lists: list) -> "Ragged":
        lengths = np.array([len(x) for x in lists], dtype=np.int64)
        flat = np.fromiter(chain.from_iterable(lists), np.int64, int(lengths.sum()))
        return cls(flat, np.cumsum(lengths) - lengths, lengths)

    def column(self, rows: np.ndarray, at: int | np.ndarray) -> np.ndarray:
        """The words at a place of each list, which must be long enough."""
        return self.flat[self.starts[rows] + at]


def verbatim(flat: np.ndarray, place: np.ndarray, runs: Ragged, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Run and first place of every verbatim copy: each run is tried where its rarest word stands."""
    pieces = np.split(runs.flat, runs.starts[1:])
    offsets = np.array([int(np.argmax(weights[piece])) for piece in pieces])
    lengths = runs.lengths
    anchors = runs.column(np.arange(len(lengths)), offsets)
    by_anchor = np.argsort(anchors, kind="stable")
    first = np.searchsorted(anchors[by_anchor], np.arange(len(weights) + 1))
    tries = np.diff(first)
    at = np.flatnonzero(tries[flat] > 0)
    hits: list[tuple[np.ndarray, np.ndarray]] = []
    for k in range(0, len(at), CHUNK):
        here = at[k : k + CHUNK]
        n = tries[flat[here]]
        step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        run = by_anchor[np.repeat(first[flat[here]], n) + step]
        start = np.repeat(here, n) - offsets[run]
        inside = (start >= 0) & (start + lengths[run] <= len(flat))
        run, start = run[inside], start[inside]
        inside = place[start + lengths[run] - 1] - place[start] == lengths[run] - 1
        run, start, j = run[inside], start[inside], 0
        while len(run):
            whole = lengths[run] == j
            hits.append((run[whole], place[start[whole]]))
            run, start = run[~whole], start[~whole]
            same = flat[start + j] == runs.column(run, j)
            run, start, j = run[same], start[same], j + 1
    none = np.empty(0, dtype=np.int64)
    return tuple(np.concatenate(x) for x in zip((none, none), *hits, strict=True))


def leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    least_cosine: float = LEAST_COSINE,
    least_lcs: float = LEAST_LCS,
    least_answer: float = LEAST_ANSWER,
    block_items: int = BLOCK_ITEMS,
) -> DataFrame:
    """Documents that hold benchmark items: doc_id, digest, item_id, cosine, lcs, answer, first_word, last_word.

    One row per document row and item, for its best place: cosine of the best passage, share of the item's words in common
    order, share of the answer's words (those after a last question mark or "answer:", else the rarest third) that are
    there, and the range of words searched. From ``SURE_LCS`` of the item's words or of its question's on, the answer is not
    asked for; nor is it where the question alone stands verbatim. Items shorter than ``SHORT_ITEM`` words count verbatim
    only; so do such questions, and they need ``least_answer`` of the answer's words around them unless their own words
    are rare (``RARE_SHARE``). Questions below ``LEAST_QUESTION`` words are not looked for by themselves.
    Null and empty texts, in either table, match nothing. Repeated rows and repeated items give a row each; a null doc_id
    or item_id stays null. Empty tables give no rows. Other columns are not read. Benchmarks of more than ``block_items``
    items are searched block by block, each against every document.
    """
    spark = docs.sparkSession
    numbered = benchmark.select(F.col("item_id").cast("bigint"), "text")
    n = numbered.count()
    blocks = max(1, -(-n // block_items))
    parts = []
    for block in range(blocks):
        own = numbered.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block)
        rows = sorted(((r[0], r[1]) for r in own.collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
        if (items := items_of(rows)).ids:
            parts.append(_block_leaks(docs, items, least_cosine, least_lcs, least_answer))
    if not parts:
        return spark.createDataFrame([], OUTPUT)
    result = parts[0]
    for part in parts[1:]:
        result = result.union(part)
    return result


OUTPUT = (
    "doc_id bigint, digest bigint, item_id bigint, cosine double, lcs double, answer double, "
    "first_word bigint, last_word bigint"
)


def _block_leaks(docs: DataFrame, items: Items, least_cosine: float, least_lcs: float, least_answer: float) -> DataFrame:
    size = len(items.vocabulary)
    terms = stored(encoded_terms(docs, items.vocabulary), "terms")
    weights = inverse_frequencies(terms, size)
    latent = latent_terms(decomposition(terms, weights)[0], weights)
    sums = [latent[items.texts[i][a:b]].sum(axis=0) for i, a, b in items.segments]
    segments = _unit(np.stack(sums)) if sums else np.zeros((0, latent.shape[1]), dtype=np.float32)
    of_segment = items.segments[:, 0]
    answers = [set(a) or _rarest(t, weights) for a, t in zip(items.answers, items.texts, strict=True)]
    masks: list[dict[int, int]] = []
    for text in items.texts:
        mask: dict[int, int] = {}
        for place, term in enumerate(text):
            mask[term] = mask.get(term, 0) | 1 << place
        masks.append(mask)
    ids, texts, questions = items.ids, items.texts, np.array(items.questions)
    n_runs = len(texts)
    runs_of = np.append(np.arange(n_runs), np.flatnonzero(questions))  # every item, then every question
    runs = Ragged.of(texts + [texts[i][: questions[i]] for i in runs_of[n_runs:]])
    by_chance = [-np.log(np.expm1(weights[texts[i][: questions[i]]])).sum() for i in runs_of[n_runs:]]
    alone = (questions[runs_of[n_runs:]] >= SHORT_ITEM) | (np.array(by_chance) <= np.log(RARE_SHARE))
    kind_of_run = np.append(np.full(n_runs, WHOLE), np.where(alone, WHOLE, ASKED)).astype(np.int8)
    held, asked = Ragged.of(texts), Ragged.of([sorted(a) for a in answers])
    lengths_of = held.lengths
    rows_at_once = max(64, CELLS // max(1, len(segments)))

    def candidates(flat: np.ndarray, place: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
        """Item, first place of the window and cosine of every near window; place is document << 32 | word."""
        if not len(segments):
            return
        stride = (place >> 32 << 32) + (place & 0xFFFFFFFF) // STRIDE
        for lo, hi in _cuts(stride >> 32):
            key, first = np.unique(stride[lo:hi], return_index=True)
            ends = np.append(first, hi - lo)
            windows = np.empty((len(key), latent.shape[1]), dtype=np.float32)
            for a in range(0, len(key), STRIDES):
                b = min(a + STRIDES, len(key))
                windows[a:b] = _added(latent, flat[lo + ends[a] : lo + ends[b]], first[a:b] - first[a])
            # A window is a stride and the next one of the same document; one without words of the items adds nothing.
            follows = np.flatnonzero(key[1:] == key[:-1] + 1)
            windows[follows] += windows[follows + 1].copy()
            windows = _unit(windows)
            begin = (key >> 32 << 32) + (key & 0xFFFFFFFF) * STRIDE
            for w in range(0, len(windows), rows_at_once):
                cosine = windows[w : w + rows_at_once] @ segments.T
                i, j = np.nonzero(cosine >= least_cosine)
                yield of_segment[j], begin[w + i], cosine[i, j]

    def present(
        words: Ragged, item: np.ndarray, first: np.ndarray, last: np.ndarray, sorted_terms: np.ndarray, limit: np.ndarray
    ) -> np.ndarray:
        """How many of each item's first ``limit`` words stand between two places; sorted_terms is term << 32 | rank of place."""
        total = np.zeros(len(item), dtype=np.int64)
        rows = np.flatnonzero(limit > 0)
        for k in count(0, COLUMNS):
            rows = rows[limit[rows] > k]
            if not len(rows):
                return total
            at = k + np.arange(COLUMNS)
            inside = at < limit[rows, None]
            wanted = words.flat[np.minimum(words.starts[item[rows], None] + at, len(words.flat) - 1)] << 32
            low = wanted + first[rows, None]
            found = sorted_terms[np.minimum(np.searchsorted(sorted_terms, low), len(sorted_terms) - 1)]
            total[rows] += (inside & (found >= low) & (found < wanted + last[rows, None])).sum(axis=1)

    def answered(item: np.ndarray, first: np.ndarray, last: np.ndarray, sorted_terms: np.ndarray) -> np.ndarray:
        return present(asked, item, first, last, sorted_terms, asked.lengths[item]) / asked.lengths[item]

    def accepted(item: int, lcs: float, answer: float, words: list[int]) -> bool:
        if lengths_of[item] < SHORT_ITEM:
            return False
        if lcs >= max(SURE_LCS, least_lcs) or (lcs >= least_lcs and answer >= least_answer):
            return True
        n = int(questions[item])
        if n < SHORT_ITEM:  # a question so short must stand verbatim
            return False
        own = {term: m & ((1 << n) - 1) for term, m in masks[item].items()}
        return common_subsequence(own, n, words) >= SURE_LCS * n

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([(c.split()[0], pa.float64() if c.endswith("double") else pa.int64()) for c in OUTPUT.split(", ")])
        for batch in batches:
            flat, at, lengths = _flat(batch)
            place = (np.repeat(np.arange(len(lengths)), lengths) << 32) + at
            sorted_terms = np.sort((flat.astype(np.int64) << 32) + np.arange(len(flat)))
            best: dict[tuple[int, int], tuple] = {}
            run_of, begun = verbatim(flat, place, runs, weights)
            _, once = np.unique(np.stack([begun >> 32, run_of]), axis=1, return_index=True)
            copies = (runs_of[run_of[once]], begun[once], np.ones(len(once), dtype=np.float32), kind_of_run[run_of[once]])
            for item, begin, cosine, kinds in chain([copies], ((*c, None) for c in candidates(flat, place))):
                for k in range(0, len(item), PAIRS):
                    near, start, score = item[k : k + PAIRS], begin[k : k + PAIRS], cosine[k : k + PAIRS]
                    kind = np.full(len(near), NEAR, np.int8) if kinds is None else kinds[k : k + PAIRS]
                    # The item may stand around the window: look its length further, within the document.
                    doc, length = start >> 32 << 32, lengths_of[near]
                    first = np.searchsorted(place, np.maximum(start - length, doc))
                    last = np.searchsorted(place, np.minimum(start + WINDOW + length, doc + 0xFFFFFFFF))
                    # No more words can be in common order than are there.
                    room = last - first
                    tried = np.flatnonzero((kind == NEAR) & (room >= least_lcs * np.minimum(length, _or_more(questions[near]))))
                    likely = kind != NEAR
                    there = present(held, near[tried], first[tried], last[tried], sorted_terms, length[tried])
                    likely[tried] = there >= least_lcs * length[tried]
                    some = tried[~likely[tried] & (questions[near[tried]] >= SHORT_ITEM)]
                    there = present(held, near[some], first[some], last[some], sorted_terms, questions[near[some]])
                    likely[some] = there >= SURE_LCS * questions[near[some]]
                    likely = np.flatnonzero(likely)
                    near, score, doc, length, first, last, kind = (x[likely] for x in (near, score, doc, length, first, last, kind))
                    there = answered(near, first, last, sorted_terms)
                    for c in range(len(near)):
                        key = (int(doc[c] >> 32), int(near[c]))
                        if key in best and best[key][1] == 1 and best[key][0] >= score[c]:
                            continue
                        words = flat[first[c] : last[c]].tolist()
                        lcs = common_subsequence(masks[near[c]], int(length[c]), words) / int(length[c])
                        sure = kind[c] == WHOLE or (kind[c] == ASKED and there[c] >= least_answer)
                        if not (sure or accepted(int(near[c]), lcs, float(there[c]), words)):
                            continue
                        found = (float(score[c]), lcs, float(there[c]), int(at[first[c]]), int(at[last[c] - 1]))
                        if key not in best or (*found[1:3], found[0]) > (*best[key][1:3], best[key][0]):
                            best[key] = found
            keys = batch.select(["doc_id", "digest"]).to_pylist()
            rows = [
                (keys[d]["doc_id"], keys[d]["digest"], ids[item], *found)
                for (d, item), found in best.items()
            ]
            columns = zip(*rows, strict=True) if rows else [[]] * len(schema)
            arrays = [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, schema=schema)

    return terms.select("doc_id", "digest", "terms", "gaps").mapInArrow(run, OUTPUT)


def _or_more(questions: np.ndarray) -> np.ndarray:
    """Lengths of the questions that paraphrases are looked for; where there is none, longer than any item."""
    return np.where(questions >= SHORT_ITEM, questions, np.iinfo(np.int64).max)


def _rarest(text: list[int], weights: np.ndarray) -> set[int]:
    words = sorted(set(text), key=lambda t: (-weights[t], t))
    return set(words[: max(1, len(words) // 3)])


def decontaminated(docs: DataFrame, benchmark: DataFrame, **how) -> DataFrame:
    """The documents without leaks, all columns as they are; a document that holds an item goes, with all its copies."""
    doc, text = unused(docs, "_doc", "_text")
    found = leaks(docs, benchmark, **how).select(F.col("doc_id").alias(doc), F.col("digest").alias(text)).distinct()
    same = F.col("doc_id").cast("bigint").eqNullSafe(F.col(doc)) & (F.xxhash64("text") == F.col(text))
    return docs.join(stored(found, "leaks"), same, "left_anti")
