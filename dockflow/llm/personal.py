"""Personal data by weak supervision: labelers vote on candidate spans, their reliabilities are estimated, a classifier decides.

Base patterns give spans that always count. More candidates (names, national ids, bank accounts, addresses, dates of
birth, local phone numbers) only count if the classifier says so. Every candidate gets the votes of six labelers: format,
checksum, gazetteer, cue words before it, cue words against it, and its borders. Votes of the whole corpus are counted by
pattern; expectation-maximisation on the counts estimates how reliable each labeler is for each kind (Dawid and Skene),
and the posterior of a pattern is the label with which a logistic regression over votes, length and the word before is
trained. All that passes the driver are the counts by kind and pattern of votes, of which there are at most 3^6 a kind.
"""

import hashlib
import re
import string
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dockflow.llm.common import stored

# Kinds in the order in which spans are listed; the first four are the base.
KINDS = ("email", "ip", "card", "phone", "name", "ssn", "iban", "address", "birth", "local")
BASE_KINDS = 4
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
LOCAL = string.ascii_letters + string.digits + "._%+-"  # what may stand before the @
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")  # a match inside a run of digits is one from its first digit
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

# More candidates: kind, a string that the text must hold (or None), pattern.
MORE = (
    ("name", ("Mr", "Mrs", "Ms", "Dr", "Prof", "name is", "Name:"), re.compile(r"(?:\b(?:Mr|Mrs|Ms|Dr|Prof)\.? |[Nn]ame(?: is|:) )([A-Z][a-z]+(?: [A-Z][a-z]+){0,2})")),
    ("ssn", None, re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")),
    ("iban", None, re.compile(r"\b[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?\b")),
    ("address", ("Street", "Avenue", "Road", "Lane", "Straße", "straße", "Calle", "Rue", "rue ", "calle "), re.compile(r"\b[0-9]{1,5} (?:[A-Z][a-z]+ ){1,3}(?:Street|Avenue|Road|Lane)\b|\b(?:Calle|Rue|rue|calle) (?:de )?(?:la )?[A-Z]\w+,? [0-9]{1,4}\b|\b[A-Z]\w*straße [0-9]{1,4}\b")),
    ("birth", ("born", "Born", "birth", "Birth"), re.compile(r"(?:[Bb]orn(?: on)?|[Bb]irth:?|[Bb]irthday:?) ([0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{1,2}[./][0-9]{1,2}[./][0-9]{2,4})")),
    ("local", None, re.compile(r"\([0-9]{3}\) ?[0-9]{3}-[0-9]{4}(?![0-9])")),
)
FROM_DIGITS = ("ssn", "iban", "local")

# Gazetteers: lists that the third labeler looks up.
TOP_DOMAINS = frozenset("com org net edu gov mil int info biz io co uk de fr es it nl eu us ca au ch at be se no dk".split())
FIRST_NAMES = frozenset("James Mary John Linda Robert Susan Michael Anna David Sarah Maria Carlos Juan Ana Hans Peter Karl Julia Pierre Marie Jean Sophie Paul Laura Thomas Emma".split())
COUNTRY_CODES = ("1", "20", "27", "30", "31", "32", "33", "34", "36", "39", "40", "41", "43", "44", "45", "46", "47", "48", "49", "52", "55", "61", "81", "82", "86", "91")
CARD_STARTS = ("34", "37", "4", "51", "52", "53", "54", "55", "60", "62", "65")
IBAN_LENGTHS = {"DE": 22, "FR": 27, "ES": 24, "GB": 22, "IT": 27, "NL": 18, "BE": 16, "CH": 21, "AT": 20, "PT": 25}
CUES = {
    "email": ("mail", "email", "contact", "write", "reach"),
    "ip": ("ip", "address", "host", "server", "from", "client"),
    "card": ("card", "visa", "mastercard", "credit", "payment"),
    "phone": ("phone", "tel", "call", "mobile", "fax", "contact"),
    "name": ("name", "mr", "mrs", "ms", "dr", "prof"),
    "ssn": ("ssn", "social", "security"),
    "iban": ("iban", "account", "bank"),
    "address": ("address", "lives", "at", "street"),
    "birth": ("born", "birth", "birthday", "dob"),
    "local": ("phone", "tel", "call", "mobile", "fax"),
}
AGAINST = frozenset("version v isbn issn example sample order serial sku part model figure table page chapter".split())
LABELERS = 6
LENGTHS, WORDS = 8, 64
WORD_BEFORE = re.compile(r"[^\W_]+")


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2]))
    return (total + sum(int(d) * 2 - 9 * (d > "4") for d in digits[-2::-2])) % 10 == 0


def _base(text: str) -> dict[str, list[tuple[int, int]]]:
    """Leftmost non-overlapping matches of each base kind that pass its test."""
    emails, end = [], 0
    if "@" in text:
        for m in DOMAIN.finditer(text):
            start = _local_start(text, end, m.start())
            if start < m.start():
                emails.append((start, end := m.end()))
    ips = [m.span() for m in IP.finditer(text) if all(_small(p) for p in m[0].split("."))]
    cards = []
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 13:
            digits = m[0].replace(" ", "").replace("-", "")
            if 13 <= len(digits) <= 19 and luhn(digits):
                cards.append(m.span())
    phones = []
    if "+" in text:
        phones = [m.span() for m in PHONE.finditer(text) if 9 <= sum(c.isdigit() for c in m[0]) <= 15]
    return {"email": emails, "ip": ips, "card": cards, "phone": phones}


def _local_start(text: str, least: int, at: int) -> int:
    """Where the run of mail characters before ``at`` begins, not before ``least``: one step a character of the run."""
    start, width = at, 64
    while start > least:
        piece = text[max(least, start - width) : start]
        left = len(piece.rstrip(LOCAL))
        start -= len(piece) - left
        if left:
            break
        width *= 2
    return start


def _small(part: str) -> bool:
    return len(part.lstrip("0")) <= 3 and int(part[-3:]) <= 255


def _more(text: str, taken: list[tuple[int, int]]) -> Iterator[tuple[str, int, int]]:
    """Further candidates that touch no base span; of two that overlap the first kind has its way."""
    starts, ends = _merged(taken)
    digits = any(d in text for d in "0123456789")
    for kind, needs, pattern in MORE:
        if (needs and not any(n in text for n in needs)) or (kind in FROM_DIGITS and not digits):
            continue
        own = []
        for m in pattern.finditer(text):
            start, end = m.span(m.lastindex or 0)
            before = bisect_left(starts, end) - 1  # the last taken span that begins before this one ends
            if before < 0 or ends[before] <= start:
                own.append((start, end))
                yield kind, start, end
        if own:
            starts, ends = _merged([*zip(starts, ends, strict=True), *own])


def _merged(spans: list[tuple[int, int]]) -> tuple[list[int], list[int]]:
    """Starts and ends of the stretches that the spans cover, in order."""
    starts, ends = [], []
    for start, end in sorted(spans):
        if ends and start <= ends[-1]:
            ends[-1] = max(ends[-1], end)
        else:
            starts.append(start)
            ends.append(end)
    return starts, ends


def _strict(kind: str, found: str) -> int:
    if kind == "email":
        return 1 if re.fullmatch(r"[A-Za-z0-9][A-Za-z0-9._%+-]*@(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,}", found) else -1
    if kind == "ip":
        return 1 if re.fullmatch(r"(?:0|[1-9][0-9]{0,2})(?:\.(?:0|[1-9][0-9]{0,2})){3}", found) else -1
    if kind == "card":
        return 1 if re.fullmatch(r"[0-9]{13,19}|[0-9]{4}(?:([ -])[0-9]{4}(?:\1[0-9]{4}){2})", found) else -1
    if kind == "phone":
        return 1 if re.fullmatch(r"\+[0-9]{1,3}[ .-]?(?:\([0-9]{1,4}\)[ .-]?)?[0-9]+(?:[ .-][0-9]+)*", found) else -1
    if kind == "name":
        return 1 if " " in found else 0
    return 1


def _checksum(kind: str, found: str) -> int:
    if kind == "card":
        return 1 if found.replace(" ", "").replace("-", "")[0] in "3456" else -1
    if kind == "ip":
        return -1 if found.split(".")[0] in ("0", "127", "255") else 1
    if kind == "ssn":
        return -1 if found[:3] in ("000", "666") or found[0] == "9" or found[4:6] == "00" else 1
    if kind == "iban":
        bare = found.replace(" ", "")
        number = "".join(str(int(c, 36)) for c in bare[4:] + bare[:4])
        return 1 if int(number) % 97 == 1 else -1
    if kind in ("phone", "local"):
        digits = re.sub(r"\D", "", found)
        return -1 if len(set(digits)) <= 2 else 1
    return 0


def _gazetteer(kind: str, found: str) -> int:
    if kind == "email":
        return 1 if found.rpartition(".")[2].lower() in TOP_DOMAINS else -1
    if kind == "card":
        return 1 if found.replace(" ", "").startswith(CARD_STARTS) else -1
    if kind == "phone":
        return 1 if found[1:].startswith(COUNTRY_CODES) else -1
    if kind == "name":
        return 1 if found.split(" ")[0] in FIRST_NAMES else 0
    if kind == "iban":
        return 1 if IBAN_LENGTHS.get(found[:2]) == len(found.replace(" ", "")) else -1
    return 0


def _candidate(text: str, kind: str, start: int, end: int) -> tuple[list[int], int, int]:
    """Votes (1 for, -1 against, 0 none), the bucket of the length, and of the word before."""
    found = text[start:end]
    before = [w.lower() for w in WORD_BEFORE.findall(text, max(0, start - 60), start)][-5:]
    votes = [
        _strict(kind, found),
        _checksum(kind, found),
        _gazetteer(kind, found),
        1 if any(w in CUES[kind] for w in before) else 0,
        -1 if any(w in AGAINST for w in before) else 0,
        1 if not (text[start - 1 : start].isalnum() or text[end : end + 1].isalnum()) else -1,
    ]
    word = int.from_bytes(hashlib.blake2b((before[-1] if before else "").encode(), digest_size=4).digest(), "big")
    return votes, min(LENGTHS - 1, (end - start) // 5), word % WORDS


FOUND = "struct<kind: int, start: bigint, end: bigint, votes: array<int>, len: int, word: int>"
COLUMNS = "doc_id bigint, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_sha256 string"


def candidates(docs: DataFrame) -> DataFrame:
    """Base counts and digest of every document, and its candidates by kind as listed, then start."""
    schema = f"{COLUMNS}, found array<{FOUND}>"
    item = pa.struct([("kind", pa.int32()), ("start", pa.int64()), ("end", pa.int64()), ("votes", pa.list_(pa.int32())), ("len", pa.int32()), ("word", pa.int32())])

    def one(text: str) -> tuple:
        base = _base(text)
        spans = [(kind, s, e) for kind in KINDS[:BASE_KINDS] for s, e in base[kind]]
        digest = hashlib.sha256(",".join(f"{k}:{s}:{e}" for k, s, e in spans).encode()).hexdigest()
        more = sorted(_more(text, [(s, e) for _, s, e in spans]), key=lambda c: (KINDS.index(c[0]), c[1]))
        found = []
        for kind, s, e in [*spans, *more]:
            votes, length, word = _candidate(text, kind, s, e)
            found.append({"kind": KINDS.index(kind), "start": s, "end": e, "votes": votes, "len": length, "word": word})
        return [len(base[k]) for k in KINDS[:BASE_KINDS]], digest, found

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [one(text or "") for text in batch.column("text").to_pylist()]
            counts = [pa.array([r[0][i] for r in rows], pa.int64()) for i in range(BASE_KINDS)]
            found = pa.array([r[2] for r in rows], pa.list_(item))
            names = [c.split()[0] for c in COLUMNS.split(", ")]
            arrays = [batch.column("doc_id"), *counts, pa.array([r[1] for r in rows], pa.string()), found]
            yield pa.RecordBatch.from_arrays(arrays, [*names, "found"])

    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(run, schema)


def reliabilities(votes: np.ndarray, counts: np.ndarray, rounds: int = 50) -> tuple[np.ndarray, np.ndarray]:
    """Posterior of each pattern of votes, and the labelers' tables P(vote | truth), by expectation-maximisation."""
    posterior = 1 / (1 + np.exp(-votes.sum(axis=1).astype(float)))
    tables = np.full((2, votes.shape[1], 3), 1 / 3)
    for _ in range(rounds):
        weight = np.stack([counts * (1 - posterior), counts * posterior])
        for y in (0, 1):
            for v in (-1, 0, 1):
                # A labeler is taken to be better than chance: a prior count for the vote that agrees.
                prior = 1.0 + (v == 2 * y - 1)
                tables[y, :, v + 1] = (weight[y][:, None] * (votes == v)).sum(axis=0) + prior
        tables /= tables.sum(axis=2, keepdims=True)
        share = (weight.sum(axis=1) + 1) / (counts.sum() + 2)
        logs = [np.log(share[y]) + np.log(tables[y][np.arange(votes.shape[1]), votes + 1]).sum(axis=1) for y in (0, 1)]
        after = 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -500, 500)))
        if np.abs(after - posterior).max() < 1e-6:
            return after, tables
        posterior = after
    return posterior, tables


def label_model(found: DataFrame) -> dict[tuple[int, ...], float]:
    """Posterior of every (kind, votes) that occurs, from their counts over the whole corpus."""
    rows = found.groupBy("kind", "votes").count().collect()  # at most 3^6 patterns a kind
    result = {}
    for kind in range(len(KINDS)):
        own = sorted((tuple(r["votes"]), r["count"]) for r in rows if r["kind"] == kind)
        if own:
            posterior, _ = reliabilities(np.array([v for v, _ in own]), np.array([float(n) for _, n in own]))
            result.update({(kind, *v): float(p) for (v, _), p in zip(own, posterior, strict=True)})
    return result


def _features(x: str) -> str:
    """One number per feature of a candidate: kind, votes for and against, length, word before."""
    kinds, lengths, words = len(KINDS), LENGTHS, WORDS
    return f"""concat(
        transform(sequence(0, {kinds - 1}), i -> CAST({x}.kind = i AS DOUBLE)),
        transform({x}.votes, v -> CAST(v = 1 AS DOUBLE)), transform({x}.votes, v -> CAST(v = -1 AS DOUBLE)),
        transform(sequence(0, {lengths - 1}), i -> CAST({x}.len = i AS DOUBLE)),
        transform(sequence(0, {words - 1}), i -> CAST({x}.word = i AS DOUBLE)))"""


def train(found: DataFrame) -> tuple[list[float], float]:
    """Weights and intercept of the span classifier; (0, 0) where there is no candidate.

    Equal candidates are counted first, so the regression sees each combination of features once with a weight.
    """
    posterior = label_model(found)
    if not posterior:
        return [0.0] * (len(KINDS) + 2 * LABELERS + LENGTHS + WORDS), 0.0
    spark = found.sparkSession
    labels = spark.createDataFrame(
        [(k[0], list(k[1:]), p) for k, p in posterior.items()], "kind int, votes array<int>, p double"
    )
    combined = found.groupBy("kind", "votes", "len", "word").count().join(labels, ["kind", "votes"])
    rows = combined.select(
        F.expr("inline(array(struct(1.0D AS label, count * p AS weight), struct(0.0D AS label, count * (1 - p) AS weight)))"),
        F.struct("kind", "votes", "len", "word").alias("x"),
    )
    rows = stored(rows.select("label", "weight", F.expr(_features("x")).alias("numbers")), "training")
    rows = rows.select("label", "weight", array_to_vector("numbers").alias("features"))
    model = LogisticRegression(weightCol="weight", regParam=0.001, maxIter=30, standardization=False).fit(rows)
    return [float(w) for w in model.coefficients], float(model.intercept)


def _probability(weights: list[float], intercept: float) -> Column:
    """found with the classifier's probability in each span, as an expression over its few features."""
    at, parts = 0, []
    for n in (len(KINDS), LABELERS, LABELERS, LENGTHS, WORDS):
        parts.append("array(" + ",".join(f"{w!r}D" for w in weights[at : at + n]) + ")")
        at += n
    kind, plus, minus, length, word = parts
    logit = f"""{intercept!r}D + {kind}[x.kind] + {length}[x.len] + {word}[x.word]
        + aggregate(zip_with(x.votes, {plus}, (v, w) -> IF(v = 1, w, 0D)), 0D, (a, w) -> a + w)
        + aggregate(zip_with(x.votes, {minus}, (v, w) -> IF(v = -1, w, 0D)), 0D, (a, w) -> a + w)"""
    return F.expr(f"transform(found, x -> struct(x.kind AS kind, x.start AS start, x.end AS end, 1 / (1 + exp(-({logit}))) AS p))")


def personal_data(docs: DataFrame, threshold: float = 0.5) -> DataFrame:
    """One row per document: base counts and digest, all spans kept, their mean probability, and doubtful base spans.

    spans lists every base span and the further candidates that the classifier gives at least ``threshold``, by kind as
    listed, then start. A null text is empty: zero counts, the digest of the empty string, no spans, a null probability.
    A very long text is one row of one task; its search takes time in proportion to its length, its spans n log n.
    Repeated rows keep a row each, a null doc_id stays null, an empty table gives no rows, other columns are not read.
    """
    table = stored(candidates(docs), "spans")
    weights, intercept = train(table.select(F.inline("found")))
    scored = table.withColumn("scored", _probability(weights, intercept))
    names = "array(" + ",".join(f"'{k}'" for k in KINDS) + ")"
    kept = f"filter(scored, s -> s.kind < {BASE_KINDS} OR s.p >= {threshold}D)"
    return scored.withColumn("kept", F.expr(kept)).select(
        *[c.split()[0] for c in COLUMNS.split(", ")],
        F.expr(f"array_join(transform(kept, s -> concat_ws(':', {names}[s.kind], s.start, s.end)), ',')").alias("spans"),
        F.expr("CAST(size(kept) AS BIGINT)").alias("n_spans"),
        F.expr(f"CAST(size(filter(kept, s -> s.p < {threshold}D)) AS BIGINT)").alias("n_doubtful"),
        F.expr("CASE WHEN size(kept) > 0 THEN aggregate(kept, 0D, (a, s) -> a + s.p) / size(kept) END").alias("mean_probability"),
    )
