"""Secret scan with corpus-wide ownership: how many owners and repositories hold the same credential.

Candidates come from regular expressions inside Spark. ``split`` and ``regexp_extract_all`` with one pattern give the
text between the matches and the matches themselves, whose lengths are the places. A value that many owners hold is an
example copied around; one that a single owner holds and that looks random is reported as live.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dockflow.llm.common import stored

ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""

# A key block ends with its END line, or else where its base64 lines end. A run of five dashes ends the first form.
PEM_LINE = r"-----(?:BEGIN|END) [A-Z ]*PRIVATE KEY-----"
PEM = (
    r"-----BEGIN [A-Z ]*PRIVATE KEY-----(?:[^-]*+(?:-{1,4}[^-]++)*+-----END [A-Z ]*PRIVATE KEY-----"
    r"|(?:\s*+[A-Za-z0-9+/=]{16,}+)*+(?:\s*+[A-Za-z0-9+/]{1,15}={1,2})?+)"
)
PEM_NOISE = r"\\[nrt]|[^A-Za-z0-9+/=]"  # what may stand between the characters of a key: line ends, also escaped, and quotes

# Fixed values, in the order in which kinds are listed: kind, pattern, group of the value, its least length, a gate.
# The first three are the base. A run of at least 32 (or 16) characters of a class is a run that long of `+`.
KINDS = (
    ("assign", ASSIGN, 2, 8, None),
    ("access", r"AKIA[A-Z0-9]{12,}", 0, 16, "AKIA"),
    ("hex", r"[0-9a-f]{32,}", 0, 32, None),
    ("github", r"gh[pousr]_[A-Za-z0-9]{36,}", 0, 40, "gh"),
    ("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}", 0, 15, "xox"),
    ("google", r"AIza[0-9A-Za-z_-]{35}", 0, 39, "AIza"),
    ("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", 0, 30, "eyJ"),
    ("pem", PEM, 0, 27, "PRIVATE KEY"),
    ("url", r"(?:\G|(?<![a-z0-9+]))[a-z0-9+]{2,}+://[A-Za-z0-9._~-]++:[A-Za-z0-9._~!-]{3,}+@[A-Za-z0-9.-]+", 0, 12, "://"),
)
BASE_KINDS = 3

SPREAD_OWNERS = 3  # this many owners: an example that is copied around
SPREAD_REPOSITORIES = 5
LIVE_CHARACTERS = 8  # a live value has at least so many different characters


def _places(matches: str, pieces: str, order: int) -> Column:
    """Structs (start, order, end, value) of the matches; places in code points, end exclusive."""
    kind, pattern, group, least, _ = KINDS[order]
    none = "CAST(array() AS array<struct<start: bigint, ord: int, end: bigint, value: string>>)"
    value = f"regexp_extract(x.m, {_sql(pattern)}, {group})" if group else "x.m"
    if kind == "pem":  # the key itself without white space; a header without a key stands for itself
        body = f"regexp_replace(regexp_replace(x.m, {_sql(PEM_LINE)}, ''), {_sql(PEM_NOISE)}, '')"
        value = f"CASE WHEN length({body}) >= {least} THEN {body} ELSE regexp_extract(x.m, {_sql(PEM_LINE)}, 0) END"
    steps = f"zip_with(slice({pieces}, 1, size({matches})), {matches}, (p, m) -> CAST(length(p) + length(m) AS BIGINT))"
    # Prefix sums by doubling: every round adds what stands 2^r places before, so n matches cost n log n steps.
    ends = f"""aggregate(sequence(0, CAST(ceil(log2(size({matches}))) AS INT)), {steps},
        (sums, r) -> transform(sums, (x, i) -> x + IF(i >= shiftleft(1, r), get(sums, i - shiftleft(1, r)), 0L)))"""
    placed = f"""zip_with({matches}, {ends}, (m, e) -> struct(m AS m, e AS e))"""
    fold = f"""transform({placed}, x -> struct(x.e - length(x.m) AS start, {order} AS ord, x.e AS end, {value} AS value))"""
    found = f"filter({fold}, s -> length(s.value) >= {least})"
    return F.expr(f"CASE WHEN size({matches}) > 0 THEN {found} ELSE {none} END")


def _sql(pattern: str) -> str:
    return "r'" + pattern.replace("'", "\\x27") + "'"


def candidates(docs: DataFrame, owner: str, repository: str) -> DataFrame:
    """(row, doc_id, owner, repository, found): found lists (start, ord, end, hash) by start, then kind as listed."""
    text = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col("doc_id").cast("bigint"),
        F.col(owner).cast("string").alias("owner"),
        F.col(repository).cast("string").alias("repository"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    matched = text.select(
        "*",
        *[
            F.expr(
                f"regexp_extract_all(text, {_sql(pattern)}, 0)"
                if gate is None
                else f"CASE WHEN contains(text, '{gate}') THEN regexp_extract_all(text, {_sql(pattern)}, 0) ELSE array() END"
            ).alias(f"m{i}")
            for i, (_, pattern, _, _, gate) in enumerate(KINDS)
        ],
    )
    between = matched.select(
        "row",
        "doc_id",
        "owner",
        "repository",
        *[f"m{i}" for i in range(len(KINDS))],
        *[
            F.expr(f"CASE WHEN size(m{i}) > 0 THEN split(text, {_sql(kind[1])}, -1) END").alias(f"p{i}")
            for i, kind in enumerate(KINDS)
        ],
    )
    placed = F.array_sort(F.concat(*[_places(f"m{i}", f"p{i}", i) for i in range(len(KINDS))]))
    hashed = F.transform(
        placed,
        lambda s: F.struct(
            s["start"].alias("start"),
            s["ord"].alias("ord"),
            s["end"].alias("end"),
            F.sha2(s["value"], 256).alias("hash"),
            F.size(F.array_distinct(F.split(s["value"], ""))).alias("letters"),
        ),
    )
    return between.select("row", "doc_id", "owner", "repository", hashed.alias("found"))


def ownership(found: DataFrame) -> DataFrame:
    """(hash, owners, repositories, uses) of every candidate: pre-counted per owner and repository before each shuffle."""
    each = found.select("owner", "repository", F.explode("found.hash").alias("hash"))
    repositories = each.groupBy("hash", "owner", "repository").agg(F.count("*").alias("uses"))
    owners = repositories.groupBy("hash", "owner").agg(F.count("*").alias("repositories"), F.sum("uses").alias("uses"))
    return owners.groupBy("hash").agg(
        F.count("*").alias("owners"), F.sum("repositories").alias("repositories"), F.sum("uses").alias("uses")
    )


def _listed(spans: str) -> Column:
    names = "array(" + ", ".join(f"'{kind[0]}'" for kind in KINDS) + ")"
    return F.expr(f"array_join(transform({spans}, s -> concat_ws(':', {names}[s.ord], s.start, s.end)), ',')")


def secret_scan(
    docs: DataFrame,
    owner: str = "source",
    repository: str = "lang",
    spread_owners: int = SPREAD_OWNERS,
    spread_repositories: int = SPREAD_REPOSITORIES,
) -> DataFrame:
    """One row per document: base counts and digest, all spans, and how many of them look live or copied around.

    A repository is a value of ``repository`` within an owner; null is an owner or repository of its own. A null or empty
    text has no spans: zero counts, the digest of the empty string, empty lists. A very long text is one row of one task:
    n matches in it cost n log n steps. Repeated rows keep a row each and count as one owner. A null doc_id stays null, an empty table gives no rows, other columns are not read.
    """
    found = stored(candidates(docs, owner, repository), "candidates")
    counts = ownership(found)
    spread = (F.col("owners") >= spread_owners) | (F.col("repositories") >= spread_repositories)
    own = (F.col("owners") == 1) & (F.col("letters") >= LIVE_CHARACTERS)
    each = found.select("row", F.explode("found").alias("s")).select("row", "s.*")
    judged = (
        each.join(counts, "hash")
        .withColumn("verdict", F.when(spread, "example").when(own, "live").otherwise("shared"))
        .groupBy("row")
        .agg(
            F.count_if(F.col("verdict") == "live").alias("n_live"),
            F.count_if(F.col("verdict") == "example").alias("n_example"),
            F.max("owners").alias("most_owners"),
        )
    )
    described = found.select(
        "row",
        "doc_id",
        *[
            F.expr(f"CAST(size(filter(found, s -> s.ord = {i})) AS BIGINT)").alias(f"n_{KINDS[i][0]}")
            for i in range(BASE_KINDS)
        ],
        F.sha2(_listed(f"filter(found, s -> s.ord < {BASE_KINDS})"), 256).alias("base_sha256"),
        _listed("found").alias("spans"),
    )
    zero = [F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in ("n_live", "n_example", "most_owners")]
    kept = [c for c in described.columns if c != "row"]
    return described.join(judged, "row", "left").select(*kept, *zero)
