import hashlib
import random
import re
import time

import numpy as np
import pytest

from dockflow.llm import personal
from tests.llm.frames import documents, empty


def luhn(digits):
    return sum(sum(divmod(int(d) * (1 + i % 2), 10)) for i, d in enumerate(digits[::-1])) % 10 == 0


def digits(text):
    return re.sub(r"[^0-9]", "", text)


BASE = (
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m.split("."))),
    ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 13 <= len(digits(m)) <= 19 and luhn(digits(m))),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(digits(m)) <= 15),
)


def plain(text):
    spans = [(k, m.start(), m.end()) for k, p, ok in BASE for m in re.finditer(p, text or "") if ok(m[0])]
    counts = [sum(s[0] == k for s in spans) for k, _, _ in BASE]
    return (*counts, hashlib.sha256(",".join(f"{k}:{s}:{e}" for k, s, e in spans).encode()).hexdigest())


EXTRA = [
    "a@b.c@d.e f@g h@i.j.k.@l.m %+-@x.y..z",
    "1.2.3.4.5.6.7.8 255.255.255.255 256.1.1.1 0000255.1.1.1 1.2.3 12.34.56.7890",
    "4111-1111-1111-1111 4111 1111 1111 1111 4012888888881881 37828224631000512345678 1-1-1",
    "+1 (555) 010-9999 +49.30.1234567 +1 +12 34 ++44 20 7946 0958 +1234567890123456",
    "x" * 9000 + "@mail.com",
    "My name is Anna Schmidt, born 1990-02-03, SSN 123-45-6789, 12 Oak Street, call (555) 123-4567, DE89 3704 0044 0532 0130 00",
]


@pytest.fixture(scope="module")
def scanned(spark):
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    extra = spark.createDataFrame([(100 + i, t, "en", "x", 1) for i, t in enumerate(EXTRA)], schema)
    docs = documents(spark).unionByName(extra, allowMissingColumns=True)
    return docs.collect(), personal.personal_data(docs).collect()


def test_base_agrees_with_the_plain_definition(scanned):
    texts, rows = scanned
    fields = ("n_email", "n_ip", "n_card", "n_phone", "base_sha256")
    found = sorted(((r["doc_id"], *(r[f] for f in fields)) for r in rows), key=str)
    assert found == sorted(((r["doc_id"], *plain(r["text"])) for r in texts), key=str)


def test_base_spans_stay_and_lists_are_ordered(scanned):
    texts, rows = scanned
    for r in rows:
        spans = [s.split(":") for s in r["spans"].split(",") if s]
        order = [(personal.KINDS.index(k), int(s)) for k, s, _ in spans]
        assert order == sorted(order)
        base = [s for s in spans if personal.KINDS.index(s[0]) < personal.BASE_KINDS]
        assert len(base) == r["n_email"] + r["n_ip"] + r["n_card"] + r["n_phone"]


def test_random_strings(spark):
    random = np.random.default_rng(3)
    for _ in range(3000):
        text = "".join(random.choice(list("ab.@+-( )0123456789%_"), random.integers(0, 60)))
        base = personal._base(text)
        assert [(k, *s) for k in personal.KINDS[:4] for s in base[k]] == [
            (k, m.start(), m.end()) for k, p, ok in BASE for m in re.finditer(p, text) if ok(m[0])
        ], text


def test_reliabilities_are_found():
    random = np.random.default_rng(1)
    truth = random.random(20_000) < 0.4
    skill = (0.9, 0.8, 0.6)
    votes = np.stack([np.where(random.random(20_000) < s, truth, ~truth) * 2 - 1 for s in skill], axis=1)
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    posterior, tables = personal.reliabilities(patterns, counts.astype(float))
    assert np.allclose(tables[1, :, 2], skill, atol=0.05)
    assert posterior[(patterns == 1).all(axis=1)] > 0.9 and posterior[(patterns == -1).all(axis=1)] < 0.1


def test_empty_table(spark):
    assert personal.personal_data(empty(spark)).count() == 0


def test_many_matches_and_long_runs_take_time_in_proportion():
    mails = " ".join(f"Mr Name{'x' * (i % 5)} user{i}@mail.com" for i in range(100_000))
    texts = [mails, "a" * 1_000_000 + " " + "a" * 500_000 + "@x.com", "1" * 1_000_000, "1." * 300_000, "@a.b" * 100_000]
    begun = time.perf_counter()
    found = [personal._base(t) for t in texts]
    more = list(personal._more(mails, found[0]["email"]))
    assert time.perf_counter() - begun < 20
    assert len(found[0]["email"]) == 100_000 and len(more) == 100_000
    assert found[1]["email"] == [(1_000_001, 1_500_007)]
    assert len(found[4]["email"]) == 50_000


def test_base_and_added_spans_agree_with_plain_search():
    """Random texts of awkward characters: base spans by their patterns, added ones by a search through all taken spans."""
    rng = random.Random(5)
    parts = ["a", "b.c", "@", ".", "1", "22", "+", "-", " ", "(", ")", "Mr Ann", "Name: Bob Lee", "123-45-6789", "(555) 123-4567", "DE89 3704 0044 0532", "born 1990-02-03", "12 Oak Street", "%", "é", "255.1.1.1", "4111111111111111"]
    for _ in range(3_000):
        text = "".join(rng.choices(parts, k=rng.randrange(25)))
        base = personal._base(text)
        spans = [(k, *m.span()) for k, p, ok in BASE for m in re.finditer(p, text) if ok(m[0])]
        assert [(k, s, e) for k in base for s, e in base[k]] == spans
        taken, want = [s[1:] for s in spans], []
        for kind, needs, pattern in personal.MORE:
            for m in pattern.finditer(text) if not needs or any(n in text for n in needs) else ():
                s, e = m.span(m.lastindex or 0)
                if not any(a < e and s < b for a, b in taken):
                    taken.append((s, e))
                    want.append((kind, s, e))
        assert list(personal._more(text, [s[1:] for s in spans])) == want
