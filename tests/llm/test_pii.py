"""Personal data against the plain definition; the estimated reliabilities against known ones."""

import hashlib
import random
import re

from meterline.llm.pii import BASE, LABELERS, Votes, detect, posterior, reliabilities
from meterline.llm.queries_pii import op6_pii

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    return sum(d if k % 2 == 0 else d * 2 - 9 * (d > 4) for k, d in enumerate(map(int, reversed(digits)))) % 10 == 0


def passes(kind, found):
    digits = re.sub("[^0-9]", "", found)
    if kind == "ip":
        return all(int(p) <= 255 for p in found.split("."))
    if kind == "card":
        return 16 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 8 <= len(digits) <= 15


def brute(text):
    return [(k, m.start(), m.end()) for k in BASE for m in re.finditer(PLAIN[k], text or "") if passes(k, m[0])]


PIECES = ["4111 1111 1111 1111", "4111111111111112", "a@b.co", "x.y+z@d-e.fr.com", "@", ".", "12", "1.2.3.4", "300.1.1.1", "007.8.9.0001", "+1 (415) 555-0100", "+", "-", " ", "é", "\U0001f600", "call ", "(212) 555-0199", "078-05-1120", "joe (at) site (dot) org", "5"]


def test_base_spans_equal_the_definition(spark):
    rng = random.Random(4)
    rows = [(1, None), (2, ""), (None, "a@b.com"), (3, "9" * 60000), (4, "a" * 60000 + "@"), (5, "1 " * 30000), (6, "+1" + "-" * 40000), (7, "a@b.c_d@e.f"), (7, "a@b.c_d@e.f")]
    rows += [(k, "".join(rng.choice(PIECES) for _ in range(rng.randrange(25)))) for k in range(10, 260)]
    docs = spark.createDataFrame([(i, t, "c", 1) for i, t in rows], "doc_id long, text string, spans string, kind int")
    key = lambda x: (str(x[0]), x[1])
    got = detect(docs).collect()
    have = sorted(((r.doc_id, [(s.kind, s.start, s.end) for s in sorted(r.spans, key=lambda s: (s.place, s.start)) if s.base]) for r in got), key=key)
    assert have == sorted(((i, brute(t)) for i, t in rows), key=key)
    for r in got:
        base = [s for s in r.spans if s.base]
        assert not any(s.start < b.end and b.start < s.end for s in r.spans if not s.base for b in base)


def test_reliabilities_are_recovered():
    rng = random.Random(9)
    good, bad = (0.95, 0.7, 0.6, 0.9, 0.85), (0.1, 0.4, 0.3, 0.5, 0.2)
    counts = {}
    for _ in range(30000):
        right = rng.random() < 0.4
        votes = tuple(-1 if rng.random() < 0.2 else int(rng.random() < (good if right else bad)[j]) for j in range(len(LABELERS)))
        counts[votes] = counts.get(votes, 0) + 1
    seen = [Votes("x", v, n) for v, n in counts.items()]
    prior, rates = reliabilities(seen, 200)
    assert abs(prior["x"] - 0.4) < 0.03
    assert all(abs(a - g) < 0.05 and abs(b - w) < 0.05 for (a, b), g, w in zip(rates, good, bad))
    assert posterior(Votes("x", (1, 1, 1, 1, 1), 1), prior, rates) > 0.95 > 0.05 > posterior(Votes("x", (0, 0, 0, 0, 0), 1), prior, rates)


def test_empty_table(spark):
    assert detect(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_query(spark):
    folder = "/root/testdata/sf0.01"
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    found = 0
    for r in op6_pii(spark, folder).collect():
        want = brute(docs[r.doc_id])
        joined = ",".join(f"{k}:{s}:{e}" for k, s, e in want)
        found += len(want)
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert not want or set(joined.split(",")) <= set(r.spans.split(","))
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == x[0] for x in want) for k in BASE]
    assert found > 10
