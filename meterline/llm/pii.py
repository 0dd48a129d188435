"""Personal data by weak supervision.

Broad patterns propose spans. Labelers vote on each: the strict form of its
kind, a gazetteer (domains, country codes, issuers, address ranges), cue words
before it, what stands beside it, and its length. Expectation maximisation
over the counts of vote patterns estimates how far each labeler can be
trusted; its posteriors are the soft labels that the final span classifier
(log odds of a span's features, one by one) is trained on. Spans of strict
form are always kept; the classifier adds others it finds likely.

Only counts reach the driver: one row for each pattern of votes and each value
of a feature, whose numbers are fixed by the definitions below.

Defined results: a null or empty text has no spans; rows with equal ids or none
are scanned one by one; spans of strict form may overlap those of another
kind, added ones overlap no strict span; without candidates nothing is added;
columns other than the two named are left behind.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterline.llm.common import stored, texts
from meterline.llm.spans import places

# Groups that repeat are possessive, and a first part begins where its run of characters does: the
# same matches as without, in a number of steps that grows with the text's length only.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
ADDRESS = r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
PATTERNS = {
    "email": EMAIL,
    "ip": ADDRESS,
    "card": CARD,
    "phone": PHONE,
    "plain_phone": r"(?<![0-9+])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "spelled_email": r"[A-Za-z0-9._-]{1,64}\x20?[\[(](?:at|AT)[\])]\x20?[A-Za-z0-9-]{1,63}\x20?[\[(](?:dot|DOT)[\])]\x20?[A-Za-z]{2,10}",
}
BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, *(f"likely_{k}" for k in PATTERNS))
LABELERS = ("form", "gazetteer", "context", "beside", "size")
FEATURES = ("kind", *LABELERS, "before", "after", "digits")

CUES = {
    "email": "mail|contact|write|@|reply",
    "ip": "ip|host|server|address|login|client",
    "card": "card|visa|master|amex|credit|pay|iban|account",
    "phone": "tel|phone|call|fax|mobile|cell|contact",
    "plain_phone": "tel|phone|call|fax|mobile|cell|contact",
    "ssn": "ssn|social|security|tax",
    "spelled_email": "mail|contact|write|reply",
}
TOP_DOMAINS = "com|org|net|edu|gov|info|io|eu|de|fr|es|it|uk|us|ca|au|nl|ch|at|be|pt|se|no|dk|fi|pl|br|mx|jp|cn|in"
COUNTRY_CODES = "1|7|20|27|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]"


def _digits(found: Column) -> Column:
    return F.regexp_replace(found, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Of 16 to 19 digits."""
    turned = F.reverse(digits)

    def add(total: Column, k: Column) -> Column:
        d = F.substring(turned, k, F.lit(1)).cast("int") * F.when(k % 2 == 0, 2).otherwise(1)
        return total + F.when(d > 9, d - 9).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0


def strict(kind: str, found: Column) -> Column:
    """Whether a match has the full form of its kind."""
    n = F.length(_digits(found))
    if kind == "ip":
        parts = F.transform(F.split(found, r"\."), lambda p: F.regexp_replace(p, "^0+(?=.)", ""))
        return F.forall(parts, lambda p: F.when(F.length(p) <= 3, p.cast("int") <= 255).otherwise(False))
    if kind == "card":
        return F.when(n.between(16, 19), _luhn(_digits(found))).otherwise(False)
    if kind == "phone":
        return n.between(8, 15)
    return F.lit(kind in ("email", "ssn"))


def _gazetteer(kind: str, found: Column) -> Column:
    if kind in ("email", "spelled_email"):
        return found.rlike(rf"(?i)[^A-Za-z](?:{TOP_DOMAINS})$")
    if kind == "ip":
        return ~found.rlike(r"^(?:0|127|22[4-9]|2[3-5][0-9])\.")
    if kind == "card":
        return found.rlike("^[3-6]")
    if kind == "phone":
        return found.rlike(rf"^\+(?:{COUNTRY_CODES})")
    if kind == "ssn":
        return ~found.rlike("^(?:000|666|9)")
    return found.rlike(r"^\(?[2-9]")


def _size(kind: str, found: Column) -> Column:
    n = F.length(_digits(found))
    if kind in ("email", "spelled_email"):
        return F.length(found).between(6, 80)
    if kind == "ip":
        return F.length(found).between(7, 15)
    return n == 16 if kind == "card" else n.between(10, 12) if kind == "phone" else n.between(9, 10)


def _class(char: Column) -> Column:
    return (
        F.when(char == "", "edge").when(char.rlike("[0-9]"), "digit").when(char.rlike(r"\p{L}"), "letter").when(char.rlike(r"\s"), "space").otherwise("mark")
    )


CANDIDATE = "struct<kind: string, start: int, end: int, base: boolean, form: int, gazetteer: int, context: int, beside: int, size: int, before: string, after: string, digits: string>"


def candidates(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``spans``: all that the patterns propose, with their votes (1, 0, or -1 for none) and features."""
    text = F.col("text")

    def of(kind: str, pattern: str) -> Column:
        def span(s: Column) -> Column:
            found = s["found"]
            form = strict(kind, found)
            cued = F.substring(text, F.greatest(F.lit(1), s["start"] - 39), F.least(s["start"], F.lit(40))).rlike(f"(?i){CUES[kind]}")
            before = F.when(s["start"] > 0, F.substring(text, s["start"], F.lit(1))).otherwise("")
            after = F.substring(text, s["end"] + 1, F.lit(1))
            alone = ~F.concat(before, F.lit(" "), after).rlike("[A-Za-z0-9]")
            return F.struct(
                F.lit(kind).alias("kind"),
                s["start"],
                s["end"],
                (F.lit(kind in BASE) & form).alias("base"),
                form.cast("int").alias("form"),
                _gazetteer(kind, found).cast("int").alias("gazetteer"),
                F.when(cued, 1).otherwise(-1).alias("context"),
                alone.cast("int").alias("beside"),
                _size(kind, found).cast("int").alias("size"),
                _class(before).alias("before"),
                _class(after).alias("after"),
                F.least(F.length(_digits(found)), F.lit(20)).cast("string").alias("digits"),
            )

        return F.transform(places(text, pattern), span)

    none = F.array().cast(f"array<{CANDIDATE}>")
    spans = reduce(F.concat, (of(k, p) for k, p in PATTERNS.items()), none)
    return docs.select("doc_id", F.when(text.rlike(r"[0-9@]|[\[(](?:at|AT)[\])]"), spans).otherwise(none).alias("spans"))


@dataclass(frozen=True)
class Votes:
    """A pattern of votes on a kind of span, and how often it was seen."""

    kind: str
    votes: tuple[int, ...]
    n: int


def reliabilities(seen: list[Votes], rounds: int = 50) -> tuple[dict[str, float], list[tuple[float, float]]]:
    """By expectation maximisation: how often a kind is right; P(vote 1) of each labeler for right and for wrong spans."""
    prior = {v.kind: 0.5 for v in seen}
    rates = [(0.8, 0.3)] * len(LABELERS)
    for _ in range(rounds):
        right = [posterior(v, prior, rates) for v in seen]
        for kind in prior:
            own = [(p, v.n) for p, v in zip(right, seen) if v.kind == kind]
            prior[kind] = (1 + sum(p * n for p, n in own)) / (2 + sum(n for _, n in own))
        for j in range(len(LABELERS)):
            cast = [(p, v.n, v.votes[j]) for p, v in zip(right, seen) if v.votes[j] >= 0]
            good = (4 + sum(p * n * vote for p, n, vote in cast)) / (5 + sum(p * n for p, n, _ in cast))
            bad = (1 + sum((1 - p) * n * vote for p, n, vote in cast)) / (4 + sum((1 - p) * n for p, n, _ in cast))
            rates[j] = (good, min(bad, good))
    return prior, rates


def posterior(votes: Votes, prior: dict[str, float], rates: list[tuple[float, float]]) -> float:
    """The probability that spans with these votes are right."""
    odds = math.log(prior[votes.kind]) - math.log(1 - prior[votes.kind])
    for vote, (good, bad) in zip(votes.votes, rates):
        if vote >= 0:
            odds += math.log(good / bad) if vote else math.log((1 - good) / (1 - bad))
    return 1 / (1 + math.exp(-max(-30.0, min(30.0, odds))))


def _value(span: Column, feature: str) -> Column:
    return F.concat_ws("=", F.lit(feature), span[feature].cast("string"))


def train(found: DataFrame) -> dict[str, float]:
    """The log odds of each value of each feature, and of none (under ``""``)."""
    spans = found.select(F.explode("spans").alias("s"))
    pattern = [F.col("s")[x].alias(x) for x in ("kind", *LABELERS)]
    counted = spans.groupBy(*pattern).agg(F.count("*").alias("n")).collect()  # kinds times 3 to the number of labelers at most
    seen = [Votes(r.kind, tuple(r[x] for x in LABELERS), r.n) for r in counted]
    if not seen:
        return {"": -1.0}
    prior, rates = reliabilities(seen)
    soft = [(v.kind, *v.votes, posterior(v, prior, rates)) for v in seen]
    soft_table = found.sparkSession.createDataFrame(soft, f"kind string, {', '.join(f'{x} int' for x in LABELERS)}, right double")
    flat = spans.select("s", *pattern).join(F.broadcast(soft_table), ["kind", *LABELERS])  # a row per vote pattern
    values = flat.select("right", F.explode(F.array(F.lit(""), *(_value(F.col("s"), x) for x in FEATURES))).alias("value"))
    sums = values.groupBy("value").agg(F.sum("right").alias("good"), F.sum(1 - F.col("right")).alias("bad")).collect()  # a row per value of a feature
    total = next(r for r in sums if r.value == "")
    prior_odds = math.log((total.good + 1) / (total.bad + 1))
    return {r.value: math.log((r.good + 1) / (r.bad + 1)) - (prior_odds if r.value else 0.0) for r in sums}


def detect(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: float = 0.5) -> DataFrame:
    """``doc_id`` and ``spans``: kind, start, end, base, the kind's place in ``KINDS``, and the classifier's probability."""
    found = stored(candidates(texts(docs, id_col, text_col)), "candidates")
    odds = train(found)
    table = F.create_map(*(F.lit(x) for pair in odds.items() for x in pair))

    def judged(s: Column) -> Column:
        total = sum((F.coalesce(F.try_element_at(table, _value(s, x)), F.lit(0.0)) for x in FEATURES), F.lit(odds[""]))
        kind = F.when(s["base"], s["kind"]).otherwise(F.concat(F.lit("likely_"), s["kind"]))
        place = F.array_position(F.array(*(F.lit(k) for k in KINDS)), kind).cast("int")
        chance = 1 / (1 + F.exp(-total))
        return F.struct(kind.alias("kind"), s["start"], s["end"], s["base"], place.alias("place"), chance.alias("chance"))

    every = F.transform("spans", judged)
    known = F.filter(every, lambda s: s["base"])
    more = F.filter(every, lambda s: ~s["base"] & (s["chance"] >= least) & ~F.exists(known, lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"])))
    return found.select("doc_id", F.concat(known, more).alias("spans"))
