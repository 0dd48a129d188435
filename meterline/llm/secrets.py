"""Secret scans: rules as regular expressions behind an index of trigrams.

From each rule's expression a Boolean query is derived: one of several sets of
trigrams, each of which a match must contain in full. The postings of these
trigrams tell which documents hold which of them; intersecting them gives the
documents that a rule has to look at. A rule whose expression forces no
trigram looks at every document. Everything is a DataFrame operation.

Defined results: a null or empty text has no spans; rows with equal ids are
scanned one by one, rows without an id too; spans of different kinds may
overlap; an empty table gives an empty table; columns of the documents other
than the two named are left behind.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterline.llm.spans import places

#: A derived query with more alternatives than this is given up, and its rule scans everything.
MOST_ALTERNATIVES = 64


@dataclass(frozen=True)
class Rule:
    """A kind of secret. ``least`` is the fewest characters that ``group`` may have."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1
    base: bool = False


RULES = (
    Rule("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6, True),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20, True),
    Rule("hex", r"[0-9a-f]{24,}", 0, 24, True),  # the same runs as of any length cut to 24 and more, without a match per letter
    Rule("private_key", r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]+", 0, 40),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]+", 0, 15),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+"),
    Rule("bearer", r"(?i)bearer\x20{1,4}([A-Za-z0-9._~+/=-]+)", 1, 16),
    Rule("url_password", r"[a-z][a-z0-9+.-]{1,20}://[^\s/:@]{1,200}:[^\s/@]{1,200}@"),
)

#: Between the lines of a key: white space, marks of quotations, line ends as a string literal has them.
_BETWEEN = r"""(?:[\s"',>]|\\[nrt])*+"""
#: What follows the first line of a private key: all up to its last line, or without that (the next dashes are
#: of something else) the headers and base64 lines there are, the last of which may be short.
KEY_BODY = (
    r"(?:(?:[^-]|-(?!----))*+-----END [A-Z ]{0,40}PRIVATE KEY-----"
    rf"|(?:{_BETWEEN}(?:Proc-Type|DEK-Info):[^\r\n\\]*+)*+(?:{_BETWEEN}[A-Za-z0-9+/=]{{16,}}+)*+"
    r"""(?:["']?+[\x20\t]*+(?:\r?\n|(?:\\r)?\\n)[\x20\t"'>]*+[A-Za-z0-9+/=]{1,15}+(?=["',]*+[\x20\t]*+(?:[\r\n\\]|$)))?+)"""
)

#: By kind, what is taken out of texts where the rule that finds the place takes less: the body of a key, a long user or password.
WHOLE = {
    "private_key": r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----" + KEY_BODY,
    "url_password": r"[a-z][a-z0-9+.-]{1,20}://[^\s/:@]++:[^\s/@]++@",
}
#: The rules of the scan (which its SQL shares) for redaction.
WHOLE_RULES = tuple(replace(rule, pattern=WHOLE.get(rule.kind, rule.pattern)) for rule in RULES)


def trigram_query(pattern: str) -> list[frozenset[str]] | None:
    """The alternatives of trigrams, in lower case, one of which every match contains; None if there is no such query."""
    alternatives = [tuple(filter(None, runs)) for runs in _runs(list(re._parser.parse(pattern)))]
    grams = {frozenset(run[k : k + 3].lower() for run in runs for k in range(len(run) - 2)) for runs in alternatives}
    if frozenset() in grams or len(grams) > MOST_ALTERNATIVES:
        return None
    return sorted((g for g in grams if not any(h < g for h in grams)), key=sorted)


def _runs(parsed: list) -> list[tuple[str, ...]]:
    """Alternatives, each a sequence of literal runs between which anything may stand."""
    found: list[tuple[str, ...]] = [("",)]
    for kind, value in parsed:
        name = str(kind)
        if name == "LITERAL":
            step = [(chr(value),)]
        elif name == "IN" and all(str(k) == "LITERAL" for k, _ in value) and len(value) <= 5:
            step = [(chr(c),) for _, c in value]
        elif name == "SUBPATTERN":
            step = _runs(list(value[-1]))
        elif name == "BRANCH":
            step = [runs for branch in value[1] for runs in _runs(list(branch))]
        elif name == "MAX_REPEAT" and value[:2] == (0, 1):
            step = [("",), *_runs(list(value[2]))]
        elif name == "MAX_REPEAT" and value[0] == value[1] == 1:
            step = _runs(list(value[2]))
        elif name == "MAX_REPEAT" and value[0] >= 1:
            step = [(*runs, "", "") if len(runs) > 1 or runs != ("",) else ("", "") for runs in _runs(list(value[2]))]
            step = [(*(r for r in runs), "") for runs in step]
        else:
            step = [("", "")]
        found = [(*a[:-1], a[-1] + b[0], *b[1:]) for a in found for b in step]
        if len(found) > MOST_ALTERNATIVES:
            return [("",)]
    return found


def postings(docs: DataFrame, grams: list[str]) -> DataFrame:
    """``gram`` and the key of each document that holds it, letters in either case."""
    lower = F.lower("text")
    held = F.filter(F.array(*(F.when(lower.contains(g), F.lit(g)) for g in grams)), lambda g: g.isNotNull())
    return docs.select("doc_id", "text_hash", F.explode(held).alias("gram"))


def candidates(docs: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """Keys of documents with the ``rules`` whose query they satisfy; rules without a query are not listed."""
    spark = docs.sparkSession
    queries = {rule.kind: trigram_query(rule.pattern) for rule in rules}
    terms = [(kind, n, gram, len(grams)) for kind, query in queries.items() for n, grams in enumerate(query or []) for gram in grams]
    index = postings(docs, sorted({t[2] for t in terms}))
    wanted = spark.createDataFrame(terms, "kind string, alternative int, gram string, needed int")
    met = index.join(F.broadcast(wanted), "gram").groupBy("doc_id", "text_hash", "kind", "alternative", "needed")  # a row per gram of a rule
    met = met.agg(F.count_distinct("gram").alias("grams")).where("grams = needed")
    return met.groupBy("doc_id", "text_hash").agg(F.collect_set("kind").alias("rules"))


def scan(
    docs: DataFrame, rules: tuple[Rule, ...] = RULES, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()
) -> DataFrame:
    """``doc_id``, ``text`` (empty for null) and ``spans``, an array of kind, start, end, base and the rule's place in the list.

    The columns of ``keep`` come along as the struct ``kept``.
    """
    kept = F.struct(*(docs[name] for name in keep)).alias("kept") if keep else F.lit(None).alias("kept")
    text_of = F.coalesce(docs[text_col], F.lit("")).alias("text")
    keyed = docs.select(docs[id_col].alias("doc_id"), text_of, kept).withColumn("text_hash", F.xxhash64("text"))
    hits = candidates(keyed, rules).withColumnsRenamed({"doc_id": "hit_id", "text_hash": "hit_hash"})
    looked = keyed.join(hits, F.col("doc_id").eqNullSafe(F.col("hit_id")) & (F.col("text_hash") == F.col("hit_hash")), "left")
    text, none = F.col("text"), F.array().cast("array<struct<kind: string, start: int, end: int, base: boolean, place: int>>")

    def of(place: int, rule: Rule) -> Column:
        matches = F.filter(places(text, rule.pattern, rule.group), lambda s: F.length(s["inner"]) >= rule.least)
        spans = F.transform(
            matches,
            lambda s: F.struct(F.lit(rule.kind).alias("kind"), s["start"], s["end"], F.lit(rule.base).alias("base"), F.lit(place).alias("place")),
        )
        if trigram_query(rule.pattern) is None:
            return spans
        return F.when(F.array_contains("rules", rule.kind), spans).otherwise(none)

    columns = ["doc_id", "text", *(["kept"] if keep else [])]
    return looked.select(*columns, reduce(F.concat, (of(k, r) for k, r in enumerate(rules)), none).alias("spans"))


def redact(text: Column, spans: Column, mark: str = "[SECRET]") -> Column:
    """The text with every span, or run of overlapping spans, replaced by ``mark``."""
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"], s["end"])))

    def add(so_far: Column, span: Column) -> Column:
        fresh = span["start"] >= so_far["at"]
        part = F.concat(F.substring(text, so_far["at"] + 1, span["start"] - so_far["at"]), F.lit(mark))
        kept = F.when(fresh, F.concat(so_far["parts"], F.array(part))).otherwise(so_far["parts"])
        return F.struct(F.greatest(so_far["at"], span["end"]).alias("at"), kept.alias("parts"))

    first = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("parts"))
    done = F.aggregate(ordered, first, add, lambda x: F.concat(F.array_join(x["parts"], ""), F.substring(text, x["at"] + 1, F.length(text))))
    return F.when(F.size(spans) > 0, done).otherwise(text)
