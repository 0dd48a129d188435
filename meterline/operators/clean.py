"""Row cleaning: duplicates, keep rules, quarantine.

Rules look at one row only, so filtering before removing duplicates gives the
same rows and shuffles fewer of them.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterline.functions.rules import Rules, all_hold, broken_rules, holds
from meterline.operators.joins import fits_broadcast
from meterline.session import scratch_path


#: Holds the names of the rules that a row breaks.
BROKEN = "_broken"


def keep_rows(df: DataFrame, rules: Rules) -> DataFrame:
    return df.filter(reduce(lambda kept, rule: kept & rule, rules.values())) if rules else df


def drop_copies(df: DataFrame) -> DataFrame:
    """Whole-row distinct. Map tasks drop their own copies before the shuffle,
    so a large group of copies reaches it as one row per task. A column naming
    the file makes this a per-file distinct."""
    return df.dropDuplicates()


def row_digest(columns: Sequence[str]) -> Column:
    """64 bits that equal rows share. NULLs count by their place."""
    bits = [F.when(F.col(c).isNull(), F.lit(1 << i % 31)).otherwise(F.lit(0)) for i, c in enumerate(columns)]
    missing = (reduce(Column.bitwiseOR, bits[k : k + 31]) for k in range(0, len(bits), 31))
    return F.xxhash64(*missing, *columns)


def split_by_copies(df: DataFrame, digest: Column | None = None, max_digests: int = 1_000_000) -> tuple[DataFrame, DataFrame] | None:
    """(rows whose digest no other row has, the rest), or None if more than ``max_digests`` digests are repeated.

    What is shuffled is a digest per row; they are counted at once, when this is called.
    """
    marked = df.withColumn("_digest", row_digest(df.columns) if digest is None else digest)
    counted = marked.groupBy("_digest").count().filter("count > 1").select("_digest")
    path = scratch_path(df.sparkSession, "digests")
    counted.write.parquet(path)  # measured and used twice, counted once
    repeated = df.sparkSession.read.schema(counted.schema).parquet(path)
    if not fits_broadcast(repeated, max_digests):
        return None
    some = F.broadcast(repeated)
    return tuple(marked.join(some, "_digest", how).select(*df.columns) for how in ("left_anti", "left_semi"))


def drop_copies_by_digest(df: DataFrame, digest: Column | None = None, max_digests: int = 1_000_000) -> DataFrame:
    """Whole-row distinct that shuffles 8 bytes a row instead of the row.

    Digests are counted first. A row whose digest no other has goes straight
    through; only the rows of repeated digests are shuffled, and compared as
    whole rows, so that unlike rows of one digest all stay. The input is read
    three times, which pays where copies are few and rows are wide; the digests are
    counted at once, when this is called. More than
    ``max_digests`` repeated digests are not broadcast: then this is
    :func:`drop_copies`.
    """
    sides = split_by_copies(df, digest, max_digests)
    if sides is None:
        return drop_copies(df)
    alone, copied = sides
    return alone.unionByName(drop_copies(copied))


def clean(df: DataFrame, rules: Rules, dropped: tuple[str, ...] = ()) -> DataFrame:
    return drop_copies(keep_rows(df, rules)).drop(*dropped)


def mark_rows(df: DataFrame, rules: Rules, column: str = BROKEN) -> DataFrame:
    """The distinct rows, each with the names of the rules it breaks: none means accepted."""
    return drop_copies_by_digest(df).withColumn(column, broken_rules(rules))


def quarantine_split(df: DataFrame, rules: Rules, column: str = "broken") -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected): together exactly the distinct input rows.

    Rejected rows carry the names of the rules they break.
    """
    rejected = drop_copies(df.filter(~all_hold(rules)))
    return drop_copies(keep_rows(df, rules)), rejected.withColumn(column, broken_rules(rules))


def reject_report(df: DataFrame, rules: Rules) -> DataFrame:
    """Distinct rows per broken rule; a row that breaks two rules counts in both."""
    rejected = drop_copies(df.filter(~all_hold(rules)))
    per_rule = rejected.agg(*(F.count_if(~holds(rule)).alias(name) for name, rule in rules.items()))
    return per_rule.unpivot([], list(rules), "rule", "rejected_rows")
