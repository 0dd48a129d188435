"""A queue of file events, drained into distinct prefixes for compaction.

Arrivals, leases and acknowledgements are segments of one versioned table, so
each step is one atomic publication. What is pending is a matter of pairs
(prefix, arrival batch): those that no acknowledgement covers and no live lease
holds. A batch that is announced again replaces itself; a run that dies between
drain and acknowledgement leaves its lease to expire, and what it held comes
back; a run that starts again under its name gets what it held before.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterline.plans.maintenance import compact
from meterline.sources.files import remove
from meterline.sources.versions import VersionConflict, VersionedTable

ARRIVAL, LEASE, ACK = "arrival", "lease", "ack"
#: How long a drained prefix stays hidden from other runs.
VISIBILITY = timedelta(hours=6)
DRAINS = 20


class FileQueue:
    """``by`` names the partition columns that make a prefix."""

    def __init__(self, spark: SparkSession, root: str, by: Sequence[str], visibility: timedelta = VISIBILITY):
        self.spark, self.by, self.visibility = spark, list(by), visibility
        self.table = VersionedTable(spark, root)

    # --- arrivals ---------------------------------------------------------------

    def arrive(self, batch: str, files: DataFrame, size: str = "length", changed: str = "modificationTime") -> None:
        """Announce the files of a batch; announcing it again changes nothing."""
        rows = files.groupBy(*self.by).agg(F.count("*").alias("n_files"), F.sum(size).cast("bigint").alias("n_bytes"), F.min(changed).cast("timestamp").alias("oldest"))
        self.table.publish([self.table.write(f"{ARRIVAL}/{batch}", rows.withColumn("batch", F.lit(batch)), ARRIVAL)])

    def _side(self, side: str, number: int) -> DataFrame | None:
        version = self.table.version(number)
        return self.table.read(side, number) if any(s.rows.get(side) for s in version.segments) else None

    def pending(self, now: datetime | None = None, number: int | None = None) -> DataFrame:
        """A row per prefix and batch that nobody has done or is doing."""
        number = self.table.version().number if number is None else number
        now = now or datetime.now(timezone.utc)
        arrivals = self._side(ARRIVAL, number)
        if arrivals is None:
            kinds = ", ".join(f"{c} string" for c in self.by)
            return self.spark.createDataFrame([], f"{kinds}, n_files bigint, n_bytes bigint, oldest timestamp, batch string")
        pairs = arrivals.select(*self.by, "n_files", "n_bytes", "oldest", "batch")
        leases, acks = self._side(LEASE, number), self._side(ACK, number)
        for taken in (acks, None if leases is None else leases.filter(F.col("leased_at") > F.lit(now - self.visibility))):
            if taken is not None:
                held = taken.select(*(F.col(c).alias(f"_{c}") for c in (*self.by, "batch")))
                pairs = pairs.join(held, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in (*self.by, "batch")], "left_anti")
        return pairs

    def waiting(self, now: datetime | None = None, number: int | None = None) -> DataFrame:
        """What the gate reads: per prefix the files and bytes that wait, and the oldest one's time."""
        return self.pending(now, number).groupBy(*self.by).agg(F.sum("n_files").alias("n_files"), F.sum("n_bytes").alias("n_bytes"), F.min("oldest").alias("oldest"))

    # --- drain and acknowledgement ------------------------------------------------

    def drain(self, run: str, now: datetime | None = None, min_files: int = 1, max_age: timedelta | None = None) -> DataFrame:
        """Lease the prefixes that are due to this run, each once however many files touched it.

        Due are prefixes with enough files, or whose oldest file has waited too long.
        """
        now = now or datetime.now(timezone.utc)
        name = f"{LEASE}/{run}"
        for _ in range(DRAINS):
            version = self.table.version()
            if name in version.names():
                return self._leased(run)
            due = F.col("n_files") >= min_files
            if max_age is not None:
                due = due | (F.col("oldest") <= F.lit(now - max_age))
            chosen = self.waiting(now, version.number).filter(due).select(*(F.col(c).alias(f"_{c}") for c in self.by))
            same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in self.by]
            rows = self.pending(now, version.number).join(chosen, same, "left_semi")
            lease = self.table.write(name, rows.withColumns({"run": F.lit(run), "leased_at": F.lit(now)}), LEASE)
            if not lease.rows[LEASE]:
                remove(self.spark, self.table.segment_path(lease.id))
                return self._leased(run)
            try:
                self.table.publish([lease], after=version.number)
                return self._leased(run)
            except VersionConflict:  # somebody else drained or announced meanwhile: look again
                remove(self.spark, self.table.segment_path(lease.id))
        raise VersionConflict(f"{run}: overtaken {DRAINS} times")

    def _lease_rows(self, run: str) -> DataFrame | None:
        leases = self._side(LEASE, self.table.version().number)
        return None if leases is None else leases.filter(F.col("run") == run)

    def _leased(self, run: str) -> DataFrame:
        rows = self._lease_rows(run)
        if rows is None:
            return self.waiting().limit(0)
        return rows.groupBy(*self.by).agg(F.sum("n_files").alias("n_files"), F.sum("n_bytes").alias("n_bytes"), F.min("oldest").alias("oldest"))

    def acknowledge(self, run: str, done: DataFrame) -> None:
        """The run has dealt with the prefixes in ``done``; what else it held is free again at once."""
        rows = self._lease_rows(run)
        if rows is None:
            return
        finished = done.select(*(F.col(c).alias(f"_{c}") for c in self.by)).distinct()
        acked = rows.join(finished, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in self.by], "left_semi").select(*self.by, "batch")
        self.table.publish([self.table.write(f"{ACK}/{run}", acked, ACK)], drop=[f"{LEASE}/{run}"])

    def release(self, run: str) -> None:
        self.table.publish(drop=[f"{LEASE}/{run}"])

    def tidy(self) -> None:
        """Take out arrival batches that are wholly acknowledged, and acknowledgements that cover nothing else."""
        version = self.table.version()
        arrivals, acks = self._side(ARRIVAL, version.number), self._side(ACK, version.number)
        if arrivals is None or acks is None:
            return
        open_batches = {r["batch"] for r in self.pending(datetime.max.replace(tzinfo=timezone.utc), version.number).select("batch").distinct().collect()}
        gone = [s.name for s in version.segments if s.name.startswith(f"{ARRIVAL}/") and s.name.partition("/")[2] not in open_batches]
        left = acks.filter(~F.col("batch").isin(*(n.partition("/")[2] for n in gone))) if gone else acks
        old = [s.name for s in version.segments if s.name.startswith(f"{ACK}/")]
        self.table.publish([self.table.write(f"{ACK}/before-{version.number}", left, ACK)], drop=[*gone, *old], after=version.number)


def compact_due(
    queue: FileQueue, root: str, run: str, now: datetime | None = None, compacting: Callable[..., DataFrame] = compact, **options
) -> DataFrame:
    """Drain the queue, compact each prefix once, acknowledge what succeeded. A failed prefix comes back."""
    gate = {k: options.pop(k) for k in ("min_files", "max_age") if k in options}
    due = queue.drain(run, now, **gate)
    report = compacting(queue.spark, root, due, queue.by, **options)
    names = F.concat_ws("/", *(F.concat(F.lit(f"{c}="), F.coalesce(F.col(c).cast("string"), F.lit("__HIVE_DEFAULT_PARTITION__"))) for c in queue.by))
    done = due.withColumn("partition", names).join(report.filter("status = 'compacted'"), "partition", "left_semi")
    queue.acknowledge(run, done)
    return report
