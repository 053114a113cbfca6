"""The two jobs: pending feeds to silver, silver to mirror; and both in a row."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from feedlake.operators.drift import WIDTH, drift_plan, drifted_ranges
from feedlake.operators.keyed import restrict
from feedlake.operators.merge import fold_snapshots, merge_dealt, merge_snapshot
from feedlake.operators.sync import DELETE, PUT, KeyedStore, push_plan, removed_rows
from feedlake.plans.silver import clean_items, is_bad, judge_items
from feedlake.schemas import KEY, OPEN_SILVER, SILVER
from feedlake.session import materialize, work_tables
from feedlake.sources.feeds import archive_feeds, file_status, list_feeds, pending_feeds, scan_feeds, scan_feeds_exact
from feedlake.sources.parts import PartTable, Synced, by_date
from feedlake.sources.sweep import KEEP, sweep_versions, sweep_work
from feedlake.sources.tables import BucketedTable, SnapshotTable, append_ledger, publish, read_ledger

PROCESSED, REJECTED, SKIPPED = "processed", "rejected", "skipped"
MIRROR_ORDER = ["start_date", "start_time", KEY]


class FeedRejected(ValueError):
    """A file holds an item that breaks a rule. Nothing of that file was applied."""


@dataclass
class Lake:
    """The tables of one deployment, all below ``root``, and how its feeds are read."""

    spark: SparkSession
    root: str
    guid_is_link: bool = True
    #: Names in the catalog that ``run`` keeps at the latest versions.
    silver_name: str | None = None
    mirror_name: str | None = None
    #: Files that silver is dealt out to by key; None: as they come.
    buckets: int | None = None
    #: Whether the mirror is kept as ``ranges`` and ``by_date``, of which a sync writes what changed.
    deltas: bool = False

    @property
    def silver(self) -> SnapshotTable:
        if self.buckets:
            return BucketedTable(self.spark, f"{self.root}/silver", SILVER, KEY, self.buckets)
        return SnapshotTable(self.spark, f"{self.root}/silver", SILVER)

    @property
    def ranges(self) -> PartTable:
        """The mirror in folders by range of the key."""
        return PartTable(self.spark, f"{self.root}/ranges", SILVER)

    @property
    def by_date(self) -> PartTable:
        """The rows of the mirror that have a date and a time, in folders by date."""
        return PartTable(self.spark, f"{self.root}/by_date", SILVER, part=by_date())

    @property
    def mirror(self) -> SnapshotTable:
        return SnapshotTable(self.spark, f"{self.root}/mirror", SILVER)

    @property
    def removed(self) -> SnapshotTable:
        """Rows that the last sync deleted; rows of a foreign store may lack any column."""
        return SnapshotTable(self.spark, f"{self.root}/removed", OPEN_SILVER)

    @property
    def ledger_path(self) -> str:
        return f"{self.root}/ledger"

    def ledger(self) -> DataFrame:
        return read_ledger(self.spark, self.ledger_path)


@dataclass(frozen=True)
class IngestReport:
    """How many files got which status, and the version of silver they made, if any."""

    processed: int = 0
    rejected: int = 0
    skipped: int = 0
    silver_version: int | None = None


@dataclass(frozen=True)
class DriftReport:
    """Ranges of keys that differed, and the rows deleted and put there."""

    n_ranges: int
    n_deleted: int
    n_put: int


@dataclass(frozen=True)
class SyncReport:
    """``n_put``: rows put, all there are or, with ``deltas``, those that were new or changed."""

    n_deleted: int
    n_put: int
    mirror_version: int | None = None


def _scan(spark: SparkSession, landing: str, pending: DataFrame, files: DataFrame, marks: bool = False) -> DataFrame:
    """Items of the given files, by the reader that each of them needs.

    Spark's readers take path names on the driver: one per snapshot, however many parts it has.
    """
    wanted = pending.join(files.select("record_source", "hidden"), "record_source")
    rows = wanted.select("hidden", F.explode("snapshots").alias("below")).distinct().collect()
    split = [row.below for row in rows if not row.hidden]
    hidden = [row.below for row in rows if row.hidden]
    if not hidden:
        return scan_feeds(spark, landing, split, marks)
    if not split:
        return scan_feeds_exact(spark, landing, hidden, marks)
    return scan_feeds(spark, landing, split, marks).unionByName(scan_feeds_exact(spark, landing, hidden, marks))


def _checked(spark: SparkSession, landing: str, pending: DataFrame, files: DataFrame) -> DataFrame:
    items = judge_items(_scan(spark, landing, pending, files, True))
    found = materialize(files.join(file_status(items, is_bad()), "record_source", "full"), "checked")
    # A file that was read under a name nobody asked for would leave another one looking empty.
    strange = found.filter("hidden is null").first()
    if strange:
        raise ValueError(f"items of {strange.record_source!r}, which is not among the files to be read")
    counts = found.na.fill(0, ["n_items", "n_bad", "n_unsound"]).na.fill(False, ["again"])
    # A file that is no whole feed, or of no bytes, counts like a bad item.
    return counts.withColumn("n_bad", F.col("n_bad") + F.col("n_unsound") + F.col("n_empty")).drop("n_unsound")


def check_feeds(spark: SparkSession, landing: str, pending: DataFrame) -> DataFrame:
    """One row per pending file: ``n_items``, ``n_bad`` and whether it has ``hidden`` items.

    One pass over all items. Files that the splitting scan cannot cut right are then read
    again by the exact reader. Files without items are in the result too. A file without the root of a feed,
    or without its end, is bad: an error page, a feed cut short, nothing at all.
    """
    names = pending.select("record_source", "state", "n_empty").withColumn("hidden", F.lit(False))
    checked = _checked(spark, landing, pending, names)
    again = checked.filter("again").select("record_source", "state", "n_empty", F.lit(True).alias("hidden"))
    done = checked.filter(~F.col("again"))
    if not again.isEmpty():
        done = done.unionByName(_checked(spark, landing, pending, again))
    return done.drop("again", "n_empty")


def feed_rows(lake: Lake, landing: str, pending: DataFrame, files: DataFrame, load_date: str) -> DataFrame:
    """Silver rows of the given files, which have been checked."""
    return clean_items(_scan(lake.spark, landing, pending, files), load_date, lake.guid_is_link).select(SILVER.names)


def changed_files(lake: Lake, files: DataFrame) -> DataFrame:
    """The names among ``files`` that were processed before: what they hold replaces their own rows."""
    before = lake.ledger().filter(F.col("status") == PROCESSED).select("record_source")
    return files.join(before, "record_source", "left_semi").select("record_source").distinct()


def _folded(lake: Lake, landing: str, pending: DataFrame, files: DataFrame, load_date: str) -> DataFrame:
    """The silver table after ``files``. All but the last are read only if one can matter."""
    last, n_files = files.agg(F.max("record_source"), F.count("*")).first()
    late = lake.silver.read().filter(F.col("record_source") >= last)
    changed = materialize(changed_files(lake, files), "changed")
    if not changed.isEmpty():
        late = late.join(changed, "record_source", "left_anti").select(late.columns)
    if late.isEmpty():
        files, n_files = files.filter(F.col("record_source") == last), 1
    batch = feed_rows(lake, landing, pending, files, load_date)
    merge = merge_dealt if lake.buckets else merge_snapshot
    return fold_snapshots(late, lake.silver.dealt(batch), last, n_files, merge=merge)


def ingest(
    lake: Lake,
    landing: str,
    load_date: str | None = None,
    strict: bool = True,
    allow_empty: bool = True,
    listing: DataFrame | None = None,
    archive: str | None = None,
    apply: Callable[[str, DataFrame, DataFrame, str], None] | None = None,
) -> IngestReport:
    """Apply the landed feeds that the ledger has not seen, in name order, to silver.

    ``strict``: stop before the first bad file, keep what came before it, and raise; that
    file stays pending. Otherwise bad files are noted as rejected and left out.
    ``allow_empty``: a feed without items empties the table, as any snapshot would; if
    false such feeds are skipped.
    ``listing``: the part of ``list_feeds`` to look at, if not all of it.
    ``archive``: folder that the files of this run are moved to once the ledger has them.
    ``apply``: what is done with good files (landing, pending, files, load date) in place of a new version of silver.

    The ledger is written last, and rows of a file that is loaded twice stay the same, so a
    run that died at any point can be repeated.
    """
    with work_tables(lake.spark):
        return _ingest(lake, landing, load_date, strict, allow_empty, listing, archive, apply)


def _ingest(
    lake: Lake, landing: str, load_date: str | None, strict: bool, allow_empty: bool, listing: DataFrame | None, archive: str | None, apply: Callable | None
) -> IngestReport:
    load_date = load_date or datetime.now(timezone.utc).isoformat()
    listing = list_feeds(lake.spark, landing) if listing is None else listing
    pending = materialize(pending_feeds(listing, lake.ledger()), "pending")
    if pending.isEmpty():
        return IngestReport()
    files = check_feeds(lake.spark, landing, pending)
    first_bad = files.filter("n_bad > 0").agg(F.min("record_source")).first()[0] if strict else None
    if first_bad:
        files = files.filter(F.col("record_source") < first_bad)
    skip = (F.col("n_items") == 0) & ~F.lit(allow_empty)
    status = F.when(F.col("n_bad") > 0, REJECTED).when(skip, SKIPPED).otherwise(PROCESSED)
    files = materialize(files.withColumn("status", status), "files")
    counts = {row.status: row["count"] for row in files.groupBy("status").count().collect()}
    version = None
    if PROCESSED in counts:
        good = files.filter(F.col("status") == PROCESSED)
        if apply:
            apply(landing, pending, good, load_date)
        else:
            version = lake.silver.write(_folded(lake, landing, pending, good, load_date))
    if counts:
        append_ledger(files.withColumn("load_date", F.lit(load_date)), lake.ledger_path)
    if archive and counts:
        used = pending.join(files, "record_source", "left_semi").select(F.explode("snapshots").alias("below"))
        archive_feeds(lake.spark, landing, [row.below for row in used.collect()], archive)
    if first_bad:
        raise FeedRejected(f"{first_bad}: bad items; stopped before it")
    return IngestReport(*[counts.get(s, 0) for s in (PROCESSED, REJECTED, SKIPPED)], version)


def sync_mirror(
    lake: Lake, open_store: Callable[[], KeyedStore] | None = None, current: DataFrame | None = None
) -> SyncReport:
    """Make the mirror (and an external store, if given) equal silver.

    ``current``: the rows that the external store really holds, with their key at least. What it
    has beyond silver is deleted, also what no run of this job has put there. Without it the mirror
    stands for the store. The delete set is written as a table first: it is counted as it is written, and
    previewed and sent from there. A lake with ``deltas`` compares, and writes and sends what changed.
    """
    with work_tables(lake.spark):
        if lake.deltas and current is None:
            return _sync_changes(lake, open_store)
        return _sync_all(lake, open_store, current)


def _as_silver(rows: DataFrame) -> DataFrame:
    """Rows by the columns of silver; those that a store does not have are NULL."""
    has = set(rows.columns)
    return rows.select(*[(F.col(f.name) if f.name in has else F.lit(None)).cast(f.dataType).alias(f.name) for f in SILVER])


def _sync_all(lake: Lake, open_store: Callable[[], KeyedStore] | None, current: DataFrame | None) -> SyncReport:
    desired = lake.silver.read()
    held = lake.ranges.read() if lake.deltas else lake.mirror.read()
    if current is not None:
        held = _as_silver(current)
    # Not under the declared schema, since a store may hold less than a whole row.
    gone, put = Observation(), Observation()
    lake.removed.write(removed_rows(held, desired), rows=gone)
    if open_store:
        plan = lake.removed.read().withColumn("op", F.lit(DELETE)).unionByName(desired.withColumn("op", F.lit(PUT)))
        push_plan(plan, open_store)
    if lake.deltas:
        _sync_parts(lake, desired, lake.ranges.changes(desired))
        return SyncReport(gone.get.get("n", 0), desired.count())
    version = lake.mirror.write(desired, cluster_by=MIRROR_ORDER, rows=put)
    return SyncReport(gone.get.get("n", 0), put.get.get("n", 0), version)


def _sync_parts(lake: Lake, desired: DataFrame, changes: DataFrame) -> Synced:
    synced = lake.ranges.sync(desired, changes)
    lake.by_date.sync(desired.filter("start_date IS NOT NULL AND start_time IS NOT NULL"))
    return synced


def _sync_changes(lake: Lake, open_store: Callable[[], KeyedStore] | None) -> SyncReport:
    desired = lake.silver.read()
    changes = lake.ranges.changes(desired)
    lake.removed.write(restrict(lake.ranges.read(), changes.filter(F.col("op") == DELETE), KEY, "left_semi"))
    if open_store:
        put = restrict(desired, changes.filter(F.col("op") == PUT), KEY, "left_semi")
        plan = lake.removed.read().withColumn("op", F.lit(DELETE)).unionByName(put.withColumn("op", F.lit(PUT)))
        push_plan(plan, open_store)
    synced = _sync_parts(lake, desired, changes)
    return SyncReport(synced.n_deleted, synced.n_put)


def mend_store(lake: Lake, open_store: Callable[[], KeyedStore], current: DataFrame, width: int = WIDTH) -> DriftReport:
    """Make an external store equal silver where it has drifted from it, and touch nothing else.

    ``current``: the rows that the store really holds. Digests of ranges of ``width`` keys are compared first; rows are
    read again, compared and sent only where these differ. Can be repeated, like a sync.
    """
    with work_tables(lake.spark):
        held, desired = _as_silver(current), lake.silver.read()
        ranges = materialize(drifted_ranges(held, desired, KEY, width), "drifted")
        # Written first: it reads the store that is about to change.
        plan = materialize(drift_plan(held, desired, ranges, KEY, width), "drift")
        counts = plan.agg(F.count_if(F.col("op") == DELETE).alias("gone"), F.count_if(F.col("op") == PUT).alias("put")).first()
        push_plan(plan, open_store)
        return DriftReport(ranges.count(), counts.gone, counts.put)


def sweep(lake: Lake, keep: timedelta = KEEP, now: datetime | None = None) -> int:
    """Remove versions beyond their retention, versions without a commit and forgotten work tables; how many went.

    ``keep``: nothing that holds a file younger than this is taken for forgotten.
    """
    now = now or datetime.now(timezone.utc)
    tables = (lake.silver, lake.mirror, lake.removed)
    gone = sum(sweep_versions(table, keep, now) for table in tables)
    return gone + sweep_work(lake.spark, keep, now)


def run(
    lake: Lake,
    landing: str,
    load_date: str | None = None,
    strict: bool = True,
    allow_empty: bool = True,
    open_store: Callable[[], KeyedStore] | None = None,
    current: DataFrame | None = None,
    archive: str | None = None,
) -> tuple[IngestReport, SyncReport]:
    """Landed feeds to silver, then silver to mirror; then the catalog names of ``lake``, and ``sweep``.

    The second starts only if the first did not raise.
    """
    report = ingest(lake, landing, load_date, strict, allow_empty, archive=archive)
    synced = sync_mirror(lake, open_store, current)
    for table, name in ((lake.silver, lake.silver_name), (lake.mirror, lake.mirror_name)):
        if name and table.version:
            publish(table, name)
    sweep(lake)
    return report, synced
