"""

Every query reads whole tables. ``events`` plays the feed: a user is a key, a day is a
snapshot file named ``events_<yyyymmdd>.xml``.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date
from importlib import import_module

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlake.functions import fields, html, text
from feedlake.operators import drift, latest, lookup, merge, retention, sync, validate
from feedlake.operators.keyed import restrict
from feedlake.plans import jobs, silver
from feedlake.schemas import PERMALINK, SILVER
from feedlake.session import materialize, work_path
from feedlake.sources import feeds, parts, tables
from feedlake.sources.folder_store import folder_store
from feedlake.sources.store import register_store
from feedlake.streaming.fold import FeedLog, fold_log
from feedlake.streaming.ingest import stream_feeds

LOAD_DATE = "2024-02-01T00:00:00+00:00"
CUT = date(2024, 1, 20)
AS_OF = date(1998, 8, 2)

FEED_FILE = "'events_'yyyyMMdd'_000000.xml'"
FEED_TIME = "EEE, dd MMM yyyy HH:mm:ss 'GMT'"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- events as rows of daily snapshots ------------------------------------------------


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    day_file = F.date_format("ts", "'events_'yyyyMMdd'.xml'").alias("f")
    return _table(spark, sf_dir, "events").select(
        "user_id", "event_id", "event_type", "value", "ts", day_file
    )


def _newest() -> list[Column]:
    return [F.col("f"), F.col("ts"), F.col("event_id")]


ROW = ["user_id", "event_id", "event_type", "value", "f"]


def _existing_and_new(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """All days but the last, and the last; the cut is on ``ts``, so it reaches the scan."""
    rows = _events(spark, sf_dir)
    last_day = F.lit(rows.agg(F.to_date(F.max("ts"))).first()[0])
    return rows.filter(F.col("ts") < last_day), rows.filter(F.col("ts") >= last_day)


def latest_per_key(spark, sf_dir):
    rows = _events(spark, sf_dir)
    return latest.latest_per_key_window(rows, "user_id", _newest()).select(ROW)


def latest_per_key_maxby(spark, sf_dir):
    rows = _events(spark, sf_dir)
    return latest.latest_per_key(rows, "user_id", _newest()).select(ROW)


def merge_snapshot(spark, sf_dir):
    existing, new = _existing_and_new(spark, sf_dir)
    return merge.merge_snapshot(existing, new, "user_id", _newest()).select(ROW)


def merge_first_run(spark, sf_dir):
    """No table yet: the merge sees the new rows only."""
    new = _events(spark, sf_dir)
    existing = tables.read_or_empty(spark, work_path(spark, "absent"), new.schema)
    return merge.merge_snapshot(existing, new, "user_id", _newest()).select(ROW)


def fold_snapshots(spark, sf_dir):
    """The days before ``CUT`` arrive late, over a table made of the days since."""
    rows = _events(spark, sf_dir)
    early, since = rows.filter(F.col("ts") < F.lit(CUT)), rows.filter(F.col("ts") >= F.lit(CUT))
    existing = latest.latest_per_key(since, "user_id", _newest())
    files = early.agg(F.max("f").alias("last"), F.countDistinct("f").alias("n")).first()
    folded = merge.fold_snapshots(
        existing, early, files["last"], files["n"], "user_id", _newest(), "f"
    )
    return folded.select(ROW)


def active_set_semi(spark, sf_dir):
    existing, new = _existing_and_new(spark, sf_dir)
    return restrict(existing, new, "user_id", "left_semi").select(ROW)


def distinct_keys(spark, sf_dir):
    return latest.distinct_keys(_events(spark, sf_dir), "user_id")


def union_existing_new(spark, sf_dir):
    existing, new = _existing_and_new(spark, sf_dir)
    return merge.union_rows(existing, new).select(ROW)


# --- mirror: current is the table before the last day, desired after it -----------------


def _current_and_desired(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    existing, new = _existing_and_new(spark, sf_dir)
    current = latest.latest_per_key(existing, "user_id", _newest()).select(ROW)
    desired = merge.merge_snapshot(existing, new, "user_id", _newest()).select(ROW)
    return current, desired


def removed_anti(spark, sf_dir):
    return sync.removed_rows(*_current_and_desired(spark, sf_dir), "user_id")


def sync_plan(spark, sf_dir):
    return sync.sync_plan(*_current_and_desired(spark, sf_dir), "user_id")


def sync_counts(spark, sf_dir):
    return sync.sync_counts(sync_plan(spark, sf_dir))


def removed_preview(spark, sf_dir):
    """Of all users, the first that have no event in the last hour."""
    rows = _events(spark, sf_dir)
    last = rows.agg(F.max("ts")).first()[0]
    desired = rows.filter(F.col("ts") >= F.lit(last) - F.expr("interval 1 hour")).select(ROW)
    current = latest.latest_per_key(rows, "user_id", _newest()).select(ROW)
    return sync.removed_preview(sync.removed_rows(current, desired, "user_id"), "user_id")


def mirror_apply(spark, sf_dir):
    current, desired = (materialize(side) for side in _current_and_desired(spark, sf_dir))
    plan = materialize(sync.sync_plan(current, desired, "user_id"))
    return sync.apply_plan(current, plan, "user_id")


def merge_bucketed(spark, sf_dir):
    """``merge_snapshot`` over a table that lies dealt out by key: only the new day is shuffled."""
    existing, new = _existing_and_new(spark, sf_dir)
    before = latest.latest_per_key(existing, "user_id", _newest())
    table = tables.BucketedTable(spark, work_path(spark, "bucketed"), before.schema, "user_id", buckets=8)
    table.write(table.dealt(before))
    return merge.merge_dealt(table.read(), table.dealt(new), "user_id", _newest()).select(ROW)


def mirror_delta(spark, sf_dir):
    """The second sync writes the folders in which a row changed."""
    current, desired = _current_and_desired(spark, sf_dir)
    table = parts.PartTable(spark, work_path(spark, "parts"), current.schema, "user_id", parts.by_range("user_id", 50))
    table.sync(current)
    table.sync(desired)
    return table.read()


def store_sync(spark, sf_dir):
    """An external store, read and written as a data source; a folder in this process plays it."""
    current, desired = _current_and_desired(spark, sf_dir)
    place = work_path(spark, "store").removeprefix("file:")
    name = f"store_{place.rpartition('-')[2]}"
    register_store(spark, name, folder_store(place, "user_id"), current.schema, "user_id", ranges=8)
    for wanted in (current, desired):
        held = spark.read.format(name).load()
        sync.sync_plan(held, wanted, "user_id").write.format(name).mode("append").save()
    return spark.read.format(name).load()


def _drifted(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    current, desired = _current_and_desired(spark, sf_dir)
    return current, desired, materialize(drift.drifted_ranges(current, desired, "user_id", 10), "drifted")


def drift_ranges(spark, sf_dir):
    return _drifted(spark, sf_dir)[2]


def drift_plan(spark, sf_dir):
    """Rows that differ only, unlike ``sync_plan``."""
    return drift.drift_plan(*_drifted(spark, sf_dir), "user_id", 10)


# --- one field at a time ----------------------------------------------------------------


def clean_title(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents")
    padded = F.concat(F.lit("\u2003\t"), F.col("text"), F.lit("\xa0\n"))
    return docs.select("doc_id", text.strip(padded).alias("title"))


def ascii_clean(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents")
    return docs.select("doc_id", text.ascii_text(F.col("text")).alias("location"))


def optional_text(spark, sf_dir):
    turns = _table(spark, sf_dir, "conversations")
    said = F.concat(F.lit(" "), F.col("text"), F.lit("\u3000"))
    host = F.when(F.col("turn") % 3 == 0, "").when(F.col("turn") % 3 == 1, " \u3000 ").otherwise(said)
    return turns.select("conv_id", "turn", text.optional_text(host).alias("host"))


def nfkc_text(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents")
    folded = html.nfkc_text(F.concat(F.lit("ﬁ①Ａ"), F.col("text")))
    return docs.select("doc_id", folded.alias("event_description"))


def guid_to_id(spark, sf_dir):
    pages = _table(spark, sf_dir, "pages")
    return pages.select("page_id", fields.id_from_guid(F.col("url")).alias("event_id"))


def record_source(spark, sf_dir):
    pages = _table(spark, sf_dir, "pages")
    return pages.select("page_id", fields.file_name(F.col("url")).alias("record_source"))


def html_class_text(spark, sf_dir):
    pages = _table(spark, sf_dir, "pages")
    return pages.select("page_id", html.class_text(F.col("html"), "ad").alias("ad_text"))


def parse_dates(spark, sf_dir):
    rows = _table(spark, sf_dir, "events")
    said = F.date_format("ts", FEED_TIME)
    return rows.select("event_id", fields.feed_date(said).alias("start_date"))


def parse_times(spark, sf_dir):
    rows = _table(spark, sf_dir, "events")
    said = F.date_format("ts", FEED_TIME)
    return rows.select("event_id", fields.feed_time(said).alias("start_time"))


def snapshot_name(spark, sf_dir):
    rows = _table(spark, sf_dir, "events")
    return rows.select("event_id", fields.snapshot_name(F.col("ts")).alias("name"))


# --- feed items made from events: every event, and one per user and day -----------------


def _items(rows: DataFrame, key: str) -> DataFrame:
    """Feed items with what a feed has to be cleaned of."""
    kind, end = F.col("event_type"), F.col("ts") + F.expr("interval 1 hour")
    said_end = (
        F.when(kind == "click", "to be announced")
        .when(kind == "view", F.date_format(end, "d MMM yyyy"))
        .otherwise(F.date_format(end, FEED_TIME))
    )
    host = F.when(kind == "signup", "").when(kind == "error", "   ")
    link = F.concat(F.lit("https://feed.example.org/e/"), F.col("event_id").cast("string"))
    description = F.concat(
        F.lit('<div class="h-event"><div class="p-name">Name</div>'),
        F.lit('<div class="p-description description"><p>'),
        kind,
        F.lit("&nbsp;</p><!-- who --><p>user <b>"),
        F.col("user_id").cast("string"),
        F.lit("</b></p></div><div>Where</div></div>"),
    )
    return rows.select(
        F.concat(F.lit("  "), kind, F.lit(" by user "), F.col("user_id").cast("string"), F.lit("\xa0"))
        .alias("title"),
        F.concat(F.lit("https://feed.example.org/event/"), F.col(key).cast("string")).alias("guid"),
        F.when(kind == "error", "").otherwise(link).alias("link"),
        host.otherwise(F.concat(F.lit("host "), kind, F.lit(" "))).alias("host"),
        F.concat(F.lit(" Räum "), F.col("props"), F.lit(" ")).alias("location"),
        F.date_format("ts", FEED_TIME).alias("start"),
        said_end.alias("end"),
        description.alias("description"),
        F.lit(None).cast("string").alias("_corrupt_record"),
        F.lit(True).alias(PERMALINK),
        F.date_format("ts", FEED_FILE).alias("record_source"),
    )


def _event_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _items(_table(spark, sf_dir, "events"), "event_id")


def _daily_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "events").withColumn("day", F.to_date("ts"))
    best = F.max_by(F.struct(*rows.columns), F.struct("ts", "event_id"))
    daily = rows.groupBy("user_id", "day").agg(best.alias("row")).select("row.*")
    return _items(daily, "user_id")


def _landed(spark: SparkSession, items: DataFrame) -> str:
    landing = work_path(spark, "landing")
    feeds.land_items(items, landing)
    return landing


def _silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.clean_items(_event_items(spark, sf_dir), LOAD_DATE).select(SILVER.names)


def _stored(spark: SparkSession, sf_dir: str) -> tables.SnapshotTable:
    table = tables.SnapshotTable(spark, work_path(spark, "silver"))
    table.write(_silver(spark, sf_dir))
    return table


def _mirror(spark: SparkSession, sf_dir: str) -> tables.SnapshotTable:
    mirror = tables.SnapshotTable(spark, work_path(spark, "mirror"))
    mirror.write(_stored(spark, sf_dir).read(), cluster_by=jobs.MIRROR_ORDER)
    return mirror


def list_pending_files(spark, sf_dir):
    landing = _landed(spark, _event_items(spark, sf_dir))
    return feeds.list_feeds(spark, landing).select("record_source").distinct()


def pending_minus_ledger(spark, sf_dir):
    """The ledger knows every day but the last."""
    items = _event_items(spark, sf_dir)
    landing = _landed(spark, items)
    listing = feeds.list_feeds(spark, landing)
    last = listing.agg(F.max("record_source")).first()[0]
    known = items.filter(F.col("record_source") < last).groupBy("record_source").agg(
        F.lit(jobs.PROCESSED).alias("status"),
        F.count("*").alias("n_items"),
        F.lit(0).cast("long").alias("n_bad"),
        F.lit(LOAD_DATE).alias("load_date"),
    )
    ledger = work_path(spark, "ledger")
    tables.append_ledger(known, ledger)
    pending = feeds.pending_feeds(listing, tables.read_ledger(spark, ledger))
    return pending.select("record_source").distinct()


def scan_feed_xml(spark, sf_dir):
    landing = _landed(spark, _event_items(spark, sf_dir))
    return feeds.scan_feeds(spark, landing).select(
        "title", "guid", "link", "host", "location", "start", "end", "description", "record_source"
    )


def scan_feed_xml_whole(spark, sf_dir):
    landing = _landed(spark, _event_items(spark, sf_dir))
    return feeds.scan_feeds_whole(spark, landing).select(
        "title", "guid", "link", "host", "location", "start", "end", "description", "record_source"
    )


def _loose_items(spark: SparkSession, sf_dir: str) -> str:
    """Landed items as feeds in the wild have them: HTML entities, a bare &, a loose end tag."""
    rows = _table(spark, sf_dir, "events")
    item = F.concat(
        F.lit("<item><title>"), F.col("event_type"), F.lit("&nbsp;&eacute; R&D &amp; more</title><guid isPermaLink='false'>"),
        F.col("event_id").cast("string"), F.lit("</guid><link>https://feed.example.org/?a=1&b="), F.col("user_id").cast("string"),
        F.lit("</link><host>&unknown; x</host><description><![CDATA[<b>a & b&nbsp;</b>]]></description></item >"),
    )
    landing = work_path(spark, "loose")
    _land_text(rows.select(item.alias("item"), F.date_format("ts", FEED_FILE).alias("record_source")), landing)
    return landing


def _land_text(lines: DataFrame, landing: str) -> None:
    """The text column of ``lines`` as it is, in a folder per ``record_source``."""
    plain = {"extension": "xml", "quote": "\u0000", "sep": "\u0001", "ignoreLeadingWhiteSpace": "false"}
    lines.write.mode("append").partitionBy("record_source").options(**plain).csv(landing)


def scan_lenient_xml(spark, sf_dir):
    found = feeds.scan_feeds(spark, _loose_items(spark, sf_dir))
    return found.select("title", "guid", "link", "host", "description", PERMALINK, "_corrupt_record", "record_source")


def scan_hidden_xml(spark, sf_dir):
    """Each item hides tags of items in CDATA and in a comment, and holds an element whose name begins like theirs."""
    rows = _table(spark, sf_dir, "events")
    item = F.concat(
        F.lit("<item><itemized>1</itemized><!-- <item> --><title>"), F.col("event_type"), F.lit("</title><guid>"), F.col("event_id").cast("string"),
        F.lit("</guid><description><![CDATA[<item>--> <!-- user "), F.col("user_id").cast("string"), F.lit(" & </item>]]></description></item>"),
    )
    landing = work_path(spark, "hidden")
    _land_text(rows.select(item.alias("item"), F.date_format("ts", FEED_FILE).alias("record_source")), landing)
    return feeds.scan_feeds_exact(spark, landing).select("title", "guid", "description", "_corrupt_record", "record_source")


def whole_feed_status(spark, sf_dir):
    """Landed feeds; by the day of the month, an error page, a feed cut short or one without items lies beside them."""
    items = _event_items(spark, sf_dir)
    landing = _landed(spark, items)
    days = _table(spark, sf_dir, "events").select(F.to_date("ts").alias("day")).distinct()
    kind = F.day("day") % 4
    extra = F.when(kind == 0, "<html><h1>502 Bad Gateway</h1></html>").when(kind == 1, "<rss><channel><item><title>cut</title></item>")
    added = days.select(extra.otherwise("<rss><channel></channel></rss>").alias("text"), F.date_format("day", FEED_FILE).alias("record_source"))
    _land_text(added, landing)
    read = silver.judge_items(feeds.scan_feeds(spark, landing, None, True))
    return feeds.file_status(read, F.col("_corrupt_record").isNotNull()).select("record_source", "n_items", "n_bad", "n_unsound")


def feed_to_silver(spark, sf_dir):
    landing = _landed(spark, _event_items(spark, sf_dir))
    return silver.feed_to_silver(feeds.scan_feeds(spark, landing), LOAD_DATE)


def scan_silver(spark, sf_dir):
    return spark.read.parquet(_stored(spark, sf_dir).path)


def scan_silver_typed(spark, sf_dir):
    return _stored(spark, sf_dir).read()


def scan_mirror(spark, sf_dir):
    return _mirror(spark, sf_dir).read()


def silver_snapshot_roundtrip(spark, sf_dir):
    """Version 2 is made out of version 1, which is read while 2 is written."""
    rows = _silver(spark, sf_dir)
    last = rows.agg(F.max("record_source")).first()[0]
    table = tables.SnapshotTable(spark, work_path(spark, "silver"))
    table.write(rows.filter(F.col("record_source") < last))
    table.write(merge.merge_snapshot(table.read(), rows))
    return table.read()


def events_on_date(spark, sf_dir):
    rows = lookup.events_on_date(_mirror(spark, sf_dir).read(), CUT)
    return rows.select("event_id", "start_date", "start_time", "title")


def events_by_date_index(spark, sf_dir):
    """The same lookup in folders by date that syncs keep up; one of them is read."""
    table = parts.PartTable(spark, work_path(spark, "by_date"), SILVER, part=parts.by_date())
    table.sync(_silver(spark, sf_dir).filter("start_date IS NOT NULL AND start_time IS NOT NULL"))
    rows = lookup.events_on_date(table.read_part(CUT.isoformat()), CUT)
    return rows.select("event_id", "start_date", "start_time", "title")


def adhoc_sql_by_date(spark, sf_dir):
    tables.publish(_stored(spark, sf_dir), "feedlake_silver")
    return spark.sql(
        """
        SELECT start_date, count(*) AS n_events, count(DISTINCT title) AS n_titles,
               min(start_time) AS first_time, max(end_time) AS last_end
        FROM feedlake_silver GROUP BY start_date
        """
    )


def catalog_schema_merge(spark, sf_dir):
    """Rows before ``CUT`` were stored before the table had ``external_link``."""
    rows = _silver(spark, sf_dir)
    old, new = work_path(spark, "narrow"), work_path(spark, "wide")
    rows.filter(F.col("start_date") < F.lit(CUT)).drop("external_link").write.parquet(old)
    rows.filter(F.col("start_date") >= F.lit(CUT)).write.parquet(new)
    tables.register(tables.merged_schema(spark, [old, new]), "feedlake_merged")
    return spark.sql("SELECT event_id, title, start_date, external_link FROM feedlake_merged")


def csv_roundtrip(spark, sf_dir):
    """With a language that reads like the mark for NULL."""
    lang = F.when(F.col("lang") == "de", "\\N").when(F.col("lang") != "fr", F.col("lang"))
    docs = _table(spark, sf_dir, "documents").withColumn("lang", lang)
    path = work_path(spark, "csv")
    tables.write_csv(docs, path)
    return tables.read_csv(spark, path, docs.schema)


def event_titles(spark, sf_dir):
    return lookup.titles(_table(spark, sf_dir, "part"), "p_name").withColumnRenamed("p_name", "title")


def titles_json(spark, sf_dir):
    parts = _table(spark, sf_dir, "part")
    return lookup.titles_json(parts, 1000, "p_partkey", "p_name")


# --- checks -----------------------------------------------------------------------------


def file_atomic_valid(spark, sf_dir):
    rows = _events(spark, sf_dir)
    bad = F.col("value").isNull() | (F.col("value") < 0.05)
    return validate.drop_bad_files(rows, bad, "f").select("event_id", "f", "value")


def file_status(spark, sf_dir):
    rows = _events(spark, sf_dir)
    return validate.file_status(rows, F.col("value").isNull() | (F.col("value") < 0.05), "f")


def quality_flags(spark, sf_dir):
    """Pages as items: the guid may not end in a number, the start may be 30 or 31 Feb."""
    pages = _table(spark, sf_dir, "pages")
    items = pages.select(
        "page_id",
        F.regexp_extract("html", "<title>([^<]*)</title>", 1).alias("title"),
        F.col("url").alias("guid"),
        F.col("url").alias("location"),
        F.concat((F.col("page_id") % 31 + 1).cast("string"), F.lit(" Feb 2024 08:00:00")).alias("start"),
        F.lit("").alias("end"),
        F.lit(None).cast("string").alias("_corrupt_record"),
    )
    return silver.judge_items(items).select("page_id", "reject_reason")


def retention_tier(spark, sf_dir):
    orders = _table(spark, sf_dir, "orders")
    dated = orders.withColumn("created", F.when(F.col("o_orderstatus") != "P", F.col("o_orderdate")))
    return retention.retention_tier(dated, "created", AS_OF).select("o_orderkey", "tier")


# --- whole jobs over landed feeds -------------------------------------------------------


def _lake(spark: SparkSession) -> jobs.Lake:
    return jobs.Lake(spark, work_path(spark, "lake"))


def end_to_end_run(spark, sf_dir):
    lake = _lake(spark)
    jobs.run(lake, _landed(spark, _daily_items(spark, sf_dir)), LOAD_DATE)
    return lake.mirror.read()


def mirror_deletes(spark, sf_dir):
    """Two runs, the second with the last day only: what it removed from the mirror."""
    lake = _lake(spark)
    landing = _landed(spark, _daily_items(spark, sf_dir))
    listing = feeds.list_feeds(spark, landing)
    last = listing.agg(F.max("record_source")).first()[0]
    jobs.ingest(lake, landing, LOAD_DATE, listing=listing.filter(F.col("record_source") < last))
    jobs.sync_mirror(lake)
    jobs.ingest(lake, landing, LOAD_DATE)
    jobs.sync_mirror(lake)
    return lake.removed.read()


def stream_ingest(spark, sf_dir):
    lake = _lake(spark)
    landing = _landed(spark, _daily_items(spark, sf_dir))
    stream_feeds(lake, landing, work_path(spark, "stream"), LOAD_DATE).awaitTermination()
    return lake.silver.read()


def stream_fold(spark, sf_dir):
    """``fold_snapshots`` in the state of a stream: the table of the days since as one feed, then the days before."""
    rows = _events(spark, sf_dir)
    early, since = rows.filter(F.col("ts") < F.lit(CUT)), rows.filter(F.col("ts") >= F.lit(CUT))
    schema = rows.select(ROW).schema
    newest = [F.col("f"), F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"), F.col("event_id")]
    log = FeedLog(spark, work_path(spark, "log"), schema, "user_id", newest)
    table, checkpoint = tables.SnapshotTable(spark, work_path(spark, "folded"), schema), work_path(spark, "stream")
    existing = latest.latest_per_key(since, "user_id", _newest()).withColumn("feed", F.lit("table"))
    for feed in (existing, early.withColumn("feed", F.col("f"))):
        log.append(feed, feed.select("feed").distinct(), "feed")
        fold_log(log, table, checkpoint)
    return table.read()


def entry(spark: SparkSession) -> DataFrame:
    """Merge the last day into everything before it."""
    return merge_snapshot(spark, "/root/testdata/sf0.001")


def _corpus() -> tuple[dict[str, Callable], dict[str, str]]:
    """Queries and SQL of the corpus operators, where that subpackage is there."""
    try:
        corpus_pipeline, llm = import_module("corpus_pipeline"), import_module("feedlake.llm.queries")
    except ImportError:
        return {}, {}
    sql = dict(llm.ORACLES)
    if corpus_pipeline.ORACLE_SQL:
        sql["pipeline"] = corpus_pipeline.ORACLE_SQL
    return {**llm.QUERIES, "pipeline": corpus_pipeline.run}, sql


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """Every query by name; each takes the session and a data folder."""
    return {**feed_queries(), **_corpus()[0]}


def oracle_sql() -> dict[str, str]:
    """SQL with the same result, for every query that SQL can express."""
    return {**feed_sql(), **_corpus()[1]}


def feed_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """The queries of the feed pipeline."""
    listed = [
        list_pending_files, scan_feed_xml, scan_feed_xml_whole, scan_lenient_xml, scan_hidden_xml, whole_feed_status, scan_silver, scan_silver_typed,
        merge_first_run, scan_mirror, event_titles, adhoc_sql_by_date,
        silver_snapshot_roundtrip, mirror_apply, mirror_deletes, pending_minus_ledger,
        titles_json, catalog_schema_merge, csv_roundtrip,
        clean_title, guid_to_id, optional_text, ascii_clean, parse_dates, parse_times,
        html_class_text, nfkc_text, record_source, feed_to_silver, snapshot_name,
        latest_per_key, latest_per_key_maxby, events_on_date, active_set_semi, removed_anti,
        distinct_keys, sync_counts, removed_preview, union_existing_new,
        merge_snapshot, merge_bucketed, fold_snapshots, sync_plan, mirror_delta, store_sync, drift_ranges, drift_plan, events_by_date_index, end_to_end_run,
        file_atomic_valid, file_status, quality_flags, retention_tier, stream_ingest, stream_fold,
    ]
    return {query.__name__: query for query in listed}


# --- the same in SQL --------------------------------------------------------------------

_E = """
e AS (SELECT user_id, event_id, event_type, value, ts,
             strftime(ts, 'events_%Y%m%d.xml') AS f FROM events),
last AS (SELECT max(f) AS f FROM e),
existing AS (SELECT * FROM e WHERE f < (SELECT f FROM last)),
new AS (SELECT * FROM e WHERE f = (SELECT f FROM last))
"""
_ROW = "user_id, event_id, event_type, value, f"


def _latest_sql(source: str) -> str:
    return f"""SELECT {_ROW} FROM {source}
        QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY f DESC, ts DESC, event_id DESC) = 1"""


_MIRROR = f"""{_E},
cur AS ({_latest_sql("existing")}),
des AS (SELECT * FROM ({_latest_sql("e")}) WHERE user_id IN (SELECT user_id FROM new))
"""

_FEED = "strftime(ts, 'events_%Y%m%d_000000.xml')"
_SAID = "strftime({}, '%a, %d %b %Y %H:%M:%S GMT')"
_END = "(ts + INTERVAL 1 HOUR)"

_ITEMS_SQL = f"""
SELECT '  ' || event_type || ' by user ' || user_id || chr(160) AS title,
       'https://feed.example.org/event/' || event_id AS guid,
       CASE WHEN event_type = 'error' THEN ''
            ELSE 'https://feed.example.org/e/' || event_id END AS link,
       CASE event_type WHEN 'signup' THEN '' WHEN 'error' THEN '   '
            ELSE 'host ' || event_type || ' ' END AS host,
       ' Räum ' || props || ' ' AS location,
       {_SAID.format("ts")} AS start,
       CASE event_type WHEN 'click' THEN 'to be announced'
            WHEN 'view' THEN strftime({_END}, '%-d %b %Y')
            ELSE {_SAID.format(_END)} END AS "end",
       '<div class="h-event"><div class="p-name">Name</div>'
         || '<div class="p-description description"><p>' || event_type
         || '&nbsp;</p><!-- who --><p>user <b>' || user_id
         || '</b></p></div><div>Where</div></div>' AS description,
       {_FEED} AS record_source
FROM events"""


def _silver_sql(key: str, source: str) -> str:
    return f"""
SELECT {key}::INTEGER AS event_id,
       event_type || ' by user ' || user_id AS title,
       CASE WHEN event_type NOT IN ('signup', 'error') THEN 'host ' || event_type END AS host,
       ts::DATE AS start_date,
       CASE event_type WHEN 'click' THEN NULL ELSE {_END}::DATE END AS end_date,
       strftime(ts, '%H:%M:%S') AS start_time,
       CASE WHEN event_type IN ('click', 'view') THEN NULL
            ELSE strftime({_END}, '%H:%M:%S') END AS end_time,
       event_type || ' user ' || user_id AS event_description,
       'R um ' || props AS location,
       CASE event_type WHEN 'error' THEN 'https://feed.example.org/event/' || {key}
            ELSE 'https://feed.example.org/e/' || event_id END AS external_link,
       {_FEED} AS record_source,
       '{LOAD_DATE}' AS load_date
FROM {source}"""


_SILVER_SQL = _silver_sql("event_id", "events")

# One item per user and day; the table after the last day, and what it had before.
_DAILY = f"""daily AS (SELECT *, {_FEED} AS f FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id, ts::DATE ORDER BY ts DESC, event_id DESC) = 1),
final AS (SELECT * FROM daily WHERE f = (SELECT max(f) FROM daily)),
before AS (SELECT * FROM daily
    WHERE f = (SELECT max(f) FROM daily WHERE f < (SELECT max(f) FROM daily)))"""

_STRIP = r"regexp_replace({}, '^\s+|\s+$', '', 'g')"


def feed_sql() -> dict[str, str]:
    """SQL with the same result for each query of the feed pipeline.

    SQL has NFC, not NFKC: what ``nfkc_text`` puts in front is given as it should come out, and
    ``documents`` holds no other compatibility characters.
    """
    events_f = f"WITH {_E}"
    mirror = f"WITH {_MIRROR}"
    removed = "SELECT * FROM cur WHERE user_id NOT IN (SELECT user_id FROM des)"
    plan = f"""SELECT *, 'delete' AS op FROM ({removed})
               UNION ALL SELECT *, 'put' AS op FROM des"""
    bad = "(value IS NULL OR value < 0.05)"
    fold = f"""WITH {_E},
        early AS (SELECT * FROM e WHERE ts < DATE '{CUT}'),
        since AS (SELECT * FROM e WHERE ts >= DATE '{CUT}'),
        s0 AS ({_latest_sql("since")}),
        k AS (SELECT user_id FROM early GROUP BY user_id
              HAVING count(DISTINCT f) = (SELECT count(DISTINCT f) FROM early)),
        n AS (SELECT * FROM ({_latest_sql("early")}) WHERE f = (SELECT max(f) FROM early)),
        kept AS (SELECT * FROM s0 WHERE user_id IN (SELECT user_id FROM k))
        SELECT * FROM kept
        UNION ALL SELECT * FROM n WHERE user_id NOT IN (SELECT user_id FROM kept)"""
    return {
        "list_pending_files": f"SELECT DISTINCT {_FEED} AS record_source FROM events",
        "pending_minus_ledger": f"SELECT max({_FEED}) AS record_source FROM events",
        "scan_feed_xml": _ITEMS_SQL,
        "scan_feed_xml_whole": _ITEMS_SQL,
        "scan_lenient_xml": f"""SELECT event_type || chr(160) || 'é R&D & more' AS title,
            event_id::VARCHAR AS guid, 'https://feed.example.org/?a=1&b=' || user_id AS link,
            '&unknown; x' AS host, '<b>a & b&nbsp;</b>' AS description,
            false AS guid_is_permalink, NULL::VARCHAR AS _corrupt_record, {_FEED} AS record_source FROM events""",
        "scan_hidden_xml": f"""SELECT event_type AS title, event_id::VARCHAR AS guid, '<item>--> <!-- user ' || user_id || ' & </item>' AS description,
            NULL::VARCHAR AS _corrupt_record, {_FEED} AS record_source FROM events""",
        "whole_feed_status": f"""SELECT record_source, count(*) + (day % 4 = 1)::BIGINT AS n_items, 0::BIGINT AS n_bad, (day % 4 IN (0, 1))::BIGINT AS n_unsound
            FROM (SELECT {_FEED} AS record_source, day(ts) AS day FROM events) GROUP BY record_source, day""",
        "feed_to_silver": _SILVER_SQL,
        "scan_silver": _SILVER_SQL,
        "scan_silver_typed": _SILVER_SQL,
        "scan_mirror": _SILVER_SQL,
        "silver_snapshot_roundtrip": _SILVER_SQL,
        **dict.fromkeys(["events_on_date", "events_by_date_index"], f"""SELECT event_id, start_date, start_time, title FROM ({_SILVER_SQL})
            WHERE start_date = DATE '{CUT}' AND start_time IS NOT NULL ORDER BY start_time"""),
        "adhoc_sql_by_date": f"""SELECT start_date, count(*) AS n_events,
            count(DISTINCT title) AS n_titles, min(start_time) AS first_time,
            max(end_time) AS last_end FROM ({_SILVER_SQL}) GROUP BY start_date""",
        "catalog_schema_merge": f"""SELECT event_id, title, start_date,
            CASE WHEN start_date >= DATE '{CUT}' THEN external_link END AS external_link
            FROM ({_SILVER_SQL})""",
        "csv_roundtrip": r"""SELECT * REPLACE (CASE lang WHEN 'de' THEN '\N' WHEN 'fr' THEN NULL ELSE lang END
            AS lang) FROM documents""",
        "event_titles": "SELECT p_name AS title FROM part",
        "titles_json": """SELECT p_partkey // 1000 AS page,
            to_json(list(p_name ORDER BY p_partkey))::VARCHAR AS body
            FROM part GROUP BY p_partkey // 1000""",
        "latest_per_key": f"{events_f} {_latest_sql('e')}",
        "latest_per_key_maxby": f"{events_f} {_latest_sql('e')}",
        "merge_first_run": f"{events_f} {_latest_sql('e')}",
        "merge_snapshot": f"{mirror} SELECT * FROM des",
        **dict.fromkeys(["mirror_apply", "merge_bucketed", "mirror_delta", "store_sync"], f"{mirror} SELECT * FROM des"),
        "fold_snapshots": fold,
        "stream_fold": fold,
        "active_set_semi": f"""{events_f} SELECT {_ROW} FROM existing
            WHERE user_id IN (SELECT user_id FROM new)""",
        "distinct_keys": "SELECT DISTINCT user_id FROM events",
        "union_existing_new": f"{events_f} SELECT {_ROW} FROM e",
        "removed_anti": f"{mirror} {removed}",
        "removed_preview": f"""{events_f} SELECT * FROM ({_latest_sql("e")}) WHERE user_id NOT IN
            (SELECT user_id FROM e WHERE ts >= (SELECT max(ts) FROM e) - INTERVAL 1 HOUR)
            ORDER BY user_id LIMIT 20""",
        "sync_plan": f"{mirror} {plan}",
        "drift_plan": f"""{mirror} SELECT *, 'delete' AS op FROM ({removed})
            UNION ALL SELECT *, 'put' AS op FROM (SELECT * FROM des EXCEPT SELECT * FROM cur)""",
        "drift_ranges": f"""{mirror}, d AS ((SELECT * FROM cur EXCEPT SELECT * FROM des) UNION ALL (SELECT * FROM des EXCEPT SELECT * FROM cur)),
            r AS (SELECT DISTINCT floor(user_id / 10)::BIGINT AS r FROM d)
            SELECT r AS range, (SELECT count(*) FROM cur WHERE floor(user_id / 10) = r) AS n_held,
                (SELECT count(*) FROM des WHERE floor(user_id / 10) = r) AS n_desired FROM r""",
        "sync_counts": f"{mirror} SELECT op, count(*) AS n_rows FROM ({plan}) GROUP BY op",
        "clean_title": f"SELECT doc_id, {_STRIP.format('text')} AS title FROM documents",
        "ascii_clean": f"""SELECT doc_id, coalesce({_STRIP.format(
            "regexp_replace(text, '[^[:ascii:]]+', ' ', 'g')")}, '') AS location FROM documents""",
        "optional_text": f"""SELECT conv_id, turn,
            CASE WHEN turn % 3 = 2 THEN nullif({_STRIP.format('text')}, '') END AS host
            FROM conversations""",
        "nfkc_text": """SELECT doc_id, 'fi1A' || nfc_normalize(text) AS event_description
            FROM documents""",
        "guid_to_id": """SELECT page_id, CASE WHEN regexp_matches(tail, '^[+-]?[0-9]+$')
            THEN try_cast(tail AS INTEGER) END AS event_id
            FROM (SELECT page_id, string_split(url, '/')[-1] AS tail FROM pages)""",
        "record_source": "SELECT page_id, string_split(url, '/')[-1] AS record_source FROM pages",
        "html_class_text": r"""SELECT page_id,
            trim(regexp_extract(html, '<div class="ad">([^<]*)</div>', 1)) AS ad_text FROM pages""",
        "parse_dates": "SELECT event_id, ts::DATE AS start_date FROM events",
        "parse_times": "SELECT event_id, strftime(ts, '%H:%M:%S') AS start_time FROM events",
        "snapshot_name": """SELECT event_id, strftime(ts, 'events_%Y%m%d_%H%M%S.xml') AS name
            FROM events""",
        "file_atomic_valid": f"""{events_f} SELECT event_id, f, value FROM e
            WHERE f NOT IN (SELECT f FROM e WHERE {bad})""",
        "file_status": f"""{events_f} SELECT f, count(*) AS n_items,
            count(*) FILTER (WHERE {bad}) AS n_bad FROM e GROUP BY f""",
        "quality_flags": """SELECT page_id, concat_ws(',',
            CASE WHEN NOT regexp_matches(string_split(url, '/')[-1], '^[+-]?[0-9]+$')
                 THEN 'event_id' END,
            CASE WHEN page_id % 31 + 1 > 29 THEN 'start' END) AS reject_reason FROM pages""",
        "retention_tier": f"""SELECT o_orderkey, CASE WHEN age >= 60 THEN 'archive'
            WHEN age >= 30 THEN 'infrequent' ELSE 'standard' END AS tier
            FROM (SELECT o_orderkey, date_diff('day', CASE WHEN o_orderstatus <> 'P'
                  THEN o_orderdate::DATE END, DATE '{AS_OF}') AS age FROM orders)
            WHERE age < 90 OR age IS NULL""",
        "end_to_end_run": f"WITH {_DAILY} {_silver_sql('user_id', 'final')}",
        "stream_ingest": f"WITH {_DAILY} {_silver_sql('user_id', 'final')}",
        "mirror_deletes": f"""WITH {_DAILY} SELECT * FROM ({_silver_sql("user_id", "before")})
            WHERE event_id NOT IN (SELECT user_id FROM final)""",
    }
