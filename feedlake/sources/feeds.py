"""XML feed snapshots: listing, scanning, landing.

A snapshot is one file ``<name>.xml`` or one folder ``<name>.xml`` (also
``record_source=<name>.xml``) of part files; either way its name is the record source. Names
are read below the landing folder only, by one rule for listing, scans and stream.
"""

from __future__ import annotations

from collections.abc import Callable
from html.entities import name2codepoint

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.classic.column import Column as ClassicColumn

from feedlake import schemas
from feedlake.operators.automaton import NONE, states_before, transition
from feedlake.operators.keyed import restrict
from feedlake.schemas import CORRUPT, ITEM_FIELDS, PERMALINK
from feedlake.session import materialize
from feedlake.sources.tables import path_exists_or_empty

# What follows ``<item`` where that opens an item, and markup that may hide one.
AFTER_ITEM_TAG = r"^(?:\s[^<>]*)?/?>"
ITEM_START = r"<item(?=[\s/>])"
ITEM_END = "</item>"
LOOSE_END = r"</item\s+>"
CDATA, CDATA_END = "<![CDATA[", "]]>"
COMMENT, COMMENT_END = "<!--", "-->"
XML_ENTITIES = ("amp", "lt", "gt", "quot", "apos")
# Fixed value: characters that XML 1.0 cannot hold.
NOT_XML = "[^\\x{9}\\x{A}\\x{D}\\x{20}-\\x{D7FF}\\x{E000}-\\x{FFFD}\\x{10000}-\\x{10FFFF}]"

# The root elements of feeds that have items, what may stand before one and after its end.
ROOT = r"(?:rss|(?:[A-Za-z_][\w.-]*:)?RDF)"
PROLOG = r"(?s)^\x{FEFF}?\s*(?:(?:<\?.*?\?>|<!--.*?-->|<!DOCTYPE[^>\[]*(?:\[.*?\]\s*)?>)\s*)*"
EPILOG = r"\s*(?:<\?.*?\?>\s*)*\z"
OPENS = PROLOG + "<" + ROOT + r"(?=[\s/>])"
CLOSES = r"(?s)</" + ROOT + r"\s*>" + EPILOG
SELF_CLOSED = PROLOG + "<" + ROOT + r"(?:\s[^<>]*)?/>" + EPILOG

# A section that may hide an item, from its opening mark to its end or to that of the text.
SECTION = r"(?s)<!\[CDATA\[.*?\]\]>|<!--.*?-->|(<!\[CDATA\[|<!--).*\z"
#: Put into a hidden ``<item`` while a text is cut; a character that XML cannot hold.
MASK = "\u0001"
#: States of a reader between two chunks: in text, in CDATA, in a comment.
TEXT, IN_CDATA, IN_COMMENT = 0, 1, 2

FIRST_XML = r"^(?:[^/]+/)*?([^/]+\.xml)(?:/.*)?$"
PREFIX = "record_source="

FILE_OPTIONS = {"pathGlobFilter": "*.xml", "recursiveFileLookup": "true"}
FILE_SCHEMA = "path string, modificationTime timestamp, length long, content binary"
LISTING = "snapshot string, length long, modified timestamp, record_source string"
ITEM_OPTIONS = {"ignoreSurroundingSpaces": "false", "nullValue": "\u0000"}


def _plain(escaped: Column) -> Column:
    """A path without URL escapes; a plus sign is one."""
    return F.url_decode(F.replace(escaped, F.lit("+"), F.lit("%2B")))


def _below(spark: SparkSession, landing: str, path_of: Column | None = None) -> Column:
    """The path of a scanned (or the given) file below ``landing``, still escaped, without a leading slash."""
    path = spark._jvm.org.apache.hadoop.fs.Path(landing)
    system = path.getFileSystem(spark._jsc.hadoopConfiguration())
    root = system.makeQualified(path).toUri().getRawPath().rstrip("/")
    # Less scheme and host, which readers and file systems write in different ways.
    path_of = F.col("_metadata.file_path") if path_of is None else path_of
    own = F.regexp_replace(path_of, r"^[A-Za-z][A-Za-z0-9+.-]*:(?://[^/]*)?", "")
    return F.substring(own, F.lit(len(root) + 2), F.length(own))


def source_of_path(below: Column) -> Column:
    """The record source of an escaped path below the landing folder: its first ``.xml`` part."""
    part = _plain(F.regexp_extract(below, FIRST_XML, 1))
    # Spark escapes the values in names of partition folders once more.
    named = _plain(F.substring(part, len(PREFIX) + 1, 1 << 30))
    return F.when(part.startswith(PREFIX), named).otherwise(part)


def _snapshot_of_path(below: Column) -> Column:
    """The file or folder of the snapshot, below the landing folder."""
    return _plain(F.regexp_extract(below, r"^((?:[^/]+/)*?[^/]+\.xml)(?:/.*)?$", 1))


def _has_sections(text: Column) -> Column:
    return text.contains(CDATA) | text.contains(COMMENT)


def _plain_text(text: Column) -> Column:
    """``text`` with a blank for each section; of one that is not closed the opening mark is left."""
    return F.when(_has_sections(text), F.regexp_replace(text, SECTION, "$1 ")).otherwise(text)


def _state_after(text: Column) -> Column:
    """Where a reader that begins ``text`` outside of any section is at its end."""
    left = _plain_text(text)
    return F.when(left.contains(CDATA), IN_CDATA).when(left.contains(COMMENT), IN_COMMENT).otherwise(TEXT)


def _transition(text: Column) -> Column:
    """The states after ``text`` for each state before it, as one number."""

    def from_inside(closing: str, state: int) -> Column:
        at = F.locate(closing, text)
        rest = F.substring(text, at + len(closing), F.length(text))
        return F.when(at == 0, state).otherwise(_state_after(rest))

    ends = [_state_after(text), from_inside(CDATA_END, IN_CDATA), from_inside(COMMENT_END, IN_COMMENT)]
    return transition(ends)


def _by_section(text: Column, outside: Callable[[Column], Column], inside: Callable[[Column], Column]) -> Column:
    """``text`` with its sections, and what is between them, changed each in its own way."""
    between, sections = F.split(text, SECTION, -1), F.regexp_extract_all(text, F.lit(SECTION), 0)
    parts = F.zip_with(between, sections, lambda b, s: F.concat(outside(b), F.coalesce(inside(s), F.lit(""))))
    return F.when(_has_sections(text), F.array_join(parts, "")).otherwise(outside(text))


def _masked(text: Column) -> Column:
    """``text`` in which no hidden tag reads like that of an item."""
    return _by_section(text, lambda between: between, lambda section: F.regexp_replace(section, "<(/?item)", f"<{MASK}$1"))


def _opens(text: Column) -> Column:
    return text.rlike(OPENS)


def _closes(text: Column) -> Column:
    """Whether the root of a feed ends with ``text``; the cheap test goes first."""
    may = text.contains("</rss") | text.contains("RDF") | text.contains("<rss")
    return may & (_plain_text(text).rlike(CLOSES) | text.rlike(SELF_CLOSED))


def listing_columns(spark: SparkSession, landing: str) -> list[Column]:
    """Columns of a listing, for the ``binaryFile`` reader of batch and stream alike."""
    below = _below(spark, landing)
    return [
        _snapshot_of_path(below).alias("snapshot"),
        F.col("length"),
        F.col("modificationTime").alias("modified"),
        source_of_path(below).alias("record_source"),
    ]


def _empty_files(files: DataFrame, landing: str) -> DataFrame:
    """Rows of a listing for files of no bytes, which Spark's scans leave out, but not its file index.

    The paths stay in the JVM, which holds them anyway.
    """
    spark = files.sparkSession
    paths = ClassicColumn(spark._jvm.org.apache.spark.sql.functions.lit(files._jdf.inputFiles()))
    known = spark.range(1).select(F.explode(paths).alias("value"))
    below = F.col("below")
    empty = known.select(_below(spark, landing, F.col("value")).alias("below")).join(files.select(_below(spark, landing).alias("below")), "below", "left_anti")
    return empty.select(
        _snapshot_of_path(below).alias("snapshot"),
        F.lit(0).cast("bigint").alias("length"),
        F.lit(None).cast("timestamp").alias("modified"),
        source_of_path(below).alias("record_source"),
    )


def list_feeds(spark: SparkSession, landing: str) -> DataFrame:
    """Every feed file below ``landing``: snapshot (its path), length, modified, record_source.

    Only file metadata is read. A file of no bytes is listed too, without a time. A folder that does
    not exist yet is an empty listing.
    """

    def load() -> DataFrame:
        files = spark.read.format("binaryFile").options(**FILE_OPTIONS).load(landing)
        return files.select(*listing_columns(spark, landing)).unionByName(_empty_files(files, landing))

    return path_exists_or_empty(spark, load, LISTING)


def snapshots(listing: DataFrame) -> DataFrame:
    """A row per record source: its paths, how many files are empty, and a state that changes with any of its files."""
    file_state = F.xxhash64("snapshot", "length", "modified").cast("decimal(38,0)")
    return listing.groupBy("record_source").agg(
        F.collect_set("snapshot").alias("snapshots"),
        F.count_if(F.col("length") == 0).alias("n_empty"),
        F.sum(file_state).cast("string").alias("state"),
    )


def pending_feeds(listing: DataFrame, ledger: DataFrame) -> DataFrame:
    """Snapshots of the listing that the ledger has not seen in their present state.

    A snapshot with a new part, or put again with other content, is pending again. A ledger
    row without a state stands for any.
    """
    found = snapshots(listing)
    known = ledger.groupBy("record_source").agg(F.collect_set("state").alias("states"), F.bool_or(F.col("state").isNull()).alias("any_state"))
    seen = known.join(found.select("record_source", "state"), "record_source").filter(F.col("any_state") | F.array_contains("states", F.col("state")))
    return found.join(seen.select("record_source"), "record_source", "left_anti")


def _repaired(item: Column) -> Column:
    """An item with entities that only HTML knows, and with bare ``&``, made XML outside CDATA."""
    names = {n: f"&#{c};" for n, c in name2codepoint.items() if n not in XML_ENTITIES}
    known = F.create_map([F.lit(x) for pair in names.items() for x in pair])
    name = r"&([A-Za-z][A-Za-z0-9]*);"

    def mended(text: Column) -> Column:
        found = F.array_except(F.array_distinct(F.regexp_extract_all(text, F.lit(name), 1)), F.array(*map(F.lit, XML_ENTITIES)))
        by_name = F.aggregate(found, text, lambda t, n: F.replace(t, F.concat(F.lit("&"), n, F.lit(";")), F.coalesce(known[n], F.concat(F.lit("&amp;"), n, F.lit(";")))))
        return F.regexp_replace(by_name, r"&(?!(?:[A-Za-z][A-Za-z0-9]*|#[0-9]+|#[xX][0-9a-fA-F]+);)", "&amp;")

    odd = r"&(?!(?:amp|lt|gt|quot|apos|#[0-9]+|#[xX][0-9a-fA-F]+);)"
    return F.when(item.contains("&") & item.rlike(odd), _by_section(item, mended, lambda section: section)).otherwise(item)


def _parsed(chunks: DataFrame, unsplittable: Column, keep: tuple[str, ...] = ()) -> DataFrame:
    """Items of texts that begin behind ``<item``, and the columns of ``keep``.

    Needs value, record_source, is_utf8, is_item. Other chunks are rows too, without fields.
    """
    value = F.col("value")
    # The end tag as it should be is the rule: only where it is missing is a loose one looked for.
    chunks = chunks.withColumn("value", F.when(value.contains(ITEM_END), value).otherwise(F.regexp_replace(value, LOOSE_END, ITEM_END)))
    chunks = chunks.withColumn("unsplittable", unsplittable)
    good = F.col("is_item") & F.col("is_utf8") & ~F.col("unsplittable") & value.contains(ITEM_END)
    item = F.concat(F.lit("<item"), F.substring_index(value, ITEM_END, 1), F.lit(ITEM_END))
    item = _repaired(F.replace(item, F.lit(MASK), F.lit("")))
    chunks = chunks.withColumns({"good": good, "item": F.when(good, item)})
    options = {**ITEM_OPTIONS, "columnNameOfCorruptRecord": CORRUPT}
    fields = F.from_xml(F.col("item"), schemas.ITEM_WITH_CORRUPT, options)
    guid_tag = F.regexp_extract("item", r"<guid\b([^>]*)>", 1)
    says = F.lower(F.regexp_extract(guid_tag, r"isPermaLink\s*=\s*[\"']([^\"']*)", 1))
    permalink = F.when(F.col("item").contains("isPermaLink"), says != "false").otherwise(True)
    # A generator, so that a later filter on the fields cannot pull the parser into itself
    # and run it once per field named.
    about = ["is_utf8", "unsplittable", "record_source", *keep]
    parsed = chunks.select("good", permalink.alias(PERMALINK), *about, F.inline(F.array(fields)))
    return parsed.select(*ITEM_FIELDS, F.when(F.col("good"), F.col(CORRUPT)).otherwise(F.lit("<item")).alias(CORRUPT), PERMALINK, *about)


def _paths(landing: str, below: list[str] | None) -> str | list[str]:
    if below is None:
        return landing
    # Readers take paths as globs: what a name has of their signs is escaped.
    escaped = ["".join("\\" + c if c in "*?[]{}\\," else c for c in b) for b in below]
    return [f"{landing.rstrip('/')}/{b}" for b in escaped]


#: Columns that ``file_status`` needs of a scan with ``marks``.
MARKS = ("file", "place", "opens", "closes", "is_item")


def _chunks(spark: SparkSession, landing: str, below: list[str] | None) -> DataFrame:
    """The texts between one ``<item`` and the next, as many tasks as the files have splits.

    ``place`` grows within a file: a task has fewer chunks than a block has bytes, so the first byte
    of the block and the number of the chunk in its task can be added up.
    """
    text = spark.read.options(**FILE_OPTIONS).option("lineSep", "<item").text(_paths(landing, below))
    row = F.monotonically_increasing_id()
    return text.select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        (F.col("_metadata.file_block_start") + row.bitwiseAND(F.lit((1 << 33) - 1))).alias("place"),
        row.alias("row"),
        source_of_path(_below(spark, landing)).alias("record_source"),
        F.is_valid_utf8("value").alias("is_utf8"),
        F.col("value").rlike(AFTER_ITEM_TAG).alias("is_item"),
    )


def _marked(chunks: DataFrame) -> DataFrame:
    value = F.col("value")
    # Only what is no item can come before all items.
    return chunks.withColumns({"opens": ~F.col("is_item") & _opens(value), "closes": _closes(value)})


def _about_items(rows: DataFrame, marks: bool) -> DataFrame:
    return rows if marks else rows.filter(F.col("is_item") | ~F.col("is_utf8") | F.col("unsplittable")).drop(*MARKS)


def scan_feeds(spark: SparkSession, landing: str, below: list[str] | None = None, marks: bool = False) -> DataFrame:
    """One row per ``<item>``: its fields as text, plus columns about the read.

    ``below``: snapshots as a listing names them, instead of all. Text is cut at ``<item``, so a
    file of any size is read by as many tasks as it has splits, and one that is not UTF-8 or not
    XML marks its own rows (``_corrupt_record``) and leaves the rest of the run alone. An ``<item``
    or ``</item>`` inside CDATA or a comment, or an element inside an item whose name begins like it,
    would be cut in the wrong place: where that may be so, rows carry ``unsplittable``, and
    ``scan_feeds_exact`` reads their files.

    HTML entities, a bare ``&`` and ``</item >`` are mended before an item is called corrupt.

    ``marks``: also rows for the texts before, between and behind items, and the columns by which
    ``file_status`` tells a whole feed from an error page or a feed cut short.
    """
    value = F.col("value")
    inside = _has_sections(value) & (_state_after(value) != TEXT)
    two_ends = F.substring_index(value, ITEM_END, 2) != value
    no_end = F.col("is_item") & ~value.contains(ITEM_END) & ~value.rlike(LOOSE_END)
    chunks = _chunks(spark, landing, below)
    rows = _parsed(_marked(chunks) if marks else chunks, inside | two_ends | no_end, MARKS if marks else ("is_item",))
    return _about_items(rows, marks)


def scan_feeds_whole(spark: SparkSession, landing: str, below: list[str] | None = None) -> DataFrame:
    """``scan_feeds`` with each file as one text: exact for any well-formed file, one task a file.

    Sections that may hide an item are masked before the text is cut.
    """
    files = spark.read.options(**FILE_OPTIONS).text(_paths(landing, below), wholetext=True).select(
        "value", source_of_path(_below(spark, landing)).alias("record_source"), F.is_valid_utf8("value").alias("is_utf8")
    )
    sound = F.when(F.col("is_utf8"), F.col("value")).otherwise("")
    # A file that is not UTF-8 has one row that says so.
    cut = F.when(F.col("is_utf8"), F.slice(F.split(_masked(sound), ITEM_START), 2, 1 << 30)).otherwise(F.array(F.lit("")))
    chunks = files.select("record_source", "is_utf8", F.explode(cut).alias("value"))
    chunks = chunks.withColumn("is_item", F.col("value").rlike(AFTER_ITEM_TAG))
    return _about_items(_parsed(chunks, F.lit(False), ("is_item",)), False)


def scan_feeds_exact(spark: SparkSession, landing: str, below: list[str] | None = None, marks: bool = False) -> DataFrame:
    """``scan_feeds`` for files with hidden items: exact, and still as many tasks as a file has splits.

    A reader of XML is an automaton of three states: in text, in CDATA, in a comment. What a chunk does
    to them is worked out for all three, and ``states_before`` tells in which of them each chunk
    really begins. Chunks that begin inside a section, or behind the tag of another element, belong to the item
    before them and are put back to it; only those few are shuffled.

    The chunks are written once, since their places must not change between the steps.
    """
    chunks = materialize(_chunks(spark, landing, below).withColumn("code", _transition(F.col("value")).cast("bigint")), "chunks")
    sequence = chunks.select(F.col("file").alias("sequence"), "block", "place", "code", F.col("is_item").alias("marks"), "row")
    odd = materialize(states_before(sequence, states=3).filter("not alone").select("row", "owner", "state"), "odd")
    alone = restrict(chunks, odd, "row", "left_anti").withColumn("in_text", F.lit(True))
    # What comes before the first item is no item's, and stays apart.
    owner = F.when(F.col("owner") == NONE, F.col("place")).otherwise(F.col("owner"))
    together = chunks.join(odd, "row").groupBy("file", "record_source", owner.alias("at"))
    joined = together.agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("place", "value"))), lambda c: c["value"]), "<item").alias("value"),
        F.bool_and("is_utf8").alias("is_utf8"),
        F.bool_and(F.col("owner") != NONE).alias("is_item"),
        F.bool_or((F.col("owner") != NONE) | (F.col("state") == TEXT)).alias("in_text"),
    ).withColumnRenamed("at", "place")
    columns = ["file", "record_source", "value", "is_utf8", "place", "is_item", "in_text"]
    rows = alone.select(columns).unionByName(joined.select(columns))
    if marks:
        rows = _marked(rows).withColumn("closes", F.col("closes") & F.col("in_text"))
    rows = rows.withColumn("value", F.when(_has_sections(F.col("value")), _masked(F.col("value"))).otherwise(F.col("value")))
    return _about_items(_parsed(rows, F.lit(False), MARKS if marks else ("is_item",)), marks)


def file_status(rows: DataFrame, bad: Column) -> DataFrame:
    """(record_source, n_items, n_bad, n_unsound, again) from a scan with ``marks``.

    ``n_unsound`` counts files that do not begin with the root of a feed or do not end with its
    end: error pages, feeds cut short. An honest feed without items has both. ``again``: the file has to be read
    by ``scan_feeds_exact``, and what is said of it here does not count.
    """
    is_row = F.col("is_item") | ~F.col("is_utf8") | F.col("unsplittable")
    first, last = F.min("place"), F.max("place")
    files = rows.groupBy("record_source", "file").agg(
        F.count_if(is_row).alias("n_items"),
        F.count_if(is_row & bad).alias("n_bad"),
        (F.bool_or("unsplittable") & F.bool_and("is_utf8")).alias("again"),
        (F.min(F.when(F.col("opens"), F.col("place"))).eqNullSafe(first) & F.max(F.when(F.col("closes"), F.col("place"))).eqNullSafe(last)).alias("sound"),
    )
    return files.groupBy("record_source").agg(
        F.sum("n_items").alias("n_items"), F.sum("n_bad").alias("n_bad"), F.count_if(~F.col("sound")).alias("n_unsound"), F.bool_or("again").alias("again")
    )


def land_items(items: DataFrame, landing: str) -> None:
    """Write items as XML, one folder per ``record_source``.

    Characters that XML cannot hold become U+FFFD, so that one of them does not end the write.
    REBALANCE lets AQE give a big source many files and a small one few.
    """
    (
        items.select(*[F.when(F.col(c).rlike(NOT_XML), F.regexp_replace(c, NOT_XML, "�")).otherwise(F.col(c)).alias(c) for c in ITEM_FIELDS], "record_source")
        .hint("rebalance", F.col("record_source"))
        .write.format("xml")
        .option("rootTag", "rss")
        .option("rowTag", "item")
        .partitionBy("record_source")
        .mode("append")
        .save(landing)
    )


def archive_feeds(spark: SparkSession, landing: str, below: list[str], archive: str) -> None:
    """Move snapshots, named as in a listing, out of the landing folder. One that is gone is skipped."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    for name in below:
        old, new = (jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/{name}") for root in (landing, archive))
        system = old.getFileSystem(conf)
        if system.exists(old):
            system.mkdirs(new.getParent())
            if not system.rename(old, new):
                raise OSError(f"{name}: could not be moved to {archive}")
