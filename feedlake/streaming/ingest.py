"""Silver kept up to date by a file stream over the landing folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from feedlake.plans.jobs import Lake, ingest
from feedlake.sources.feeds import FILE_OPTIONS, FILE_SCHEMA, list_feeds, listing_columns


#: Longer than any file has been there.
MAX_AGE_DAYS = 100_000


def stream_feeds(
    lake: Lake,
    landing: str,
    checkpoint: str,
    load_date: str | None = None,
    strict: bool = True,
    allow_empty: bool = True,
    archive: str | None = None,
) -> StreamingQuery:
    """Start a stream that applies every feed not seen before, then stops.

    The stream says that files have come; which of them are pending is the listing less the ledger,
    as in a batch, so stream and batch cannot differ: no file is too old, a late part or a file
    put again makes its snapshot pending. A stream does not report a file that is put again under a
    name it has seen, so changed snapshots are applied when it starts.

    A feed without items is seen too. A batch that is replayed finds its files in the ledger. With
    ``strict`` a bad file holds the stream up; a start with ``strict=False`` gets it past.

    ``archive``: folder that consumed files are moved to, one batch later.
    """
    # Files never age out, however old their time of modification.
    options = {**FILE_OPTIONS, "maxFileAge": f"{MAX_AGE_DAYS}d"}
    if archive:
        options |= {"cleanSource": "archive", "sourceArchiveDir": archive}

    def apply_landed(listing: DataFrame | None = None) -> None:
        ingest(lake, landing, load_date, strict, allow_empty, listing)

    landed = list_feeds(lake.spark, landing)
    seen = lake.ledger().select("record_source").distinct()
    apply_landed(landed.join(seen, "record_source", "left_semi"))

    files = (
        lake.spark.readStream.format("binaryFile")
        .schema(FILE_SCHEMA)
        .options(**options)
        .load(landing)
        .select(*listing_columns(lake.spark, landing))
    )

    def apply(batch: DataFrame, _: int) -> None:
        # Also where the batch shows no rows: a file of no bytes has none, and has to be judged.
        apply_landed()

    return (
        files.writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
