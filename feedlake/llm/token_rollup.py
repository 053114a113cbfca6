"""Token totals by source, language and tokenizer version, kept up by deltas.

A change is an insert, a delete or a revised count. It becomes signed rows: an insert adds the new
count, a delete takes the old one back, a revision does both. A batch of changes is summed by key
and written as one small table under its id. The totals are the sums over all committed batches,
so the corpus is never counted again.

A batch is committed by Spark's own success marker, which is written last. A batch that was lost on
the way leaves no marker and is replaced when it comes again; one that is committed is left
alone, so a batch may be delivered any number of times. ``compact`` sums what is committed into one table
that says which batches it holds, so that totals read that table and the batches since.

Defined results: null keys are keys like others; a null count is 0; an unknown kind of change fails
the batch; keys with nothing left are not in the totals; an empty batch is committed as such; a batch id is any text, also
one with a slash; columns beside those of ``CHANGES`` are left out.
"""

from __future__ import annotations

from urllib.parse import quote, unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlake.session import delete_path

KEYS = ["source", "lang", "tokenizer"]
CHANGES = "change string, source string, lang string, tokenizer string, old_tokens bigint, new_tokens bigint"
TOTALS = "source string, lang string, tokenizer string, n_docs bigint, n_tokens bigint"


def signed(changes: DataFrame) -> DataFrame:
    """Signed rows (keys, n_docs, n_tokens) of changes in the form of ``CHANGES``.

    A document that moves to another key is a delete there and an insert here.
    """
    old, new = (F.coalesce(f"{k}_tokens", F.lit(0)) for k in ("old", "new"))
    fail = F.raise_error(F.concat(F.lit("unknown change: "), F.coalesce("change", F.lit("null"))))
    docs = F.when(F.col("change") == "insert", 1).when(F.col("change") == "delete", -1).when(F.col("change") == "revise", 0).otherwise(fail.cast("int"))
    tokens = F.when(F.col("change") == "insert", new).when(F.col("change") == "delete", -old).otherwise(new - old)
    return changes.select(*KEYS, docs.cast("bigint").alias("n_docs"), tokens.alias("n_tokens"))


def between(old: DataFrame, new: DataFrame, id_col: str) -> DataFrame:
    """The changes that turn one list of counts (id, keys, n_tokens) into another.

    Ids are unique per tokenizer in each list.
    """
    on = [id_col, *KEYS]
    was = old.select(*[F.col(c).alias(f"old_{c}") for c in on], F.col("n_tokens").alias("old_tokens"), F.lit(True).alias("was"))
    now = new.select(*[F.col(c).alias(f"new_{c}") for c in on], F.col("n_tokens").alias("new_tokens"), F.lit(True).alias("now"))
    same = [F.col(f"old_{c}").eqNullSafe(F.col(f"new_{c}")) for c in on]
    both = was.join(now, same, "full")
    change = F.when(F.col("was").isNull(), "insert").when(F.col("now").isNull(), "delete").otherwise("revise")
    keys = [F.coalesce(f"old_{c}", f"new_{c}").alias(c) for c in KEYS]
    rows = both.select(change.alias("change"), *keys, "old_tokens", "new_tokens")
    return rows.filter("change <> 'revise' or not old_tokens <=> new_tokens")


def _sums(rows: DataFrame) -> DataFrame:
    return rows.groupBy(*KEYS).agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))


class Rollup:
    """Totals below a folder that all executors share."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def _exists(self, path: str) -> bool:
        place = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return place.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(place)

    def _folder(self, batch_id: str) -> str:
        return f"{self.path}/batch={quote(batch_id, safe='')}"

    def committed(self, batch_id: str) -> bool:
        return self._exists(f"{self._folder(batch_id)}/_SUCCESS")

    def commit(self, batch_id: str, changes: DataFrame) -> bool:
        """Add a batch; False if it is there already."""
        if self.committed(batch_id):
            return False
        _sums(signed(changes)).coalesce(1).write.mode("overwrite").parquet(self._folder(batch_id))
        return True

    def _listed(self, prefix: str, marker: str) -> list[str]:
        """Names behind ``prefix`` of the folders that have their marker."""
        place = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        system = place.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not system.exists(place):
            return []
        names = [s.getPath().getName() for s in system.listStatus(place)]
        return sorted(n.removeprefix(prefix) for n in names if n.startswith(prefix) and self._exists(f"{self.path}/{n}/{marker}"))

    def batches(self) -> list[str]:
        """Ids of the committed batches."""
        return sorted(unquote(name) for name in self._listed("batch=", "_SUCCESS"))

    def _held(self, base: str | None) -> set[str]:
        """Ids of the batches that a compacted table holds: a short text for each, as in the listing."""
        if base is None:
            return set()
        return {row.batch for row in self.spark.read.schema("batch string").parquet(f"{self.path}/base={base}/batches").collect()}

    def _parts(self) -> tuple[str | None, set[str], list[str]]:
        """The compacted table in force, what it holds, and the batches since."""
        base = max(self._listed("base=", "batches/_SUCCESS"), default=None)
        held = self._held(base)
        return base, held, [b for b in self.batches() if b not in held]

    def _read(self, base: str | None, since: list[str]) -> DataFrame:
        paths = [f"{self.path}/base={base}/totals"] * (base is not None) + [self._folder(b) for b in since]
        return self.spark.read.schema(TOTALS).parquet(*paths) if paths else self.spark.createDataFrame([], TOTALS)

    def compact(self) -> int:
        """Sum all committed batches into one table; how many were not in one before.

        Its list of batches is written last and puts it in force. The rows of a batch are deleted by the compaction after the
        one that took it in, for the sake of readers; its marker stays, so it is never added again. Can be
        repeated after a crash. One compaction at a time; batches may be committed meanwhile.
        """
        base, held, since = self._parts()
        if not since:
            return 0
        after = f"{int(base or 0) + 1:012d}"
        _sums(self._read(base, since)).coalesce(1).write.mode("overwrite").parquet(f"{self.path}/base={after}/totals")
        ids = self.spark.createDataFrame([(b,) for b in sorted(held) + since], "batch string")
        ids.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/base={after}/batches")
        for batch in held:
            self._empty(batch)
        for old in self._listed("base=", "batches/_SUCCESS"):
            if base is not None and old < base:
                delete_path(self.spark, f"{self.path}/base={old}")
        return len(since)

    def _empty(self, batch_id: str) -> None:
        """Delete the rows of a batch, not its marker."""
        place = self.spark._jvm.org.apache.hadoop.fs.Path(self._folder(batch_id))
        for status in place.getFileSystem(self.spark._jsc.hadoopConfiguration()).listStatus(place):
            if status.getPath().getName() != "_SUCCESS":
                delete_path(self.spark, status.getPath().toString())

    def totals(self) -> DataFrame:
        """(source, lang, tokenizer, n_docs, n_tokens) over all committed batches."""
        base, _, since = self._parts()
        return _sums(self._read(base, since)).filter("n_docs <> 0 or n_tokens <> 0")
