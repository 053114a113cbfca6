"""Mixing sources to target weights by Pfair scheduling. DataFrame operations only.

Time runs in slots, one block of documents each. A source of weight w has to place its j-th block
between the release time floor((j - 1) / w) and the deadline ceil(j / w). Earliest deadline first among the
released blocks keeps every source within less than one block of weight times slots, at every
slot. Weights are whole shares of a period, so the schedule repeats and only one period of it is
worked out: a row per slot, whatever the number of documents. A period grows with the number of
sources, so that a share is within a fiftieth of its weight and two slots a period.

Documents are numbered within their source by the MD5 of their id. Every document gets a slot. Up
to the first block that a source does not have the mix is exact (``exact``). After that the slots
of sources that have run out stay empty, and the others keep theirs. The mix is as many slots as
there are blocks (``in_mix``): a source that has less than its weight is in it whole, one that has
more is in it with its weight, to less than one block.

Defined results: a null source is a source of its own; a source without a target weight (or with
weight 0) has no slots and is not in the mix; rows of one id follow each other; an empty table
gives an empty result.
"""

from __future__ import annotations

from math import isqrt

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from feedlake.llm.rows import column
from feedlake.operators.latest import free_name
from feedlake.session import materialize

BLOCK = 8
PERIOD = 1000
#: Slots a source that a period has at least: one of them goes to each source whatever its weight.
SLOTS_PER_SOURCE = 50
#: The default target weight of a source is this power of its number of documents.
POWER = 0.7


def shares(weights: DataFrame, period: int | None = None) -> DataFrame:
    """(source, share): whole shares of a period, one at least, by largest remainders.

    ``weights`` has a row per source. Without ``period`` there are ``PERIOD`` slots, or
    ``SLOTS_PER_SOURCE`` for each source where that is more. A given period is as long as the
    number of sources where that is more.
    """
    every = W.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    rows = weights.filter("weight > 0").withColumn("all", F.sum("weight").over(every)).withColumn("sources", F.count("*").over(every))
    # Each source has one share; the rest of the period is dealt by weight.
    length = F.greatest(F.lit(PERIOD), F.col("sources") * SLOTS_PER_SOURCE) if period is None else F.lit(period)
    rest = F.greatest(length - F.col("sources"), F.lit(0))
    rows = rows.withColumn("exact", F.col("weight") / F.col("all") * rest).withColumn("whole", F.floor("exact"))
    rows = rows.withColumn("open", rest - F.sum("whole").over(every))
    nth = F.row_number().over(W.orderBy(F.desc(F.round(F.col("exact") - F.col("whole"), 9)), F.col("source")))
    return rows.withColumn("nth", nth).select("source", (1 + F.col("whole") + F.when(F.col("nth") <= F.col("open"), 1).otherwise(0)).cast("bigint").alias("share"))


def _bound(value: Column, use) -> Column:
    """``use`` of a value that is worked out once, not at each place that names it."""
    return F.transform(F.array(value), use)[0]


def one_period(shares: DataFrame) -> DataFrame:
    """(source, share, period, turn, at): the slot of each block of a source in each period.

    Runs earliest deadline first over the slots of a single row. Sources of one share have the same
    release times and deadlines, so they take turns in the order of their names: a step looks at
    one source of each share, of which there are at most sqrt(2 * period).
    """
    alike = shares.groupBy("share").agg(F.array_sort(F.collect_list("source")).alias("sources"))
    row = alike.agg(
        F.array_sort(F.collect_list(F.struct("share", "sources"))).alias("s"),
        F.coalesce(F.sum(F.col("share") * F.size("sources")), F.lit(0)).alias("period"),
    ).filter("period > 0")

    def step(state: Column, slot: Column) -> Column:
        def candidate(done: Column, i: Column) -> Column:
            share, sources = F.col("s")[i]["share"], F.col("s")[i]["sources"]
            turn = F.floor(done / F.size(sources))
            free = (F.floor(turn * F.col("period") / share) <= slot) & (turn < share)
            deadline = F.ceil((turn + 1) * F.col("period") / share)
            return F.when(free, F.struct(deadline.alias("deadline"), sources[(done % F.size(sources)).cast("int")].alias("source"), i.alias("i"), turn.alias("turn")))

        def taken(pick: Column) -> Column:
            done = F.transform(state["done"], lambda d, i: F.when(i == pick["i"], d + 1).otherwise(d))
            place = F.struct(slot.alias("at"), pick["source"].alias("source"), F.col("s")[pick["i"]]["share"].alias("share"), pick["turn"].alias("turn"))
            return F.struct(done.alias("done"), F.concat(state["order"], F.array(place)).alias("order"))

        return _bound(F.array_min(F.transform(state["done"], candidate)), taken)

    # The order grows by stretches, so that it is not copied at each slot.
    length = F.ceil(F.sqrt("period")).cast("int")
    nothing = F.array().cast("array<struct<at:int,source:string,share:bigint,turn:bigint>>")

    def stretch(state: Column, begin: Column) -> Column:
        slots = F.sequence(begin, F.least(begin + length, F.col("period").cast("int")) - 1)
        run = F.aggregate(slots, F.struct(state["done"].alias("done"), nothing.alias("order")), step)
        return _bound(run, lambda r: F.struct(r["done"].alias("done"), F.concat(state["order"], F.array(r["order"])).alias("order")))

    start = F.struct(F.transform("s", lambda _: F.lit(0).cast("bigint")).alias("done"), F.array().cast("array<array<struct<at:int,source:string,share:bigint,turn:bigint>>>").alias("order"))
    run = F.aggregate(F.sequence(F.lit(0), F.col("period").cast("int") - 1, length), start, stretch, lambda state: F.flatten(state["order"]))
    return row.select("period", F.inline(run)).select("source", "share", "period", "turn", "at")


def _keyed(df: DataFrame, source_col: str, id_col: str) -> DataFrame:
    """Rows as structs, a name of the source that is never null, and the order within it."""
    source = F.coalesce(F.concat(F.lit("="), column(df, source_col).cast("string")), F.lit(""))
    order = F.md5(F.coalesce(column(df, id_col).cast("string"), F.lit("")).cast("binary"))
    return df.select(F.struct(*[column(df, c) for c in df.columns]).alias("row"), source.alias("source"), order.alias("place"))


def _numbered(rows: DataFrame, largest: int, lengths: DataFrame) -> DataFrame:
    """``rows`` with ``n``, the number of the row in its source, from 0, and the columns of ``lengths``, a row per source.

    A source is cut into ranges of the order, about as many as a range has rows, so that no task
    holds a whole source: rows are counted by range, then numbered inside each.
    """
    ranges = isqrt(largest) + 1
    part = F.floor(F.conv(F.substring("place", 1, 8), 16, 10).cast("bigint") * ranges / F.lit(1 << 32)).cast("int")
    counts = rows.groupBy("source", part.alias("part")).count()
    before = F.sum("count").over(W.partitionBy("source").orderBy("part").rowsBetween(W.unboundedPreceding, -1))
    begins = counts.select("source", "part", F.coalesce(before, F.lit(0)).alias("before"))
    begins = materialize(begins.join(lengths, "source", "left"), "ranges")
    nth = F.row_number().over(W.partitionBy("source", "part").orderBy("place", F.xxhash64(F.col("row").cast("string")))) - 1
    return rows.withColumn("part", part).withColumn("nth", nth).join(begins, ["source", "part"]).withColumn("n", F.col("before") + F.col("nth"))


def mix(df: DataFrame, source_col: str, id_col: str, weights: dict[str, float] | None = None, block: int = BLOCK, period: int | None = None, power: float = POWER) -> DataFrame:
    """``df`` with a struct ``_mix`` as its last column (a free name like it where there is such a column): share, period,
    block, release, deadline, slot, in_mix, exact; null without a weight.

    Without ``weights`` the target of a source is the power ``power`` of its number of rows.
    """
    rows = _keyed(df, source_col, id_col)
    counts = materialize(rows.groupBy("source").agg(F.count("*").alias("rows")), "sources")
    if weights is None:
        target = counts.withColumn("weight", F.pow("rows", F.lit(power)))
    else:
        listed = df.sparkSession.createDataFrame([("=" + k, float(v)) for k, v in weights.items()], "source string, weight double")
        target = counts.join(listed, "source")
    plan = materialize(one_period(shares(target.select("source", "weight"), period)), "plan")
    # The first block that a source lacks ends the exact part; as many slots as there are blocks are the mix.
    slot = lambda number: F.floor(number / F.col("share")) * F.col("period") + F.col("at")
    blocks = F.ceil(F.col("rows") / block)
    ends = counts.join(plan, "source").filter(blocks % F.col("share") == F.col("turn"))
    found = ends.agg(F.min(slot(blocks)).alias("exact"), F.sum(blocks).alias("all")).first()
    largest = counts.agg(F.max("rows")).first()[0] or 0
    # The plan has a row per slot and is joined by source and turn: a large source has as many keys as its share.
    numbered = _numbered(rows, largest, plan.filter("turn = 0").select("source", "share", "period"))
    numbered = numbered.withColumn("block", F.floor(F.col("n") / block)).withColumn("turn", F.coalesce(F.col("block") % F.col("share"), F.col("block")))
    placed = numbered.join(plan.select("source", "turn", "at"), ["source", "turn"], "left")
    mixed = placed.withColumn("slot", slot(F.col("block"))).select("row", F.when(F.col("share").isNotNull(), F.struct(
        "share", "period", "block",
        F.floor(F.col("block") * F.col("period") / F.col("share")).alias("release"),
        F.ceil((F.col("block") + 1) * F.col("period") / F.col("share")).alias("deadline"),
        "slot", (F.col("slot") < F.lit(found["all"])).alias("in_mix"), (F.col("slot") < F.lit(found["exact"])).alias("exact"),
    )).alias("mix"))
    return mixed.select("row.*", F.col("mix").alias(free_name(df.columns, "_mix")))
