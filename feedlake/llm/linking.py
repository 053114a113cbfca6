"""Connected groups of similar things, from keys that similar things share.

Only DataFrame operations. Work grows with the members of a key, not with their square:

1. Pairs: a key with two members needs no join, an aggregate holds all that is to be known of them.
2. Star: in a key with more members, each is compared with the smallest one. Where the cheap test of a pair costs a
   few instructions, members that pass it with no other member of the key can be dropped before (``sift``).
3. Keys whose members now all belong to one group are done.
4. In the others a second star is drawn around a member chosen by a hash.
5. What is still in different groups under one key is compared pair by pair, as far as a cheap
   test of both sides does not rule the pair out. So no link is lost that the keys offer. Where things
   are sets, parts that one of two sets has and the other cannot have rule out most of these pairs, and never a link.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from feedlake.session import discard, materialize


@dataclass(frozen=True)
class Near:
    """The cheap test: sizes of which the smaller is ``share`` percent of the larger at least, and
    bit columns that differ in ``most_bits`` bits at most."""

    size: str
    share: int
    bits: tuple[str, ...]
    most_bits: int

    @property
    def columns(self) -> list[str]:
        return [self.size, *self.bits]

    def _test(self, small: Column, large: Column, differ: list[Column]) -> Column:
        bits = sum((F.bit_count(d) for d in differ), F.lit(0))
        return (100 * small >= self.share * large) & (bits <= self.most_bits)

    def of(self, a: str, b: str) -> Column:
        """The test on two sides, named by the prefixes of their columns."""
        sizes = F.col(f"{a}.{self.size}"), F.col(f"{b}.{self.size}")
        return self._test(F.least(*sizes), F.greatest(*sizes), [F.col(f"{a}.{c}").bitwiseXOR(F.col(f"{b}.{c}")) for c in self.bits])

    def sums(self) -> list[Column]:
        """Aggregates over the members of a key that hold the test of a key with two."""
        return [F.min(self.size).alias("small"), F.max(self.size).alias("large"), *[F.bit_xor(c).alias(c) for c in self.bits]]

    def of_sums(self) -> Column:
        return self._test(F.col("small"), F.col("large"), [F.col(c) for c in self.bits])


def connected(edges: DataFrame) -> DataFrame:
    """(id, root) of every id that is not itself the smallest of its group; edges are (a, b).

    Each id is hung below its smallest neighbour, chains are shortened until they end in a root,
    and the edges are contracted to those between roots. Roots with edges at least halve each time.
    """
    a, b = F.col("a"), F.col("b")
    now = materialize(edges.select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo")).filter("hi <> lo").distinct(), "edges")
    roots = now.select(F.col("hi").alias("id"), F.col("lo").alias("root")).limit(0)
    while not now.isEmpty():
        up = materialize(now.groupBy(F.col("hi").alias("id")).agg(F.min("lo").alias("root")), "up")
        moved = True
        while moved:
            above = up.select(F.col("id").alias("root"), F.col("root").alias("top"))
            step = up.join(above, "root", "left").select("id", F.coalesce("top", "root").alias("root"), F.col("top").isNotNull().alias("moved"))
            last, up = up, materialize(step, "up")
            moved = not up.filter("moved").isEmpty()
            up = up.select("id", "root")
            discard(last)
        tops = up.select(F.col("id").alias("root"), F.col("root").alias("top"))
        held = roots.join(tops, "root", "left").select("id", F.coalesce("top", "root").alias("root")).union(up)
        roots = materialize(held, "roots")
        left = now.join(up.toDF("hi", "x"), "hi").join(up.toDF("lo", "y"), "lo", "left").select(F.col("x").alias("a"), F.coalesce("y", "lo").alias("b"))
        last = now
        now = materialize(left.select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo")).filter("hi <> lo").distinct(), "edges")
        discard(last)
    return roots


def link(
    facts: DataFrame,
    keys: Column | list[Column],
    near: Near,
    confirm: Callable[[DataFrame], DataFrame],
    alone: Callable[[DataFrame], DataFrame] | None = None,
    sift: bool = False,
) -> DataFrame:
    """(id, root) of all ids that are linked to a smaller one, directly or through others.

    ``facts`` has a row per id, with the columns of ``near``; ``keys`` is an array of long per row, or
    several of them, of which one at a time is spread out.
    ``near`` rules pairs out cheaply, ``confirm`` keeps the true ones of pairs (a, b). ``alone``,
    for sets of ``near.size`` parts: of given ids (id, own, and any columns of bits): the parts that none of
    the others has, and a bit for each value of a hash that a part of the set has. Ids may be missing.
    ``sift``: members of a key that pass the cheap test with no other one are dropped before the stars. It
    pays where the test is cheap and most members of a key meet by chance.
    """
    found = []
    for some in keys if isinstance(keys, list) else [keys]:
        # Dealt out by key once, at any size: what is to be known of a key is gathered and joined to its members where they lie.
        spread = facts.select("id", *near.columns, F.explode(some).alias("key")).repartition("key")
        sums = [F.min("id").alias("first"), F.max("id").alias("last"), F.count("*").alias("times"), *near.sums()]
        met = spread.groupBy("key").agg(*sums).filter((F.col("times") > 2) | ((F.col("times") == 2) & near.of_sums()))
        found.append(materialize(spread.join(met.select("key", "first", "last", "times").hint("merge"), "key"), "members", release=True))
    members = reduce(DataFrame.unionByName, found)
    shared = materialize(members.filter("times > 2").select("key", "id", *near.columns, "first"), "shared")
    if sift:
        last, shared = shared, materialize(_company(shared, near), "shared")
        discard(last)

    def confirmed(pairs: DataFrame) -> DataFrame:
        pairs = materialize(pairs.distinct(), "pairs")
        links = materialize(confirm(pairs) if not pairs.isEmpty() else pairs, "links", release=True)
        discard(pairs)
        return links

    def starred(rows: DataFrame, centres: DataFrame, where: str) -> DataFrame:
        """Pairs of the members of each key with its centre, as far as they may be near."""
        both = rows.alias("x").join(centres.alias("y"), F.col("x.key") == F.col("y.key")).filter(F.expr(where) & near.of("x", "y"))
        return both.select(F.least("x.id", "y.id").alias("a"), F.greatest("x.id", "y.id").alias("b"))

    two = members.filter("times = 2 and id = first").select(F.col("first").alias("a"), F.col("last").alias("b"))
    links = confirmed(two.union(starred(shared, shared.filter("id = first"), "x.id <> y.id")))
    for used in found:
        discard(used)
    shared, roots = _mixed(shared, near, connected(links))
    if not shared.isEmpty():
        star = starred(shared, shared.filter("spread = pick"), "x.root <> y.root")
        links = links.union(confirmed(star))
        shared, roots = _mixed(shared, near, connected(links))
    if not shared.isEmpty():
        test = F.expr("x.id < y.id and x.root <> y.root") & near.of("x", "y")
        if alone:
            own = materialize(alone(shared.select("id").distinct()), "own")
            masks = [c for c in own.columns if c not in ("id", "own")]
            last, shared = shared, materialize(_with_room(shared, own, near, masks), "shared")
            discard(last)
            discard(own)
            bits = sum((F.bit_count(F.col(f"x.{c}").bitwiseAND(F.col(f"y.{c}"))) for c in masks), F.lit(0))
            common = F.least("x.room", "y.room", bits + F.least("x.hidden", "y.hidden"))
            test &= (100 + near.share) * common >= near.share * (F.col(f"x.{near.size}") + F.col(f"y.{near.size}"))
        rest = shared.alias("x").join(shared.alias("y"), (F.col("x.key") == F.col("y.key")) & test)
        links = links.union(confirmed(rest.select(F.col("x.id").alias("a"), F.col("y.id").alias("b"))))
        roots = connected(links)
    discard(shared)
    return roots


def _company(shared: DataFrame, near: Near) -> DataFrame:
    """The members that pass the test with another member of their key, and the smallest of these. No other can have a link there."""
    test = (F.col("x.key") == F.col("y.key")) & (F.col("x.id") != F.col("y.id")) & near.of("x", "y")
    kept = shared.alias("x").join(shared.alias("y").hint("merge"), test, "left_semi").select("key", "id", *near.columns)
    return kept.withColumn("first", F.min("id").over(W.partitionBy("key")))


def _with_room(shared: DataFrame, own: DataFrame, near: Near, masks: list[str]) -> DataFrame:
    """The members with what bounds the parts that two of them have in common: no more than ``room`` of one side, and
    no more than the bits that both have and the ``hidden`` parts of one side, which have no bit to themselves.

    Where nothing is known of an id, its bits are all set and any number of parts is hidden.
    """
    size = F.col(near.size)
    held = sum((F.bit_count(c) for c in masks), F.lit(0))
    room = size - F.coalesce("own", F.lit(0))
    hidden = F.when(F.col("own").isNotNull(), size - held).otherwise(1 << 40) if masks else size
    kept = shared.join(own, "id", "left").select("key", "id", "root", *near.columns, room.alias("room"), hidden.cast("bigint").alias("hidden"), *masks)
    return kept.na.fill(-1, masks) if masks else kept


def _mixed(shared: DataFrame, near: Near, roots: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The members of keys under which several groups meet, with their group and a chosen member."""
    rows = shared.select("key", "id", *near.columns).join(roots, "id", "left").withColumn("root", F.coalesce("root", "id"))
    rows = materialize(rows.withColumn("spread", F.xxhash64("id", "key")), "shared")
    several = rows.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), F.min("spread").alias("pick"))
    several = materialize(several.filter("lo <> hi").select("key", "pick"), "several")
    out = materialize(rows.join(several, "key"), "shared")
    for used in (shared, rows, several):
        discard(used)
    return out, roots
