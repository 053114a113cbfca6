"""Fuzzy line dedup: of lines that are alike, one occurrence stays. DataFrame operations only.

Lines are normalised (lower case, letters and digits only, one blank between words). Lines that are then
equal are one class. The SimHash of a class is the majority of its words' 64-bit hashes, bit by
bit. Two classes are alike if their SimHashes differ in at most ``DISTANCE`` bits and the edit
similarity of the normalised lines is at least ``similar``. Of each connected group the
occurrence with the smallest (id, line number) stays, all others go.

Pigeonhole: with ``DISTANCE + agree`` blocks of bits, two SimHashes in reach of each other are equal
in ``agree`` blocks. Each choice of so many blocks is a key to join on; more blocks make keys
longer, and so chance meetings rarer, at the price of more keys. The result is the same.

Defined results: a null text stays null; lines without a letter or digit always stay; rows with the
same id and text are one document and lose the same lines; rows without an id come after all others.
"""

from __future__ import annotations

from functools import reduce
from itertools import batched, combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedlake.llm.linking import Near, link
from feedlake.llm.rows import column, pick
from feedlake.operators.keyed import MAX_BROADCAST_BYTES, restrict
from feedlake.operators.latest import free_name
from feedlake.session import discard, materialize

DISTANCE = 3
SIMILAR = 0.9
#: Keys of 32 bits: 20 per class, and classes that are not alike hardly ever meet.
AGREE = 3
#: Choices of blocks whose keys are dealt out at a time.
KEYS_AT_A_TIME = 4
#: Characters, and so words, of a line up to which four counts of 14 bits fit into one long.
FEW_CHARS = 16_000
#: Memory that the place of a line takes in a broadcast.
PLACE_BYTES = 64


def normalised(line: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(line), r"[^\p{L}\p{N}]+", " "))


def _lanes(lanes: int) -> int:
    """A long with a one in each of its ``lanes``."""
    return sum(1 << (64 // lanes * i) for i in range(lanes))


def simhash_of_words(hashes: Column, lanes: int) -> list[Column]:
    """Sums that hold, over a group of words, the count of each bit: ``lanes`` counts in each long."""
    return [F.sum(F.shiftright(hashes, k).bitwiseAND(F.lit(_lanes(lanes)))).alias(f"bits{k}") for k in range(64 // lanes)]


def _majority(words: Column, lanes: int) -> Column:
    """The 64 bits that are set in more than half of the words.

    All counts of a long are compared at once: with what is added, the second bit from the top of a lane is
    set where the count is above half, and the top one never is.
    """
    one, width = F.lit(_lanes(lanes)), 64 // lanes
    added = one * (F.lit((1 << (width - 2)) - 1) - F.floor(words / 2))
    above = [F.shiftleft(F.shiftright(F.col(f"bits{k}") + added, width - 2).bitwiseAND(one), k) for k in range(width)]
    return reduce(Column.bitwiseOR, above)


def _lines(docs: DataFrame, of: Column) -> DataFrame:
    """Lines with a letter or digit of which ``of`` holds. Both tests are cheap, and on the line as it is."""
    lines = docs.select("row", "id", F.posexplode(F.split("text", "\n", -1)).alias("pos", "line")).filter(of & F.col("line").rlike(r"[\p{L}\p{N}]"))
    lines = lines.select("row", "id", "pos", normalised(F.col("line")).alias("line"))
    return lines.select("row", "id", "pos", F.xxhash64("line").alias("k1"), F.xxhash64("line", F.lit(1)).alias("k2"), F.length("line").alias("n"), F.split("line", " ").alias("words"))


def _simhashed(lines: DataFrame, lanes: int) -> DataFrame:
    words = lines.select("row", "id", "pos", "k1", "k2", "n", F.explode("words").alias("word"))
    hashed = words.withColumn("word", F.xxhash64("word"))
    counts = hashed.groupBy("row", "id", "pos", "k1", "k2", "n").agg(F.count("*").alias("words"), *simhash_of_words(F.col("word"), lanes))
    return counts.select("row", "id", "pos", "k1", "k2", "n", _majority(F.col("words"), lanes).alias("simhash"))


def lines_of(docs: DataFrame) -> DataFrame:
    """A row per line with a word: row, id, pos, class keys k1 and k2, length and SimHash.

    Very long lines, which only very long texts can hold, are counted with wider counts.
    """
    few = _simhashed(_lines(docs, F.length("line") <= FEW_CHARS), lanes=4)
    many = _simhashed(_lines(docs.filter(F.length("text") > FEW_CHARS), F.length("line") > FEW_CHARS), lanes=2)
    return few.unionByName(many)


def block_keys(simhash: Column, agree: int) -> list[Column]:
    """One key for each choice of ``agree`` of the blocks, in arrays of a few."""
    blocks = DISTANCE + agree
    cuts = [64 * i // blocks for i in range(blocks + 1)]
    keys = []
    for chosen in combinations(range(blocks), agree):
        mask = sum(((1 << cuts[i + 1]) - (1 << cuts[i])) for i in chosen)
        mask -= (mask >> 63) << 64
        keys.append(F.xxhash64(F.lit(len(keys)), simhash.bitwiseAND(F.lit(mask))))
    return [F.array(*some) for some in batched(keys, KEYS_AT_A_TIME)]


def _confirm(docs: DataFrame, classes: DataFrame, similar: float):
    """Of pairs (a, b) of classes those with similar normalised lines, read where they first stand."""

    def confirm(pairs: DataFrame) -> DataFrame:
        ids = pairs.select(F.col("a").alias("k1")).union(pairs.select("b"))
        places = materialize(restrict(classes.select("k1", "first.row", "first.pos"), ids, "k1", "left_semi"), "places")
        # Where the places are few, lines are cut out where their texts lie, and no text is shuffled.
        few = places.count() * PLACE_BYTES <= MAX_BROADCAST_BYTES
        texts = docs.select("row", "text").join(F.broadcast(places) if few else places, "row")
        line = F.element_at(F.split("text", "\n", -1), F.col("pos") + 1)
        lines = materialize(texts.select("k1", normalised(line).alias("line")).distinct(), "lines")
        both = pairs.join(lines.toDF("a", "x"), "a").join(lines.toDF("b", "y"), "b")
        longest = F.greatest(F.length("x"), F.length("y"))
        most = F.floor((1 - similar) * longest + 1e-9).cast("int")
        links = materialize(both.withColumn("most", most).filter("levenshtein(x, y, most) >= 0").select("a", "b"), "similar", release=True)
        discard(places)
        discard(lines)
        return links

    return confirm


def repeated_lines(df: DataFrame, id_col: str, text_col: str, similar: float = SIMILAR, agree: int = AGREE) -> DataFrame:
    """(row, gone): for each document that loses lines, a hash of its id and text, and their numbers."""
    docs = _rows(pick(df, id=id_col, text=text_col), "id", "text")
    lines = materialize(lines_of(docs), "lines", release=True)
    first = F.min(F.struct(F.col("id").isNull().alias("late"), "id", "row", "pos")).alias("first")
    classes = lines.groupBy("k1", "k2").agg(first, F.count("*").alias("times"), F.min("n").alias("n"), F.min("simhash").alias("simhash"))
    classes = materialize(classes, "classes", release=True)
    near = Near("n", round(100 * similar), ("simhash",), DISTANCE)
    roots = link(classes.select(F.col("k1").alias("id"), "n", "simhash"), block_keys(F.col("simhash"), agree), near, _confirm(docs, classes, similar), sift=True)
    rooted = materialize(classes.select("k1", "k2", "first", "times").join(roots.toDF("k1", "root"), "k1", "left").withColumn("root", F.coalesce("root", "k1")), "rooted")
    groups = rooted.groupBy("root").agg(F.min("first").alias("stays"), F.sum("times").alias("times")).filter("times > 1").drop("times")
    groups = materialize(groups, "groups")
    several = materialize(rooted.select("k1", "k2", "root").join(groups, "root").select("k1", "k2", "stays.row", "stays.pos").toDF("k1", "k2", "stay_row", "stay_pos"), "several")
    gone = lines.join(several, ["k1", "k2"]).filter("row <> stay_row or pos <> stay_pos")
    out = materialize(gone.groupBy("row").agg(F.collect_set("pos").alias("gone")), "gone", release=True)
    for used in (lines, classes, rooted, groups, several):
        discard(used)
    return out


def _rows(df: DataFrame, id_col: str, text_col: str, name: str = "row") -> DataFrame:
    return df.withColumn(name, F.xxhash64(column(df, id_col), column(df, text_col)))


def dedup(df: DataFrame, id_col: str, text_col: str, similar: float = SIMILAR, agree: int = AGREE) -> DataFrame:
    """``df`` with the text without its repeated lines, and as its last columns ``_n_lines`` and ``_n_removed``,
    or free names like these where the table has such columns."""
    row, lost = (free_name(df.columns, x) for x in ("_row", "_gone"))
    gone = repeated_lines(df, id_col, text_col, similar, agree).toDF(row, lost)
    size = gone.agg(F.coalesce(F.sum(4 * F.size(lost) + 48), F.lit(0))).first()[0]
    marked = _rows(df, id_col, text_col, row).join(F.broadcast(gone) if size <= MAX_BROADCAST_BYTES else gone, row, "left")
    text = column(df, text_col)
    # The lines are bound once: named at each place, they would be split again for each line.
    numbers = lambda lines: F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), lost)
    kept = lambda lines: F.array_join(F.transform(numbers(lines), lambda i: F.get(lines, i)), "\n")
    left = F.transform(F.array(F.split(text, "\n", -1)), kept)[0]
    removed = F.coalesce(F.size(lost), F.lit(0))
    new = F.when(removed > 0, left).otherwise(text).alias(text_col)
    n_lines = free_name(df.columns, "_n_lines")
    ends = F.octet_length(text) - F.octet_length(F.replace(text, F.lit("\n"), F.lit("")))
    counts = [F.coalesce(ends + 1, F.lit(0)).alias(n_lines), removed.alias(free_name([*df.columns, n_lines], "_n_removed"))]
    return marked.select(*[new if c == text_col else column(df, c) for c in df.columns], *counts)
