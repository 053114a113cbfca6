"""What line dedup carries along: members of crowded keys, lines of pairs, the split text."""

from pyspark.sql import functions as F

from feedlake.llm import line_dedup, linking
from feedlake.llm.linking import Near, link


def _carried(monkeypatch, module):
    """Names, rows and plans of the work tables that ``module`` writes."""
    seen, write = [], module.materialize

    def noted(df, name="cut", release=False):
        out = write(df, name, release)
        seen.append((name, out.count(), df._jdf.queryExecution().optimizedPlan().toString()))
        return out

    monkeypatch.setattr(module, "materialize", noted)
    return seen


def test_members_that_meet_by_chance_go_before_the_stars(spark, monkeypatch):
    # One key for all: ids 0 to 39 are far from everything, 40 to 42 differ in a bit, 43 has these bits and another size.
    far = [(i, 100, ((1 << 60) - 1) // 40 * i ^ (0x5DEECE66D1234567 * i & (1 << 62) - 1)) for i in range(1, 40)]
    near = [(40, 100, -1), (41, 100, -2), (42, 95, -3), (43, 50, -1)]
    assert all((x ^ y).bit_count() > 3 for _, _, x in far for _, _, y in far if x != y)
    facts = spark.createDataFrame(far + near, "id bigint, n int, simhash bigint")
    seen = _carried(monkeypatch, linking)
    found = link(facts, F.array(F.lit(7).cast("bigint")), Near("n", 90, ("simhash",), 3), lambda pairs: pairs, sift=True)
    assert sorted(map(tuple, found.collect())) == [(41, 40), (42, 40)]
    rows = [n for name, n, _ in seen if name == "shared"]
    assert rows[0] == 43 and max(rows[1:]) == 3


def test_sifted_links_are_all_links(spark):
    # Two groups and strangers under one key; the smallest member is a stranger.
    facts = spark.createDataFrame(
        [(1, 10, 0), (2, 10, -1), (3, 10, -2), (4, 10, 0xFFFF), (5, 10, 0xFFFE), (6, 10, 0xFFFC), (7, 10, -4)], "id bigint, n int, simhash bigint"
    )
    near = Near("n", 90, ("simhash",), 1)
    keys = F.array(F.lit(7).cast("bigint"))
    found = [sorted(map(tuple, link(facts, keys, near, lambda pairs: pairs, sift=sift).collect())) for sift in (False, True)]
    assert found[0] == found[1] == [(3, 2), (5, 4), (6, 4), (7, 2)]


def test_texts_of_pairs_are_not_shuffled(spark, monkeypatch):
    words = " ".join(f"word{i}" for i in range(40))
    docs = spark.createDataFrame([(1, words), (2, f"{words}\nother"), (3, f"first\n{words}.x"), (3, f"first\n{words}.x")], "id bigint, text string")
    seen = _carried(monkeypatch, line_dedup)
    pairs = spark.createDataFrame([(1, 2)], "a bigint, b bigint")
    rows = line_dedup._rows(docs, "id", "text")
    place = lambda k, i, pos: (k, rows.filter(f"id = {i}").first()["row"], pos)
    classes = spark.createDataFrame([place(1, 1, 0), place(2, 3, 1)], "k1 bigint, row bigint, pos int").select("k1", F.struct("row", "pos").alias("first"))
    assert [tuple(r) for r in line_dedup._confirm(rows, classes, 0.9)(pairs).collect()] == [(1, 2)]
    (plan,) = [plan for name, _, plan in seen if name == "lines"]
    assert "first(text" not in plan and "strategy=broadcast" in plan
    assert [n for name, n, _ in seen if name == "lines"] == [2]


def test_a_text_is_split_once_for_all_its_lines(spark):
    df = spark.createDataFrame([(1, "a b c\nsame line here\n\nd"), (2, "same line here\ne"), (3, None), (4, "")], "id bigint, text string")
    found = line_dedup.dedup(df, "id", "text")
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("split(text") == 1
    assert {r.id: r.text for r in found.collect()} == {1: "a b c\nsame line here\n\nd", 2: "e", 3: None, 4: ""}
