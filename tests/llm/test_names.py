"""Tables whose columns have the names that operators use, and one pass of the language model."""

import random

from pyspark.sql import functions as F

from feedlake.llm import langid, line_dedup, pfair


def test_line_dedup_beside_its_own_names(spark):
    df = spark.createDataFrame([(1, "a b\na b", 7, 8, 9, 10)], "id long, text string, _n_removed int, _n_lines int, _row int, _gone int")
    (row,) = line_dedup.dedup(df, "id", "text").collect()
    assert tuple(row) == (1, "a b", 7, 8, 9, 10, 2, 1)


def test_mix_beside_its_own_name(spark):
    df = spark.createDataFrame([(i, "s", "x") for i in range(9)], "id long, source string, _mix string")
    found = pfair.mix(df, "source", "id")
    assert found.columns == ["id", "source", "_mix", "_mix_"] and {r._mix for r in found.collect()} == {"x"}


def test_language_beside_its_own_names_and_in_one_pass(spark, sf_dir, capsys):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = langid.train(docs, "text", "lang", "doc_id")
    odd = docs.select("doc_id", "text", *[F.lit(c).alias(c) for c in ("_lang_pred", "_score", "_label", "lang", "score")])
    found = langid.predict(odd, "text", model)
    assert found.columns == [*odd.columns, "_lang_pred_", "_score_"]
    assert {r.doc_id: r._lang_pred_ for r in found.collect()} == {r.doc_id: r._lang_pred for r in langid.predict(docs, "text", model).collect()}
    assert {(r._lang_pred, r.score) for r in found.collect()} == {("_lang_pred", "score")}
    kept = found.filter((F.col("_lang_pred_") != "und") & (F.col("_score_") > 0.5)).select("doc_id", "_lang_pred_")
    capsys.readouterr()
    kept.explain()
    assert capsys.readouterr().out.count("ArrowEvalPython") == 1


def test_bits_of_short_and_very_long_lines(spark):
    """Both widths of counts against a plain majority."""
    draw, words = random.Random(1), ["a", "b", "cc", "dd", "é", "x1"]
    sizes = (1, 2, 3, 7, 8, 40, 9000, 40_000)
    text = "\n".join(" ".join(draw.choice(words) for _ in range(n)) for n in sizes)
    docs = spark.createDataFrame([(1, 1, text)], "row long, id long, text string")
    found = {r.pos: r.simhash for r in line_dedup.lines_of(docs).collect()}
    hashes = {r.w: r.h for r in spark.createDataFrame([(w,) for w in words], "w string").withColumn("h", F.xxhash64("w")).collect()}
    for pos, line in enumerate(text.split("\n")):
        own = [hashes[w] for w in line.split()]
        assert found[pos] % (1 << 64) == sum(1 << k for k in range(64) if 2 * sum((h >> k) & 1 for h in own) > len(own))


def test_slices_of_a_given_size():
    """Training reads texts in pieces as small as those of a prediction."""
    import pyarrow as pa

    from feedlake.llm.rows import slices

    batch = pa.record_batch([pa.array(["a" * 1000] * 10)], ["text"])
    assert [part.num_rows for part in slices(batch, "text", 2200)] == [2] * 5
    assert [part.num_rows for part in slices(batch, "text")] == [10]
