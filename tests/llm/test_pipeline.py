"""The queries against their SQL, and the pipeline stage by stage."""

import hashlib

import duckdb
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline
from feedlake.llm import bpe, pfair
from feedlake.llm.queries import ORACLES, QUERIES
from feedlake.session import materialize


def as_rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(repr(row[i]) for i in order) for row in rows)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, sf_dir, name):
    with duckdb.connect() as con:
        for table in ("documents", "embeddings"):
            con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')")
        want = con.execute(ORACLES[name])
        got = QUERIES[name](spark, sf_dir)
        names = [c[0] for c in want.description]
        assert as_rows(got.columns, got.collect()) == as_rows(names, want.fetchall())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_has_a_row_for_each_of_its_table(spark, sf_dir, name):
    found = QUERIES[name](spark, sf_dir)
    table = "embeddings" if name.startswith("op9") else "pages" if name.startswith("op2") else "documents"
    rows = spark.read.parquet(f"{sf_dir}/{table}.parquet").count()
    assert found.count() == (rows // 100 * 10 if table == "embeddings" else rows)


ODD = [
    (1, "The and of the in that it is", "en", "a", 28, "x"), (1, "The and of the in that it is", "en", "a", 28, "x"), (2, None, "en", "a", None, "x"), (3, "", None, None, 0, None),
    (None, "The and that is of it", None, "b", 21, "x"), (4, "12 34 !!", "de", "b", 8, "x"), (5, "über die der und das ist nicht", "de", "b", 30, "x"),
    (6, "THE and of the in that it is!", "en", "c", 29, "x"),
]


def test_stages_on_odd_rows(spark, sf_dir):
    df = spark.createDataFrame(ODD, "doc_id long, text string, lang string, source string, n_chars long, component_id string")
    train = spark.read.parquet(f"{sf_dir}/documents.parquet").withColumn("component_id", F.lit("y"))
    for name, stage in corpus_pipeline.STAGES:
        some = stage(spark, df.unionByName(train) if name == "language ID" else df, sf_dir)
        none = stage(spark, df.limit(0), sf_dir)
        assert none.isEmpty()
        if name != corpus_pipeline.STAGES[-1][0]:
            assert some.columns == df.columns and none.columns == df.columns
        some.collect()


def test_language_stage_keeps_what_has_a_language(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    odd = spark.createDataFrame([(9001, "!! 12", "en", "s", 5), (9002, None, "en", "s", None)], docs.schema)
    kept = corpus_pipeline.identify_language(spark, docs.union(odd), sf_dir)
    assert sorted(r.doc_id for r in kept.collect()) == sorted(r.doc_id for r in docs.filter("text rlike '\\\\p{L}'").collect())


def test_run_is_the_stages_in_a_row(spark, sf_dir):
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    real = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        before, docs = docs, stage(spark, docs, sf_dir)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        rows = docs.collect()
        assert {r.doc_id for r in rows} <= {r.doc_id for r in before.collect()} and len({r.doc_id for r in rows}) == len(rows)
        docs = spark.createDataFrame(rows, docs.schema)
    found = corpus_pipeline.run(spark, sf_dir).collect()
    assert sorted(r.doc_id for r in found) == sorted(r.doc_id for r in rows)
    texts = {r.doc_id: r.text for r in rows}
    for r in found:
        ids = real.encode_ordinary(texts[r.doc_id])
        assert (r.n_tokens, r.decoded_sha256) == (len(ids), hashlib.sha256(texts[r.doc_id].encode()).hexdigest())


def test_mixing_keeps_every_document(spark, sf_dir):
    rows = [(i, "t", "en", "hot" if i < 200 else f"s{i % 29}", 1) for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    found = corpus_pipeline.mix_sources(spark, docs, sf_dir).collect()
    assert sorted(r.doc_id for r in found) == list(range(600))
    # What a source has beyond its weight comes last: the rest is through before it is.
    assert {r.source for r in found[-8:]} == {"hot"}


def test_the_last_table_in_its_order_is_the_mix(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:3]:
        docs = materialize(stage(spark, docs, sf_dir))
    mixed = pfair.mix(docs, "source", "doc_id", power=corpus_pipeline.MIX_POWER)
    want = [r.doc_id for r in mixed.orderBy("_mix.slot", "doc_id").collect()]
    found = corpus_pipeline.run(spark, sf_dir)
    assert [r.doc_id for r in found.orderBy("mix_file", "mix_row").collect()] == want
    assert len({r.source for r in mixed.collect()}) > 2 and want != sorted(want)
