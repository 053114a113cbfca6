"""From documents to token ids: the stages in their order, and one run of all of them."""

from __future__ import annotations

import public_tokenizers
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlake.llm import bpe, langid, line_dedup, minhash_oph, pfair
from feedlake.llm.rows import column
from feedlake.session import discard, materialize

BPE_FILE = "byte_bpe_multi_50k.tiktoken"
#: Letters in the predicted language, as a share, below which a text is no language we know.
LEAST_SCORE = 0.2
#: Target weights: sources by this power of their number of documents.
MIX_POWER = 0.9


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without documents that have no letters, or hardly any in a script of a learned language.

    A missing ``lang`` is filled in; one that is there is left as it is.
    """
    model = langid.train(docs.filter(~langid.is_held_out(F.col("doc_id"))), "text", "lang", "doc_id")
    found = langid.predict(docs, "text", model)
    predicted, score = (column(found, c) for c in found.columns[-2:])
    lang = F.coalesce(predicted, F.lit("und"))
    stays = (lang != "und") & (score >= LEAST_SCORE)
    return found.filter(stays).select(*[F.coalesce(column(found, c), lang).alias(c) if c == "lang" else column(found, c) for c in docs.columns])


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without lines that stand elsewhere; documents of which no line is left go."""
    found = line_dedup.dedup(docs, "doc_id", "text")
    lost = column(found, found.columns[-1]) > 0
    stays = ~(lost & (F.trim("text") == "")) | F.col("text").isNull()
    n_chars = F.when(lost, F.length("text").cast("bigint")).otherwise(F.col("n_chars"))
    return found.filter(stays).select(*[n_chars.alias(c) if c == "n_chars" else column(found, c) for c in docs.columns])


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that shingles of five words link at a similarity of 0.8."""
    return minhash_oph.keep_one(docs, "doc_id", "text")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, in the order of their slots: the weights say where a document comes, not whether.

    The order is that of the files this is written to, and of the rows in them.
    """
    mixed = pfair.mix(docs, "source", "doc_id", power=MIX_POWER)
    slot = column(mixed, mixed.columns[-1])["slot"]
    return mixed.orderBy(slot, "doc_id").select([column(mixed, c) for c in docs.columns])


def with_place(docs: DataFrame) -> DataFrame:
    """``docs`` with ``mix_file`` and ``mix_row``: where a document stands in the files it is read from.

    Sorting by both gives back the order in which the table was written. Null for a table that comes from no files.
    """
    name, row = F.regexp_extract("_metadata.file_name", "^part-([0-9]+)", 1), F.col("_metadata.row_index")
    try:
        return docs.select("*", F.try_to_number(name, F.lit("9999999999")).cast("int").alias("mix_file"), row.alias("mix_row"))
    except AnalysisException:
        return docs.select("*", F.lit(None).cast("int").alias("mix_file"), F.lit(None).cast("bigint").alias("mix_row"))


def encode_and_decode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, lang, the place in the mix, and the tokens of the text: their number, a digest, and one of what
    they decode to."""
    keys = ["doc_id", "source", "lang", "mix_file", "mix_row"]
    return bpe.round_trip(with_place(docs), keys, "text", public_tokenizers.path(BPE_FILE), public_tokenizers.PATTERN)


STAGES = [
    ("language ID", identify_language),
    ("line dedup", drop_repeated_lines),
    ("near-dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("byte-level BPE", encode_and_decode),
]

#: SQL has no language model, no SimHash and no such tokenizer; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after another, each written to the shared folder and read again.

    ``orderBy("mix_file", "mix_row")`` of the result is the mix.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        before, docs = docs, materialize(stage(spark, docs, sf_dir), f"stage{i}")
        discard(before)
    return docs
