"""The queries of this package: each applies one operator to its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlake.llm import (
    bpe, cross_polytope, fingerprint, hard_negatives, html_density, infill, langid, line_dedup, minhash_oph, pfair, pii, rendezvous, token_rollup,
)
from feedlake.llm.rows import hash_text
from feedlake.session import materialize, work_path

BPE_FILE = "byte_bpe_multi_50k.tiktoken"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_pii(spark, sf_dir):
    """Counts are of the base spans; ``n_added`` is what the transducers found besides."""
    found = pii.find_pii(_table(spark, sf_dir, "documents"), "doc_id", "text")

    def place(s):
        return F.concat_ws(":", s["kind"], s["start"], s["end"])

    def of_kind(name):
        return lambda s: s["kind"] == name

    counts = [F.size(F.filter("base", of_kind(k))).cast("long").alias(f"n_{k}") for k in pii.KINDS]
    ordered = F.concat(*[_by_start(F.filter(F.concat("base", "added"), of_kind(k))) for k in pii.KINDS])
    return found.select(
        "doc_id",
        *counts,
        F.sha2(F.array_join(F.transform("base", place), ",").cast("binary"), 256).alias("base_sha256"),
        F.array_join(F.transform(ordered, place), ",").alias("spans"),
        F.size("added").cast("long").alias("n_added"),
    )


def _by_start(spans):
    return F.array_sort(spans, lambda a, b: a["start"].cast("int") - b["start"].cast("int"))


def op2_html_extraction(spark, sf_dir):
    pages = _table(spark, sf_dir, "pages")
    found = html_density.main_text(pages, ["page_id", "url"], "html")
    text = F.array_join("blocks", " ")
    return found.select("page_id", "url", text.alias("text"), F.length(text).cast("long").alias("n_chars"), F.size("blocks").alias("n_blocks"))


def op5_language_id(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents")
    held_out = langid.is_held_out(F.col("doc_id"))
    model = langid.train(docs.filter(~held_out), "text", "lang", "doc_id")
    found = langid.label_spans(docs, "doc_id", "text", model)
    return found.select("doc_id", held_out.alias("held_out"), F.col("lang").alias("lang_pred"), "score", F.size("spans").alias("n_spans"))


def op8_byte_bpe(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents")
    return bpe.round_trip(docs, ["doc_id"], "text", public_tokenizers.path(BPE_FILE), public_tokenizers.PATTERN)


def op10_document_fingerprints(spark, sf_dir):
    found = fingerprint.follow(_table(spark, sf_dir, "documents"), "doc_id", "text")
    return found.withColumn("edited", hash_text(F.col("edited"))).withColumnRenamed("edited", "edited_sha256")


#: Counts by tokenizer version; both are plain patterns, so that SQL has them too.
WORD = r"[^\x20\x09-\x0D]+"
PIECE = r"\p{L}+|\p{N}+|[^\x20\x09-\x0D\p{L}\p{N}]+"
TOKENIZERS = {"words-1": WORD, "pieces-1": PIECE}
#: Signs that a later clean-up of the texts takes out.
DECORATION = r"[#*$%&]{3}"
LEAST_TOKENS = 20
SHARDS = 24


def op3_token_rollup(spark, sf_dir):
    """Three batches, one of them delivered twice: all documents come in; texts lose their decoration
    and counts are revised; documents of fewer than ``LEAST_TOKENS`` tokens go."""
    docs = _table(spark, sf_dir, "documents")
    text = F.coalesce("text", F.lit(""))
    plain = F.regexp_replace(text, DECORATION, "")
    counts = [
        F.struct(F.lit(name).alias("tokenizer"), F.regexp_count(text, F.lit(p)).alias("old"), F.regexp_count(plain, F.lit(p)).alias("new"))
        for name, p in TOKENIZERS.items()
    ]
    counts = materialize(docs.select("source", "lang", F.inline(F.array(*counts))), "counts")

    def changes(kind: str, old, new, rows):
        return rows.select(F.lit(kind).alias("change"), "source", "lang", "tokenizer", old.cast("bigint").alias("old_tokens"), new.cast("bigint").alias("new_tokens"))

    none = F.lit(None)
    revised = changes("revise", F.col("old"), F.col("new"), counts.filter("old <> new"))
    rollup = token_rollup.Rollup(spark, work_path(spark, "rollup"))
    rollup.commit("load", changes("insert", none, F.col("old"), counts))
    rollup.commit("clean-up", revised)
    rollup.commit("clean-up", revised)
    rollup.commit("takedown", changes("delete", F.col("new"), none, counts.filter(F.col("new") < LEAST_TOKENS)))
    return rollup.totals()


def op4_fuzzy_line_dedup(spark, sf_dir):
    found = line_dedup.dedup(_table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id", "text")
    return found.withColumnsRenamed({"_n_lines": "n_lines", "_n_removed": "n_removed"})


def op6_minhash_near_dedup(spark, sf_dir):
    return minhash_oph.components(_table(spark, sf_dir, "documents"), "doc_id", "text", size=2)


def op7_pfair_mix(spark, sf_dir):
    found = pfair.mix(_table(spark, sf_dir, "documents").select("doc_id", "source"), "source", "doc_id")
    return found.select("doc_id", "source", "_mix.*")


def op9_nearest_neighbours(spark, sf_dir):
    rows = _table(spark, sf_dir, "embeddings")
    return cross_polytope.neighbours(rows, "vec_id", "embedding", F.col("id") % 100 == 0)


def op11_rendezvous_shards(spark, sf_dir):
    """24 shards of one weight; the slot of a document is its number in its shard."""
    docs = _table(spark, sf_dir, "documents")
    found = rendezvous.numbered(rendezvous.sizes(docs, "doc_id", "text", [1.0] * SHARDS, grown=1.0))
    return found.withColumnRenamed("key", "doc_id").withColumn("law", F.lit("key"))


def op12_hard_negatives(spark, sf_dir):
    """Some labels are moved first, so that near rows of other labels are there."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(_table(spark, sf_dir, "embeddings"), "vec_id", "embedding", label, F.col("id") % 100 == 0)


def op13_fill_in_middle(spark, sf_dir):
    found = infill.restore(infill.transform(_table(spark, sf_dir, "documents"), "doc_id", "text"))
    digests = [hash_text(F.col(c)).alias(f"{c}_sha256") for c in ("output", "restored")]
    return found.select(F.col("id").alias("doc_id"), "n", "form", "prefix_chars", "middle_chars", *digests)


QUERIES = {
    f.__name__: f
    for f in (
        op1_pii, op2_html_extraction, op3_token_rollup, op4_fuzzy_line_dedup, op5_language_id, op6_minhash_near_dedup,
        op7_pfair_mix, op8_byte_bpe, op9_nearest_neighbours, op10_document_fingerprints,
        op11_rendezvous_shards, op12_hard_negatives, op13_fill_in_middle,
    )
}

#: The same in SQL. The other operators train, walk a tree, tokenize, hash or search by means that
#: SQL does not have; their tests compare with brute force, round trips or held-out rows.
ORACLES: dict[str, str] = {
    "op3_token_rollup": r"""
WITH c AS (SELECT doc_id, source, lang, coalesce(text, '') AS t, regexp_replace(coalesce(text, ''), '[#*$%&]{3}', '', 'g') AS p FROM documents),
n AS (SELECT source, lang, 'words-1' AS tokenizer, len(regexp_extract_all(t, '[^\x20\x09-\x0D]+')) AS old, len(regexp_extract_all(p, '[^\x20\x09-\x0D]+')) AS new FROM c
      UNION ALL SELECT source, lang, 'pieces-1', len(regexp_extract_all(t, '\p{L}+|\p{N}+|[^\x20\x09-\x0D\p{L}\p{N}]+')), len(regexp_extract_all(p, '\p{L}+|\p{N}+|[^\x20\x09-\x0D\p{L}\p{N}]+')) FROM c)
SELECT source, lang, tokenizer, count(*)::BIGINT AS n_docs, sum(new)::BIGINT AS n_tokens FROM n WHERE new >= 20 GROUP BY ALL""",
    "op6_minhash_near_dedup": r"""
WITH RECURSIVE w AS MATERIALIZED (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS MATERIALIZED (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 2 THEN list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) WHEN len(w) = 1 THEN w ELSE []::VARCHAR[] END) AS g FROM w),
n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
link AS MATERIALIZED (SELECT a, b FROM common JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 80 * (x.n + y.n - c)),
edge AS MATERIALIZED (SELECT a, b FROM link UNION ALL SELECT b, a FROM link),
reach AS (SELECT doc_id AS id, doc_id AS root FROM documents UNION SELECT e.b, r.root FROM reach r JOIN edge e ON e.a = r.id WHERE r.root < e.b)
SELECT d.doc_id, coalesce(max(n.n), 0)::BIGINT AS n_shingles, min(r.root) AS component_id, d.doc_id = min(r.root) AS kept
FROM documents d LEFT JOIN n USING (doc_id) JOIN reach r ON r.id = d.doc_id GROUP BY d.doc_id""",
    "op7_pfair_mix": r"""
WITH RECURSIVE c AS (SELECT '=' || source AS s, source, count(*) AS n FROM documents GROUP BY source),
t AS (SELECT *, power(n, 0.7) / sum(power(n, 0.7)) OVER () * greatest(1000 - count(*) OVER (), 0) AS exact, count(*) OVER () AS sources FROM c),
f AS (SELECT *, floor(exact) AS whole, greatest(1000 - sources, 0) - sum(floor(exact)) OVER () AS open FROM t),
a AS (SELECT s, source, n, (1 + whole + CASE WHEN row_number() OVER (ORDER BY round(exact - whole, 9) DESC, s) <= open THEN 1 ELSE 0 END)::BIGINT AS share FROM f),
l AS (SELECT list(share ORDER BY s) AS shares, sum(share)::BIGINT AS period FROM a),
run AS (SELECT 0::BIGINT AS t, list_transform(shares, lambda x: 0::BIGINT) AS done, NULL::BIGINT AS pick FROM l
  UNION ALL SELECT t + 1, list_transform(done, lambda d, i: d + CASE WHEN i = p THEN 1 ELSE 0 END), p FROM (
    SELECT t, done, list_min(list_transform(list_filter(range(1, len(shares) + 1), lambda i: done[i] < shares[i] AND (done[i] * period) // shares[i] <= t),
      lambda i: {'d': ((done[i] + 1) * period + shares[i] - 1) // shares[i], 'i': i})).i AS p FROM run, l WHERE t < period)),
k AS (SELECT t - 1 AS slot, pick, row_number() OVER (PARTITION BY pick ORDER BY t) - 1 AS k FROM run WHERE pick IS NOT NULL),
o AS (SELECT *, row_number() OVER (ORDER BY s) AS i FROM a),
plan AS (SELECT o.s, o.share, k.k, k.slot FROM k JOIN o ON o.i = k.pick),
b AS (SELECT doc_id, source, '=' || source AS s, (row_number() OVER (PARTITION BY source ORDER BY md5(doc_id::VARCHAR)) - 1) // 8 AS block FROM documents),
ends AS (SELECT min((ceil(n / 8)::BIGINT // a.share) * period + slot) AS exact, sum(ceil(n / 8))::BIGINT AS alls FROM a JOIN plan p ON p.s = a.s AND p.k = ceil(n / 8)::BIGINT % a.share, l)
SELECT doc_id, source, p.share, period, block, (block * period) // p.share AS release, ((block + 1) * period + p.share - 1) // p.share AS deadline,
  (block // p.share) * period + p.slot AS slot, (block // p.share) * period + p.slot < alls AS in_mix, (block // p.share) * period + p.slot < exact AS exact
FROM b JOIN plan p ON p.s = b.s AND p.k = block % p.share, l, ends""",
    "op11_rendezvous_shards": r"""
WITH RECURSIVE bits AS (SELECT i AS b, 0 AS step, i::BIGINT AS c FROM range(256) r(i)
  UNION ALL SELECT b, step + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM bits WHERE step < 8),
crc AS MATERIALIZED (SELECT list(c ORDER BY b) AS t FROM bits WHERE step = 8),
d AS MATERIALIZED (SELECT coalesce(doc_id::VARCHAR, '') AS k, doc_id, (octet_length(encode(coalesce(text, ''))) + 8)::BIGINT AS size,
  xor(list_reduce(list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda h: ('0x' || h)::BIGINT), lambda c, b: xor(t[xor(c & 255, b) + 1], c >> 8), 4294967295::BIGINT), 4294967295) AS text_crc32 FROM documents, crc),
s AS (SELECT k, i, -ln((('0x' || substr(md5(k || ':' || i), 1, 13))::BIGINT + 0.5::DOUBLE) / 4503599627370496) AS score FROM (SELECT DISTINCT k FROM d), range(25) r(i)),
a AS (SELECT k, arg_min(i, (score, i)) FILTER (i < 24)::INTEGER AS shard, arg_min(i, (score, i))::INTEGER AS grown_shard FROM s GROUP BY k),
p AS (SELECT doc_id, size, text_crc32, shard, grown_shard, (row_number() OVER (PARTITION BY doc_id, size, text_crc32) - 1) // 65536 AS piece FROM d JOIN a USING (k))
SELECT doc_id, size, text_crc32, 'key' AS law, shard, grown_shard,
  row_number() OVER (PARTITION BY shard ORDER BY md5(concat_ws(':', coalesce(doc_id::VARCHAR, ''), size, text_crc32, shard, grown_shard, piece))) - 1 AS slot FROM p""",
    "op12_hard_negatives": r"""
WITH v AS MATERIALIZED (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS MATERIALIZED (SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same, list_inner_product(a.q, b.q)::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.q) = len(b.q) WHERE a.vec_id % 100 = 0),
p AS (SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT p.anchor_id, positive_id, (row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.id))::INTEGER AS rank, s.id AS negative_id, positive_score, s.score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT same AND 80 * positive_score <= 100 * s.score AND 100 * s.score <= 100 * positive_score
QUALIFY row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.id) <= 5""",
    "op13_fill_in_middle": r"""
WITH h AS (SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, '')) AS n, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS x FROM documents),
g AS (SELECT *, ('0x' || substr(x, 1, 8))::BIGINT % (n + 1) AS a, ('0x' || substr(x, 9, 8))::BIGINT % (n + 1) AS b, ('0x' || substr(x, 17, 8))::BIGINT % 100 AS c, ('0x' || substr(x, 25, 8))::BIGINT % 100 AS d FROM h),
f AS (SELECT *, CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR c >= 90 THEN 'plain' WHEN d < 20 THEN 'spm' ELSE 'psm' END AS form FROM g),
o AS (SELECT *, substr(t, 1, least(a, b)) AS p, substr(t, least(a, b) + 1, abs(a - b)) AS m, substr(t, greatest(a, b) + 1) AS s FROM f)
SELECT doc_id, n::BIGINT AS n, form, (CASE WHEN form <> 'plain' THEN least(a, b) END)::BIGINT AS prefix_chars, (CASE WHEN form <> 'plain' THEN abs(a - b) END)::BIGINT AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256, sha256(t) AS restored_sha256 FROM o""",
}
