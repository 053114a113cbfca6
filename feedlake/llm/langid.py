"""Language of every word, span and text.

The script of a word narrows the languages that come into question; letter trigrams of the word
score each of them; Viterbi over the words, with a penalty for each switch, labels spans.

Training counts trigrams of a bounded sample of labelled texts: every language gives
``sample_per_lang`` texts in expectation, chosen by a hash of the id. The model has a row per
bucket of trigrams and a column per language, so its size does not follow the corpus.

Defined results: a null text or one without a letter is ``und`` with score 0. The score is the
share of letters that lie in spans of the predicted language, in a script that it is written in.
Texts in a script that no learned language uses get a learned value with score 0. Without any
labelled text everything is ``und``.
"""

from __future__ import annotations

import sys
from dataclasses import dataclass
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedlake.llm.rows import column, map_slices, pick, same_length_lower
from feedlake.operators.latest import free_name

BUCKET_BITS = 15
#: Letters that a task labels at a time: some ten numbers of 64 bits each are held for one.
PREDICT_CHARS = 1_000_000
SWITCH = 12.0
#: What a word of a script costs a language that is not written in it.
WRONG_SCRIPT = 30.0
LEAST_SHARE = 0.01
SMOOTHING = 0.1

# First code point of each stretch of scripts, after the Unicode blocks.
SCRIPTS = [
    (0x0000, "Latin"), (0x0370, "Greek"), (0x0400, "Cyrillic"), (0x0530, "Armenian"), (0x0590, "Hebrew"),
    (0x0600, "Arabic"), (0x0700, "Syriac"), (0x0750, "Arabic"), (0x0780, "Thaana"), (0x07C0, "other"),
    (0x08A0, "Arabic"), (0x0900, "Devanagari"), (0x0980, "Bengali"), (0x0A00, "Gurmukhi"), (0x0A80, "Gujarati"),
    (0x0B00, "Oriya"), (0x0B80, "Tamil"), (0x0C00, "Telugu"), (0x0C80, "Kannada"), (0x0D00, "Malayalam"),
    (0x0D80, "Sinhala"), (0x0E00, "Thai"), (0x0E80, "Lao"), (0x0F00, "Tibetan"), (0x1000, "Myanmar"),
    (0x10A0, "Georgian"), (0x1100, "Hangul"), (0x1200, "Ethiopic"), (0x13A0, "other"), (0x1780, "Khmer"),
    (0x1800, "Mongolian"), (0x18B0, "other"), (0x1C80, "Cyrillic"), (0x1C90, "Georgian"), (0x1CC0, "other"),
    (0x1D00, "Latin"), (0x1F00, "Greek"), (0x2000, "Latin"), (0x2C00, "other"), (0x2C60, "Latin"), (0x2C80, "other"),
    (0x2DE0, "Cyrillic"), (0x2E00, "other"), (0x2E80, "Han"), (0x3040, "Kana"), (0x3100, "Bopomofo"), (0x3130, "Hangul"),
    (0x3190, "Han"), (0x31F0, "Kana"), (0x3200, "Han"), (0xA000, "other"), (0xA640, "Cyrillic"), (0xA6A0, "other"),
    (0xA720, "Latin"), (0xA800, "other"), (0xAC00, "Hangul"), (0xD7FC, "other"), (0xF900, "Han"), (0xFB00, "Latin"),
    (0xFB13, "Armenian"), (0xFB1D, "Hebrew"), (0xFB50, "Arabic"), (0xFE00, "other"), (0xFE70, "Arabic"), (0xFF00, "Latin"),
    (0xFF66, "Kana"), (0xFFA0, "Hangul"), (0xFFE0, "other"), (0x20000, "Han"), (0x32000, "other"),
]
SCRIPT_NAMES = sorted({name for _, name in SCRIPTS})


@cache
def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Whether a code point is a letter, and its script."""
    letters = np.fromiter((chr(i).isalpha() for i in range(sys.maxunicode + 1)), bool, sys.maxunicode + 1)
    starts = [s for s, _ in SCRIPTS]
    scripts = np.zeros(sys.maxunicode + 1, np.uint8)
    for i in range(len(SCRIPTS)):
        end = starts[i + 1] if i + 1 < len(SCRIPTS) else sys.maxunicode + 1
        scripts[starts[i] : end] = SCRIPT_NAMES.index(SCRIPTS[i][1])
    return letters, scripts


@dataclass
class Words:
    """The words of a run of texts that are joined by one sign each."""

    text: np.ndarray  # of each word: its text,
    start: np.ndarray  # place of its first letter in the text,
    size: np.ndarray  # letters,
    first: np.ndarray  # place of its first letter among all letters,
    script: np.ndarray
    bucket: np.ndarray  # of each letter: the trigram around it


def read_words(texts: list[str | None]) -> Words:
    letters, scripts = _tables()
    low = [same_length_lower(t or "") for t in texts]
    points = np.frombuffer("\n".join([*low, ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
    is_letter = letters[points]
    at = np.flatnonzero(is_letter)
    plain = np.where(is_letter, points, 0).astype(np.uint64)
    # The sign before a word or behind it is no letter and counts as 0.
    before, after = plain[np.maximum(at - 1, 0)] * (at > 0), plain[np.minimum(at + 1, len(plain) - 1)]
    mixed = (before * np.uint64(0x9E3779B97F4A7C15)) ^ (plain[at] * np.uint64(0xC2B2AE3D27D4EB4F)) ^ (after * np.uint64(0x165667B19E3779F9))
    mixed *= np.uint64(0xD6E8FEB86659FD93)
    bucket = (mixed >> np.uint64(64 - BUCKET_BITS)).astype(np.int32)
    first = np.flatnonzero(np.diff(at, prepend=-2) > 1)
    begins = np.cumsum([0, *(len(t) + 1 for t in low)])
    start = at[first]
    text = np.searchsorted(begins, start, "right") - 1
    size = np.diff(first, append=len(at))
    return Words(text, start - begins[text], size, first, scripts[points[start]], bucket)


@dataclass
class Model:
    langs: list[str]
    score: np.ndarray  # bucket, language: log of the smoothed share
    written: np.ndarray  # script, language: whether the language comes into question

    def words(self, words: Words) -> np.ndarray:
        """Score of each word in each language."""
        scores = np.add.reduceat(self.score[words.bucket], words.first, axis=0).astype(np.float64)
        known = self.written.any(axis=1)
        wrong = known[:, None] & ~self.written
        scores[~known[words.script]] = 0
        return scores - WRONG_SCRIPT * wrong[words.script]

    def paths(self, words: Words, switch: float) -> np.ndarray:
        """The language of each word, as a place in ``langs``."""
        scores = self.words(words)
        begin = np.flatnonzero(np.diff(words.text, prepend=-1))
        count = np.diff(begin, append=len(words.text))
        total = np.add.reduceat(scores, begin, axis=0)
        best = total.argmax(axis=1)
        path = np.repeat(best, count)
        # Where no stretch gains more than half the penalty by another language, one language is the
        # best path: m stretches cost m - 1 switches, which is half a switch each at least. Stretches are differences of running sums; a step down between texts keeps
        # the running minimum of a text apart from those before it.
        nth = np.repeat(np.arange(len(begin)), count)
        own = scores[np.arange(len(path)), path]
        mixed = np.zeros(len(begin), bool)
        for k in range(len(self.langs)):
            gain = scores[:, k] - own
            after = np.cumsum(gain)
            step = float(np.abs(after).max()) * 2 + 1
            before = after - gain - nth * step
            stretch = after - nth * step - np.minimum.accumulate(before)
            mixed |= np.maximum.reduceat(stretch, begin) > switch / 2
        for i in np.flatnonzero(mixed):
            a = begin[i]
            path[a : a + count[i]] = viterbi(scores[a : a + count[i]], switch)
        return path


def viterbi(scores: np.ndarray, switch: float) -> list[int]:
    """The best labels of a sequence of words, each change of label costing ``switch``."""
    rows = scores.tolist()
    value, came = rows[0], []
    for row in rows[1:]:
        top = max(value)
        at, least = value.index(top), top - switch
        came.append([at if v < least else i for i, v in enumerate(value)])
        value = [(least if v < least else v) + s for v, s in zip(value, row, strict=True)]
    label = value.index(max(value))
    path = [label]
    for back in reversed(came):
        label = back[label]
        path.append(label)
    return path[::-1]


def is_held_out(doc_id: Column) -> Column:
    """A fifth of all documents, by CRC-32 of the id as text."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def train(docs: DataFrame, text_col: str, lang_col: str, id_col: str, sample_per_lang: int = 3000) -> Model | None:
    """Counts from a sample of the labelled rows of ``docs``, or None without any.

    Only language counts (a row per language) and bucket counts (a row per bucket, language and
    script at most) reach the driver.
    """
    rows = pick(docs, text=text_col, lang=lang_col, id=id_col).filter("text is not null and lang is not null")
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    langs = sorted(counts)
    if not langs:
        return None
    spread = F.pmod(F.xxhash64("id"), F.lit(1_000_000)) / 1_000_000
    share = F.create_map([F.lit(x) for k in langs for x in (k, min(1.0, sample_per_lang / counts[k]))])
    chosen = rows.filter(spread < share[F.col("lang")]).select("text", "lang")

    def count(batch: pa.RecordBatch) -> pa.RecordBatch:
        words = read_words(batch.column("text").to_pylist())
        lang = np.array([langs.index(x) for x in batch.column("lang").to_pylist()])
        lang_of = np.repeat(lang[words.text], words.size)
        script_of = np.repeat(words.script, words.size)
        # Buckets first, then scripts, in one number per language.
        width = (1 << BUCKET_BITS) + len(SCRIPT_NAMES)
        seen = np.bincount(lang_of * width + words.bucket, minlength=width * len(langs))
        seen += np.bincount(lang_of * width + (1 << BUCKET_BITS) + script_of, minlength=width * len(langs))
        at = np.flatnonzero(seen)
        return pa.record_batch([pa.array(at, pa.int64()), pa.array(seen[at], pa.int64())], ["place", "n"])

    seen = map_slices(chosen, count, "place bigint, n bigint", chars=PREDICT_CHARS).groupBy("place").agg(F.sum("n").alias("n"))
    found = seen.toArrow()
    width = (1 << BUCKET_BITS) + len(SCRIPT_NAMES)
    table = np.zeros((len(langs), width))
    table.reshape(-1)[found["place"].to_numpy()] = found["n"].to_numpy()
    grams, scripts = table[:, : 1 << BUCKET_BITS], table[:, 1 << BUCKET_BITS :]
    share_of = (grams + SMOOTHING) / (grams.sum(axis=1, keepdims=True) + SMOOTHING * grams.shape[1])
    written = scripts >= LEAST_SHARE * np.maximum(scripts.sum(axis=1, keepdims=True), 1)
    return Model(langs, np.log(share_of).T.astype(np.float32), written.T)


def label_spans(df: DataFrame, id_col: str, text_col: str, model: Model | None, switch: float = SWITCH) -> DataFrame:
    """(id, lang, score, spans): spans are (start, end, lang) in code points, from first to last letter.

    Neighbouring words of one language share a span.
    """
    docs = pick(df, id=id_col, text=text_col)
    kind = docs.schema["id"].dataType.simpleString()
    spans = "array<struct<start:bigint,end:bigint,lang:string>>"
    shared = df.sparkSession.sparkContext.broadcast(model)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = batch.column("text").to_pylist()
        lang, score = _labels(texts, shared.value, switch, found := [[] for _ in texts])
        span = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("lang", pa.string())])
        return pa.record_batch([batch.column("id"), pa.array(lang), pa.array(score), pa.array(found, pa.list_(span))], ["id", "lang", "score", "spans"])

    return map_slices(docs, work, f"id {kind}, lang string, score double, spans {spans}").withColumnRenamed("id", id_col)


def _labels(texts: list[str | None], model: Model | None, switch: float, spans: list[list] | None = None) -> tuple[list[str], list[float]]:
    """Language and score of each text; ``spans`` is filled if given."""
    n = len(texts)
    words = read_words(texts) if model else None
    if words is None or not len(words.text):
        return ["und"] * n, [0.0] * n
    path = model.paths(words, switch)
    letters = np.zeros((n, len(model.langs)))
    np.add.at(letters, (words.text, path), words.size)
    sure = np.zeros((n, len(model.langs)))
    np.add.at(sure, (words.text, path), words.size * model.written[words.script, path])
    best, total = letters.argmax(axis=1), letters.sum(axis=1)
    share = sure[np.arange(n), best] / np.maximum(total, 1)
    if spans is not None:
        new = np.flatnonzero((np.diff(words.text, prepend=-1) != 0) | (np.diff(path, prepend=-1) != 0))
        last = np.append(new[1:], len(path)) - 1
        for i, j in zip(new.tolist(), last.tolist(), strict=True):
            end = int(words.start[j] + words.size[j])
            spans[words.text[i]].append({"start": int(words.start[i]), "end": end, "lang": model.langs[path[i]]})
    lang = [model.langs[b] if t else "und" for b, t in zip(best.tolist(), total.tolist(), strict=True)]
    return lang, share.tolist()


def predict(df: DataFrame, text_col: str, model: Model | None, switch: float = SWITCH, names: tuple[str, str] = ("_lang_pred", "_score")) -> DataFrame:
    """All columns of ``df``, and two of the given names: language and score. A column that has such a name keeps it, and ours get a longer one; they are the last two.

    The texts go through Python once, whatever is done with the result: it comes out of a generator, which no later
    filter can be pulled through.
    """
    shared = df.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang string, score double")
    def label(text: pd.Series) -> pd.DataFrame:
        langs, scores, held, size = [], [], [], 0
        for t in [*text, None]:
            held.append(t)
            size += len(t or "")
            if size > PREDICT_CHARS or len(langs) + len(held) > len(text):
                a, b = _labels(held, shared.value, switch)
                langs, scores, held, size = langs + a, scores + b, [], 0
        return pd.DataFrame({"lang": langs[: len(text)], "score": scores[: len(text)]})

    lang = free_name(df.columns, names[0])
    score = free_name([*df.columns, lang], names[1])
    found = df.select(*[column(df, c) for c in df.columns], F.inline(F.array(label(column(df, text_col)))))
    return found.toDF(*df.columns, lang, score)
