"""PII, main text, language and tokens: per text, against plain Python."""

import hashlib
import random
import re

import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from feedlake.llm import bpe, html_density, langid, pii

# --- PII ---------------------------------------------------------------------------------

BASE = [
    (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda x: True),
    (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda x: all(int(p) <= 255 for p in x.split("."))),
    (r"[0-9]([\x20-]?[0-9])+", lambda x: 16 <= len(re.sub("[ -]", "", x)) <= 19 and luhn(re.sub("[ -]", "", x))),
    (r"\+[0-9][\x20().0-9-]+[0-9]", lambda x: 8 <= len(re.findall("[0-9]", x)) <= 15),
]


def luhn(digits):
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        total += d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def plain_base(text):
    return [(k, m.start(), m.end()) for k, (p, good) in enumerate(BASE) for m in re.finditer(p, text) if good(m.group())]


@settings(max_examples=1500, deadline=None)
@given(st.text(alphabet="a1@.-+ (0234b%é4", max_size=50))
def test_base_spans_are_those_of_the_patterns(text):
    assert pii.base_spans(text) == plain_base(text)


DISGUISED = {
    "write to john.doe at example dot com today": ["email", "john.doe at example dot com"],
    "john (at) example (dot) com": ["email", "john (at) example (dot) com"],
    "jоhn@exаmple.com": ["email", "jоhn@exаmple.com"],
    "mary_at_example_dot_com!": ["email", "mary_at_example_dot_com"],
    "foo{at}bar{dot}co{dot}uk": ["email", "foo{at}bar{dot}co{dot}uk"],
    "host 192[.]168[.]0[.]1": ["ip", "192[.]168[.]0[.]1"],
    "192 dot 168 dot 0 dot 1": ["ip", "192 dot 168 dot 0 dot 1"],
    "４１１１ 1111 1111 1111": ["card", "４１１１ 1111 1111 1111"],
    "four one one one one one one one one one one one one one one one": ["card", "four" + " one" * 15],
    "at +49 three zero 1234 5678": ["phone", "+49 three zero 1234 5678"],
}


@pytest.mark.parametrize("text", DISGUISED)
@pytest.mark.parametrize("before", ["", "é 日本 said so, "])
def test_disguises_map_back_to_the_source(text, before):
    spans = pii.added_spans(before + text, pii.base_spans(before + text))
    assert [[pii.KINDS[k], (before + text)[a:b]] for k, a, b in spans] == [DISGUISED[text]]


WHOLE = {
    "10.0.zero.one": "ip", "one nine two dot one six eight dot one dot one": "ip", "192 dot one six 8 dot 0 dot zero": "ip", "١٠ dot ٠ dot ٠ dot ١": "ip",
    "li at host dot cn": "email", "jan at mail dot posta dot cz": "email", "kim at host dot xyz": "email", "a at b dot co dot za": "email",
    "john dot doe at example dot photography": "email", "plus one two one two five five five one two three four": "phone",
    "plus four four double seven triple 0 one two three": "phone",
    "+ 1 double five double five one two three four": "phone", "más tres cuatro, nueve uno uno double dos tres cuatro": "phone",
    "four one one one one one one one double one double one double one double one": "card",
    "a.b.c.d.e.f at host dot com": "email", "me at a dot b dot c dot d dot e dot f dot com": "email",
}


@pytest.mark.parametrize("text", WHOLE)
def test_whole_disguises(text):
    """With any text around them."""
    for before, after in (("", ""), ("it is: ", "."), ("é ", ", he said")):
        full = before + text + after
        assert [(pii.KINDS[k], full[a:b]) for k, a, b in pii.added_spans(full, pii.base_spans(full))] == [(WHOLE[text], text)]


def test_long_addresses_and_many_signs_are_read_in_time():
    for text in ("a dot " * 200 + "b at " + "c dot " * 300 + "com", "x" * 5000 + " at " + "y" * 5000 + " dot org"):
        assert [(k, a, b) for k, a, b in pii.added_spans("to " + text, [])] == [(0, 3, 3 + len(text))]
    for text in ("a dot " * 30_000, "x dot at dot " * 15_000, "plus double " * 30_000 + "one", "one at " * 30_000, "one, " * 40_000, "a at b dot " * 10_000):
        pii.added_spans(text, [])


@pytest.mark.parametrize("text", ["he is at this point so tired", "plus one or two of three", "double one, triple two", "a double five is plus one", "surplus one two one two five five five one two three four", "one. two. three. four.", "one dot two dot three", "three hundred. one dot 256 dot 1 dot one", "1.2.3.4"])
def test_prose_is_no_disguise(text):
    assert pii.added_spans(text, pii.base_spans(text)) == []


@pytest.mark.parametrize(
    "text",
    ["", "look at the polka dot dress. he is at home point blank", "one two three four five", "we met @ home. It was late",
     "Les un deux trois quatre", "a plain@example.com", "x" * 100_000 + "@", "1" * 50_000, "a." * 20_000 + "@"],
)
def test_clean_text_gets_nothing_more(text):
    assert pii.added_spans(text, pii.base_spans(text)) == []


def test_pii_rows(spark):
    rows = [(1, "a@b.co +1 (456) 555-2186", "x"), (1, "a@b.co +1 (456) 555-2186", "x"), (2, None, None), (None, "", "y")]
    df = spark.createDataFrame(rows, "doc_id long, text string, base string")
    found = pii.find_pii(df, "doc_id", "text").collect()
    assert sorted((r.doc_id or 0, len(r.base), len(r.added)) for r in found) == [(0, 0, 0), (1, 2, 0), (1, 2, 0), (2, 0, 0)]
    assert [s.text for s in max(found, key=lambda r: len(r.base)).base] == ["a@b.co", "+1 (456) 555-2186"]
    assert pii.find_pii(df.limit(0), "doc_id", "text").isEmpty()
    counts, digest, spans, added = pii.digest(rows[0][1])
    assert (counts, spans, added) == ([1, 0, 0, 1], "email:0:6,phone:7:24", 0)
    assert digest == hashlib.sha256(spans.encode()).hexdigest()


# --- main text ------------------------------------------------------------------------------

ARTICLE = ["A headline", "First paragraph with quite some words, &amp; more.", "Second one, <a href=x>linked</a> in part, and\n long enough."]
PAGE = (
    "<html><head><title>T</title><script>var a='</p><p>no</p>';</script></head><body><header><h2>Site</h2></header><nav><a href=/>Home</a></nav>"
    "<div class='cookie-notice'>We use cookies and tell you so in many words, every day.</div>{}<aside>Buy this now, it is cheap and very good.</aside>"
    "<section id=comments><p>I liked it a lot, thank you for this long text of yours!</p></section><form>Subscribe <input></form><footer>(c) me</footer></body></html>"
)
WANT = ["A headline", "First paragraph with quite some words, & more.", "Second one, linked in part, and long enough."]


@pytest.mark.parametrize(
    "body",
    [
        "<article><h1>{}</h1><p>{}</p><p>{}</p></article>",
        "<main><h1>{}</h1><p>{}<p>{}</main>",
        "<div class=content><h1>{}</h1><p>{}<p>{}</div>",
        "<div><article><h1>{}</h1><div><p>{}</p><div class='ad'>Special offer for you, dear reader!</div></div><p><b>{}</p></article></div>",
        "<article><header><h1>{}</h1></header><p>{}</p><!-- <p>no</p> --><p>{}</p><button>Share</button></article>",
    ],
)
def test_main_text_of_pages(body):
    assert html_density.main_blocks(PAGE.format(body.format(*ARTICLE))) == WANT


LONG = "A sentence of the article that has quite some words in it. "


@pytest.mark.parametrize(
    "page",
    [
        "<div class='elementor-widget-heading'><h1>T</h1></div><div class='elementor-widget-container'><p>{}</p></div>",
        "<main><h1>T</h1><div class='elementor-widget-container'><p>{}</p></div></main>",
        "<article class='post'><h1>T</h1><div class='more widget'><p>{}</p></div></article>",
        "<article><h1>T</h1><p>{}</p></article><div class='comments'><article class='comment-body'><p>{}</p></article><article><p>{}</p></article></div>",
        "<div class='has-sidebar'><article><h1>T</h1><p>{}</p></article><div id='comments'><article class='comment-body'><p>{}</p></article></div></div>",
        "<article class='tags-on'><h1>T</h1><p>{}</p></article><article class='related teaser'><p>{}</p></article>",
    ],
)
def test_names_do_not_decide_alone(page):
    said = ["A reader's words about it, many more of them than the article itself has. " * 20] * 2
    assert html_density.main_blocks("<body>" + page.format(LONG * 8, *said) + "</body>")[-1] == (LONG * 8).strip()


def test_density_alone_finds_the_article():
    links = "".join(f"<li><a href=/{i}>entry {i}</a></li>" for i in range(30))
    paragraphs = "".join(f"<p>{'some words of the article ' * 8}{i}</p>" for i in range(5))
    page = f"<body><div><ul>{links}</ul></div><div><div>{paragraphs}</div></div><div><ul>{links}</ul></div></body>"
    blocks = html_density.main_blocks(page)
    assert len(blocks) == 5 and blocks[4].endswith("article 4")


@pytest.mark.parametrize("html, want", [(None, []), ("", []), ("<p></p>", []), ("no markup", ["no markup"]), ("<p>a<b>c</p>", ["ac"]),
                                        ("<p title='x>y'>z", ["z"]), ("<div>" * 5000 + "deep" + "</div>" * 5000, ["deep"])])
def test_odd_pages(html, want):
    assert html_density.main_blocks(html) == want


def test_pages_of_the_table(spark, sf_dir):
    """All of them are made from one template, whose article is known."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    found = {r.page_id: " ".join(r.blocks) for r in html_density.main_text(pages, ["page_id"], "html").collect()}
    from html import unescape

    for row in pages.collect():
        article = re.search("(?s)<article>(.*?)</article>", row.html)[1]
        plain = re.sub("<[^>]*>", " ", re.sub("</?b>", "", article))
        assert found[row.page_id] == " ".join(unescape(plain).split())


# --- language --------------------------------------------------------------------------------


def test_held_out_accuracy_and_spans(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir.replace('0.001', '0.01')}/documents.parquet")
    out = langid.is_held_out(F.col("doc_id"))
    model = langid.train(docs.filter(~out), "text", "lang", "doc_id", sample_per_lang=100)
    found = langid.label_spans(docs.filter(out).select("doc_id", "text"), "doc_id", "text", model)
    both = found.withColumnRenamed("lang", "said").join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(both) > 150 and sum(r.said == r.lang for r in both) / len(both) > 0.97
    texts = {r.lang: r.text for r in docs.filter("n_chars between 800 and 1500 and lang in ('de', 'en')").collect()}
    mixed = spark.createDataFrame([(1, texts["de"] + "\n" + texts["en"])], "doc_id long, text string")
    (row,) = langid.label_spans(mixed, "doc_id", "text", model).collect()
    assert [s.lang for s in row.spans] == ["de", "en"]
    assert abs(row.spans[1].start - len(texts["de"])) < 40
    odd = [(1, None), (2, ""), (3, "12 !? 34"), (4, "Привет мир"), (5, texts["de"]), (5, texts["de"]), (None, "the and of the")]
    df = spark.createDataFrame(odd, "doc_id long, text string")
    got = [(r.lang, round(r.score, 2)) for r in langid.label_spans(df, "doc_id", "text", model).collect()]
    assert got[:3] == [("und", 0.0)] * 3 and got[3][0] in model.langs and got[3][1] == 0.0
    assert got[4] == got[5] == ("de", 1.0) and got[6][0] == "en"
    assert langid.train(df.limit(0).withColumn("lang", F.lit("x")), "text", "lang", "doc_id") is None
    assert [r.lang for r in langid.label_spans(df, "doc_id", "text", None).collect()] == ["und"] * len(odd)


def test_one_language_shortcut_equals_viterbi():
    draw = random.Random(3)
    import numpy as np

    for _ in range(200):
        n = draw.randrange(1, 40)
        scores = np.array([[draw.gauss(0, 4) for _ in range(3)] for _ in range(n)])
        words = langid.Words(*[np.zeros(n, int)] * 2, np.ones(n, int), np.arange(n), np.zeros(n, int), np.zeros(n, int))
        model = langid.Model(["a", "b", "c"], np.zeros((1, 3)), np.ones((len(langid.SCRIPT_NAMES), 3), bool))
        model.words = lambda _, s=scores: s.copy()
        path = model.paths(words, 6.0).tolist()
        value = lambda p: sum(scores[i, k] for i, k in enumerate(p)) - 6.0 * sum(a != b for a, b in zip(p, p[1:], strict=False))  # noqa: E731, B023
        assert abs(value(path) - value(langid.viterbi(scores, 6.0))) < 1e-9


def test_two_short_languages_are_not_a_third():
    import numpy as np

    draw = random.Random(5)
    cases = [np.array([[5.0, -100, 0], [-100, 5, 0]])]
    cases += [np.array([[draw.choice([5, -100, 0, 3]) for _ in range(4)] for _ in range(draw.randrange(2, 7))], float) for _ in range(300)]
    for scores in cases:
        n, k = scores.shape
        words = langid.Words(*[np.zeros(n, int)] * 2, np.ones(n, int), np.arange(n), np.zeros(n, int), np.zeros(n, int))
        model = langid.Model(list("abcd"[:k]), np.zeros((1, k)), np.ones((len(langid.SCRIPT_NAMES), k), bool))
        model.words = lambda _, s=scores: s.copy()
        value = lambda p: sum(scores[i, k] for i, k in enumerate(p)) - 6.0 * sum(a != b for a, b in zip(p, p[1:], strict=False))  # noqa: E731, B023
        assert value(model.paths(words, 6.0).tolist()) == value(langid.viterbi(scores, 6.0))


# --- tokens ----------------------------------------------------------------------------------

FILE = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
RANKS = bpe.read_ranks(FILE)
CODEC = bpe.Codec(RANKS, public_tokenizers.PATTERN)
REAL = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})


@settings(max_examples=1500, deadline=None)
@given(st.one_of(st.text(max_size=60), st.text(alphabet="abeno tis\n12éüñß,.'", max_size=80), st.text(alphabet="ab ", max_size=60)))
def test_ids_are_those_of_the_merges(text):
    assert CODEC.encode(text) == REAL.encode_ordinary(text)
    assert CODEC.decode(CODEC.encode(text)) == text.encode()


def test_long_pieces_take_linear_time():
    text = "abcdefghij" * 60_000
    assert CODEC.encode(text) == REAL.encode_ordinary("abcdefghij" * 1000)[:1] + CODEC.encode(text)[1:]
    assert CODEC.decode(CODEC.encode(text)) == text.encode()


def test_token_rows(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    odd = spark.createDataFrame([(-1, None), (-2, ""), (-3, "<|endoftext|>"), (None, "x"), (None, "x")], "doc_id long, text string")
    rows = docs.union(odd)
    found = bpe.round_trip(rows, ["doc_id"], "text", FILE, public_tokenizers.PATTERN).collect()
    want = []
    for row in rows.collect():
        ids = REAL.encode_ordinary(row.text or "")
        digest = lambda x: hashlib.sha256(x).hexdigest()
        want.append((row.doc_id, len(ids), digest(",".join(map(str, ids)).encode()), digest((row.text or "").encode())))
    key = lambda r: (r[0] or 10**9, r[1:])
    assert sorted(map(tuple, found), key=key) == sorted(want, key=key)
    ids = bpe.encode(odd, "doc_id", "text", FILE, public_tokenizers.PATTERN)
    assert {bytes(r.bytes) for r in bpe.decode(ids, "doc_id", "ids", FILE, public_tokenizers.PATTERN).collect()} == {b"", b"<|endoftext|>", b"x"}
    assert bpe.encode(odd.limit(0), "doc_id", "text", FILE, public_tokenizers.PATTERN).isEmpty()
