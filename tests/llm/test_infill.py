"""Fill-in-middle: every byte against a plain cut of the text, and the way back."""

import hashlib
import random

import numpy as np
import pytest

from feedlake.llm import infill


def plain_cut(doc_id, text):
    """The same by slices of the text."""
    text = text or ""
    h = [int(hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()[8 * i : 8 * i + 8], 16) for i in range(4)]
    n = len(text)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    p, m, s = text[:a], text[a:b], text[b:]
    if h[3] % 100 < 20:
        return n, "spm", a, b - a, f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", a, b - a, f"<P>{p}<S>{s}<M>{m}"


SIGNS = ["a", "é", "語", "🦊", "<", ">", "P", "S", "M", "<", ">", "\n"]


def random_texts(seed, count):
    rnd = random.Random(seed)
    return ["".join(rnd.choice(SIGNS) for _ in range(rnd.choice([0, 1, 2, 3, 5, 9, 40]))) for _ in range(count)]


def test_all_forms_equal_plain_cuts_and_come_back(spark):
    texts = [None, "", "x", "<P>", "a<S>b", "<<P", "P>P>", "<S", *random_texts(1, 900)]
    rows = [(i, t, "clash", "clash") for i, t in enumerate(texts)]
    rows += [(None, "no id, é", "c", "c"), (5, texts[5], "c", "c"), (5, texts[5], "c", "c")]
    df = spark.createDataFrame(rows, "doc_id long, text string, form string, output string")
    found = infill.restore(infill.transform(df, "doc_id", "text")).collect()
    want = sorted((repr((r[0], *plain_cut(r[0], r[1]), r[1] or "")) for r in rows))
    assert sorted(repr((r.id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output, r.restored)) for r in found) == want
    assert {r.form for r in found} == {"plain", "psm", "spm"}


def test_moving_by_windows_changes_nothing(spark, monkeypatch):
    texts = [t.encode() for t in random_texts(2, 300)]
    raw = np.frombuffer(b"".join(texts), np.uint8)
    places = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    rnd = np.random.default_rng(3)
    chars = np.array([len(t.decode()) for t in texts])
    cut = np.sort(rnd.integers(0, chars[:, None] + 1, (len(texts), 2)), axis=1)
    form = np.array([rnd.choice(["plain", "psm", "spm"]) if not any(m in t for m in (b"<P>", b"<S>", b"<M>")) else "plain" for t in texts], object)
    results = []
    for window in (1, 7, 64, 1 << 20):
        monkeypatch.setattr(infill, "WINDOW", window)
        first, last = (infill._code_points(raw, cut[:, i], places[:-1], places[1:]) for i in (0, 1))
        out, to = infill.scatter(raw, places, first, last, form)
        back, at = infill.gather(out, to, form)
        assert bytes(back) == bytes(raw) and (at == places).all()
        results.append((first.tolist(), last.tolist(), bytes(out), to.tolist()))
    assert all(r == results[0] for r in results)
    assert results[0][0] == [len(t.decode()[:a].encode()) + b for t, a, b in zip(texts, cut[:, 0], places, strict=False)]


def test_very_long_text(spark):
    text = "ab é語<P " * 700_000
    rows = [(i, text[i:]) for i in range(4)]
    found = infill.restore(infill.transform(spark.createDataFrame(rows, "doc_id long, text string"), "doc_id", "text")).collect()
    for r in found:
        assert (r.n, r.form, r.prefix_chars, r.middle_chars, r.output) == plain_cut(r.id, text[r.id :])
        assert r.restored == text[r.id :]


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    found = infill.restore(infill.transform(df, "doc_id", "text"))
    assert found.count() == 0 and found.columns[-1] == "restored"


@pytest.mark.parametrize("doc_id", [0, 7, -3, 2**62])
def test_cut_depends_on_the_id_alone(spark, doc_id):
    df = spark.createDataFrame([(doc_id, "abcdefghij"), (doc_id, "klmnopqrst")], "doc_id long, text string")
    a, b = infill.transform(df, "doc_id", "text").collect()
    assert (a.form, a.prefix_chars, a.middle_chars) == (b.form, b.prefix_chars, b.middle_chars)
