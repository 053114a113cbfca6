"""Fill-in-middle transformation by displacement scatter, and its inverse.

A text is cut twice between code points. Its parts are written in another order, each behind a mark:

    psm    <P>prefix<S>suffix<M>middle
    spm    <S>suffix<P>prefix<M>middle
    plain  the text as it is

Cuts and form come from a hash of the document id alone, so that any run gives the same. Moving works on
a batch of texts as one string of bytes: a scan turns cuts into byte places; an array of
differences holds, at the first byte of each part, by how much the shift changes there; its running sum is the
shift of every byte, and one scatter writes the output. The way back scans the output for the
marks, which no moved text holds, builds the same kind of shifts from them, and gathers.

Long batches are moved in windows of some million bytes, so memory beyond the bytes is bounded.

Defined results: a null text is empty; an empty text, and one that holds a mark, is plain; a null id counts as
an empty one; repeated rows are each moved alike; an empty table gives an empty result. Texts of any length are moved whole. Only
the named columns are read, so other columns cannot clash.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedlake.llm.rows import map_slices, pick

# The marks, and the percentages of plain texts and, among the others, of spm.
MARKS = {"prefix": "<P>", "suffix": "<S>", "middle": "<M>"}
PLAIN_FROM, SPM_BELOW = 90, 20
PLAIN, PSM, SPM = "plain", "psm", "spm"
ORDER = {PSM: ("prefix", "suffix", "middle"), SPM: ("suffix", "prefix", "middle")}
MARK_BYTES = 3

WINDOW = 1 << 20


def cuts(doc_id: Column, text: Column) -> dict[str, Column]:
    """``n`` code points, the ``form``, and how many go into prefix and middle (null if plain)."""
    digest = F.sha2(F.concat(F.lit("1:"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"), 256)
    h1, h2, h3, h4 = (F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("bigint") for i in range(4))
    n = F.length(text).cast("bigint")
    marked = text.contains(MARKS["prefix"]) | text.contains(MARKS["suffix"]) | text.contains(MARKS["middle"])
    form = F.when((n == 0) | marked | (h3 % 100 >= PLAIN_FROM), PLAIN).when(h4 % 100 < SPM_BELOW, SPM).otherwise(PSM)
    first, last = F.least(h1 % (n + 1), h2 % (n + 1)), F.greatest(h1 % (n + 1), h2 % (n + 1))
    moved = form != PLAIN
    return {"n": n, "form": form, "prefix_chars": F.when(moved, first), "middle_chars": F.when(moved, last - first)}


def _bytes_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All texts as one array of bytes, and where each begins; the last place is the end."""
    held = texts.cast(pa.large_binary())
    _, offsets, data = held.buffers()
    places = np.frombuffer(offsets, np.int64)[held.offset : held.offset + len(held) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[places[0] : places[-1]], places - places[0]


def _texts_of(raw: np.ndarray, places: np.ndarray) -> pa.Array:
    whole = pa.Array.from_buffers(pa.large_string(), len(places) - 1, [None, pa.py_buffer(places.astype(np.int64)), pa.py_buffer(raw)])
    return whole.cast(pa.string())


def _code_points(raw: np.ndarray, at: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The byte place of code point ``at[i]`` of the text between ``begin[i]`` and ``end[i]``."""
    found = end.copy()
    for lo in range(0, len(raw), WINDOW):
        starts = lo + np.flatnonzero((raw[lo : lo + WINDOW] & 0xC0) != 0x80)
        skip = np.searchsorted(starts, begin)
        here = np.flatnonzero((at >= 0) & (skip + at < len(starts)))
        place = starts[(skip + at)[here]]
        found[here] = np.minimum(place, end[here])
        # What is left to count of a text that goes on behind this window; below 0 once found.
        at = at - (len(starts) - skip)
    return found


def _shifts(length: int, place: np.ndarray, change: np.ndarray):
    """(begin, end, shift of every byte) by windows: the running sum of the differences."""
    order = np.argsort(place, kind="stable")
    place, change = place[order], change[order]
    held = np.int64(0)
    for lo in range(0, length, WINDOW):
        hi = min(lo + WINDOW, length)
        part = slice(*np.searchsorted(place, [lo, hi]))
        difference = np.zeros(hi - lo, np.int64)
        np.add.at(difference, place[part] - lo, change[part])
        difference[0] += held
        shift = np.cumsum(difference)
        held = shift[-1]
        yield lo, hi, shift


def _differences(begin: np.ndarray, shift: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places and changes of the shift, for parts in their order that each begin at ``begin``."""
    return begin.reshape(-1), np.diff(shift.reshape(-1), prepend=0)


def scatter(raw: np.ndarray, places: np.ndarray, first: np.ndarray, last: np.ndarray, form: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and places of the outputs; ``first`` and ``last`` are cuts in bytes, by text."""
    begin, end = places[:-1], places[1:]
    moved = form != PLAIN
    sizes = end - begin + np.where(moved, 3 * MARK_BYTES, 0)
    to = np.concatenate([[0], np.cumsum(sizes)])
    parts = np.stack([begin, first, last], axis=1)
    length = {"prefix": first - begin, "middle": last - first, "suffix": end - last}
    shift = np.repeat((to[:-1] - begin)[:, None], 3, axis=1)
    out = np.empty(int(to[-1]), np.uint8)
    for name, order in ORDER.items():
        rows = np.flatnonzero(form == name)
        at = to[:-1][rows]
        for part in order:
            out[(at[:, None] + np.arange(MARK_BYTES)).reshape(-1)] = np.tile(np.frombuffer(MARKS[part].encode(), np.uint8), len(rows))
            at = at + MARK_BYTES
            column = ("prefix", "middle", "suffix").index(part)
            shift[rows, column] = at - parts[rows, column]
            at = at + length[part][rows]
    for lo, hi, by in _shifts(len(raw), *_differences(parts, shift)):
        out[np.arange(lo, hi) + by] = raw[lo:hi]
    return out, to


def gather(out: np.ndarray, to: np.ndarray, form: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and places of the texts that ``scatter`` made these outputs from."""
    begin, end = to[:-1], to[1:]
    moved = np.flatnonzero(form != PLAIN)
    places = np.concatenate([[0], np.cumsum(end - begin - np.where(form != PLAIN, 3 * MARK_BYTES, 0))])
    raw = np.empty(int(places[-1]), np.uint8)
    found = []
    for lo in range(0, len(out), WINDOW):
        piece = out[lo : lo + WINDOW + MARK_BYTES - 1]
        mark = (piece[:-2] == ord("<")) & (piece[2:] == ord(">")) & np.isin(piece[1:-1], [ord(m[1]) for m in MARKS.values()])
        found.append(lo + np.flatnonzero(mark))
    marks = np.concatenate([np.zeros(0, np.int64), *found])
    owner = np.searchsorted(to, marks, "right") - 1
    # A mark that begins in one text and ends in the next is none.
    marks = marks[(form[owner] != PLAIN) & (marks + MARK_BYTES <= end[owner])].reshape(-1, 3)
    # Where each part stands in the output, and how long it is, in the order of the output.
    starts = marks + MARK_BYTES
    sizes = np.concatenate([marks[:, 1:], end[moved][:, None]], axis=1) - starts
    back, part_begin = np.zeros((len(form), 3), np.int64), np.repeat(places[:-1][:, None], 3, axis=1)
    back[:] = (begin - places[:-1])[:, None]
    for name, order in ORDER.items():
        rows = np.flatnonzero(form[moved] == name)
        at = places[:-1][moved[rows]]
        for column, part in enumerate(("prefix", "middle", "suffix")):
            where = order.index(part)
            part_begin[moved[rows], column] = at
            back[moved[rows], column] = starts[rows, where] - at
            at = at + sizes[rows, where]
    for lo, hi, by in _shifts(len(raw), *_differences(part_begin, back)):
        raw[lo:hi] = out[np.arange(lo, hi) + by]
    return raw, places


def transform(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, n, form, prefix_chars, middle_chars, output) of every row."""
    rows = pick(df, id=id_col, text=text_col).withColumn("text", F.coalesce("text", F.lit("")))
    rows = rows.withColumns(cuts(F.col("id"), F.col("text")))

    def move(batch: pa.RecordBatch) -> pa.RecordBatch:
        raw, places = _bytes_of(batch.column("text"))
        form = np.array(batch.column("form").to_pylist(), object)
        first = batch.column("prefix_chars").fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
        middle = batch.column("middle_chars").fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
        begin, end = places[:-1], places[1:]
        out, to = scatter(raw, places, _code_points(raw, first, begin, end), _code_points(raw, first + middle, begin, end), form)
        names = ["id", "n", "form", "prefix_chars", "middle_chars"]
        return pa.record_batch([*(batch.column(c) for c in names), _texts_of(out, to)], [*names, "output"])

    kind = rows.schema["id"].dataType.simpleString()
    return map_slices(rows, move, f"id {kind}, n bigint, form string, prefix_chars bigint, middle_chars bigint, output string")


def restore(moved: DataFrame) -> DataFrame:
    """The columns of ``transform`` and ``restored``, built from ``output`` and ``form`` alone."""
    names = moved.columns

    def back(batch: pa.RecordBatch) -> pa.RecordBatch:
        out, to = _bytes_of(batch.column("output"))
        raw, places = gather(out, to, np.array(batch.column("form").to_pylist(), object))
        return pa.record_batch([*(batch.column(c) for c in names), _texts_of(raw, places)], [*names, "restored"])

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in moved.schema)
    return map_slices(moved, back, f"{kinds}, restored string", "output")
