"""Byte-level BPE by backtracking over longest matches.

Bytes are mapped to the code points 0 to 255, so that pyahocorasick can find the tokens of a
vocabulary in them. Encoding a piece walks left to right and takes the longest token that may
follow the token before it. Two tokens may stand side by side if the merges would keep them
apart; that is a property of the pair alone and is memoised. Where no token fits, the position
is dead, the last token is taken back and its next shorter prefix tried. Each position dies at
most once, so the work is linear in the length of the piece. The result is that of the merges.

Defined results: a null text is an empty one; an empty text has no tokens; special tokens have
no meaning, their strings are ordinary text.
"""

from __future__ import annotations

import base64
import hashlib
from itertools import chain

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlake.llm.rows import column, map_slices, pick

MEMO_PIECES = 300_000
MEMO_PAIRS = 500_000
#: So many bytes ahead mostly settle the longest token.
NEAR = 8


def read_ranks(path: str) -> dict[bytes, int]:
    """The tokens of a rank file: base64 of the bytes, a blank, the rank."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines) if a}


def merge_split(token: bytes, ranks: dict[bytes, int]) -> tuple[bytes, bytes] | None:
    """The two parts whose merge is ``token``; None if the merges cannot reach it."""
    parts = [token[i : i + 1] for i in range(len(token))]
    whole = ranks[token]
    while len(parts) > 2:
        best, at = whole, -1
        for i in range(len(parts) - 1):
            rank = ranks.get(parts[i] + parts[i + 1], whole)
            if rank < best:
                best, at = rank, i
        if at < 0:
            return None
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
    return parts[0], parts[1]


class _Memo(dict):
    """Tokens by piece; a piece that is not there yet is encoded."""

    def __init__(self, encode):
        super().__init__()
        self.encode = encode

    def __missing__(self, piece: str) -> tuple[int, ...]:
        self[piece] = tokens = self.encode(piece)
        return tokens


class Codec:
    """Encoder and decoder for one vocabulary; built once per worker process."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.find = regex.compile(pattern).findall
        self.ranks = ranks
        self.bytes_of = {rank: token for token, rank in ranks.items()}
        self.text_of = {rank: str(rank) for rank in self.bytes_of}
        self.split: dict[int, tuple[int, int]] = {}
        self.merged: dict[tuple[int, int], int] = {}
        self.size: dict[int, int] = {}
        self.shorter: dict[int, int] = {}
        reachable = {}
        for token, rank in sorted(ranks.items(), key=lambda x: x[1]):
            if len(token) > 1:
                parts = merge_split(token, ranks)
                if parts is None:
                    continue
                left, right = ranks.get(parts[0]), ranks.get(parts[1])
                if left is None or right is None:
                    continue
                self.split[rank] = left, right
                self.merged[left, right] = rank
            reachable[token] = rank
        self.automaton = ahocorasick.Automaton()
        for token, rank in reachable.items():
            self.size[rank] = len(token)
            self.automaton.add_word(token.decode("latin-1"), rank)
            for n in range(len(token) - 1, 0, -1):
                if token[:n] in reachable:
                    self.shorter[rank] = reachable[token[:n]]
                    break
        self.widest = max(map(len, reachable), default=0)
        self.pairs: dict[tuple[int, int], bool] = {}
        self.near: dict[str, int] = {}
        self.choice: dict[tuple[int, int], int] = {}
        self.memo = _Memo(self.piece)

    def fits(self, left: int, right: int) -> bool:
        """Whether the merges leave ``left`` and ``right`` side by side."""
        known = self.pairs.get((left, right))
        if known is None:
            if len(self.pairs) >= MEMO_PAIRS:
                self.pairs.clear()
            known = self.pairs[left, right] = self._fits(left, right)
        return known

    def _fits(self, left: int, right: int) -> bool:
        # Undo the merges of both sides, latest first (on equal ranks the right one, as merges
        # go from the left). A merge across the border that comes before the last one undone
        # would have been made in its place.
        bound = float("inf")
        while True:
            across = self.merged.get((left, right))
            if across is not None and across < bound:
                return False
            in_left, in_right = self.split.get(left), self.split.get(right)
            if in_left is None and in_right is None:
                return True
            if in_right is None or (in_left is not None and left > right):
                bound, left = left, in_left[1]
            else:
                # A merge of the same rank further left comes first.
                bound, right = right + 1, in_right[0]

    def longest(self, data: str, at: int) -> int | None:
        """The longest token of ``data`` that begins at ``at``."""
        ahead = data[at : at + self.widest]
        walked = self.automaton.longest_prefix(ahead)
        rank = None
        for n in range(walked, 0, -1):
            rank = self.automaton.get(ahead[:n], None)
            if rank is not None:
                break
        near = data[at : at + NEAR]
        if rank is not None and (walked < NEAR or len(near) < NEAR):  # what follows cannot matter
            if len(self.near) >= MEMO_PAIRS:
                self.near.clear()
            self.near[near] = rank
        return rank

    def choose(self, last: int, first: int | None) -> int:
        """``first`` or its longest prefix that may follow ``last`` (-1: nothing), else -1."""
        token = first
        while token is not None and last >= 0 and not self.fits(last, token):
            token = self.shorter.get(token)
        token = -1 if token is None else token
        if first is not None:
            if len(self.choice) >= MEMO_PAIRS:
                self.choice.clear()
            self.choice[last, first] = token
        return token

    def piece(self, piece: str) -> tuple[int, ...]:
        """The tokens of one piece."""
        raw = piece.encode("utf-8")
        rank = self.ranks.get(raw)
        if rank is not None:  # a piece that is a token is that token, whatever the merges
            return (rank,)
        data = raw.decode("latin-1")
        near, choice, size, shorter = self.near, self.choice, self.size, self.shorter
        out, dead, last, at, n = [], set(), -1, 0, len(data)
        while at < n:
            first = near.get(data[at : at + NEAR])
            if first is None:
                first = self.longest(data, at)
            token = choice.get((last, first))
            if token is None:
                token = self.choose(last, first)
            while token < 0 or at + size[token] in dead:
                if token >= 0:
                    first = shorter.get(token)
                    token = choice.get((last, first))
                    if token is None:
                        token = self.choose(last, first)
                elif out:
                    dead.add(at)
                    token = out.pop()
                    at -= size[token]
                    last = out[-1] if out else -1
                else:
                    raise ValueError("the vocabulary does not cover every byte")
            out.append(token)
            at += size[token]
            last = token
        return tuple(out)

    def encode(self, text: str) -> list[int]:
        if len(self.memo) > MEMO_PIECES:
            self.memo.clear()
        return list(chain.from_iterable(map(self.memo.__getitem__, self.find(text))))

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))

    def digits(self, ids: list[int]) -> str:
        return ",".join(map(self.text_of.__getitem__, ids))


_CODECS: dict[tuple[str, str], Codec] = {}


def _worker_codec(shared, key: tuple[str, str]) -> Codec:
    """The codec of this worker process, built from the broadcast vocabulary when first asked for."""
    if key not in _CODECS:
        _CODECS.clear()
        _CODECS[key] = Codec(shared.value, key[1])
    return _CODECS[key]


def _shared(df: DataFrame, path: str, pattern: str):
    """The vocabulary as a broadcast: as large as its file, however many documents there are."""
    ranks = read_ranks(path)
    name = hashlib.sha256(repr(sorted(ranks.items())).encode()).hexdigest()
    return df.sparkSession.sparkContext.broadcast(ranks), (name, pattern)


def encode(df: DataFrame, id_col: str, text_col: str, path: str, pattern: str) -> DataFrame:
    """(id, ids array<int>) of every text."""
    docs = pick(df, id=id_col, text=text_col)
    shared, key = _shared(df, path, pattern)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        codec = _worker_codec(shared, key)
        ids = [codec.encode(t or "") for t in batch.column("text").to_pylist()]
        return pa.record_batch([batch.column("id"), pa.array(ids, pa.list_(pa.int32()))], ["id", "ids"])

    kind = docs.schema["id"].dataType.simpleString()
    return map_slices(docs, work, f"id {kind}, ids array<int>").toDF(id_col, "ids")


def decode(df: DataFrame, id_col: str, ids_col: str, path: str, pattern: str) -> DataFrame:
    """(id, bytes) of every array of ids; an id outside the vocabulary fails the job."""
    rows = pick(df, id=id_col, ids=ids_col)
    shared, key = _shared(df, path, pattern)

    def run(batches):
        codec = _worker_codec(shared, key)
        for batch in batches:
            data = [codec.decode(x or []) for x in batch.column("ids").to_pylist()]
            yield pa.record_batch([batch.column("id"), pa.array(data, pa.binary())], ["id", "bytes"])

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, bytes binary").toDF(id_col, "bytes")


def round_trip(df: DataFrame, keys: list[str], text_col: str, path: str, pattern: str) -> DataFrame:
    """The key columns, n_tokens, ids_sha256 and decoded_sha256: encoded, decoded again, both as digests."""
    docs = df.select(F.struct(*[column(df, k) for k in keys]).alias("keys"), column(df, text_col).alias("text"))
    shared, key = _shared(df, path, pattern)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        codec = _worker_codec(shared, key)
        n, ids_hash, bytes_hash = [], [], []
        for text in batch.column("text").to_pylist():
            ids = codec.encode(text or "")
            n.append(len(ids))
            ids_hash.append(hashlib.sha256(codec.digits(ids).encode()).hexdigest())
            bytes_hash.append(hashlib.sha256(codec.decode(ids)).hexdigest())
        columns = [pa.array(n, pa.int64()), pa.array(ids_hash, pa.string()), pa.array(bytes_hash, pa.string())]
        return pa.record_batch([batch.column("keys"), *columns], ["keys", "n_tokens", "ids_sha256", "decoded_sha256"])

    kind = docs.schema["keys"].dataType.simpleString()
    schema = f"keys {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    return map_slices(docs, work, schema).select("keys.*", "n_tokens", "ids_sha256", "decoded_sha256")
