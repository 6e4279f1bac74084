"""Byte-level BPE: exact encoding by backtracking over longest matches, and decoding."""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.llm.common import Splitter, rows

RANKS = "byte_bpe_50k.tiktoken"
#: Pieces and token pairs remembered by a worker, some 50 MB; beyond that it forgets all and starts anew.
REMEMBERED = 150_000
#: Longer pieces are encoded each time.
SHORT = 64


class Encoder:
    """Encoder of one rank table.

    Bytes are read as Latin-1 characters, so that an automaton over strings finds the tokens. A sequence of tokens is what the merges would give exactly if each two neighbours are what
    the merges would give for their bytes alone. So the encoder takes the longest token at a position, falls back to
    shorter ones if it doesn't fit its left neighbour, and steps back if none does; a position it has to give up is
    never entered again, so that a piece takes time in proportion to its length.
    """

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        top = max(ranks.values(), default=0) + 1
        self.bytes = [b""] * top
        self.size = [0] * top
        #: What the first and the last part of a token grow through, each with the rank of the merge that ends it.
        self.heads: list[tuple] = [()] * top
        self.tails: list[tuple] = [()] * top
        #: The longest other token that begins a token, or -1.
        self.shorter = [-1] * top
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        made = set()
        for token, rank in ranks.items():
            self.bytes[rank], self.size[rank] = token, len(token)
            parts, heads, tails = self.merged(token)
            if len(parts) == 1:  # else the merges never make it
                made.add(token)
                self.heads[rank], self.tails[rank] = heads, tails
                self.automaton.add_word(token.decode("latin-1"), rank)
        for token in made:
            begins = (token[:n] for n in range(len(token) - 1, 0, -1))
            self.shorter[ranks[token]] = next((ranks[x] for x in begins if x in made), -1)
        self.longest_token = max(map(len, ranks), default=1)
        self.longest: dict[str, int] = {}
        self.compatible: dict[int, bool] = {}
        self.known: dict[str, bytes] = {}

    def merged(self, text: bytes) -> tuple[list[bytes], tuple, tuple]:
        """The merges themselves, smallest rank first, leftmost of equal ones; for short strings only.

        Also the first parts there were on the way, each with the rank of the merge that ended it, and the last parts.
        """
        ranks, parts = self.ranks, [text[i : i + 1] for i in range(len(text))]
        heads, tails = [], []
        while True:
            best = at = None
            for i in range(len(parts) - 1):
                rank = ranks.get(parts[i] + parts[i + 1])
                if rank is not None and (best is None or rank < best):
                    best, at = rank, i
            if at is None:
                break
            if at == 0:
                heads.append((parts[0], best))
            if at == len(parts) - 2:
                tails.append((parts[-1], best))
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        never = len(self.bytes)
        return parts, (*heads, (parts[0], never)), (*tails, (parts[-1], never))

    def fits(self, left: int, right: int) -> bool:
        """Whether the merges keep two neighbouring tokens apart, each whole. Remembered.

        Only a merge of what then ends the left token with what then begins the right one could cross the border. It
        comes first if its rank is below that of the next merge at the end of the left token (of equal ones that one
        is further left) and not above that of the next merge at the beginning of the right one.
        """
        pair = left << 32 | right
        known = self.compatible.get(pair)
        if known is None:
            if len(self.compatible) >= REMEMBERED:
                self.compatible.clear()
            ranks, tails, heads, i, j, never = self.ranks, self.tails[left], self.heads[right], 0, 0, len(self.bytes)
            known = True
            while known:
                (tail, left_ends), (head, right_ends) = tails[i], heads[j]
                rank = ranks.get(tail + head)
                known = rank is None or rank >= left_ends or rank > right_ends
                if left_ends <= right_ends:
                    i += 1
                    if left_ends == never:
                        break
                else:
                    j += 1
            self.compatible[pair] = known
        return known

    def encode_bytes(self, text: bytes) -> list[int]:
        """Tokens of one piece. A piece that is a token itself is that token."""
        whole = self.ranks.get(text)
        if whole is not None:
            return [whole]
        letters, size, sizes, compatible = text.decode("latin-1"), len(text), self.size, self.compatible
        tokens: list[int] = []
        given_up = bytearray(size + 1)
        at, last = 0, -1
        while at < size:
            token = self.longest_at(letters, at)
            while True:
                end = at + sizes[token]
                if not given_up[end]:
                    fits = last < 0 or compatible.get(last << 32 | token)
                    if fits or fits is None and self.fits(last, token):
                        tokens.append(token)
                        at, last = end, token
                        break
                token = self.shorter[token]
                if token < 0:
                    if not tokens:
                        raise ValueError("the tokens cannot spell this piece")
                    given_up[at] = 1
                    token = tokens.pop()
                    at -= sizes[token]
                    last = tokens[-1] if tokens else -1
        return tokens

    def longest_at(self, letters: str, at: int) -> int:
        """The longest token that begins at a position. Remembered by the longest string there that begins a token."""
        ahead = letters[at : at + self.longest_token]
        begun = ahead[: self.automaton.longest_prefix(ahead)]
        token = self.longest.get(begun)
        if token is None:
            spelled = begun.encode("latin-1")
            found = (spelled[:n] for n in range(len(spelled), 0, -1))
            token = next((r for x in found if (r := self.ranks.get(x)) is not None and self.tails[r]), None)
            if token is None:
                raise ValueError(f"no token begins with byte {ord(ahead[0])}")
            self.longest[begun] = token
        return token

    def encode_piece(self, piece: str) -> bytes:
        """Token ids as little-endian unsigned 32-bit integers."""
        known = self.known.get(piece)
        if known is None:
            tokens = self.encode_bytes(piece.encode())
            known = struct.pack(f"<{len(tokens)}I", *tokens)
            if len(piece) <= SHORT:
                if len(self.known) >= REMEMBERED:
                    self.known.clear()
                self.known[piece] = known
        return known


@lru_cache(maxsize=2)
def load(path: str, pattern: str) -> tuple[Encoder, Splitter, pa.Array]:
    """Encoder, splitter and the bytes of each id; read once by each worker."""
    with open(path, "rb") as file:
        lines = [line.split() for line in file if line.strip()]
    ranks = {base64.b64decode(token): int(rank) for token, rank in lines}
    encoder = Encoder(ranks)
    return encoder, Splitter(pattern), pa.array(encoder.bytes, pa.binary())


def decode(spelled: pa.Array, ids: np.ndarray) -> bytes:
    """The bytes of the ids, looked up and laid end to end by Arrow."""
    taken = pc.take(spelled, pa.array(ids, pa.uint32()))
    if not len(taken):
        return b""
    edges = np.frombuffer(taken.buffers()[1], np.int32)
    return taken.buffers()[2].to_pybytes()[edges[0] : edges[len(taken)]]


_DECODED = 1 << 18


def _rows(path: str, pattern: str, with_ids: bool, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    encoder, split, spelled = load(path, pattern)
    known = encoder.encode_piece
    for batch in batches:
        kept_rows, out, size, begin = batch.column(0), [], 0, 0
        for (text,) in rows(iter([batch]), "text"):
            count, ids_hash, text_hash, kept = 0, hashlib.sha256(), hashlib.sha256(), []
            for part in split.lists(text or ""):
                packed = b"".join([known(p) for p in part])
                ids_hash.update(packed)
                ids = np.frombuffer(packed, "<u4")
                for start in range(0, len(ids), _DECODED):
                    text_hash.update(decode(spelled, ids[start : start + _DECODED]))
                count += len(ids)
                if with_ids:
                    kept.append(packed)
                    size += len(packed)
            out.append((count, ids_hash.hexdigest(), text_hash.hexdigest(), b"".join(kept)))
            if size > 1 << 24:
                yield _batch(kept_rows.slice(begin, len(out)), out, with_ids)
                begin, out, size = begin + len(out), [], 0
        if out:
            yield _batch(kept_rows.slice(begin), out, with_ids)


def _batch(kept: pa.Array, out: list[tuple], with_ids: bool) -> pa.RecordBatch:
    """The kept columns as they came, of whatever type, and the results of their rows."""
    columns = list(zip(*out, strict=True))
    arrays = [kept, pa.array(columns[0], pa.int64()), *map(pa.array, columns[1:3])]
    names = ["row", "n_tokens", "ids_sha256", "decoded_sha256"]
    if with_ids:
        flat = np.frombuffer(b"".join(columns[3]), "<u4").astype(np.int32)
        edges = np.cumsum([0, *map(len, columns[3])]) // 4
        arrays.append(pa.ListArray.from_arrays(pa.array(edges, pa.int32()), pa.array(flat)))
        names = [*names, "ids"]
    return pa.RecordBatch.from_arrays(arrays, names)


def encode(
    df: DataFrame,
    keep: list[str],
    text_col: str = "text",
    path: str | None = None,
    pattern: str = public_tokenizers.PATTERN,
    with_ids: bool = False,
) -> DataFrame:
    """The columns ``keep`` of every row, and the encoding of its whole text by the ranks in the file ``path``.

    ``n_tokens``; ``ids_sha256`` of the ids as little-endian unsigned 32-bit integers; ``decoded_sha256`` of the bytes
    that these ids decode to; with ``with_ids`` also ``ids``. Every match of ``pattern`` is encoded by itself, and there
    are no special tokens. A null or empty text has no tokens; repeated rows give repeated rows; no rows give none. A
    long text is split and hashed in parts. Ids kept as a column are held for one text at a time.

    One pass without a shuffle. The file must be at the same place on every executor, as the installed package is.
    """
    path = path or public_tokenizers.path(RANKS)
    inner = df.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row"), F.col(f"`{text_col}`").alias("text"))
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    fields = ", ".join(f"`{c}`: {types[c]}" for c in keep)
    schema = f"row struct<{fields}>, n_tokens long, ids_sha256 string, decoded_sha256 string"
    schema += ", ids array<int>" * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _rows(path, pattern, with_ids, batches)

    out = inner.mapInArrow(run, schema)
    return out.select("row.*", *[c for c in out.columns if c != "row"])
