"""Byte-level BPE by prefix dynamic programming.

Byte-pair encoding has the property that the encoding of every prefix of a
string ends in exactly one valid token: token ``t`` ends the prefix of length
``i`` if the prefix of length ``i - len(t)`` ends in a token ``u`` such that
merging the bytes of ``u`` and ``t`` by ranks gives back ``u, t``. The table of
these last tokens, one per prefix, is filled from left to right and read back from its end.
Appending only extends it; after an edit it is recomputed from the edit until
it agrees with the old one over the length of the longest token.
"""

from __future__ import annotations

import base64
import hashlib
from itertools import islice

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import release_memory

VOCABULARY = "byte_bpe_50k.tiktoken"
CACHE_PIECES = 1 << 19   # pieces a worker remembers; the cache is emptied when full
CACHE_PAIRS = 1 << 20    # token pairs a worker remembers
LONG_TEXT = 1 << 20       # texts of more characters are encoded in batches of pieces
CACHE_BYTES = 64         # longer pieces are not remembered


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


NEVER = 1 << 62


def merges(piece: bytes, ranks: dict[bytes, int]):
    """Plain byte-pair merging, quadratic; for short strings. Yields the rank of each merge and the parts after it."""
    rank = ranks.get
    parts = [piece[i:i + 1] for i in range(len(piece))]
    joins = [rank(a + b, NEVER) for a, b in zip(parts, parts[1:])]
    yield -1, parts
    while joins and (lowest := min(joins)) < NEVER:
        at = joins.index(lowest)
        parts[at:at + 2] = [parts[at] + parts[at + 1]]
        del joins[at]
        if at < len(joins):
            joins[at] = rank(parts[at] + parts[at + 1], NEVER)
        if at:
            joins[at - 1] = rank(parts[at - 1] + parts[at], NEVER)
        yield lowest, parts


def merge_by_rank(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    parts: list[bytes] = []
    for _, parts in merges(piece, ranks):
        pass
    return [ranks[p] for p in parts]


_CODECS: dict[str, Codec] = {}  # one per worker process, with what its tasks have learnt


def codec_of(ranks_path: str) -> Codec:
    if ranks_path not in _CODECS:
        _CODECS[ranks_path] = Codec(load_ranks(ranks_path))
    return _CODECS[ranks_path]


class Codec:
    """Encoder and decoder over the ranks of a byte-level vocabulary."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.longest = max(map(len, ranks))
        # every tail of a token, with its own rank where it is a token itself
        self.tails = {token[i:]: ranks.get(token[i:], -1) for token in ranks for i in range(len(token))}
        self.pairs: dict[int, bool] = {}
        self.courses: dict[int, tuple[list[int], list[bytes], list[bytes], bool]] = {}
        self.pieces: dict[str, str] = {}  # the ids of a piece as text; they decode to the piece

    def course(self, token: int) -> tuple[list[int], list[bytes], list[bytes], bool]:
        """How the token's own bytes merge: rank of each merge, first and last part around it, whether the token results."""
        if (known := self.courses.get(token)) is None:
            steps = [(rank, parts[0], parts[-1]) for rank, parts in merges(self.tokens[token], self.ranks)]
            known = ([s[0] for s in steps[1:]] + [NEVER], [s[1] for s in steps], [s[2] for s in steps],
                     steps[-1][1] == self.tokens[token])
            self.courses[token] = known
        return known

    def compatible(self, left: int, right: int) -> bool:
        """Whether merging the bytes of both tokens gives just these two.

        Either side merges by itself as long as no merge crosses between them;
        so their courses are followed together, lowest rank first, leftmost on a
        tie, until the parts at the boundary would merge before the next step of both.
        """
        if len(self.pairs) >= CACHE_PAIRS:
            self.pairs.clear()
        ranks_a, _, lasts, _ = self.course(left)
        ranks_b, firsts, _, _ = self.course(right)
        i = j = 0
        cross = self.ranks.get(lasts[0] + firsts[0], NEVER)
        while True:
            a, b = ranks_a[i], ranks_b[j]
            if cross < a and cross <= b:
                known = False
                break
            if a == b == NEVER:
                known = True
                break
            if a <= b:
                i += 1
            else:
                j += 1
            cross = self.ranks.get(lasts[i] + firsts[j], NEVER)
        self.pairs[left << 32 | right] = known
        return known

    def fill(self, data: bytes, last: list[int], stop: int) -> None:
        """Extend ``last`` by the one valid last token of each longer prefix of ``data``, up to ``stop`` bytes.

        Going back from the end of a prefix, the bytes passed stay the tail of
        some token only so far; of the tokens met, the longest that can follow the
        prefix before it is tried first.
        """
        tail, pair, course = self.tails.get, self.pairs.get, self.courses.get
        for end in range(len(last), stop + 1):
            if end <= self.longest:  # a prefix that is one token ends in it
                token = tail(data[:end], -1)
                if token >= 0 and (course(token) or self.course(token))[3]:
                    last.append(token)
                    continue
            begin, met = end - 1, []
            token = tail(data[begin:end])
            while token is not None:
                if token >= 0:
                    met.append((begin, token))
                if not begin:
                    break
                begin -= 1
                token = tail(data[begin:end])
            for begin, token in reversed(met):
                if not (course(token) or self.course(token))[3]:
                    continue
                if begin:
                    fits = pair(last[begin] << 32 | token)
                    if not (self.compatible(last[begin], token) if fits is None else fits):
                        continue
                last.append(token)
                break
            else:
                raise ValueError("the ranks lack a token for some byte")

    def table(self, data: bytes) -> PrefixTable:
        return PrefixTable(self, data)

    def encode_piece(self, piece: bytes) -> list[int]:
        """Ids of one piece of text. A piece that is a token is that token."""
        whole = self.ranks.get(piece)
        return [whole] if whole is not None else self.table(piece).ids()

    def decode(self, ids) -> bytes:
        tokens = self.tokens
        return b"".join([tokens[i] for i in ids])


class PrefixTable:
    """Last tokens of all prefixes of a byte string: ``last[i]`` ends ``data[:i]`` (``last[0]`` is unused)."""

    def __init__(self, codec: Codec, data: bytes = b""):
        self.codec, self.data, self.last = codec, bytearray(), [-1]
        self.append(data)

    def append(self, more: bytes) -> None:
        """Exact encoding of the longer string; no earlier entry changes."""
        self.data += more
        self.codec.fill(bytes(self.data), self.last, len(self.data))

    def replace(self, start: int, stop: int, new: bytes) -> int:
        """Put ``new`` in place of ``data[start:stop]``; returns how many entries were computed.

        An entry depends on the bytes and entries of the longest token's length
        before it only, so once that many agree with the old ones, the rest stays.
        """
        old, shift = self.last, len(new) - (stop - start)
        data = bytes(self.data[:start]) + new + bytes(self.data[stop:])
        last, agree, done = old[:start + 1], 0, 0
        for end in range(start + 1, len(data) + 1):
            self.codec.fill(data, last, end)
            done += 1
            was = end - shift
            agree = agree + 1 if was > stop and old[was] == last[-1] else 0
            if agree > self.codec.longest:
                last += old[was + 1:]
                break
        self.data, self.last = bytearray(data), last
        return done

    def ids(self) -> list[int]:
        out, end = [], len(self.data)
        while end:
            token = self.last[end]
            out.append(token)
            end -= len(self.codec.tokens[token])
        return out[::-1]


def encode_documents(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id",
                     text_col: str = "text", ids: bool = False) -> DataFrame:
    """``id_col``, ``n_tokens``, ``ids_sha256``, ``decoded_sha256``, and the ids themselves if asked for.

    Each match of ``pattern`` is encoded on its own, no special token is used,
    and the ids are decoded again. Null text counts as empty: no tokens, and the
    digests of nothing. Ties do not arise, repeated rows return as they are,
    other columns are ignored. The ranks file must be readable on every executor.
    """
    rows = docs.select(F.col(id_col), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("_text"))

    def encode(batches):
        import regex
        codec, split = codec_of(ranks_path), regex.compile(pattern)
        cache = codec.pieces

        def piece(p: str) -> str:
            found = codec.encode_piece(raw := p.encode())
            if codec.decode(found) != raw:
                raise ValueError("the ids of a piece decode to something else")
            entry = " ".join(map(str, found))
            if len(p) <= CACHE_BYTES:
                if len(cache) >= CACHE_PIECES:
                    cache.clear()
                cache[p] = entry
            return entry

        def batched(text: str):
            if len(text) <= LONG_TEXT:
                yield split.findall(text)
                return
            pieces = (m[0] for m in split.finditer(text))
            while some := list(islice(pieces, 100_000)):
                yield some

        for pdf in batches:
            out = []
            for key, text in zip(pdf["_key"], pdf["_text"], strict=True):
                numbers, decoded = hashlib.sha256(), hashlib.sha256()
                count, listed, begun = 0, [], ""
                for pieces in batched(text):  # long texts: digested as they come
                    if not pieces:
                        continue
                    joined = " ".join([cache.get(p) or piece(p) for p in pieces])
                    numbers.update((begun + joined).encode())
                    decoded.update("".join(pieces).encode())  # each piece's ids gave back its bytes when it was met first
                    count += joined.count(" ") + 1
                    begun = " "
                    if ids:
                        listed += map(int, joined.split())
                out.append([key, count, numbers.hexdigest(), decoded.hexdigest()] + [listed] * ids)
            yield pd.DataFrame(out, columns=["_key", "n_tokens", "ids_sha256", "decoded_sha256", *["ids"] * ids])
        release_memory()

    done = rows.select(F.col(id_col).cast("string").alias("_key"), "_text").mapInPandas(
        encode, "_key string, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * ids)
    return done.select(F.col("_key").cast(dict(rows.dtypes)[id_col]).alias(id_col), *done.columns[1:])
