"""Alignment of two tokenizers' tokens over the same text, and how often their ids meet in a corpus.

Tokenizer A is a byte-level BPE (``tokenizers``), B a piece model with byte
fallback (``sentencepiece``); B puts a space before the text, so A is given one too.
Spans come from the libraries: A's character offsets, B's byte spans of the
proto result (what older releases call the immutable proto). They are coarse: a token that is only part of a
character reports the whole of it, a byte-fallback token the end of it or nothing. Such runs are
refined by the lengths of the decoded bytes; everywhere else the libraries' cuts stand.

No token of either goes from a letter, digit or sign on into a space, so a text is cut there into units,
a word with the white space before it, which both tokenize alike wherever they stand; a worker
tokenizes and links each unit once and keeps it for the next time.

Byte offsets where tokens of both end cut the text into groups. All
A-B pairs of a group are linked. To count in how many documents a pair of ids is
linked, texts are taken in batches of a bounded size: a batch sends each of its distinct
pairs once, with its number of documents, and receives each pair's corpus-wide
count once. So a pair of a third of all documents is one row a batch, and the links
of documents are never joined one by one.
"""

from __future__ import annotations

import os
from itertools import chain

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import document_chunks, staged, utf8_column

TOKENIZER_A, TOKENIZER_B = "byte_bpe_50k.json", "piece_bpe_32k.model"
CHUNK_BYTES = 1 << 20       # text tokenised and linked at once; a longer text is on its own
BATCH_BYTES = 8 << 20       # text whose pairs are counted together before they are sent
KEPT_CHARS, KEPT_UNITS = 8 << 20, 400_000  # of units a worker remembers; then those met once go
JOINED_UNITS = 2000         # units encoded as one text
DENSE_LINKS = 4096          # links of a group from which on its distinct ids are paired instead of its tokens


def _letter_bytes() -> dict[str, int]:
    """The byte behind each letter of a byte-level vocabulary: printable ones stand for themselves, the rest follow from U+0100."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(0x100 + i): b for i, b in enumerate(hidden)}


class Tokenizers:
    """Both tokenizers with the bytes of each id; one per Python worker."""

    def __init__(self, path_a: str, path_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has a task per core
        import sentencepiece
        import tokenizers
        self.a = tokenizers.Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        letters = _letter_bytes()
        self.bytes_a = [b""] * self.a.get_vocab_size()
        for token, i in self.a.get_vocab().items():
            self.bytes_a[i] = bytes(letters[c] for c in token) if all(c in letters for c in token) else token.encode()
        self.bytes_b = []
        for i in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(i)
            self.bytes_b.append(bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode())
        self.size_a, self.size_b = (np.array([len(t) for t in x], np.int64) for x in (self.bytes_a, self.bytes_b))
        if any("▁" in self.b.id_to_piece(i).lstrip("▁") for i in range(self.b.get_piece_size())):
            raise ValueError("a piece goes on from another character into a space")
        self.text_a, self.text_b = ([f"{i}{sep}" for i in range(len(x)) for sep in (",", last)] for x, last in ((self.bytes_a, "|"), (self.bytes_b, ";")))

    def encode(self, texts: list[str]):
        """Which texts both give back byte by byte, and of these, A's and then B's ids, byte ends and tokens per text.

        A text is not empty and is encoded with a space before it; the ends run on from text to text.
        """
        shown = [" " + t for t in texts]
        a, b = self.a.encode_batch(shown, add_special_tokens=False), self.b.encode(texts, return_type="proto", num_threads=1)
        ids_a, ids_b = [x.ids for x in a], [[p.id for p in x.pieces] for x in b]
        raw = [x.encode() for x in shown]
        some = [i for i, (r, x, y) in enumerate(zip(raw, ids_a, ids_b))
                if b"".join(map(self.bytes_a.__getitem__, x)) == r and b"".join(map(self.bytes_b.__getitem__, y)) == r]
        n_a, n_b = (np.array([len(x[i]) for i in some], np.int64) for x in (ids_a, ids_b))
        ids_a, ids_b = (np.fromiter(chain.from_iterable(x[i] for i in some), np.int64, int(n.sum())) for x, n in ((ids_a, n_a), (ids_b, n_b)))
        sizes = np.array([len(raw[i]) for i in some], np.int64)
        before = np.cumsum(sizes) - sizes
        spans_a = np.fromiter(chain.from_iterable(chain.from_iterable(a[i].offsets for i in some)), np.int64, 2 * len(ids_a)).reshape(-1, 2)
        chars = np.array([len(shown[i]) for i in some], np.int64)
        spans_a += np.repeat(np.cumsum(chars) - chars, n_a)[:, None]
        if int(chars.sum()) != int(sizes.sum()):  # characters to bytes
            joined = np.frombuffer(b"".join(raw[i] for i in some), np.uint8)
            spans_a = np.append(np.flatnonzero((joined & 0xC0) != 0x80), len(joined))[spans_a]
        spans_b = np.fromiter(chain.from_iterable((p.begin, p.end) for i in some for p in b[i].pieces), np.int64, 2 * len(ids_b)).reshape(-1, 2)
        spans_b += np.repeat(before + 1, n_b)[:, None]  # of the text, without the space
        if some:
            spans_b[np.cumsum(n_b) - n_b, 0] = before
        return some, *((ids, refined(spans[:, 0], spans[:, 1], size[ids]), n) for ids, spans, size, n in (
            (ids_a, spans_a, self.size_a, n_a), (ids_b, spans_b, self.size_b, n_b)))


def refined(starts: np.ndarray, ends: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Exact byte ends from the coarse spans of a text's tokens and their decoded lengths.

    A token is a coarse cut if its span has as many bytes as it decodes to and
    the next one starts where it ends. Between such cuts ends are counted by decoded bytes.
    """
    sure = ends - starts == sizes
    sure[:-1] &= starts[1:] == ends[:-1]
    if sure.all():
        return ends
    exact = ends.copy()
    rough = np.flatnonzero(~sure)
    first = rough[np.concatenate([[True], np.diff(rough) > 1])]
    last = rough[np.concatenate([np.diff(rough) > 1, [True]])]
    for i, j in zip(first.tolist(), last.tolist()):
        at = exact[i - 1] if i else 0
        exact[i:j + 1] = at + np.cumsum(sizes[i:j + 1])
    return exact


def links(ids_a: np.ndarray, ends_a: np.ndarray, ids_b: np.ndarray, ends_b: np.ndarray):
    """Group of each A and B token, A and B tokens per group, and the links as (group, a, b, how many).

    Ends grow strictly; those of several texts may follow each other. In groups
    of many links equal ids are counted, so no group is expanded beyond its distinct ids.
    """
    cuts = ends_a[np.isin(ends_a, ends_b, assume_unique=True)]
    ga, gb = np.searchsorted(cuts, ends_a), np.searchsorted(cuts, ends_b)
    na, nb = np.bincount(ga, minlength=len(cuts)), np.bincount(gb, minlength=len(cuts))
    dense = na * nb > DENSE_LINKS
    first_b = np.cumsum(nb) - nb
    plain = ~dense[ga]
    times = np.where(plain, nb[ga], 0)
    total = int(times.sum())
    left = np.repeat(np.arange(len(ga)), times)
    right = np.arange(total) - np.repeat(np.cumsum(times) - times, times) + first_b[ga[left]]
    parts = [(ga[left], ids_a[left], ids_b[right], np.ones(total, np.int64))]
    for g in np.flatnonzero(dense).tolist():
        (xa, ca), (xb, cb) = (np.unique(ids[np.searchsorted(of, g):np.searchsorted(of, g, side="right")], return_counts=True)
                              for ids, of in ((ids_a, ga), (ids_b, gb)))
        parts.append((np.full(len(xa) * len(xb), g), np.repeat(xa, len(xb)), np.tile(xb, len(xa)), np.repeat(ca, len(xb)) * np.tile(cb, len(xa))))
    return ga, gb, na, nb, [np.concatenate(x) for x in zip(*parts)]


class Units:
    """The units met so far: their counts, the text of their groups and their distinct links."""

    def __init__(self, t: Tokenizers):
        import regex
        self.t, self.wide = t, len(t.bytes_b)
        self.closing = regex.compile(r"[!-~\p{L}\p{N}]").fullmatch
        self.closes: dict[str, bool] = {}
        self.known: dict[str, int] = {}
        self.chars, self.texts = 0, []
        self.counts, self.used = np.zeros((0, 4), np.int64), np.zeros(0, np.int64)  # A tokens (-1: not given back), B tokens, groups, links
        self.starts, self.codes, self.times = np.zeros(1, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def forget(self):
        """Keep the units met more than once since the last time; none if these are too many as well."""
        keep = self.used > 1
        if keep.sum() > KEPT_UNITS // 2:
            keep[:] = False
        names = [u for u, k in zip(self.known, keep.tolist()) if k]
        self.known, self.chars = dict(zip(names, range(len(names)))), sum(map(len, names))
        at = np.flatnonzero(keep)
        many = np.diff(self.starts)
        held = np.repeat(keep, many)
        self.texts = [self.texts[i] for i in at.tolist()]
        self.counts, self.used, self.codes, self.times = self.counts[at], np.zeros(len(at), np.int64), self.codes[held], self.times[held]
        self.starts = np.concatenate([[0], np.cumsum(many[at])])
        if self.chars > KEPT_CHARS // 2:
            self.used[:] = 0
            self.forget()

    def cut(self, text: str) -> list[str]:
        """The units of space + text, each without the space it begins with."""
        out, held, closes = [], None, self.closes
        for part in text.split(" "):
            if held is not None:
                part = held + " " + part
            last = part[-1:]
            ends = closes.get(last)
            if ends is None:
                ends = closes[last] = bool(self.closing(last))
            if ends:
                out.append(part)
                held = None
            else:
                held = part
        if held:
            out.append(held)
        elif held is not None and out:  # the text ends in a space, which B knows only after something
            out[-1] += " "
        return out

    def learn(self, units: list[str]):
        """Tokenise and link units not known yet: many as one text, which is cut into them again."""
        counts, texts = np.tile(np.array([[-1, 0, 0, 0]]), (len(units), 1)), [""] * len(units)
        joined: list[list[int]] = [[]]
        for i, u in enumerate(units):
            if not self.closes.get(u[-1:]):
                joined.insert(0, [i])  # what follows might go on with it
            else:
                joined[-1].append(i)
                if len(joined[-1]) == JOINED_UNITS:
                    joined.append([])
        parts = []
        while joined := [g for g in joined if g]:
            some, a, b = self.t.encode([" ".join([units[i] for i in g]) for g in joined])
            of = [i for n in some for i in joined[n]]
            if of:
                parts.append(self._linked(of, [units[i] for i in of], a[0], a[1], b[0], b[1], counts, texts))
            good = set(some)
            joined = [[i] for n, g in enumerate(joined) if n not in good and len(g) > 1 for i in g]
        of, codes, times = (np.concatenate(x) for x in zip(*parts)) if parts else (np.zeros(0, np.int64),) * 3
        order = np.argsort(of, kind="stable")
        of, codes, times = of[order], codes[order], times[order]
        self.known.update(zip(units, range(len(self.known), len(self.known) + len(units))))
        self.chars += sum(map(len, units))
        self.texts += texts
        self.counts, self.used = np.concatenate([self.counts, counts]), np.concatenate([self.used, np.zeros(len(units), np.int64)])
        self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(np.bincount(of, minlength=len(units)))])
        self.codes, self.times = np.concatenate([self.codes, codes]), np.concatenate([self.times, times])

    def _linked(self, of, units, a, ea, b, eb, counts, texts):
        """Fill in ``counts`` and ``texts`` of the units numbered ``of`` that make up the tokens; their links as (of, code, times)."""
        ends = np.cumsum([1 + len(u.encode()) for u in units])
        ga, gb, na, nb, (g, la, lb, times) = links(a, ea, b, eb)
        until_a, until_b = np.searchsorted(ea, ends, side="right"), np.searchsorted(eb, ends, side="right")
        cut = [np.concatenate([[0], x]) for x in (until_a, until_b, ga[until_a - 1] + 1)]
        bounds = np.concatenate([[0], np.cumsum(na * nb)])
        counts[of] = np.stack([np.diff(cut[0]), np.diff(cut[1]), np.diff(cut[2]), np.diff(bounds[cut[2]])], 1)
        flat = np.empty(len(a) + len(b), object)  # every id with the sign that follows it
        for ids, group, before, text in ((a, ga, np.cumsum(nb) - nb, self.t.text_a), (b, gb, np.cumsum(na), self.t.text_b)):
            last = np.append(group[1:] != group[:-1], True)
            flat[np.arange(len(ids)) + before[group]] = list(map(text.__getitem__, (2 * ids + last).tolist()))
        flat, places = flat.tolist(), (cut[0] + cut[1]).tolist()
        for n, i in enumerate(of):
            texts[i] = "".join(flat[places[n]:places[n + 1]])
        span = len(self.t.bytes_a) * self.wide
        unit = np.array(of)[np.searchsorted(cut[2], g, side="right") - 1]
        key, inverse = np.unique(unit * span + la * self.wide + lb, return_inverse=True)
        times = np.bincount(inverse, times, len(key)).astype(np.int64)
        return key // span, key % span, times

    def documents(self, texts: list[str]):
        """Per text its four counts, the text of its groups, and its distinct links with their times; all empty if a unit is not given back."""
        if self.chars > KEPT_CHARS or len(self.known) > KEPT_UNITS:
            self.forget()
        cut = [self.cut(x) if x else [] for x in texts]
        if new := [u for u in dict.fromkeys(u for units in cut for u in units) if u not in self.known]:
            self.learn(new)
        units = [list(map(self.known.__getitem__, x)) for x in cut]
        sizes = [len(x) for x in units]
        every = np.fromiter((u for x in units for u in x), np.int64, sum(sizes))
        self.used += np.bincount(every, minlength=len(self.used))
        doc = np.repeat(np.arange(len(texts)), sizes)
        good = np.ones(len(texts), bool)
        good[doc[self.counts[every, 0] < 0]] = False
        doc, every = doc[good[doc]], every[good[doc]]
        counts = np.stack([np.bincount(doc, self.counts[every, k], len(texts)).astype(np.int64) for k in range(4)], 1)
        n = len(self.known)
        key, often = np.unique(doc * n + every, return_counts=True)
        doc, unit = np.divmod(key, max(n, 1))
        many = self.starts[unit + 1] - self.starts[unit]
        at = np.arange(int(many.sum())) + np.repeat(self.starts[unit] - np.cumsum(many) + many, many)
        span = len(self.t.bytes_a) * self.wide
        code, inverse = np.unique(np.repeat(doc, many) * span + self.codes[at], return_inverse=True)
        times = np.bincount(inverse, self.times[at] * np.repeat(often, many), len(code)).astype(np.int64)
        doc, code = np.divmod(code, span)
        bounds = np.searchsorted(doc, np.arange(len(texts) + 1))
        for i in range(len(texts)):
            text = "".join(map(self.texts.__getitem__, units[i]))[:-1] if good[i] else ""
            yield counts[i].tolist(), text, code[bounds[i]:bounds[i + 1]], times[bounds[i]:bounds[i + 1]]


_UNITS: dict[tuple[str, str], Units] = {}
_ROW = ("batch long, _key string, n_a long, n_b long, n_groups long, n_links long, groups string, groups_sha256 string, "
        "at binary, times binary, a binary, b binary, docs binary")


def linked(rows: DataFrame, path_a: str, path_b: str, groups: bool = False) -> DataFrame:
    """Rows (``_key``, ``_text``) encoded: a row per document and, without a key, one per batch.

    A document has its counts, its groups' text (if asked for) and digest, and its distinct links: places ``at`` in the
    batch's list and how many ``times`` each. A batch has that list: ids ``a`` and ``b`` and in how many of its
    ``docs`` they are linked. Batches are numbered by partition, so they are only told apart within one staged result.
    """
    import pyarrow as pa

    names = [x.split()[0] for x in _ROW.split(", ")]
    kinds = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}
    types = [kinds[x.split()[1]] for x in _ROW.split(", ")]

    def work(batches):
        import hashlib

        from pyspark import TaskContext
        if (path_a, path_b) not in _UNITS:  # a worker's next tasks go on with them
            _UNITS[path_a, path_b] = Units(Tokenizers(path_a, path_b))
        known = _UNITS[path_a, path_b]
        wide = known.wide
        number, held, size = TaskContext.get().partitionId() << 32, [], 0

        def send():
            """The held documents: distinct links of the batch, commonest first, and each document's places in it."""
            of = np.repeat(np.arange(len(held)), [len(h[-2]) for h in held])
            codes = np.concatenate([h[-2] for h in held]) if held else np.zeros(0, np.int64)
            distinct, at, docs = np.unique(codes, return_inverse=True, return_counts=True)
            order = np.argsort(-docs, kind="stable")
            rank = np.empty(len(order), np.uint32)
            rank[order] = np.arange(len(order), dtype=np.uint32)
            at, distinct, docs = rank[at], distinct[order], docs[order]
            bounds = np.searchsorted(of, np.arange(len(held) + 1))
            out = []
            for i, (key, counts, text, sha, _, times) in enumerate(held):
                mine = at[bounds[i]:bounds[i + 1]]
                by = np.argsort(mine)
                out.append([number, key, *counts, text, sha, mine[by].tobytes(), times[by].tobytes(), None, None, None])
            out.append([number, None, None, None, None, None, None, None, None, None, (distinct // wide).astype(np.int32).tobytes(),
                        (distinct % wide).astype(np.int32).tobytes(), docs.astype(np.int32).tobytes()])
            return [pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*out[i:i + 1000]), types)], names) for i in range(0, len(out), 1000)]

        for batch in batches:
            raw, at = utf8_column(batch.column("_text"))
            keys = batch.column("_key").to_pylist()
            for first, last in document_chunks(at, CHUNK_BYTES):
                texts = [bytes(raw[at[i]:at[i + 1]]).decode("utf-8", "surrogatepass") for i in range(first, last)]
                for key, (counts, text, codes, times) in zip(keys[first:last], known.documents(texts)):
                    sha = hashlib.sha256(text.encode()).hexdigest() if text else ""
                    held.append((key, counts, text if groups else None, sha, codes, times.astype(np.uint32)))
                size += int(at[last] - at[first])
                if size >= BATCH_BYTES:
                    yield from send()
                    number, held, size = number + 1, [], 0
        if held:
            yield from send()

    return rows.mapInArrow(work, _ROW)


def pair_requests(encoded: DataFrame) -> DataFrame:
    """``batch``, ``at``, ``a``, ``b`` and ``docs``: the distinct links of each batch as rows."""
    import pyarrow as pa

    def work(batches):
        for batch in batches:
            for row in batch.to_pylist():
                a, b, docs = (np.frombuffer(row[c], np.int32) for c in ("a", "b", "docs"))
                for i in range(0, len(a), 1 << 16):
                    n = len(a[i:i + (1 << 16)])
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(n, row["batch"])), pa.array(np.arange(i, i + n, dtype=np.int32)),
                                                      *(pa.array(x[i:i + n]) for x in (a, b, docs))], ["batch", "at", "a", "b", "docs"])

    return encoded.filter("docs IS NOT NULL").select("batch", "a", "b", "docs").mapInArrow(work, "batch long, at int, a int, b int, docs int")


def pair_counts(requests: DataFrame) -> DataFrame:
    """``a``, ``b``, ``documents`` (in how many the pair is linked) and ``best``: whether that is its A id's highest."""
    counts = staged(requests.groupBy("a", "b").agg(F.sum("docs").alias("documents")), "pair-counts")
    top = counts.groupBy(F.col("a").alias("_a")).agg(F.max("documents").alias("_most"))
    return counts.join(top, F.col("a") == F.col("_a")).select("a", "b", "documents", (F.col("documents") == F.col("_most")).alias("best"))


def align(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text",
          groups: bool = False) -> tuple[DataFrame, DataFrame]:
    """The documents' alignment and the corpus-wide pairs of ids.

    Documents: a row per input row with ``id_col``, ``n_a``, ``n_b`` (tokens), ``n_groups``, ``n_links``,
    ``n_best`` (links whose pair is linked in as many documents as any of its A id), ``count_sum`` (over links,
    the documents of their pair), ``groups_sha256`` and, if asked for, ``groups``, the ids of each group as text.
    Pairs: ``a``, ``b``, ``documents``, ``best``.

    Texts that are null, empty or not given back byte by byte by both tokenizers have no tokens: zeros and an empty
    digest. A very long text is one batch and is encoded whole. Rows that repeat an id or a text count as documents of
    their own; ties for best are all best. An empty table gives no rows; other columns are ignored.
    """
    rows = docs.select(docs[id_col].cast("string").alias("_key"), F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("_text"))
    encoded = staged(linked(rows, path_a, path_b, groups), "alignment")
    requests = pair_requests(encoded)
    pairs = staged(pair_counts(requests), "pairs")
    answers = requests.join(pairs.select(F.col("a").alias("_a"), F.col("b").alias("_b"), "documents", "best"),
                            (F.col("a") == F.col("_a")) & (F.col("b") == F.col("_b"))).select("batch", "at", "documents", "best")

    def finish(key, left, right):
        import pyarrow as pa
        at = right["at"].to_numpy()
        documents, best = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
        documents[at], best[at] = right["documents"].to_numpy(), right["best"].to_numpy(zero_copy_only=False)
        sums = []
        for places, times in zip(left["at"].to_pylist(), left["times"].to_pylist()):
            places, times = np.frombuffer(places, np.uint32), np.frombuffer(times, np.uint32).astype(np.int64)
            sums.append((int(times @ best[places]), int(times @ documents[places])))
        n_best, count_sum = zip(*sums) if sums else ((), ())
        return left.drop_columns(["batch", "at", "times"]).append_column("n_best", pa.array(n_best, pa.int64())).append_column(
            "count_sum", pa.array(count_sum, pa.int64()))

    kept = ["_key", "n_a", "n_b", "n_groups", "n_links", *["groups"] * groups, "groups_sha256"]
    of_docs = encoded.filter("docs IS NULL").select("batch", *kept, "at", "times")
    types = dict(of_docs.dtypes)
    done = of_docs.groupBy("batch").cogroup(answers.groupBy("batch")).applyInArrow(
        finish, ", ".join(f"{c} {types[c]}" for c in kept) + ", n_best long, count_sum long")
    kind = dict(docs.select(docs[id_col].alias("_id")).dtypes)["_id"]
    out = done.select(F.col("_key").cast(kind).alias(id_col), "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", *["groups"] * groups)
    return out, pairs
