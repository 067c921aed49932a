"""Removal of repeated byte strings by a common-prefix-aware distributed merge sort.

Every ``WINDOW``-byte string that also starts in a document with a smaller id is
to go. The suffixes that matter are found, sorted and compared as follows:

* Copies. A document whose whole text a smaller id has goes as a whole, by
  digest; the others are left to the following.
* Anchors. Of the ``KMER``-byte strings inside a window the one with the
  smallest hash is its anchor, so equal windows have equal anchors, and a
  document has far fewer anchors than windows. Tasks exchange hash, id and place of each
  anchor; only anchors found in two documents go on. (No window is lost: a
  repeated window has its anchor in both documents.)
* Runs. Consecutive windows of one anchor form a segment. Each task sorts its
  segments by the suffix at the anchor and writes every bucket of the sorted run
  front-coded: the length shared with the entry before, and the rest.
* Merge. The runs of a bucket are combined by a loser tree that
  keeps, for each run, the length its head shares with the last winner, and compares
  bytes only beyond it. Segments of one anchor come out together;
  there the windows of each are looked up among those of smaller ids.

An anchor in more than ``HOT`` documents would bring as many segments together;
its segments are cut into single windows, bucketed by the whole window, and
equal ones in a task's run are exchanged once.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import document_chunks, shuffle_partitions, staged, utf8_column

WINDOW = 50
KMER = 24
HOT = 2000            # documents of an anchor beyond which its windows are exchanged one by one
_PIECE = 64 << 10     # window starts hashed at a time: what a core's cache holds
_RUN = 400_000        # segments sorted into one run
BUCKETS_PER_TASK = 4
_BLOCK = 8 << 20      # bytes of whole texts taken at a time
_ANCHORS = 3_000_000  # anchors sent as one set of arrays
_P = np.uint64(0x9E3779B97F4A7C15)


# ---- anchors ----------------------------------------------------------------

def _sliding(a: np.ndarray, width: int, op) -> np.ndarray:
    """``op`` over every ``width`` neighbours, by doubling."""
    done = 1
    while done * 2 <= width:
        a = op(a[:-done], a[done:])
        done *= 2
    return op(a[:len(a) - (width - done)], a[width - done:]) if done < width else a


def kmer_hashes(raw: np.ndarray) -> np.ndarray:
    """64-bit hash of the ``KMER`` bytes at each place."""
    if len(raw) < KMER:
        return np.zeros(0, np.uint64)
    h, done = raw.astype(np.uint64) + np.uint64(1), 1
    whole, at = None, 0
    with np.errstate(over="ignore"):
        while done <= KMER:  # strings of 1, 2, 4 ... bytes, put together by the bits of KMER
            if KMER & done:
                whole = h.copy() if whole is None else whole[:len(h) - at] * np.uint64(pow(int(_P), done, 1 << 64)) + h[at:]
                at += done
            if done * 2 <= KMER:
                h = h[:-done] * np.uint64(pow(int(_P), done, 1 << 64)) + h[done:]
            done *= 2
        whole = whole[:len(raw) - KMER + 1]
        whole = (whole ^ (whole >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return whole ^ (whole >> np.uint64(29))


def anchors(raw: np.ndarray, at: np.ndarray | None = None) -> tuple[np.ndarray, ...]:
    """Text, place and hash of each anchor of texts that stand one after another in ``raw`` (offsets ``at``), and the
    first and last start of its windows; places count from the text's start.

    Where several equal smallest hashes lie in a window, the first is its
    anchor. The bytes are hashed piece by piece, whatever the texts' lengths: a
    stretch of windows may be cut in two between pieces.
    """
    at = np.array([0, len(raw)]) if at is None else np.asarray(at)
    parts = [_piece(raw[low:low + _PIECE + WINDOW - 1], low, at) for low in range(0, len(raw) - WINDOW + 1, _PIECE)]
    if not parts:
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(0, np.uint64), none, none
    text, place, h, first, last = (np.concatenate(x) for x in zip(*parts))
    begin = at[text]
    return text, place - begin, h, first - begin, last - begin


def _piece(raw: np.ndarray, low: int, at: np.ndarray) -> tuple[np.ndarray, ...]:
    width = WINDOW - KMER + 1
    h = kmer_hashes(raw)
    least = _sliding(h, width, np.minimum)
    n = len(least)
    # stretches of windows with one smallest hash, cut where a text begins or its last window has begun
    change = np.empty(n, bool)
    change[0] = True
    np.not_equal(least[1:], least[:-1], out=change[1:])
    near = at[max(0, np.searchsorted(at, low) - 1):np.searchsorted(at, low + n + WINDOW) + 1] - low
    for cuts in (near, near - WINDOW + 1):
        change[cuts[(cuts > 0) & (cuts < n)]] = True
    starts = np.flatnonzero(change)
    ends = np.append(starts[1:], n)
    text = np.searchsorted(at, starts + low, side="right") - 1
    whole = starts + low + WINDOW <= at[np.minimum(text + 1, len(at) - 1)]
    starts, ends, text = starts[whole], ends[whole], text[whole]
    # the usual case: the first place of the smallest hash serves the whole stretch
    place = _first_equal(h, least, starts, width)
    plain = place >= ends - 1
    out = [(text[plain], place[plain], starts[plain], ends[plain] - 1)]
    for t, s, e in zip(text[~plain].tolist(), starts[~plain].tolist(), ends[~plain].tolist()):  # equal strings close together
        equal = np.flatnonzero(h[s:e - 1 + width] == least[s]) + s
        w, rows = s, []
        while w < e:
            p = int(equal[np.searchsorted(equal, w)])
            rows.append((t, p, w, min(e - 1, p)))
            w = p + 1
        out.append(tuple(np.array(rows, np.int64).T))
    text, place, first, last = (np.concatenate(x).astype(np.int64) for x in zip(*out))
    if len(out) > 1:
        order = np.argsort(first, kind="stable")
        text, place, first, last = text[order], place[order], first[order], last[order]
    return text, place + low, h[place], first + low, last + low


def _first_equal(h, least, starts, width):
    """The first place in the window at each start whose hash is the smallest."""
    out = np.full(len(starts), -1, np.int64)
    open_ = np.arange(len(starts))
    for d in range(width):
        hit = h[starts[open_] + d] == least[starts[open_]]
        out[open_[hit]] = starts[open_[hit]] + d
        open_ = open_[~hit]
        if not len(open_):
            break
    return out


def _planes(a: np.ndarray) -> bytes:
    """Bytes of an array, all first bytes before all second ones: small numbers then compress to little."""
    return np.ascontiguousarray(a.view(np.uint8).reshape(len(a), -1).T).tobytes()


def _from_planes(data: bytes, kind) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(size, -1).T).reshape(-1).view(kind)


def _short(h: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and 32 further bits of a hash. Different anchors that agree in both are candidates in vain, no more."""
    return ((h & np.uint64(0xFFFFFFFF)) % np.uint64(buckets)).astype(np.int64), (h >> np.uint64(32)).astype(np.uint32)


def _anchor_arrays(rows: DataFrame, buckets: int) -> DataFrame:
    """Anchors of all documents, in arrays per block of text and bucket: hash, document and place."""
    import pyarrow as pa

    def emit(held):
        hashes, ids, places = (np.concatenate(x) for x in zip(*held))
        bucket, hashes = _short(hashes, buckets)
        order = np.argsort(bucket, kind="stable")
        cuts = np.searchsorted(bucket[order], np.arange(buckets + 1))
        full = np.flatnonzero(np.diff(cuts))
        columns = [[], [], []]
        for b in full:
            own = order[cuts[b]:cuts[b + 1]]
            columns[0].append(hashes[own].tobytes())
            columns[1].append(_planes(np.diff(ids[own], prepend=0)))
            columns[2].append(_planes(places[own]))
        return pa.RecordBatch.from_arrays([pa.array(full, pa.int32()), *(pa.array(c, pa.binary()) for c in columns)],
                                          ["bucket", "hashes", "ids", "places"])

    def work(batches):
        held, size = [], 0
        for batch in batches:
            raw, at = utf8_column(batch.column("_text"))
            ids = batch.column("_id").to_numpy(zero_copy_only=False)
            for first, last in document_chunks(at, _BLOCK):
                text, place, h, _, _ = anchors(raw[at[first]:at[last]], at[first:last + 1] - at[first])
                if len(h):
                    held.append((h, ids[first + text], place.astype(np.uint32)))
                    size += len(h)
                if size >= _ANCHORS:
                    yield emit(held)
                    held, size = [], 0
        if held:
            yield emit(held)

    return rows.mapInArrow(work, "bucket int, hashes binary, ids binary, places binary")


def _by_bucket(batches):
    """Lists of rows of one bucket after another, from batches sorted by ``bucket``."""
    held, rows = None, []
    for pdf in batches:
        for row in pdf.itertuples(index=False):
            if row.bucket != held and rows:
                yield rows
                rows = []
            held = row.bucket
            rows.append(row)
    if rows:
        yield rows


def _repeated_anchors(arrays: DataFrame, parts: int) -> DataFrame:
    """Per document and bucket: places and hashes of anchors found in two documents, and which are hot.

    A task holds one bucket at a time.
    """
    def work(batches):
        for rows in _by_bucket(batches):
            h = np.concatenate([np.frombuffer(r.hashes, np.uint32) for r in rows])
            d = np.concatenate([np.cumsum(_from_planes(r.ids, np.int64)) for r in rows])
            p = np.concatenate([_from_planes(r.places, np.uint32) for r in rows])
            order = np.argsort(h, kind="stable")
            h, d, p = h[order], d[order], p[order]
            first = np.concatenate([[True], h[1:] != h[:-1]])
            starts, group = np.flatnonzero(first), np.cumsum(first) - 1
            low, high = np.minimum.reduceat(d, starts), np.maximum.reduceat(d, starts)
            hot = np.diff(np.concatenate([starts, [len(d)]])) > HOT  # rows of the anchor: no fewer than its documents
            keep = (low < high)[group]
            h, d, p, hot = h[keep], d[keep], p[keep], hot[group][keep]
            if len(d):
                again = np.lexsort((p, d))
                h, d, p, hot = h[again], d[again], p[again], hot[again]
                cuts = np.concatenate([np.flatnonzero(np.concatenate([[True], d[1:] != d[:-1]])), [len(d)]])
                yield pd.DataFrame({"_id": d[cuts[:-1]], "anchors": [
                    p[a:z].tobytes() + h[a:z].tobytes() + hot[a:z].tobytes() for a, z in zip(cuts[:-1], cuts[1:])]})

    return (arrays.repartition(parts, "bucket").sortWithinPartitions("bucket")
            .mapInPandas(work, "_id long, anchors binary"))


# ---- sorted runs --------------------------------------------------------------

Entry = tuple[bytes, bytes, int, int, int, int]
"""Suffix at the anchor, bytes of the segment before it, document, checksum of its text, first window, number of
equal segments that start there and at the places right after."""

_NUMBERS = struct.Struct(">qIQI")


def front_code(entries: list[Entry]) -> bytes:
    """A sorted run: the length each suffix shares with the one before, the rest, and the other fields."""
    if not entries:
        return b""
    suffixes = np.array([e[0] for e in entries], f"S{2 * WINDOW}").view(np.uint8).reshape(len(entries), -1)
    length = np.array([len(e[0]) for e in entries])
    differ = np.ones((len(entries), suffixes.shape[1] + 1), bool)  # the last column ends the search
    differ[1:, :-1] = suffixes[1:] != suffixes[:-1]
    common = differ.argmax(axis=1)
    common[1:] = np.minimum(common[1:], np.minimum(length[1:], length[:-1]))
    pack = _NUMBERS.pack
    return b"".join([bytes((n, len(suffix) - n, len(left))) + suffix[n:] + left + pack(doc, tie, at, times)
                     for n, (suffix, left, doc, tie, at, times) in zip(common.tolist(), entries)])


def shared(a: bytes, b: bytes, known: int = 0) -> int:
    """Length of the common prefix, of which ``known`` bytes need no comparing."""
    n = min(len(a), len(b))
    differ = int.from_bytes(a[known:n], "big") ^ int.from_bytes(b[known:n], "big")
    return n - (differ.bit_length() + 7) // 8


def read_run(data: bytes) -> Iterator[list]:
    """Entries of a run, each after the length it shares with the one before."""
    at, before, size = 0, b"", _NUMBERS.size
    while at < len(data):
        n, rest, left = data[at:at + 3]
        at += 3
        before = before[:n] + data[at:at + rest]
        at += rest
        yield [n, before, data[at:at + left], *_NUMBERS.unpack_from(data, at + left)]
        at += left + size


class LoserTree:
    """Merge of sorted runs; heads carry the length they share with the last winner.

    Of two heads that share different lengths with the last winner, the one
    that shares more is smaller, and the two share the smaller length: no byte
    is compared. Heads that share equally much are compared beyond that length only.
    """

    def __init__(self, runs: list[bytes]):
        self.runs = [read_run(r) for r in runs]
        self.heads: list = [None] * len(runs)   # [shared length, suffix, left, ...] or None
        self.compared = 0
        size = 1
        while size < max(1, len(runs)):
            size *= 2
        self.size, self.tree = size, [None] * size
        for i in range(len(runs)):
            self.heads[i] = next(self.runs[i], None)  # the first of a run shares nothing
        self.winner = self._build(1)

    def _build(self, node: int) -> int | None:
        if node >= self.size:
            i = node - self.size
            return i if i < len(self.heads) else None
        a, b = self._build(2 * node), self._build(2 * node + 1)
        win, self.tree[node] = self._play(a, b)
        return win

    def _play(self, a: int | None, b: int | None) -> tuple[int | None, int | None]:
        """Winner and loser; the loser then carries what it shares with the winner."""
        x, y = (self.heads[i] if i is not None else None for i in (a, b))
        if x is None or y is None:
            return (b, a) if x is None else (a, b)
        if x[0] != y[0]:
            return (a, b) if x[0] > y[0] else (b, a)
        n = shared(x[1], y[1], x[0])
        self.compared += n - x[0] + 1
        if x[1][n:n + 1] <= y[1][n:n + 1]:
            y[0] = n
            return a, b
        x[0] = n
        return b, a

    def __iter__(self):
        heads, tree, size = self.heads, self.tree, self.size
        while self.winner is not None and heads[self.winner] is not None:
            best = self.winner
            yield heads[best]
            x = heads[best] = next(self.runs[best], None)  # shares with the last winner what it shares in its own run
            node = (best + size) >> 1
            while node:
                other = tree[node]
                y = heads[other] if other is not None else None
                if y is not None:
                    if x is None or x[0] < y[0]:
                        tree[node], best, x = best, other, y
                    elif x[0] == y[0]:
                        best, tree[node] = self._play(best, other)
                        x = heads[best]
                node >>= 1
            self.winner = best


def _sorted_run(entries: list, buckets: int):
    """Buckets of one sorted run, and the spans it settles by itself.

    Of equal segments all but those of the smallest document repeat it; that
    one is exchanged, with its neighbouring copies in one entry.
    """
    import pyarrow as pa
    entries.sort()
    settled: dict[int, list[tuple[int, int, int]]] = {}
    runs: dict[int, list[Entry]] = {}
    last = None
    for bucket, suffix, left, doc, tie, at in entries:
        if last is not None and last[0] == suffix and last[1] == left:
            if doc > last[2]:
                settled.setdefault(doc, []).append((tie, at, at + len(left) + len(suffix)))
                continue
            before = runs[bucket][-1]
            if last[3] == tie and before[4] + before[5] == at:
                runs[bucket][-1] = (*before[:5], before[5] + 1)
                continue
        runs.setdefault(bucket, []).append((suffix, left, doc, tie, at, 1))
        last = (suffix, left, doc, tie)
    columns = [[0] * len(runs) + [1] * len(settled), [*runs, *(d % buckets for d in settled)],
               [*map(front_code, runs.values()), *[None] * len(settled)], [*[None] * len(runs), *settled],
               [*[None] * len(runs), *(np.array(s, np.int64).tobytes() for s in settled.values())]]
    kinds = (pa.int32(), pa.int32(), pa.binary(), pa.int64(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["kind", "bucket", "run", "_id", "spans"])


def _told(rows: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Key (text and place), hash and hotness of the repeated anchors of several texts, by key."""
    keys, hashes, hot = [], [], []
    for i, row in enumerate(rows):
        for t in row:
            n = len(t) // 9
            keys.append(np.frombuffer(t, np.uint32, n).astype(np.int64) | i << 32)
            hashes.append(np.frombuffer(t, np.uint32, n, 4 * n))
            hot.append(np.frombuffer(t, bool, n, 8 * n))
    keys, hashes, hot = np.concatenate(keys), np.concatenate(hashes), np.concatenate(hot)
    order = np.argsort(keys, kind="stable")
    return keys[order], hashes[order], hot[order]


def _runs(candidates: DataFrame, buckets: int) -> DataFrame:
    """Front-coded runs per bucket (``kind`` 0), and spans that a task's own run already settles (``kind`` 1)."""
    def work(batches):
        entries = []
        for batch in batches:
            raw, at = utf8_column(batch.column("_text"))
            ids = batch.column("_id").to_pylist()
            wanted, theirs, hots = _told(batch.column("anchors").to_pylist())
            text, place, h, first, last = anchors(raw, at)
            # only anchors told for this place, and with the hash told: another text under the same id has others there
            key = place | text << 32
            spot = np.minimum(np.searchsorted(wanted, key), len(wanted) - 1)
            short = _short(h, 1)[1]
            take = np.flatnonzero((wanted[spot] == key) & (theirs[spot] == short))
            bucket = ((h[take] >> np.uint64(16)) % np.uint64(buckets)).tolist()
            begin = at[text[take]]
            ties: dict[int, int] = {}
            body = raw.tobytes()
            for t, o, a, s, e, b, hot in zip(text[take].tolist(), begin.tolist(), place[take].tolist(), first[take].tolist(),
                                             last[take].tolist(), bucket, hots[spot[take]].tolist()):
                tie = ties.get(t)
                if tie is None:
                    tie = ties[t] = zlib.crc32(body[o:at[t + 1]])
                if hot:
                    for w in range(s, e + 1):
                        window = body[o + w:o + w + WINDOW]
                        entries.append((zlib.crc32(window) % buckets, window, b"", ids[t], tie, w))
                else:
                    entries.append((b, body[o + a:o + e + WINDOW], body[o + s:o + a], ids[t], tie, s))
                if len(entries) >= _RUN:
                    yield _sorted_run(entries, buckets)
                    entries = []
        if entries:
            yield _sorted_run(entries, buckets)

    return candidates.mapInArrow(work, "kind int, bucket int, run binary, _id long, spans binary")


def _settle(group: list, spans: dict[int, list[tuple[int, int, int]]]) -> None:
    """Repeats within the segments of one anchor (or copies of one window)."""
    if len(group) < 2 or len({g[3] for g in group}) < 2:
        return
    if len({(g[1], g[2]) for g in group}) == 1:  # one segment in several documents
        first = min(g[3] for g in group)
        for _, suffix, left, doc, tie, at, times in group:
            if doc > first:
                spans.setdefault(doc, []).append((tie, at, at + times - 1 + len(left) + len(suffix)))
        return
    smallest: dict[bytes, int] = {}
    cut = []
    for _, suffix, left, doc, *_ in group:
        segment = left + suffix
        windows = [segment[i:i + WINDOW] for i in range(len(segment) - WINDOW + 1)]
        cut.append(windows)
        for w in windows:
            if smallest.get(w, doc) >= doc:
                smallest[w] = doc
    for (_, _, _, doc, tie, at, times), windows in zip(group, cut):
        begin = None
        for i, again in enumerate([smallest[w] < doc for w in windows] + [False]):
            if again and begin is None:
                begin = i
            elif not again and begin is not None:
                spans.setdefault(doc, []).append((tie, at + begin, at + times - 1 + i - 1 + WINDOW))
                begin = None


def _merged_spans(runs: DataFrame, parts: int) -> DataFrame:
    """Merge the runs of each bucket: spans of repeated bytes per document, with those that runs have settled themselves.

    A task holds one bucket at a time.
    """
    def work(batches):
        for rows in _by_bucket(batches):
            spans: dict[int, list[tuple[int, int, int]]] = {}
            group: list = []
            for entry in LoserTree([r.run for r in rows if r.kind == 0]):
                if group and entry[0] < KMER:
                    _settle(group, spans)
                    group = []
                group.append(entry)
            _settle(group, spans)
            done = [(i, np.array(s, np.int64).tobytes()) for i, s in spans.items()]
            done += [(int(r.doc), r.spans) for r in rows if r.kind == 1]
            if done:
                yield pd.DataFrame(done, columns=["_id", "spans"])

    told = runs.select("kind", "bucket", "run", F.col("_id").cast("string").alias("doc"), "spans")  # no floats from null ids
    return told.repartition(parts, "bucket").sortWithinPartitions("bucket").mapInPandas(work, "_id long, spans binary")


def union_of(spans: list[bytes], tie: int) -> list[tuple[int, int]]:
    """Maximal runs covered by the spans of one text, told from others of its id by their checksum."""
    every = np.concatenate([np.frombuffer(x, np.int64).reshape(-1, 3) for x in spans])
    out: list[list[int]] = []
    for s, e in sorted(map(tuple, every[every[:, 0] == tie, 1:].tolist())):
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return [tuple(x) for x in out]


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", kept_text: bool = False) -> DataFrame:
    """One row per input row: ``id_col``, byte counts, ``n_spans``, ``kept_sha256``, and ``spans`` (start, end of removed runs).

    Null text counts as empty; texts under ``WINDOW`` bytes lose nothing. Rows
    of equal ids are not smaller than each other: they lose only what smaller ids
    hold. A null id is larger than every other. With ``kept_text`` the remaining
    bytes are returned too (binary: a span may cut a character). Ids are
    integers. An empty table gives no rows. Other columns are ignored.
    """
    spark = docs.sparkSession
    parts = shuffle_partitions(spark)
    buckets = BUCKETS_PER_TASK * parts
    kind = dict(docs.select(id_col).dtypes)[id_col]
    body = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    null_id = (1 << 63) - 1
    rows = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(null_id)).alias("_id"), body.alias("_text"))

    # whole copies of smaller ids: found by digest, and only ids all of whose rows are such copies
    digests = staged(rows.select("_id", F.sha2("_text", 256).alias("_sha"), F.octet_length("_text").cast("long").alias("n_bytes")),
                     "text-digests")
    first = staged(digests.filter(F.col("n_bytes") >= WINDOW).groupBy("_sha").agg(F.min("_id").alias("_first"), F.count("*").alias("_n"))
                   .filter("_n > 1").select(F.col("_sha").alias("_first_sha"), "_first"), "first-copies")
    copies = staged(digests.join(first, F.col("_sha") == F.col("_first_sha"), "left")
                    .groupBy("_id").agg(F.min(F.coalesce(F.col("_first") < F.col("_id"), F.lit(False))).alias("_copy"))
                    .filter("_copy").select(F.col("_id").alias("_copy_id")), "copies")
    rows = rows.join(copies, F.col("_id") == F.col("_copy_id"), "left_anti")
    repeated = _repeated_anchors(_anchor_arrays(rows, buckets), parts)
    wanted = staged(repeated.groupBy(F.col("_id").alias("_wanted")).agg(F.collect_list("anchors").alias("anchors")), "wanted-anchors")
    texts = staged(rows.join(wanted, F.col("_id") == F.col("_wanted")).select("_id", "_text", "anchors"), "candidates")
    found = staged(_merged_spans(_runs(texts, buckets), parts).groupBy(F.col("_id").alias("_repeating"))
                   .agg(F.collect_list("spans").alias("spans")), "repeat-spans")

    def cut(batches):
        for pdf in batches:
            out = []
            for doc, text, spans in zip(pdf["_id"], pdf["_text"], pdf["spans"]):
                body, whole = text.encode(), union_of(list(spans), zlib.crc32(text.encode()))
                left, at = [], 0
                for s, e in whole:
                    left.append(body[at:s])
                    at = e
                kept = b"".join(left) + body[at:]
                out.append((doc, hashlib.sha256(body).hexdigest(), len(body) - len(kept), len(whole), hashlib.sha256(kept).hexdigest(),
                            [list(x) for x in whole], kept if kept_text else None))
            yield pd.DataFrame(out, columns=["_id", "_sha", "n_removed", "n_spans", "kept_sha256", "spans", "kept"])

    changed = staged(texts.select("_id", "_text").join(found, F.col("_id") == F.col("_repeating")).select("_id", "_text", "spans").mapInPandas(
        cut, "_id long, _sha string, n_removed long, n_spans long, kept_sha256 string, spans array<array<long>>, kept binary"), "cut-texts")
    changed = changed.dropDuplicates(["_id", "_sha"]).withColumnsRenamed({"_id": "_changed", "_sha": "_its_sha"})
    every = docs.select(F.col(id_col), F.coalesce(F.col(id_col).cast("long"), F.lit(null_id)).alias("_id"), body.alias("_text"))
    every = every.select(id_col, "_id", F.sha2("_text", 256).alias("_sha"), F.octet_length("_text").cast("long").alias("n_bytes"),
                         *([F.encode("_text", "UTF-8").alias("_whole")] * kept_text))
    done = (every.join(changed, (F.col("_id") == F.col("_changed")) & (F.col("_sha") == F.col("_its_sha")), "left")
            .join(copies, F.col("_id") == F.col("_copy_id"), "left"))
    copy = F.col("_copy_id").isNotNull()
    none = F.array().cast("array<array<long>>")
    whole = F.array(F.array(F.lit(0).cast("long"), F.col("n_bytes")))
    return done.select(
        F.col(id_col).cast(kind).alias(id_col), "n_bytes",
        F.when(copy, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
        F.when(copy, F.lit(1).cast("long")).otherwise(F.coalesce("n_spans", F.lit(0))).alias("n_spans"),
        F.when(copy, F.lit(hashlib.sha256(b"").hexdigest())).otherwise(F.coalesce("kept_sha256", "_sha")).alias("kept_sha256"),
        F.when(copy, whole).otherwise(F.coalesce("spans", none)).alias("spans"),
        *([F.when(copy, F.encode(F.lit(""), "UTF-8")).otherwise(F.coalesce("kept", "_whole")).alias("kept")] * kept_text))
