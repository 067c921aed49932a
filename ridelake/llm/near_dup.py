"""Near-duplicate detection by Order MinHash over five-word shingles, verified by banded alignment.

Each shingle of a text is labelled with its occurrence number. A sketch takes
the ``LENGTH`` labelled shingles with the smallest values under one hash and
keeps them in the order of the text, so that two texts agree on it as
far as an edit script leaves both content and order alone. Each of the
``SKETCHES`` sketches is a bucket key.

Texts with the same words are one node. In every bucket the members are
verified against two of them, the one met in most buckets and the first, and components are formed. A bucket that
still holds several is split by further keys: of each of its members, the rarest
labelled shingles, as many as two texts of the threshold similarity can't
both do without (a fifth of them and one, in one order for all). Only members that share such a
key are compared, those outside the key's largest component with those of the others. This
loses no pair, so texts of few shingles (``SHORT``), which share sketches less often,
are all compared in this way, and what many unlike texts share, being frequent, is no key.

Verification aligns the shingles of two texts in order (longest common
subsequence, without occurrence numbers), within the band that the threshold
allows: aligned / (all of both - aligned) >= SIMILARITY.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import discard, document_chunks, release_memory, staged, utf8_column, without_ids
from .decontaminate import _cut_at_texts, words_of

SHINGLE = 5
SIMILARITY = 0.8
SKETCHES, LENGTH = 14, 3   # texts of similarity 0.8 share no bucket once in 20,000 pairs
SHORT = 32                 # texts of so few shingles are compared by their rarest ones whether they share a bucket or not
_CHUNK = 1 << 19
_MIX = np.uint64(0x9E3779B97F4A7C15)
_SEEDS = np.random.default_rng(11).integers(1, 1 << 63, SKETCHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    return h ^ (h >> np.uint64(29))


def word_shingles(words: np.ndarray) -> np.ndarray:
    """Hashes of five-word shingles (one of all words where there are fewer) in the order of the text."""
    k = min(SHINGLE, len(words))
    if not k:
        return np.zeros(0, np.uint64)
    n = len(words) - k + 1
    h = np.zeros(n, np.uint64)
    for i in range(k):
        h = _mix(h * _MIX + words[i:i + n].astype(np.uint64) + np.uint64(1))
    return h


def text_shingles(words: np.ndarray) -> np.ndarray:
    """Shingles of a text's word hashes, of which the upper halves count."""
    return word_shingles((words >> np.uint64(32)).astype(np.uint32))


def labelled(h: np.ndarray) -> np.ndarray:
    """Shingles with their occurrence numbers: a set that stands for the multiset, for sampling and keys."""
    n = len(h)
    if not n:
        return h
    order = np.argsort(h, kind="stable")
    same = np.concatenate([[False], h[order][1:] == h[order][:-1]])
    if same.any():  # occurrence numbers, for the repeated ones
        at = np.arange(n)
        number = at - np.maximum.accumulate(np.where(same, 0, at))
        labels = np.empty(n, np.uint64)
        labels[order] = number.astype(np.uint64)
        h = np.where(labels > 0, _mix(h + labels * _MIX), h)
    return h


def order_sketches(shingles: np.ndarray) -> list[int]:
    """One signed 64-bit bucket key per sketch; none without shingles."""
    n = len(shingles)
    if not n:
        return []
    k = min(LENGTH, n)
    out = np.zeros(SKETCHES, np.uint64)
    step = max(1, min(SKETCHES, 2_000_000 // n))
    for low in range(0, SKETCHES, step):  # long texts: fewer sketches at a time
        seeds = _SEEDS[low:low + step, None]
        values = (shingles[None, :] ^ (seeds >> np.uint64(7))) * seeds
        values ^= values >> np.uint64(32)
        least = np.argpartition(values, k - 1, axis=1)[:, :k] if k < n else np.broadcast_to(np.arange(n), values.shape)
        least = np.sort(least, axis=1)  # the order of the text
        key = seeds[:, 0].copy()
        for i in range(k):
            key = _mix(key * _MIX + shingles[least[:, i]])
        out[low:low + step] = key
    return out.view(np.int64).tolist()


def _increasing_run(j: np.ndarray) -> int:
    """Length of the longest increasing run: the alignment of texts without repeats."""
    if (np.diff(j) > 0).all():
        return len(j)
    tails: list[int] = []
    for x in j.tolist():
        at = bisect_left(tails, x)
        tails[at:at + 1] = [x]
    return len(tails)


def _banded_alignment(a: np.ndarray, b: np.ndarray, band: int) -> int:
    """Longest common subsequence of small integers, over at least all places no more than ``band`` apart.

    Bit-parallel: a bit per place of ``a`` inside the band, cleared where the
    alignment with ``b`` so far grows. Places below the band have no more
    matches, so their bits are final and only counted.
    """
    order = np.argsort(a, kind="stable")
    starts = np.searchsorted(a[order], np.arange(int(max(a.max(), b.max())) + 2))
    rows = b.tolist()
    step = max(16, min(band // 2 + 64, (1 << 28) // (2 * band + 64)))  # masks of one step: some 32 MB at most
    low = width = aligned = v = 0
    for first in range(0, len(b), step):
        last = min(first + step, len(b))
        lo, hi = min(max(0, first - band), len(a)), min(len(a), last + band)
        cut = lo - low
        aligned += cut - (v & ((1 << cut) - 1)).bit_count()
        v, width = v >> cut, width - cut
        v |= ((1 << hi - lo - width) - 1) << width
        low, width = lo, hi - lo
        full, masks = (1 << width) - 1, {}
        for x in rows[first:last]:
            mask = masks.get(x)
            if mask is None:
                places = order[starts[x]:starts[x + 1]]
                places = places[np.searchsorted(places, lo):np.searchsorted(places, hi)] - lo
                if len(places) <= 8:
                    mask = sum(1 << p for p in places.tolist())
                else:
                    bits = np.zeros(width, np.uint8)
                    bits[places] = 1
                    mask = int.from_bytes(np.packbits(bits, bitorder="little").tobytes(), "little")
                masks[x] = mask
            u = v & mask
            if u:
                v = (v + u | v - u) & full
    return aligned + width - v.bit_count()


def aligned_similarity(a: np.ndarray, b: np.ndarray, threshold: float = SIMILARITY) -> float:
    """Share of shingles aligned in order; 0 where ``threshold`` can't be reached.

    The alignment is the longest common subsequence, repeated shingles included.
    A similarity of ``s`` leaves at most ``(1 - s) / (1 + s)`` of both texts'
    shingles unaligned, and no aligned pair can be further apart than that many.
    """
    n = len(a) + len(b)
    if not len(a) or not len(b) or min(len(a), len(b)) < threshold * max(len(a), len(b)):
        return 0.0
    ends, short = 0, min(len(a), len(b))  # equal beginnings and ends belong to some longest alignment
    differ = np.flatnonzero(a[:short] != b[:short])
    head = int(differ[0]) if len(differ) else short
    a, b, ends, short = a[head:], b[head:], head, short - head
    differ = np.flatnonzero(a[len(a) - short:] != b[len(b) - short:])
    tail = short - 1 - int(differ[-1]) if len(differ) else short
    a, b, ends = a[:len(a) - tail], b[:len(b) - tail], ends + tail
    both, which = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = which[:len(a)], which[len(a):]
    count_x, count_y = np.bincount(x, minlength=len(both)), np.bincount(y, minlength=len(both))
    most = ends + int(np.minimum(count_x, count_y).sum())
    if most < threshold * (n - most):
        return 0.0
    shared = (count_x > 0) & (count_y > 0)
    x, y = x[shared[x]], y[shared[y]]  # the others move places closer together at most
    if not len(x):
        m = ends
    elif count_x[shared].max() == 1 == count_y[shared].max():
        place = np.empty(len(both), np.int64)
        place[y] = np.arange(len(y))
        m = ends + _increasing_run(place[x])
    else:
        m = ends + _banded_alignment(x, y, int(n * (1 - threshold) / (1 + threshold)) + 1)
    similarity = m / (n - m)
    return similarity if similarity >= threshold else 0.0


def _each_text(batch):
    """Word hashes and bytes of each text of a batch."""
    raw, at = utf8_column(batch.column("_text"))
    for first, last in document_chunks(at, _CHUNK):
        text, doc_at = raw[at[first]:at[last]], at[first:last + 1] - at[first]
        _, _, h, bounds = _cut_at_texts(text, *words_of(text), doc_at)
        for i in range(last - first):
            yield h[bounds[i]:bounds[i + 1]], text[doc_at[i]:doc_at[i + 1]]


def _node(words: np.ndarray, text: np.ndarray) -> bytes:
    """Digest of the words, or of the text where there are none."""
    source = b"w" + words.tobytes() if len(words) else b"t" + text.tobytes()
    return hashlib.blake2b(source, digest_size=16).digest()


def sketched(rows: DataFrame) -> DataFrame:
    """``_key``, ``node``, ``n`` (shingles), ``bands`` and, of texts of few, the ``short`` shingles of rows (``_key``, ``_text``)."""
    import pyarrow as pa

    def work(batches):
        for batch in batches:
            out = []
            for words, text in _each_text(batch):
                s = text_shingles(words)
                out.append((_node(words, text), len(s), order_sketches(labelled(s)), s.tobytes() if 0 < len(s) <= SHORT else None))
            columns = zip(*out) if out else ((),) * 4
            kinds = pa.binary(), pa.int64(), pa.list_(pa.int64()), pa.binary()
            yield pa.RecordBatch.from_arrays([batch.column("_key"), *(pa.array(x, k) for x, k in zip(columns, kinds))],
                                             ["_key", "node", "n", "bands", "short"])
        release_memory()

    return rows.mapInArrow(work, "_key string, node binary, n long, bands array<long>, short binary")


def _words_of_nodes(rows: DataFrame, wanted: DataFrame, kind: str) -> DataFrame:
    """``nid``, ``n`` and ``data``, the 32-bit word hashes, of the wanted nodes (``nid``, ``node``, ``n``, ``_first``).

    Their texts are fetched by id; whatever else has such an id is told by its node. The ids never travel
    whole to every task, however few there are: the join is by sorting at every size.
    """
    import pyarrow as pa

    def work(batches):
        for batch in batches:
            out = [(_node(words, text), (words >> np.uint64(32)).astype(np.uint32).tobytes()) for words, text in _each_text(batch)]
            columns = zip(*out) if out else ((),) * 2
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.binary()) for x in columns], ["_digest", "data"])
        release_memory()

    ids = wanted.select(F.col("_first").alias("_wanted")).distinct().hint("merge")
    found = rows.join(ids, F.col("_key").cast(kind).eqNullSafe(ids["_wanted"]), "left_semi")
    found = found.select("_text").mapInArrow(work, "_digest binary, data binary")
    return found.join(wanted.hint("merge"), F.col("_digest") == F.col("node")).groupBy("nid", "n").agg(F.first("data").alias("data"))


def _shingles_of(n: int, data: bytes) -> np.ndarray:
    """Shingles of a node's data: they themselves, or the words of a longer text."""
    return np.frombuffer(data, np.uint64) if n <= SHORT else word_shingles(np.frombuffer(data, np.uint32))


def verified(pairs: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """The ``pairs`` (``a``, ``b`` and others) whose texts (``nid``, ``n``, ``data``) reach the threshold."""
    import pyarrow as pa

    def work(batches):
        for batch in batches:
            keep, held, shingles = [], None, None
            for key, n, x, m, y in zip(*(batch.column(c).to_pylist() for c in ("a", "na", "wa", "nb", "wb"))):
                if key != held:  # a hub's pairs mostly come together
                    held, shingles = key, _shingles_of(n, x)
                keep.append(aligned_similarity(shingles, _shingles_of(m, y), threshold) >= threshold)
            yield batch.select(pairs_columns).filter(pa.array(keep, pa.bool_()))

    pairs_columns = pairs.columns
    left, right = (texts.select(F.col("nid").alias(f"_{x}"), F.col("n").alias(f"n{x}"), F.col("data").alias(f"w{x}")) for x in "ab")
    met = pairs.join(left, F.col("a") == F.col("_a")).join(right, F.col("b") == F.col("_b"))
    return met.select(*pairs_columns, "na", "wa", "nb", "wb").mapInArrow(work, pairs.schema)


def _is_star_forest(edges: DataFrame) -> bool:
    """Whether every ``u`` has one ``v`` only and no ``v`` is a ``u`` of another edge."""
    kinds = edges.select(F.col("u").alias("x"), F.lit(1).alias("u"), F.lit(0).alias("v")).unionAll(
        edges.select(F.col("v").alias("x"), F.lit(0).alias("u"), F.lit(1).alias("v")))
    return kinds.groupBy("x").agg(F.sum("u").alias("u"), F.max("v").alias("v")).filter("u > 1 OR u = 1 AND v = 1").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root``, the smallest node of its component, for every node of the edges (``a``, ``b``).

    Large-star and small-star in turn until the edges are a star per component;
    logarithmically many rounds, each written to the checkpoint folder, the one before deleted.
    """
    edges = staged(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct(), "cc-edges")
    while not _is_star_forest(edges):
        both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("_m")).select(F.col("u").alias("_u"), F.least("u", "_m").alias("_m"))
        large = staged(both.join(least, F.col("u") == F.col("_u")).filter("v > u").select(F.col("v").alias("u"), F.col("_m").alias("v"))
                       .distinct(), "cc-large")
        least = large.groupBy("u").agg(F.min("v").alias("_m")).select(F.col("u").alias("_u"), "_m")
        small = (large.join(least, F.col("u") == F.col("_u")).select(
            F.explode(F.array(F.struct("u", F.col("_m").alias("v")), F.struct(F.col("v").alias("u"), F.col("_m").alias("v")))).alias("e"))
            .select("e.u", "e.v").filter("u <> v").distinct())
        before, edges = edges, staged(small, "cc-small")
        discard(before, large)
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionAll(
        edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def _rooted(df: DataFrame, roots: DataFrame, column: str = "nid") -> DataFrame:
    """``df`` with the ``root`` of its ``column``, or that itself."""
    known = roots.select(F.col("node").alias("_node"), F.col("root").alias("_root"))
    return df.join(known, F.col(column) == F.col("_node"), "left").withColumn("root", F.coalesce("_root", column)).drop("_node", "_root")


def shingle_rows(nodes: DataFrame) -> DataFrame:
    """``nid``, ``root``, ``n`` and each labelled shingle ``s`` of nodes with their ``data``."""
    import pyarrow as pa

    def work(batches):
        for batch in batches:
            for nid, root, n, data in zip(*(batch.column(c).to_pylist() for c in ("nid", "root", "n", "data"))):
                s = labelled(_shingles_of(n, data)).view(np.int64)
                for i in range(0, len(s), 1 << 16):
                    k = len(s[i:i + (1 << 16)])
                    yield pa.RecordBatch.from_arrays([*(pa.array(np.full(k, v, np.int64)) for v in (nid, root, n)), pa.array(s[i:i + (1 << 16)])],
                                                     ["nid", "root", "n", "s"])

    return nodes.select("nid", "root", "n", "data").mapInArrow(work, "nid long, root long, n long, s long")


def _fits(a: str, b: str, threshold: float):
    """Whether the numbers of shingles leave the threshold possible."""
    return F.least(a, b) >= threshold * F.greatest(a, b)


def pairs_by_rare_shingles(nodes: DataFrame, threshold: float) -> DataFrame | None:
    """Every pair (``a``, ``b`` of roots ``ra``, ``rb``) of these nodes that may reach the threshold and is of two components.

    Texts of similarity ``t`` have at least ``t n`` of either one's ``n`` labelled shingles in common; so, in one
    order of all shingles, they share one among the first ``n - t n + 1`` of each. The order is by frequency, rarest first.
    At the first they share, no more can be in common than the ``rest`` of either one from there on.
    None where no shingle is shared by two components.
    """
    rows = shingle_rows(nodes)
    shared = staged(rows.groupBy("s").agg(F.count("*").alias("often"), (F.min("root") != F.max("root")).alias("mixed"))
                    .filter("often > 1").withColumnRenamed("s", "_s"), "shared-shingles")
    if shared.filter("mixed").isEmpty():
        return None
    of_node = Window.partitionBy("nid")
    place = F.row_number().over(of_node.orderBy("often", "s")) + F.col("n") - F.count("*").over(of_node)  # those of one text come first
    most = F.col("n") - F.ceil(F.col("n") * threshold - 1e-9) + 1
    keys = rows.join(shared, F.col("s") == F.col("_s")).withColumn("_place", place).filter((F.col("_place") <= most) & F.col("mixed"))
    keys = staged(keys.select("s", "nid", "root", "n", (F.col("n") - F.col("_place") + 1).alias("rest")), "rare-shingles")
    split = keys.groupBy("s", "root").agg(F.count("*").alias("k")).groupBy("s").agg(
        F.max(F.struct("k", "root")).alias("top"), F.count("*").alias("parts")).filter("parts > 1").select(
        F.col("s").alias("_s"), F.col("top.root").alias("top"))
    met = staged(keys.join(split, F.col("s") == F.col("_s")).drop("_s"), "mixed-shingles")
    outside = met.filter("root <> top").select(F.col("s").alias("_s"), F.col("nid").alias("a"), F.col("n").alias("na"), F.col("root").alias("ra"),
                                               F.col("rest").alias("resta"))
    enough = F.least("rest", "resta") >= threshold / (1 + threshold) * (F.col("n") + F.col("na")) - 1e-9
    once = (F.col("root") == F.col("top")) | (F.col("a") < F.col("nid"))  # each pair once: from the smaller of two that are outside
    more = met.join(outside, (F.col("s") == F.col("_s")) & (F.col("root") != F.col("ra")) & _fits("na", "n", threshold) & enough & once)
    return more.select("a", F.col("nid").alias("b"), "ra", F.col("root").alias("rb")).distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = SIMILARITY) -> DataFrame:
    """One row per input row: ``id_col``, ``class_id`` (its class's smallest id), ``class_size`` (rows) and ``kept``.

    ``kept`` marks the rows whose id is the smallest of their class. Texts of the
    same words (letters of a-z in either case, digits and characters beyond
    ASCII) are one class, as are texts linked by similarity of ``threshold`` or more.
    Texts without words, null (as empty) ones among them, are classed with equal
    texts only. Texts under five words have one shingle, of all their words; very long ones are
    sketched and aligned whole. Rows that repeat an id and its text share one class and are all kept or all
    dropped; null ids come after all others, and a class of null ids only has class_id null and is kept.
    An empty table gives no rows. Other columns are ignored, whatever their names.
    """
    kind = dict(docs.select(docs[id_col].alias("_id")).dtypes)["_id"]
    rows = docs.select(docs[id_col].cast("string").alias("_key"), F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("_text"))
    sketches = staged(sketched(rows), "sketches")

    # nodes: one per word sequence, numbered; buckets: only those met twice
    nodes = sketches.groupBy("node").agg(F.min(F.col("_key").cast(kind)).alias("_first"), F.count("*").alias("_rows"), F.first("n").alias("n"),
                                         F.first("bands").alias("bands"), F.first("short").alias("short"))
    nodes = staged(nodes.withColumn("nid", F.monotonically_increasing_id()), "nodes")
    bands = nodes.select("nid", "n", F.posexplode("bands").alias("i", "h")).select("nid", "n", F.xxhash64("i", "h").alias("band"))
    shared = bands.groupBy("band").agg(F.count("*").alias("size")).filter("size > 1").withColumnRenamed("band", "_band")
    members = staged(bands.join(shared, F.col("band") == F.col("_band")).drop("_band"), "members")

    # hubs of a bucket: the member met most often over all buckets, mostly the text that others are edits of, and the first
    met = members.groupBy("nid").agg(F.sum("size").alias("met")).withColumnRenamed("nid", "_nid")
    ranked = members.join(met, F.col("nid") == F.col("_nid"))
    hubs = ranked.groupBy("band").agg(F.max(F.struct("met", "nid")).alias("_hub"), F.min("nid").alias("_first")).select(
        F.col("band").alias("_band"), F.array_distinct(F.array("_hub.nid", "_first")).alias("hubs"))
    star = members.join(hubs, F.col("band") == F.col("_band")).select(F.explode("hubs").alias("a"), F.col("nid").alias("b"), "n").filter(
        "a <> b").distinct()
    sizes = nodes.select(F.col("nid").alias("_nid"), F.col("n").alias("_n"))
    star = staged(star.join(sizes, F.col("a") == F.col("_nid")).filter(_fits("n", "_n", threshold)).select("a", "b"), "star-pairs")
    wanted = members.filter(F.col("n") > SHORT).select(F.col("nid").alias("_nid")).distinct()
    wanted = staged(nodes.select("nid", "node", "n", "_first").join(wanted, F.col("nid") == F.col("_nid")).drop("_nid"), "wanted")
    long_texts = staged(_words_of_nodes(rows, wanted, kind), "node-words")
    short_texts = nodes.filter("short IS NOT NULL").select("nid", "n", F.col("short").alias("data"))
    texts = long_texts.unionAll(short_texts)
    linked = staged(verified(star, texts, threshold), "links")
    discard(star, wanted)
    roots = staged(components(linked), "roots")

    # members of buckets that hold several components, and short texts, by their rarest shingles
    placed = _rooted(members, roots)
    mixed = placed.groupBy("band").agg(F.min("root").alias("_lo"), F.max("root").alias("_hi")).filter("_lo <> _hi").select(F.col("band").alias("_band"))
    apart = placed.filter(F.col("n") > SHORT).join(mixed, F.col("band") == F.col("_band")).select(F.col("nid").alias("_nid"), "root").distinct()
    apart = long_texts.join(apart, F.col("nid") == F.col("_nid")).drop("_nid").unionByName(_rooted(short_texts, roots))
    more = pairs_by_rare_shingles(apart, threshold)
    merged = None
    if more is not None:
        more = staged(verified(staged(more, "more-pairs"), texts, threshold), "more-links")
        if not more.isEmpty():
            merged = staged(components(more.select(F.col("ra").alias("a"), F.col("rb").alias("b"))), "merged-roots")

    # class id: smallest id over the class's nodes, joined back by digest
    classed = _rooted(nodes.select("nid", "node", "_first", "_rows"), roots)
    if merged is not None:
        classed = _rooted(classed.withColumnRenamed("root", "_before"), merged, "_before")
    classed = staged(classed.select("node", "_first", "_rows", "root"), "classed")
    discard(members, long_texts, linked, roots, nodes)
    ids = classed.groupBy("root").agg(F.min("_first").alias("class_id"), F.sum("_rows").alias("class_size")).withColumnRenamed("root", "_root")
    named = classed.join(ids, F.col("root") == F.col("_root")).select(F.col("node").alias("_node"), "class_id", "class_size")
    back = sketches.join(named, F.col("node") == F.col("_node"))
    own = F.col("_key").cast(kind)
    return back.select(own.alias(id_col), "class_id", "class_size", own.eqNullSafe(F.col("class_id")).alias("kept"))


def keep_one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the rows that are not their class's first; an id goes only if none of its rows is kept."""
    found = near_duplicates(docs, id_col, text_col)
    dropped = found.groupBy(id_col).agg(F.max("kept").alias("_any")).filter("not _any").select(id_col)
    return without_ids(docs, dropped, id_col, "duplicates")
