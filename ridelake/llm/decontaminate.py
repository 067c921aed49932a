"""Benchmark decontamination with a generalised suffix automaton of the test items.

The automaton accepts every run of words of every item. A document's words are
streamed through it; the state tells the longest run ending at each word that
also stands in some item. A word is hit if it lies in an occurrence of a
window: ``WINDOW`` consecutive words of an item, or all words of a shorter item.

Words in no item lead back to the start of the automaton, so only runs of item
words as long as the shortest window are streamed; finding those runs is
vectorised over the bytes of a batch.
"""

from __future__ import annotations


import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import document_chunks, release_memory, utf8_column

WINDOW = 13              # words
COVERAGE = 20            # a document is contaminated if at least one word in COVERAGE is hit
BLOCK_WORDS = 2_000_000  # item words per automaton; more items are matched in further blocks
_CHUNK = 1 << 19         # bytes hashed at a time

# a word is a run of these bytes, after A-Z has become a-z
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_WORD = np.zeros(256, bool)
_WORD[48:58] = _WORD[97:123] = _WORD[128:] = True
_P = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_P), -1, 1 << 64))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    with np.errstate(over="ignore"):
        return np.cumprod(out, dtype=np.uint64)


_POWER = _powers(_P, _CHUNK + 1)
_UNPOWER = _powers(_INVERSE, _CHUNK + 1)


def words_of(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end (bytes) and 64-bit hash of the words of UTF-8 text."""
    low = _LOWER[raw]
    inside = np.zeros(len(low) + 2, np.int8)
    inside[1:-1] = _WORD[low]
    edges = np.flatnonzero(np.diff(inside))
    start, end = edges[::2], edges[1::2]
    if len(low) > _CHUNK:  # a very long text: powers for its length
        power, unpower = _powers(_P, len(low) + 1), _powers(_INVERSE, len(low) + 1)
    else:
        power, unpower = _POWER, _UNPOWER
    sums = np.zeros(len(low) + 1, np.uint64)
    np.cumsum((low.astype(np.uint64) + np.uint64(1)) * power[:len(low)], out=sums[1:])
    h = (sums[end] - sums[start]) * unpower[start]
    h ^= (end - start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return start, end, h ^ (h >> np.uint64(29))


class Automaton:
    """Generalised suffix automaton over the word lists of items ``{item: [word, ...]}``."""

    def __init__(self, items: dict[str, list[int]], window: int = WINDOW):
        self.window = window
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length, self.state_items = [-1], [0], [set()]
        self.short: list[dict[int, set[str]]] = [{}]  # whole short items by length, ending in the state
        items = {k: w for k, w in items.items() if w}
        self.shortest = min([min(len(w), window) for w in items.values()], default=0)
        for name, words in items.items():
            last = 0
            for w in words:
                last = self._extend(last, w)
        for name, words in items.items():
            state = 0
            for i, w in enumerate(words):
                state = self.next[state][w]
                self.state_items[state].add(name)
            if len(words) < window:
                self.short[state].setdefault(len(words), set()).add(name)
        for state in sorted(range(1, len(self.length)), key=self.length.__getitem__, reverse=True):
            if self.length[self.link[state]] >= window:  # shorter strings are in no window by themselves
                self.state_items[self.link[state]] |= self.state_items[state]
        self.ends = [self._ending(s) for s in range(len(self.length))]

    def _new(self, length: int, like: int | None = None) -> int:
        self.next.append(dict(self.next[like]) if like is not None else {})
        self.link.append(self.link[like] if like is not None else -1)
        self.length.append(length)
        self.state_items.append(set())
        self.short.append({})
        return len(self.length) - 1

    def _split(self, state: int, word: int) -> int:
        """The state of the longest string of ``state`` followed by ``word``, cut out of its class where need be."""
        to = self.next[state][word]
        if self.length[to] == self.length[state] + 1:
            return to
        copy = self._new(self.length[state] + 1, like=to)
        self.link[to] = copy
        while state >= 0 and self.next[state].get(word) == to:
            self.next[state][word] = copy
            state = self.link[state]
        return copy

    def _extend(self, last: int, word: int) -> int:
        if word in self.next[last]:
            return self._split(last, word)
        new, state = self._new(self.length[last] + 1), last
        while state >= 0 and word not in self.next[state]:
            self.next[state][word] = new
            state = self.link[state]
        self.link[new] = 0 if state < 0 else self._split(state, word)
        return new

    def _ending(self, state: int) -> list[tuple[int, set[str]]]:
        """Whole short items that end every long enough string of the state: (words, items)."""
        out = []
        while state > 0:
            out += self.short[state].items()
            state = self.link[state]
        return out

    def match(self, words) -> tuple[list[tuple[int, int]], set[str]]:
        """Hit ranges of ``words`` (start, end; merged) and the items whose windows occur."""
        step, link, length, window = self.next, self.link, self.length, self.window
        hits: list[tuple[int, int]] = []
        items: set[str] = set()
        state = n = 0
        for i, w in enumerate(words):
            to = step[state].get(w)
            while to is None and state:
                state = link[state]
                n = length[state]
                to = step[state].get(w)
            if to is None:
                n = 0
                continue
            state, n = to, n + 1
            size = 0
            if n >= window:
                at = state
                while length[link[at]] >= window:  # the class of the last ``window`` words
                    at = link[at]
                items |= self.state_items[at]
                size = window
            for k, names in self.ends[state]:
                if k <= n:
                    items |= names
                    size = max(size, k)
            if size:
                start = i + 1 - size
                while hits and hits[-1][1] >= start:
                    start = min(start, hits.pop()[0])
                hits.append((start, i + 1))
        return hits, items


def _text_words(text: str | None) -> list[int]:
    return words_of(np.frombuffer((text or "").encode(), np.uint8))[2].tolist()


def item_blocks(benchmark: DataFrame, id_col: str, text_col: str, block_words: int):
    """Items in blocks of about ``block_words`` words, one block on the driver at a time.

    Items with equal ids count as one item only in the count of items; each of their texts is matched.
    """
    rows = benchmark.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"),
                            F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    block, size = [], 0
    for r in rows.toLocalIterator():
        words = _text_words(r["text"])
        if words:
            block.append((r["id"], words))
            size += len(words)
        if size >= block_words:
            yield block
            block, size = [], 0
    if block:
        yield block


def _match_block(docs: DataFrame, block: list[tuple[str, list[int]]], window: int) -> DataFrame:
    """Per document: ``_key``, ``n_words``, ``spans`` (hit words: first, end, and their bytes), ``items``."""
    import pyarrow as pa
    held = docs.sparkSession.sparkContext.broadcast(block)  # at most block_words words and one item
    span = pa.list_(pa.int64())

    def match(batches):
        items = {}
        for i, (name, words) in enumerate(held.value):
            items[f"{name}\0{i}"] = words
        auto = Automaton(items, window)
        known = np.unique(np.array([w for _, ws in held.value for w in ws], np.uint64))
        flags = np.zeros(1 << 22, bool)  # first sieve for item words
        flags[known & np.uint64(len(flags) - 1)] = True
        for batch in batches:
            raw, at = utf8_column(batch.column("_text"))
            for first, last in document_chunks(at, _CHUNK):
                low = at[first]
                text, doc_at = raw[low:at[last]], at[first:last + 1] - low
                start, end, h, bounds = _cut_at_texts(text, *words_of(text), doc_at)
                inside = flags[h & np.uint64(len(flags) - 1)]
                where = np.flatnonzero(inside)
                if len(where):
                    inside[where] = known[np.minimum(np.searchsorted(known, h[where]), len(known) - 1)] == h[where]
                spans, names = [[] for _ in range(last - first)], [[] for _ in range(last - first)]
                for i, hits, found in _runs(auto, inside, h, bounds):
                    w, origin = int(bounds[i]), int(doc_at[i])
                    spans[i] = _merged([[a, b, int(start[w + a]) - origin, int(end[w + b - 1]) - origin] for a, b in hits])
                    names[i] = sorted({x.split("\0")[0] for x in found})
                yield pa.RecordBatch.from_arrays(
                    [batch.column("_key").slice(first, last - first), pa.array(np.diff(bounds).astype(np.int64)),
                     pa.array(spans, pa.list_(span)), pa.array(names, pa.list_(pa.string()))],
                    ["_key", "n_words", "spans", "items"])
        release_memory()

    return docs.mapInArrow(match, "_key string, n_words long, spans array<array<long>>, items array<string>")


def _cut_at_texts(raw, start, end, h, doc_at):
    """The words and each text's first; words that run over the end of one text into the next are two."""
    inner = doc_at[1:-1]
    inner = inner[(inner > 0) & (inner < len(raw))]
    joined = inner[(_WORD[_LOWER[raw[inner - 1]]]) & (_WORD[_LOWER[raw[inner]]])] if len(inner) else inner
    if not len(joined):
        return start, end, h, np.searchsorted(start, doc_at)
    parts = np.unique(np.concatenate([[0], joined, [len(raw)]]))
    pieces = [(s + a, e + a, g) for a, b in zip(parts[:-1], parts[1:]) for s, e, g in [words_of(raw[a:b])]]
    start, end, h = (np.concatenate([p[i] for p in pieces]) for i in range(3))
    return start, end, h, np.searchsorted(start, doc_at)


def _runs(auto: Automaton, inside: np.ndarray, h: np.ndarray, bounds: np.ndarray):
    """Streams the runs of item words that are long enough; (document, hit ranges, items) per document with any."""
    if not auto.shortest:
        return
    starts_text = np.zeros(len(inside) + 1, bool)
    starts_text[bounds] = True
    before = np.concatenate([[False], inside[:-1]]) & ~starts_text[:len(inside)]
    first = np.flatnonzero(inside & ~before)
    after = np.concatenate([inside[1:], [False]]) & ~starts_text[1:]
    last = np.flatnonzero(inside & ~after) + 1
    keep = last - first >= auto.shortest
    first, last = first[keep], last[keep]
    doc = np.searchsorted(bounds, first, side="right") - 1
    held, spans, names = None, [], set()
    for i, a, b in zip(doc.tolist(), first.tolist(), last.tolist()):
        if i != held:
            if spans:
                yield held, spans, names
            held, spans, names = i, [], set()
        hits, items = auto.match(h[a:b].tolist())
        low = a - int(bounds[i])
        spans += [(low + s, low + e) for s, e in hits]
        names |= items
    if spans:
        yield held, spans, names


def _merged(spans: list[list[int]]) -> list[list[int]]:
    out: list[list[int]] = []
    for s in sorted(map(list, spans)):
        if out and s[0] <= out[-1][1]:
            if s[1] > out[-1][1]:
                out[-1][1], out[-1][3] = s[1], s[3]
        else:
            out.append(s)
    return out


def find_contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW,
                       coverage: int = COVERAGE, block_words: int = BLOCK_WORDS) -> DataFrame:
    """One row per document: ``id_col``, counts, ``items``, ``items_sha256``, ``contaminated`` and ``spans``.

    ``spans`` lists the hit runs as first and end word, first and end byte of
    the UTF-8 text. A document is contaminated if any word is hit and at least
    one in ``coverage`` is. Null and empty texts have no words and are clean;
    items without words are no windows; equal items all count. An empty
    benchmark leaves every document clean. Repeated rows each return. Other columns are ignored.

    The automaton of one block of items (``block_words`` words and at most one
    item more) is all a task holds. Benchmarks of more words are matched block
    by block and the blocks' spans united per document by a shuffle of keys and spans.
    """
    rows = docs.select(F.col(id_col).cast("string").alias("_key"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("_text"))
    blocks = [_match_block(rows, b, window) for b in item_blocks(benchmark, item_col, item_text_col, block_words)]
    if not blocks:
        blocks = [_match_block(rows, [], window)]
    found = blocks[0]
    if len(blocks) > 1:
        # rows of one document: same key and words. Repeated keys are told apart by a digest of the text
        keyed = docs.select(F.col(id_col).cast("string").alias("_k"),
                            F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("_text"))
        keyed = keyed.select(F.to_json(F.struct(F.col("_k").alias("k"), F.sha2("_text", 256).alias("h")),
                                       {"ignoreNullFields": "false"}).alias("_key"), "_text")
        parts = [_match_block(keyed, b, window) for b in item_blocks(benchmark, item_col, item_text_col, block_words)]
        every = parts[0]
        for p in parts[1:]:
            every = every.unionAll(p)
        n = len(parts)
        united = every.groupBy("_key").agg(F.first("n_words").alias("n_words"), F.flatten(F.collect_list("spans")).alias("spans"),
                                           F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"),
                                           (F.count("*") / n).cast("int").alias("_times"))
        found = united.withColumn("_one", F.explode(F.sequence(F.lit(1), F.col("_times")))).select(
            F.get_json_object("_key", "$.k").alias("_key"), "n_words", "spans", "items")

        def unite(batches):
            for pdf in batches:
                yield pdf.assign(spans=[_merged(s) for s in pdf["spans"]])

        found = found.mapInPandas(unite, found.schema)

    # one Python step in the usual case: a second would be a second worker per task, with its own memory
    items = F.array_sort("items")
    done = found.select("_key", "n_words", F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s[1] - s[0]).alias("n_hit"),
                        F.size("items").cast("long").alias("n_items"), items.alias("items"),
                        F.sha2(F.array_join(items, ","), 256).alias("items_sha256"), "spans")
    return done.select(F.col("_key").cast(dict(docs.select(id_col).dtypes)[id_col]).alias(id_col),
                       *[c for c in done.columns[1:] if c != "spans"],
                       ((F.col("n_hit") > 0) & (coverage * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"), "spans")


def without_spans(text, spans):
    """``text`` without the bytes of the spans: what is left of a document whose matches are cut out (a column)."""
    raw = F.encode(text, "UTF-8")
    start = F.struct(F.encode(F.lit(""), "UTF-8").alias("out"), F.lit(0).cast("long").alias("at"))
    cut = F.aggregate(spans, start, lambda a, s: F.struct(
        F.concat(a["out"], F.substring(raw, (a["at"] + 1).cast("int"), (s[2] - a["at"]).cast("int"))).alias("out"), s[3].alias("at")))
    return F.decode(F.concat(cut["out"], F.substring(raw, (cut["at"] + 1).cast("int"), F.length(raw))), "UTF-8")
