"""Masked pseudo-likelihood scores from a bidirectional window network.

Every character (the token) is predicted from the ``SIDE`` characters on
either side of it, itself masked; a document's score is the sum of these
conditional log-probabilities. The most common characters have a class each; the
others share one, but every one of them has its own embedding as context and is
predicted within the class from its context, in two steps (a group of neighbouring
code points, then the character), so the model is normalised over all characters.

* counting: windows of class codes, with the ranks of the less common characters in
  them, are counted over all documents, per task and then by a shuffle;
* training: the network (embeddings, one tanh layer, softmax; numpy) is trained
  on the whole count table. In each round every partition of the table takes
  one pass of gradient steps from the common parameters, and the results are averaged by mass;
* scoring: each task computes the softmax of a context of common characters once and looks it up for every
  occurrence; windows with a less common character are computed where they stand.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import document_chunks, staged, utf8_column

SIDE = 2             # characters on either side
CLASSES = 64         # 0: text boundary, CLASSES - 1: all less common characters
EMBED, HIDDEN = 16, 64
ROUNDS = 4
STEP = 0.02          # Adam step of the first round; halved in each further one
MINIBATCH = 1024
_BITS = 6
_CHUNK = 1 << 20     # characters at a time
_CONTEXTS = 1 << 18  # softmax rows a task keeps; it starts afresh when they are full
_RARE = CLASSES - 1


def code_points(raw: np.ndarray) -> np.ndarray:
    return np.frombuffer(raw.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)


def character_counts(docs: DataFrame) -> pd.DataFrame:
    """Corpus counts of every character (at most one row per code point)."""
    import pyarrow as pa

    def count(batches):
        total = np.zeros(0x110000, np.int64)
        for batch in batches:
            raw, at = utf8_column(batch.column("_text"))
            for first, last in document_chunks(at, _CHUNK):
                total += np.bincount(code_points(raw[at[first]:at[last]]), minlength=len(total))
        k = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(k), pa.array(total[k])], ["point", "n"])

    return (docs.select("_text").mapInArrow(count, "point long, n long").groupBy("point").agg(F.sum("n").alias("n"))
            .toPandas().sort_values(["n", "point"], ascending=[False, True], ignore_index=True))


def character_classes(counts: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Class of each code point, and the log-probability of a rare one within its class (0 for the others)."""
    classes = np.full(0x110000, _RARE, np.uint8)
    common = counts["point"].to_numpy()[:CLASSES - 2]
    classes[common] = np.arange(1, len(common) + 1)
    rare = counts.iloc[CLASSES - 2:]
    within = np.zeros(0x110000, np.float32)
    total = rare["n"].sum() + 1  # one share for characters that were never counted
    within[classes == _RARE] = -np.log(total)
    within[rare["point"]] = np.log(rare["n"] / total)
    return classes, within


class Rare:
    """The characters of the shared class, in the order of their code points, as groups of ``width`` leaves.

    ``ranks`` holds leaf + 1 of every code point, 0 for one with a class of its own; characters never
    counted share the last leaf. Leaves start from their corpus frequencies.
    """

    def __init__(self, counts: pd.DataFrame, classes: np.ndarray):
        rare = counts.iloc[CLASSES - 2:].sort_values("point")
        self.size = len(rare) + 1
        self.width = int(np.ceil(np.sqrt(self.size)))
        self.ranks = np.where(classes == _RARE, self.size, 0).astype(np.int32)
        self.ranks[rare["point"]] = np.arange(1, self.size)
        share = np.zeros(self.width ** 2)
        share[:self.size] = [*rare["n"], 1]
        share = (share / share.sum()).reshape(self.width, self.width)
        with np.errstate(divide="ignore"):
            self.member = np.maximum(np.log(share), -1e4).astype(np.float32)
            self.group = np.maximum(np.log(share.sum(axis=1)), -1e4).astype(np.float32)


def padded_ranks(points: np.ndarray, place: np.ndarray, size: int, ranks: np.ndarray) -> np.ndarray:
    """Ranks at the places of padded texts, 0 around them."""
    out = np.zeros(size, np.int32)
    out[place] = ranks[points]
    return out


def padded_classes(raw: np.ndarray, at: np.ndarray, classes: np.ndarray, within: np.ndarray | None = None,
                   ranks: np.ndarray | None = None):
    """Classes of several texts with ``SIDE`` boundaries around each, each text's first place and length, its rare share, ranks."""
    lead = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
    starts = lead[at - at[0]]  # texts in characters
    length = np.diff(starts)
    points = code_points(raw)
    place = np.repeat(np.arange(1, len(length) + 1) * SIDE, length) + np.arange(len(points))
    out = np.zeros(len(points) + SIDE * (len(length) + 1), np.uint8)
    out[place] = classes[points]
    first = starts[:-1] + SIDE * np.arange(1, len(length) + 1)
    rare = None
    if within is not None:
        sums = np.concatenate([[0.0], np.cumsum(within[points], dtype=np.float64)])
        rare = sums[starts[1:]] - sums[starts[:-1]]
    return out, first, length, rare, None if ranks is None else padded_ranks(points, place, len(out), ranks)


def windows(a: np.ndarray, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """Context code and class of the places ``low`` to ``high`` of padded classes."""
    context = np.zeros(high - low, np.int32)
    for d in (*range(-SIDE, 0), *range(1, SIDE + 1)):
        context = context << _BITS | a[low + d:high + d]
    return context, a[low:high]


_OFFSETS = (*range(-SIDE, 0), *range(1, SIDE + 1), 0)  # context, then the masked place
_RANK_BITS = 21  # every code point fits


def rare_windows(r: np.ndarray, low: int, high: int) -> np.ndarray:
    """Which of the places ``low`` to ``high`` have a less common character in their window."""
    there = r != 0
    some = np.zeros(high - low, bool)
    for d in _OFFSETS:
        some |= there[low + d:high + d]
    return some


def rank_codes(r: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ranks in the windows of some places: the first three and the last two of ``_OFFSETS`` in one number each."""
    a, b = np.zeros(len(places), np.int64), np.zeros(len(places), np.int64)
    for d in _OFFSETS[:3]:
        a = a << _RANK_BITS | r[places + d]
    for d in _OFFSETS[3:]:
        b = b << _RANK_BITS | r[places + d]
    return a, b


def unpack_ranks(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    mask = (1 << _RANK_BITS) - 1
    return np.stack([a >> 2 * _RANK_BITS, a >> _RANK_BITS & mask, a & mask, b >> _RANK_BITS, b & mask], axis=1)


def window_counts(docs: DataFrame, classes: np.ndarray, ranks: np.ndarray | None = None) -> DataFrame:
    """Corpus counts of windows: (context, class) ``code`` and the ranks of less common characters (``a``, ``b``).

    Summed per task, then by a shuffle. Without ``ranks`` all less common characters are alike.
    """
    import pyarrow as pa
    held = docs.sparkSession.sparkContext.broadcast((classes, ranks))  # five bytes per code point

    def merge(parts):
        codes, n = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
        order = np.argsort(codes, kind="stable")
        codes, n = codes[order], n[order]
        first = np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1]]))
        return codes[first], np.add.reduceat(n, first)

    def emit(parts):
        codes, n = merge(parts)
        none = pa.array(np.zeros(len(codes), np.int64))
        return pa.RecordBatch.from_arrays([pa.array(codes.astype(np.int64)), none, none, pa.array(n)], ["code", "a", "b", "n"])

    def emit_rare(parts):
        code, a, b = (np.concatenate([p[i] for p in parts]) for i in range(3))
        order = np.lexsort((code, a, b))
        code, a, b = code[order], a[order], b[order]
        first = np.flatnonzero(np.concatenate([[True], (code[1:] != code[:-1]) | (a[1:] != a[:-1]) | (b[1:] != b[:-1])]))
        n = np.diff(np.concatenate([first, [len(code)]]))
        return pa.RecordBatch.from_arrays([pa.array(x) for x in (code[first], a[first], b[first], n)], ["code", "a", "b", "n"])

    def count(batches):
        classes, ranks = held.value
        parts, size, rare, rare_size = [], 0, [], 0
        for batch in batches:
            raw, at = utf8_column(batch.column("_text"))
            for first, last in document_chunks(at, _CHUNK):
                a, _, _, _, r = padded_classes(raw[at[first]:at[last]], at[first:last + 1], classes, ranks=ranks)
                for low in range(SIDE, len(a) - SIDE, _CHUNK):
                    high = min(low + _CHUNK, len(a) - SIDE)
                    context, target = windows(a, low, high)
                    code, keep = context << _BITS | target, target > 0
                    if r is not None:
                        some = keep & rare_windows(r, low, high)
                        places = np.flatnonzero(some)
                        if len(places):
                            rare.append((code[places].astype(np.int64), *rank_codes(r, places + low)))
                            rare_size += len(places)
                            keep &= ~some
                    codes, n = np.unique(code[keep], return_counts=True)
                    if len(codes):
                        parts.append((codes, n))
                        size += len(codes)
                if size > 4_000_000:
                    parts = [merge(parts)]
                    size = len(parts[0][0])
                    if size > 2_000_000:
                        yield emit(parts)
                        parts, size = [], 0
                if rare_size > 4_000_000:
                    yield emit_rare(rare)
                    rare, rare_size = [], 0
        if parts:
            yield emit(parts)
        if rare:
            yield emit_rare(rare)

    return (docs.select("_text").mapInArrow(count, "code long, a long, b long, n long")
            .groupBy("code", "a", "b").agg(F.sum("n").alias("n")))


# ---- the network ----------------------------------------------------------

Parameters = dict[str, np.ndarray]


def initial(seed: int = 7, rare: Rare | None = None) -> Parameters:
    rng = np.random.default_rng(seed)
    draw = lambda *shape: (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)
    p = {"embed": draw(CLASSES, EMBED), "in": draw(2 * SIDE * EMBED, HIDDEN), "in_b": np.zeros(HIDDEN, np.float32),
         "out": draw(HIDDEN, CLASSES), "out_b": np.zeros(CLASSES, np.float32)}
    p["out_b"][0] = -20  # a boundary is context only
    if rare is not None:  # embeddings start at nothing: the class as a whole, and corpus frequencies within it
        p |= {"rare": np.zeros((rare.size + 1, EMBED), np.float32), "leaf": draw(HIDDEN, EMBED),
              "group": np.zeros((rare.width, EMBED), np.float32), "member": np.zeros((rare.width ** 2, EMBED), np.float32)}
    return p


def unpack(context: np.ndarray) -> np.ndarray:
    shifts = np.arange(2 * SIDE - 1, -1, -1, dtype=np.int64) * _BITS
    return context[:, None] >> shifts & (CLASSES - 1)


def _log_softmax(z: np.ndarray) -> np.ndarray:
    z = z - z.max(axis=1, keepdims=True)
    return z - np.log(np.exp(z).sum(axis=1, keepdims=True))


def _inputs(p: Parameters, places: np.ndarray, ranks: np.ndarray | None) -> np.ndarray:
    x = p["embed"][places]
    if ranks is not None:
        x = x + p["rare"][ranks[:, :2 * SIDE]]
    return x.reshape(len(places), -1)


def log_probabilities(p: Parameters, context: np.ndarray) -> np.ndarray:
    """Of every class in contexts of common characters."""
    return _log_softmax(np.tanh(_inputs(p, unpack(context), None) @ p["in"] + p["in_b"]) @ p["out"] + p["out_b"])


def _leaves(p: Parameters, h: np.ndarray, leaf: np.ndarray, rare: Rare):
    """Query, group and member log-probabilities, and the members' embeddings, of hidden rows and their leaves."""
    q, g = h @ p["leaf"], leaf // rare.width
    members = p["member"].reshape(rare.width, rare.width, -1)[g]
    return q, _log_softmax(q @ p["group"].T + rare.group), _log_softmax((members @ q[:, :, None])[:, :, 0] + rare.member[g]), members


def rare_log_probabilities(p: Parameters, context: np.ndarray, target: np.ndarray, ranks: np.ndarray, rare: Rare) -> np.ndarray:
    """Of the masked character itself, in windows with less common characters of the given ranks."""
    h = np.tanh(_inputs(p, unpack(context), ranks) @ p["in"] + p["in_b"])
    i = np.arange(len(target))
    out = _log_softmax(h @ p["out"] + p["out_b"])[i, target]
    own = np.flatnonzero(ranks[:, -1])
    if len(own):
        leaf = ranks[own, -1] - 1
        _, group, member, _ = _leaves(p, h[own], leaf, rare)
        out[own] += group[i[:len(own)], leaf // rare.width] + member[i[:len(own)], leaf % rare.width]
    return out


def gradient(p: Parameters, context: np.ndarray, target: np.ndarray, weight: np.ndarray, ranks: np.ndarray | None = None,
             rare: Rare | None = None) -> Parameters:
    """Gradient of the weighted mean of the negative log-probability."""
    places = unpack(context)
    x = _inputs(p, places, ranks)
    h = np.tanh(x @ p["in"] + p["in_b"])
    z = h @ p["out"] + p["out_b"]
    z = np.exp(z - z.max(axis=1, keepdims=True))
    z /= z.sum(axis=1, keepdims=True)
    z[np.arange(len(target)), target] -= 1
    share = (weight / weight.sum())[:, None].astype(np.float32)
    z *= share
    back = z @ p["out"].T
    g = {}
    if ranks is not None:
        g = {k: np.zeros_like(p[k]) for k in ("rare", "leaf", "group", "member")}
        own = np.flatnonzero(ranks[:, -1])
        if len(own):
            leaf, i = ranks[own, -1] - 1, np.arange(len(own))
            q, group, member, members = _leaves(p, h[own], leaf, rare)
            group, member = np.exp(group), np.exp(member)
            group[i, leaf // rare.width] -= 1
            member[i, leaf % rare.width] -= 1
            group, member = group * share[own], member * share[own]
            dq = group @ p["group"] + (member[:, None, :] @ members)[:, 0]
            g["group"], g["leaf"] = group.T @ q, h[own].T @ dq
            np.add.at(g["member"].reshape(rare.width, rare.width, -1), leaf // rare.width, member[:, :, None] * q[:, None, :])
            back[own] += dq @ p["leaf"].T
    dh = back * (1 - h * h)
    dx = (dh @ p["in"].T).reshape(-1, EMBED)
    embed = np.zeros_like(p["embed"])
    np.add.at(embed, places.reshape(-1), dx)
    if ranks is not None:
        there = ranks[:, :2 * SIDE].reshape(-1)
        np.add.at(g["rare"], there[there > 0], dx[there > 0])
    return {"embed": embed, "in": x.T @ dh, "in_b": dh.sum(axis=0), "out": h.T @ z, "out_b": z.sum(axis=0)} | g


def one_pass(p: Parameters, batches, step: float, rare: Rare) -> tuple[Parameters, float]:
    """Adam over the batches of (code, a, b, count); new parameters and the mass seen."""
    p = {k: v.copy() for k, v in p.items()}
    m, v = ({k: np.zeros_like(x) for k, x in p.items()} for _ in range(2))
    mass, t = 0.0, dict.fromkeys(p, 0)
    for code, a, b, n in batches:
        for i in range(0, len(code), MINIBATCH):
            k = slice(i, i + MINIBATCH)
            c, w = code[k], n[k].astype(np.float64)
            ranks = unpack_ranks(a[k], b[k]) if (a[k] | b[k]).any() else None
            g = gradient(p, c >> _BITS, c & (CLASSES - 1), w, ranks, rare)
            mass += float(w.sum())
            for x in g:
                t[x] += 1
                m[x] += 0.1 * (g[x] - m[x])
                v[x] += 0.001 * (g[x] ** 2 - v[x])
                p[x] -= (step * m[x] / (1 - 0.9 ** t[x]) / (np.sqrt(v[x] / (1 - 0.999 ** t[x])) + 1e-8)).astype(np.float32)
    return p, mass


_PIECE = 1 << 14  # parameters in a row of the averaging


def train(counts: DataFrame, rounds: int = ROUNDS, step: float = STEP, rare: Rare | None = None) -> Parameters:
    """Rounds of a pass per partition from common parameters, averaged by mass.

    The averages are formed piece by piece on the executors: the driver gets one
    set of parameters a round, some 40 KB and 128 bytes per less common character.
    """
    p = initial(rare=rare)
    names = list(p)
    for r in range(rounds):
        held = counts.sparkSession.sparkContext.broadcast((p, rare))

        def work(batches, held=held, step=step / 2 ** r):
            p, rare = held.value
            new, mass = one_pass(p, ((b["code"].to_numpy(), b["a"].to_numpy(), b["b"].to_numpy(), b["n"].to_numpy()) for b in batches),
                                 step, rare)
            if mass:
                flat = np.concatenate([new[k].ravel() for k in names])
                at = range(0, len(flat), _PIECE)
                yield pd.DataFrame({"piece": range(len(at)), "mass": mass, "flat": [flat[i:i + _PIECE].tobytes() for i in at]})

        def average(pieces):
            total = pieces["mass"].sum()
            flat = sum(np.frombuffer(f, np.float32) * (w / total) for f, w in zip(pieces["flat"], pieces["mass"]))
            return pd.DataFrame({"piece": pieces["piece"].iloc[:1], "flat": [flat.astype(np.float32).tobytes()]})

        got = (counts.mapInPandas(work, "piece int, mass double, flat binary")
               .groupBy("piece").applyInPandas(average, "piece int, flat binary").collect())
        if not got:
            break
        flat = np.concatenate([np.frombuffer(g["flat"], np.float32) for g in sorted(got, key=lambda g: g["piece"])])
        at = 0
        for k in names:
            p[k] = flat[at:at + p[k].size].reshape(p[k].shape)
            at += p[k].size
    return p


# ---- scoring --------------------------------------------------------------

class Scorer:
    """Log-probability of every place of padded texts; softmax rows are kept per context."""

    def __init__(self, p: Parameters):
        self.p, self.rows, self.n = p, np.zeros((_CONTEXTS, CLASSES), np.float32), 0
        self.slot = np.full(1 << (2 * SIDE * _BITS), -1, np.int32)

    def __call__(self, context: np.ndarray, target: np.ndarray) -> np.ndarray:
        new = np.unique(context[self.slot[context] < 0])
        if self.n + len(new) > _CONTEXTS:
            self.slot.fill(-1)
            self.n, new = 0, np.unique(context)
            if len(new) > _CONTEXTS:  # more contexts than rows in one piece: in halves
                half = len(context) // 2
                return np.concatenate([self(context[:half], target[:half]), self(context[half:], target[half:])])
        for i in range(0, len(new), 8192):
            some = new[i:i + 8192]
            self.rows[self.n:self.n + len(some)] = log_probabilities(self.p, some.astype(np.int64))
            self.slot[some] = np.arange(self.n, self.n + len(some))
            self.n += len(some)
        return self.rows[self.slot[context], target]


def score(docs: DataFrame, p: Parameters, classes: np.ndarray, within: np.ndarray, rare: Rare | None = None) -> DataFrame:
    """``_key``, ``n_tokens`` and ``log_prob`` of every row; without ``rare`` less common characters have only their share ``within``."""
    import pyarrow as pa
    held = docs.sparkSession.sparkContext.broadcast((p, classes, within if rare is None else None, rare))

    def work(batches):
        p, classes, within, rare = held.value
        scorer = Scorer(p)
        for batch in batches:
            raw, at = utf8_column(batch.column("_text"))
            n, total = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows)
            for first, last in document_chunks(at, _CHUNK):
                a, begin, length, share, r = padded_classes(raw[at[first]:at[last]], at[first:last + 1], classes, within,
                                                            None if rare is None else rare.ranks)
                sums, before = np.zeros(len(a) + 1), 0.0
                for low in range(SIDE, len(a) - SIDE, _CHUNK):
                    high = min(low + _CHUNK, len(a) - SIDE)
                    context, target = windows(a, low, high)
                    if r is None:
                        lp = np.where(target > 0, scorer(context, target), 0.0)
                    else:
                        some = rare_windows(r, low, high)
                        lp, keep = np.zeros(high - low), np.flatnonzero((target > 0) & ~some)
                        lp[keep] = scorer(context[keep], target[keep])
                        places = np.flatnonzero((target > 0) & some)
                        for i in range(0, len(places), MINIBATCH):
                            k = places[i:i + MINIBATCH]
                            lp[k] = rare_log_probabilities(p, context[k], target[k], unpack_ranks(*rank_codes(r, k + low)), rare)
                    sums[low + 1:high + 1] = before + np.cumsum(lp, dtype=np.float64)
                    before = sums[high]
                sums[len(a) - SIDE + 1:] = before
                n[first:last] = length
                total[first:last] = sums[begin + length] - sums[begin] + (0.0 if share is None else share)
            yield pa.RecordBatch.from_arrays([batch.column("_key"), pa.array(n), pa.array(total)], ["_key", "n_tokens", "log_prob"])

    return docs.mapInArrow(work, "_key string, n_tokens long, log_prob double")


def pseudo_likelihood(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rounds: int = ROUNDS,
                      corpus: DataFrame | None = None) -> DataFrame:
    """Train on ``corpus`` (the documents themselves by default) and score every document.

    One row per input row: ``id_col``, ``n_tokens`` (characters), ``log_prob``
    (their summed conditional log-probabilities, natural logarithms) and
    ``mean_log_prob``, null for a text without characters. Null text counts as
    empty: 0 tokens and 0.0. Repeated rows are trained on and scored each.
    An empty table gives no rows. Other columns are ignored.
    """
    rows = docs.select(F.col(id_col).cast("string").alias("_key"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("_text"))
    learn = rows if corpus is None else corpus.select(F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("_text"))
    counted = character_counts(learn)
    classes, within = character_classes(counted)
    rare = Rare(counted, classes)
    key = ["code", "a", "b"]
    counts = staged(window_counts(learn, classes, rare.ranks).repartition(*key).sortWithinPartitions(F.xxhash64(*key)), "lm-windows")
    done = score(rows, train(counts, rounds, rare=rare), classes, within, rare)
    return done.select(F.col("_key").cast(dict(docs.select(id_col).dtypes)[id_col]).alias(id_col), "n_tokens", "log_prob",
                       F.when(F.col("n_tokens") > 0, F.col("log_prob") / F.col("n_tokens")).alias("mean_log_prob"))
