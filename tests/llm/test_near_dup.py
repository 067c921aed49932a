"""Order MinHash classes against all pairs in plain Python."""

import random
import re
from collections import Counter

import numpy as np
from cases import WORDS, empty_docs, odd_docs, odd_rows, prose
from hypothesis import given, settings
from hypothesis import strategies as st

from ridelake.llm import near_dup as N


def words(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def unlabelled(text):
    w = words(text)
    return [tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4) if w else 0)]


def similarity(a, b):
    """In-order alignment of shingles by the full dynamic programme."""
    if not a or not b:
        return 0.0
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
        row = new
    return row[-1] / (len(a) + len(b) - row[-1])


def plain_classes(rows):
    """Smallest id of the class of each row, by all pairs."""
    lab = [unlabelled(t) for _, t in rows]
    bags = [Counter(x) for x in lab]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            equal = words(rows[i][1]) == words(rows[j][1]) and (lab[i] or (rows[i][1] or "") == (rows[j][1] or ""))
            quick = (bags[i] & bags[j]).total() >= 0.8 * (bags[i] | bags[j]).total()
            if equal or lab[i] and quick and similarity(lab[i], lab[j]) >= 0.8:
                root[find(i)] = find(j)
    out = {}
    for i, (k, _) in enumerate(rows):
        out.setdefault(find(i), []).append(k)
    first = {r: min(ids, key=lambda k: (k is None, k)) for r, ids in out.items()}
    return sorted(((k, first[find(i)], len(out[find(i)])) for i, (k, _) in enumerate(rows)), key=str)


def got(df):
    return sorted((tuple(r)[:3] for r in N.near_duplicates(df).collect()), key=str)


def edited(text, n, seed):
    rng, w = random.Random(seed), text.split(" ")
    for _ in range(n):
        i = rng.randrange(len(w))
        w[i:i + rng.randint(0, 1)] = [rng.choice(WORDS) + "x"] * rng.randint(0, 2)
    return " ".join(w)


def varied(n, seed):
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + rng.choice(WORDS) for _ in range(n))


def test_families_of_edited_copies(spark):
    rows, k = [], 100
    for f in range(12):
        base = varied(150 + 40 * f, f)
        rows.append((k, base))
        for e in range(8):
            k += 1
            rows.append((k, edited(base, e * (3 + f // 3) // 2, f * 100 + e)))
        k += 1
    rows += [(k + i, varied(120, 500 + i)) for i in range(30)] + [(5, rows[3][1].upper()), (6, rows[3][1].replace(" ", ",\n "))]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    want = plain_classes(rows)
    assert got(df) == want and len({c for _, c, _ in want}) > 42  # families and, where edits are many, parts of them


def test_odd_rows(spark):
    rows = [(r[0], r[1] if r[1] and len(r[1]) < 9000 else r[1] and r[1][:0] + "long") for r in odd_rows()]
    have = {(k, c, n) for k, c, n in got(odd_docs(spark))}
    assert have == set(plain_classes(rows))
    flags = {(r["doc_id"], r["kept"]) for r in N.near_duplicates(odd_docs(spark)).collect()}
    assert {(1, True), (2, False), (4, True), (5, False)} <= flags
    assert got(empty_docs(spark)) == []


def test_one_large_family_and_a_common_passage(spark):
    base, passage = varied(200, 1), varied(80, 2)
    rows = [(i, edited(base, 2, i)) for i in range(300)] + [(1000 + i, varied(80, 3000 + i) + " " + passage) for i in range(300)]
    have = {k: c for k, c, _ in got(spark.createDataFrame(rows, "doc_id long, text string"))}
    assert {have[i] for i in range(300)} == {0}
    assert all(have[1000 + i] == 1000 + i for i in range(300))


def test_stage_keeps_one_of_each(spark):
    text = prose(60)
    df = spark.createDataFrame([(3, text, "x"), (1, text, "y"), (2, "other words here now then", "z"), (None, None, "n")],
                               "doc_id long, text string, node string")
    left = N.keep_one_of_each(df)
    assert left.columns == df.columns and {r["doc_id"] for r in left.collect()} == {1, 2, None}


def test_components_of_a_long_chain(spark):
    edges = [(f"{i:03}", f"{i + 1:03}") for i in range(60)] + [("x", "y"), ("y", "z"), ("x", "z")]
    have = {r["node"]: r["root"] for r in N.components(spark.createDataFrame(edges, "a string, b string")).collect()}
    assert have == {f"{i:03}": "000" for i in range(61)} | {"x": "x", "y": "x", "z": "x"}


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from("ab"), max_size=70), st.lists(st.sampled_from("abc"), max_size=8), st.integers(0, 70), st.integers(1, 3))
def test_alignment_of_repeated_shingles(a, new, at, times):
    a = a * times
    b = a[:at] + new + a[at + len(new) // 2:]
    want = similarity(unlabelled(" ".join(a)), unlabelled(" ".join(b)))
    ids = {w: i + 1 for i, w in enumerate("abc")}
    have = N.aligned_similarity(*(N.word_shingles(np.array([ids[w] for w in t], np.uint64)) for t in (a, b)))
    assert have == want if want >= 0.8 else have < 0.8


def test_long_alignment_crosses_many_steps_of_the_band():
    rng = np.random.default_rng(4)
    a = rng.integers(0, 40, 3000).astype(np.uint64)
    b = np.delete(a, rng.integers(0, 3000, 150))
    b = np.insert(b, rng.integers(0, len(b), 100), np.uint64(7))
    assert N.aligned_similarity(a, b) == similarity(a.tolist(), b.tolist()) > 0.8


def test_repeated_lines_survive_an_early_edit(spark):
    line = varied(12, 70)
    text = "\n".join(f"{line}\n{varied(9, 80 + i)}" for i in range(12))
    less = text.split(" ", 10)[10]  # the first ten words dropped: the line's copies change their numbers
    assert N.aligned_similarity(*(N.labelled(N.word_shingles(np.array([hash(w) & 0xFFFFFFFF for w in words(t)], np.uint64))) for t in (text, less))) < 0.8
    rows = [(1, text), (2, less), (3, varied(250, 99))]
    assert {k: c for k, c, _ in got(spark.createDataFrame(rows, "doc_id long, text string"))} == {1: 1, 2: 1, 3: 3}


def test_short_texts_are_compared_exactly(spark):
    """Texts of 2 to 40 words with one or two edits: every link of all pairs is found."""
    rows, k = [], 0
    for n in list(range(2, 41)) * 3:
        base = varied(n, 9000 + k)
        for e in range(3):
            w = base.split(" ")
            if e and n > 1:
                w[-1 if e == 1 else 0] += "z"
            rows.append((k, " ".join(w + ["end"] * (e == 2))))
            k += 1
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert got(df) == plain_classes(rows)


def test_recall_of_the_sketches_by_length():
    """Share of pairs of similarity 0.8 to 0.9 that share a bucket, for texts that only sketches bring together."""
    for n in (40, 80, 200, 600):
        met = total = 0
        for seed in range(250):
            rng = np.random.default_rng(seed * 1000 + n)
            a = rng.integers(0, 1 << 62, n + 4).astype(np.uint64)
            if seed % 2 and n >= 80:  # words changed here and there, or a piece cut off: 0.8 to 0.9 is left
                b = a.copy()
                b[rng.choice(n - 8, n // 50, replace=False) + 4] = rng.integers(0, 1 << 62, n // 50)
            else:
                b = a[int(n * rng.uniform(0.1, 0.199)):]
            x, y = N.text_shingles(a << np.uint64(2)), N.text_shingles(b << np.uint64(2))
            if N.aligned_similarity(x, y):
                total += 1
                met += bool(set(zip(range(14), N.order_sketches(N.labelled(x)))) & set(zip(range(14), N.order_sketches(N.labelled(y)))))
        assert total > 150 and met / total >= 0.99, (n, met, total)
