"""Phrase fingerprints against a plain computation over the sorted rows."""

import hashlib

from cases import empty_docs, odd_docs, odd_rows, prose

from ridelake.llm import fingerprints as P


def plain_phrases(text):
    out, i = set(), 0
    while i < len(text):
        j = i + 1
        while j <= len(text) and text[i:j] in out:
            j += 1
        if j > len(text):
            break
        out.add(text[i:j])
        i = j
    return out


def plain(rows):
    """Expected rows as a sorted list."""
    rows = sorted(((i, t or "") for i, t in rows), key=lambda r: (-(r[0] if r[0] is not None else -1), r[1]))
    out = []
    for k, (i, text) in enumerate(rows):
        following = rows[(k + 1) % len(rows)][1]
        cut = len(text) // 3
        edited = text[:len(text) - cut] + following[:cut]
        fp, fe, fn = (P.as_hex(P._smallest(P._hashes(list(plain_phrases(t))), P.K)) for t in (text, edited, following))
        out.append((i, len(text), hashlib.sha256(edited.encode()).hexdigest(), fp, fe, near(fp, fe), near(fp, fn)))
    return sorted(out, key=str)


def near(a, b):
    a, b = ({x[i:i + 8] for i in range(0, len(x), 8)} for x in (a, b))
    union = sorted(a | b)[:P.K]
    return sum(x in a and x in b for x in union) / len(union) if union else 1.0


def got(df):
    return sorted((tuple(r) for r in P.compare_with_edits(df).collect()), key=str)


def test_odd_rows(spark):
    assert got(odd_docs(spark)) == plain([(r[0], r[1]) for r in odd_rows()])
    assert got(empty_docs(spark)) == []


def test_table_in_many_blocks(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").repartition(7)
    assert got(df) == plain([(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()])


def test_single_row_follows_itself(spark):
    df = spark.createDataFrame([(7, prose(50))], "doc_id long, text string")
    assert got(df) == plain([(7, prose(50))])


def test_likeness_orders_similarity():
    a, b, c = prose(2000), prose(1900) + prose(100, 4), prose(2000, 9)[::-1]
    f = P.fingerprint
    assert P.likeness(f(a), f(a)) == 1 > P.likeness(f(a), f(b)) > P.likeness(f(a), f(c))
    assert P.likeness(f(None), f("")) == 1 and P.likeness(f(""), f(a)) == 0


def test_undo_restores_the_parse():
    p = P.PhraseParser()
    p.feed(prose(100))
    at, before = p.mark(), (list(p.phrases), set(p.known), p.open)
    p.feed(prose(80, 2))
    p.undo(at)
    assert (p.phrases, p.known, p.open) == before
