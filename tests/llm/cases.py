"""Small inputs every corpus operator must take."""

from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = "the of and thion ere nting ouher stand eaen was by onre heed anst lyth inere ha whst es ander".split()


def prose(n, seed=1):
    out, x = [], seed * 7919 + 13
    for i in range(n):
        x = (x * 1103515245 + 12345) % (1 << 31)
        out.append(WORDS[x // 65536 % len(WORDS)] + WORDS[x // 8192 % 7][:2] + ("." if i % 9 == 8 else ""))
    return " ".join(out)


def odd_rows():
    return [
        (1, None, None, None, None), (2, "", "en", "s", 0), (3, "é", "fr", "s", 1), (4, prose(60), "en", "s", 0),
        (5, prose(60), "en", "t", 0), (5, prose(60), "en", "t", 0), (6, prose(30_000, 3), "en", "s", 0),
        (8, " \n\t ", None, "s", 4), (9, "漢字かな🙂 password = Abcdefgh12\x00x", "de", None, 9), (10, "a" * 5000, "en", "s", 5000),
        (None, prose(40, 5), "en", "s", 7),
    ]


def odd_docs(spark):
    """Nulls in every column, empty, very long and repeated texts, and extra columns with clashing names."""
    df = spark.createDataFrame(odd_rows(), SCHEMA)
    for c in ("_text", "_id", "_key", "blob", "block", "spans", "id", "word", "_block", "item_id", "html"):
        df = df.withColumn(c, F.lit("clash"))
    return df


def empty_docs(spark):
    return spark.createDataFrame([], SCHEMA)


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}
