"""Odd documents and plain reference versions."""

import random
import re

import duckdb
from pyspark.sql import types as T

SMALL = "/root/testdata/sf0.001"
DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()), T.StructField("lang_pred", T.IntegerType()),
    T.StructField("mix", T.StringType()),
])


def sentence(rng, words=40, vocabulary=3000):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(words))


def odd_rows():
    """Nulls in every column, empty, blank, tiny and very long texts, copies, near copies, repeated rows, clashing columns."""
    rng = random.Random(5)
    base = sentence(rng, 60)
    near = base.split()
    near[30] = "changed"
    far = base.split()
    far[::4] = ["other"] * len(far[::4])
    texts = [
        base, base.upper(), " ".join(near), " ".join(far), None, "", " \t\n ", "one", "one", "two words", "ünï ÇØDÉ",
        "\n".join(sentence(rng, 8) for _ in range(6)), sentence(rng, 60_000), "tail " + base, "123 456", "x" * 50_000,
    ]
    rows = [(i, t, ("en", "de", None)[i % 3], ("b", "a", None, "ç")[i % 4], len(t) if t is not None else None, 7, "m") for i, t in enumerate(texts)]
    return rows + [rows[0], (3, "another text with the same id", None, None, None, None, None), (None, base, "en", "a", 1, None, None), (None, None, None, None, None, None, None)]


def odd_docs(spark):
    return spark.createDataFrame(odd_rows(), DOCS)


def no_docs(spark):
    return spark.createDataFrame([], DOCS)


def words(text):
    folded = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", folded)


def shingle_set(text, n):
    w = words(text)
    return frozenset(tuple(w[i : i + n]) for i in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)] if w else [])


def united(nodes, links):
    """Smallest node that each one reaches."""
    up = {n: n for n in nodes}

    def top(n):
        while up[n] != n:
            n = up[n]
        return n

    for a, b in links:
        a, b = top(a), top(b)
        up[max(a, b)] = min(a, b)
    return {n: top(n) for n in nodes}


def rows_of(frame):
    names = sorted(frame.columns)
    return sorted((tuple(r[n] for n in names) for r in frame.collect()), key=repr)


def twin_rows(sql, sf_dir=SMALL):
    import glob
    import os

    db = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        db.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    found = db.execute(sql)
    names = [d[0] for d in found.description]
    order = [names.index(n) for n in sorted(names)]
    return sorted((tuple(r[i] for i in order) for r in found.fetchall()), key=repr)
