"""Small tables with the awkward rows every operator must take, and plain versions to compare with."""

import random
import re

from pyspark.sql import types as T

PROSE = "the and of in that was for with his they this have from one had word but not what all were when your can said".split()

DOCUMENTS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        T.StructField("th", T.StringType()),  # names that operators use inside
        T.StructField("rid", T.LongType()),
        T.StructField("a.b", T.StringType()),
        T.StructField("n_words", T.LongType()),
        T.StructField("size", T.StringType()),
    ]
)


def sentence(rng, words=12):
    return " ".join(rng.choice(PROSE) + rng.choice(["", "s", "er", "ing"]) for _ in range(words)).capitalize() + "."


def prose(rng, lines=8, words=12):
    return "\n".join(sentence(rng, words) for _ in range(lines))


def awkward_texts(seed=0):
    rng = random.Random(seed)
    base = prose(rng)
    words = base.split(" ")
    words[10] = "changed"
    return [
        (1, base),
        (2, base),  # a copy
        (3, " ".join(words)),  # a near copy
        (4, None),
        (5, ""),
        (6, " \n\t "),
        (7, "one"),
        (8, "one"),
        (None, prose(rng)),
        (None, None),
        (9, prose(rng, 400)),  # very long
        (9, prose(rng, 400)),  # an id that occurs twice
        (10, prose(rng)),
        (10, None),
        (11, "naïve Ünïcödé 日本語 😀 \r\n\x85 tab\tend " + base),
        (12, base + "\n" + prose(rng)),
        (13, "word " * 300),
        (14, "<|endoftext|> ### a: </turn>\\n <|startoftext|>"),
        (15, prose(rng)),
        (15, None),
    ] + [(100 + i, prose(rng)) for i in range(6)] + [(200, base)] * 2  # repeated rows


def documents(spark, rows=None, seed=0):
    rows = awkward_texts(seed) if rows is None else rows
    data = [
        (i, text, [None, "en", "de"][k % 3], [None, "s1"][k % 2], len(text or ""), "x", k, "dot", -1, "s")
        for k, (i, text) in enumerate(rows)
    ]
    return spark.createDataFrame(data, DOCUMENTS).repartition(3)


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def roots(n, pairs):
    """Least member of each of n things' components."""
    parent = list(range(n))

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = top(a), top(b)
        parent[max(a, b)] = min(a, b)
    return [top(x) for x in range(n)]
