"""Small tables with every oddity: nulls, empty and long texts, ties, repeated rows, extra columns."""

import random

LONG = " ".join(f"word{i % 977}" for i in range(30_000))
DOCS = [
    (1, "The quick brown fox jumps over the lazy dog again and again"),
    (2, "the quick  brown fox jumps over the lazy dog again and again"),
    (3, "The quick brown fox jumps over the lazy dog again and again"),
    (4, ""), (5, None), (6, " \n\t"), (7, "one"), (8, "ONE"), (9, LONG), (10, LONG + " "), (11, "naïve café — 日本語 🙂 <|endoftext|>"),
    (12, "one"), (12, "one"), (13, "a b  c\r\n"), (None, "without an id"), (None, None),
]


def frame(spark, rows=DOCS):
    """Documents with columns whose names operators use inside."""
    made = [(d, t, i, "x", None) for i, (d, t) in enumerate(rows)]
    return spark.createDataFrame(made, "doc_id long, text string, m1 long, fingerprint string, rows int")


def empty(spark):
    return frame(spark, [])


def prose(seed, n, vocabulary=60):
    rnd = random.Random(seed)
    return " ".join(rnd.choice(["alpha", "beta", "gamma", "delta"]) + str(rnd.randrange(vocabulary)) for _ in range(n))


def rows(df, *names):
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=lambda r: tuple((x is not None, str(x)) for x in r))
