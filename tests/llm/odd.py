"""Small tables with every odd case."""

import random

from pyspark.sql import types as T

#: Columns whose names the operators use inside, in a table that has nothing to do with them.
CLASHES = ["id", "tk", "set", "lines", "kept", "runs", "size", "words", "score", "doc", "label", "place", "text_key"]

DOCUMENTS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        *[T.StructField(c, T.StringType()) for c in CLASHES],
    ]
)


def prose(seed: int, n: int) -> str:
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("abcdeghiklmnorstu") for _ in range(rng.randint(2, 7))) for _ in range(n))


def edited(text: str, seed: int, times: int) -> str:
    rng, w = random.Random(seed), text.split(" ")
    for _ in range(times):
        w[rng.randrange(len(w))] = f"new{rng.randrange(10**6)}"
    return " ".join(w)


def odd_rows() -> list[tuple]:
    """Ids and texts with nulls, blanks, ties, repeats, copies, near copies, shared passages and a very long text."""
    base, lines = prose(1, 120), "\n".join(prose(100 + n, 8) for n in range(6))
    passage, far = prose(2, 20), prose(3, 60_000)
    return [
        (1, base),
        (2, base),
        (2, base),
        (None, base),
        (3, edited(base, 1, 2)),
        (4, edited(base, 2, 3)),
        (5, edited(base, 3, 12)),
        (6, base.upper()),
        (7, None),
        (8, ""),
        (9, " \t\n "),
        (10, "word"),
        (11, "word"),
        (12, "five words are one shingle"),
        (13, "Five words are one shingle"),
        (14, prose(4, 30) + " " + passage + " " + prose(5, 30)),
        (15, passage + "\t" + prose(6, 40)),
        (None, prose(7, 25) + "\n" + passage),
        (16, lines),
        (17, prose(8, 5) + "\n" + lines + "\n" + prose(9, 5)),
        (18, "\n".join(["same"] * 7)),
        (18, "\n".join(["other"] * 5)),
        (19, "\n\n\n\n"),
        (20, "\n \n\n"),
        (21, far),
        (22, far + " " + passage),
        (-5, edited(base, 4, 1)),
        (23, "é ñ   ß\x0bx\x0cy\rz"),
    ]


def frame(spark, rows, source=lambda n: [None, "a", "b", "a", "a"][n % 5]):
    full = [(i, t, None, source(n), None if t is None else len(t), *CLASHES) for n, (i, t) in enumerate(rows)]
    return spark.createDataFrame(full, DOCUMENTS)
