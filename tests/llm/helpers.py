"""Small tables with the awkward rows that every operator must stand."""

import random

SYL = "an er on th st re in ou ti ha".split()


def prose(seed, n, ends=True):
    r = random.Random(seed)
    words = ["".join(r.choice(SYL) for _ in range(r.randint(1, 3))) for _ in range(n)]
    return " ".join(w + "." * (ends and i % 9 == 8) for i, w in enumerate(words))


#: (doc_id, text): null and empty texts, a null id, a repeated row, white space, one very long text and one very long word
AWKWARD = [(1, None), (2, ""), (3, " \n\t\n "), (None, prose(90, 60)), (5, prose(5, 70)), (5, prose(5, 70)), (6, prose(5, 70)),
           (7, "x" * 200_000), (8, prose(8, 30_000)), (9, "é漢\U0001f600 ß\x85\xa0"), (10, "|||"), (11, "a\r\nb\r\na\r\nb")]


def docs_of(spark, rows, **extra):
    """Documents with columns whose names clash with the operators' own."""
    from pyspark.sql import functions as F
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for c in ("n", "score", "fold", "gram", "node", "_doc", "_text", "size", "matches", "lang_pred"):
        df = df.withColumn(c, F.lit(c))
    for c, v in extra.items():
        df = df.withColumn(c, v)
    return df
