"""Small tables with what real ones have: nulls, empty and long texts, repeated rows, ties, clashing extra columns."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORDS = "the of and ähnlich 数据 über train model data line word token spark join scale shuffle copy page text node edge graph tree leaf root".split()


def prose(rng, n):
    return " ".join(rng.choice(WORDS) + (rng.choice(["", "", ".", ","])) for _ in range(n))


def texts(seed=3, n=60):
    rng = random.Random(seed)
    passage, line = prose(rng, 60), "This line is long enough to count and it is in many documents."
    out = [None, "", " \t\n ", "word", "ünï \x0b\x0c\r x", "a" * 5000, prose(rng, 4000)]
    for k in range(n):
        t = prose(rng, rng.randint(1, 300))
        if k % 5 == 0:
            t = t + "\n" + passage + "\n" + prose(rng, 9)
        if k % 4 == 0:
            t += "\n  " + (line.upper() if k % 8 else line) + " \n" + line
        if k % 7 == 0 and out[-1]:
            t = out[-1]
        if k % 9 == 0 and out[-1]:
            t = out[-1] + " tail"
        out.append(t)
    return out


def documents(spark, seed=3, n=60, repeat=True):
    rows = [(k * 3 + 1, t, ["en", "de", None][k % 3], f"src{k % 4}" if k % 11 else None, 0) for k, t in enumerate(texts(seed, n))]
    if repeat:
        rows += [rows[10], rows[10], (None, rows[12][1], "en", "src1", 0), (None, None, None, None, None)]
    return spark.createDataFrame(rows, SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def clashing(df, *names):
    """df with further columns under names that operators use inside or put out."""
    from pyspark.sql import functions as F

    return df.select("*", *(F.lit("x").alias(n) for n in names))
