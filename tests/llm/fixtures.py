"""Small tables with the awkward cases every operator must stand."""

import random

from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                     T.StructField("n_chars", T.LongType())])
PASSAGE = "this passage of well over fifty bytes stands in many of the documents of the table, word for word."


def prose(rng, n):
    syllables = ["ba", "ce", "di", "fo", "gu", "lär", "mé", "no", "pu", "sta"]
    return " ".join("".join(rng.choice(syllables) for _ in range(rng.randint(1, 4))) for _ in range(n))


def documents():
    """(doc_id, text, lang, source, n_chars): copies, near copies, shared passages, junk, long, empty, null, repeated rows."""
    rng = random.Random(5)
    texts = {i: prose(rng, rng.randint(60, 160)) for i in range(1, 25)}
    texts[30], texts[31] = texts[3], texts[3]
    texts[32] = texts[4].replace(" ", "  ", 1) + " more"
    texts[33] = texts[5] + " " + PASSAGE + " " + texts[6][:200]
    texts[34] = PASSAGE + texts[7] + PASSAGE
    texts[35], texts[36], texts[37] = "", None, "one two"
    texts[38] = "Und " * 4000
    texts[39] = "a" * 9000
    texts[40] = " ".join(w + "###" for w in prose(rng, 120).split())
    texts[41] = prose(rng, 200).upper() + "!!"
    texts[42] = "\n".join(["the same line again and again with some words"] * 20)
    texts[43] = "naïve café 漢字 😀 <|endoftext|> </s> \x0b\t " + prose(rng, 55)
    texts[44] = prose(rng, 12000)
    rows = [(i, t, "en", f"s{i % 4}" if i % 9 else None, len(t) if t is not None else None) for i, t in texts.items()]
    rows += [rows[2], rows[2], (None, texts[9], None, "s1", None), (None, "no id " + texts[8], "xx", None, 5)]
    rng.shuffle(rows)
    return rows


def frame(spark, rows=None):
    return spark.createDataFrame(documents() if rows is None else rows, DOCS)


def clashing(df, names):
    """The table with extra columns that have the names of result columns."""
    from pyspark.sql import functions as F
    return df.withColumns({n: F.lit("mine") for n in names})
