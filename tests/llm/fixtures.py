"""Small awkward tables and plain versions of what the operators compute."""

import random

from pyspark.sql import functions as F

from fernwick.llm.queries import vocabulary

BYTE_BPE = vocabulary("byte_bpe_50k.json")
WORD_BPE = vocabulary("word_bpe_49k.json")


def awkward_rows(seed=1, n=40):
    """Texts with copies, near copies, nulls, blanks, one word, unsplit and long text, repeated rows, null ids."""
    r = random.Random(seed)
    vocab = ["".join(r.choice("abcdeé") for _ in range(r.randint(1, 6))) for _ in range(60)]
    base = [" ".join(r.choice(vocab) for _ in range(r.randint(30, 80))) for _ in range(6)]
    rows = [(i, " ".join(r.choice(vocab) for _ in range(r.randint(3, 60)))) for i in range(n)]
    rows += [(100 + i, base[i % 6]) for i in range(9)]
    rows += [(120 + i, base[i % 6] + " tail" * (1 + i // 6)) for i in range(12)]
    rows += [(200, None), (201, ""), (202, " \n\t "), (203, "one"), (204, "ONE"), (205, "two words"), (None, base[0]),
             (None, None), (206, "x" * 3000), (207, "Ab, c! " * 900), (208, "né́ \U0001F642 <|endoftext|> z"), (41, "twice"), (41, "twice"), (0, "other text of id 0")]
    return rows


def table(spark, rows):
    """Documents with further columns whose names the operators use inside."""
    df = spark.createDataFrame(rows, "doc_id long, text string")
    return df.withColumns({c: F.lit(1) for c in ("n", "ids", "cid", "_id", "hub", "score", "length", "label", "_text", "word")})


def empty(spark):
    return table(spark, [(1, "x")]).filter("false")


def words(text):
    return (text or "").encode().lower().split()
