import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
SYLLABLES = "th er on an re he in ed nd ha at en es of or ti é è ñ ch la de".split()


def prose(rng: random.Random, n: int) -> str:
    out = []
    for _ in range(n):
        w = "".join(rng.choices(SYLLABLES, k=rng.randint(1, 4)))
        out.append(w + rng.choice(["", "", "", ",", ".", ".\n", "!"]))
    return " ".join(out)


#: Names that the operators use themselves, or used to, and one with a dot.
CLASHES = ["a.b", "__uid", "__runs", "__spans", "__cover", "uid", "node", "key", "group_uid", "lost_id", "salt", "text_", "spans", "piece", "size", "tag", "first", "n"]
ODD = [None, "", " ", "\n", "a", "\n\n x\n", "ab\tcd\x0bef", "né zz 日本語 🙂 ok", "x" * 3000, "the end\nthe end\nthe end \nthe end", "w " * 700, "12 34 ### $$ <|>\n" * 40]


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty and long texts, repeated rows, an extra column with a clashing name."""
    rng = random.Random(5)
    texts = ODD + [prose(rng, n) for n in (3, 19, 20, 50, 400, 5000)]
    rows = [(i, t, "en", "s", 1) for i, t in enumerate(texts)]
    rows += [(12, texts[12], "en", "s", 1), (12, texts[12], "en", "s", 1), (None, texts[15], None, None, None), (None, None, None, None, None)]
    from pyspark.sql import functions as F

    return spark.createDataFrame(rows, SCHEMA).withColumn("n_words", F.lit("clash")).withColumn("shard", F.lit(None).cast("string")).withColumn("kept", F.lit(1)).select("*", *(F.lit(i).alias(n) for i, n in enumerate(CLASHES)))
