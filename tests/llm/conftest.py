import random

import pytest
from pyspark.sql import types as T

EXTRA = ["n_words", "kept", "vec", "cls", "th", "rate", "tokens", "posteriors", "mix_copy", "dedup_id", "root", "start", "N_CHARS2"]


def prose(rng: random.Random, n: int) -> str:
    stems = ["ba", "cor", "den", "el", "fin", "gra", "hol", "in", "jor", "kal", "lum", "mor", "nes", "or", "pel", "qui"]
    return " ".join("".join(rng.choice(stems) for _ in range(rng.randint(1, 3))) for _ in range(n))


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls everywhere, empty, blank and very long texts, repeated rows and
    ids, and extra columns whose names clash with the operators' own."""
    rng = random.Random(3)
    texts = {1: prose(rng, 80), 2: None, 3: "", 4: " \t\n ", 5: prose(rng, 60_000), 6: "one two", 7: "x" * 50_000, 8: "naïve café – “quote” €5 你好 مرحبا \x0b\x85 end"}
    rows = [(k, t, "en" if k % 2 else None, "s", 7 if t is None else len(t)) for k, t in texts.items()]
    copy = (9, texts[1], "en", "s", len(texts[1]))
    rows += [copy, copy, (None, prose(rng, 50), None, None, None), (10, texts[1].replace("ba", "bo", 1), "en", "s", 1), (3, prose(rng, 30), "en", "s", None)]
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
                           T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
                           *[T.StructField(c, T.StringType()) for c in EXTRA]])
    return spark.createDataFrame([(*r, *["e"] * len(EXTRA)) for r in rows], schema).repartition(3)


@pytest.fixture(scope="session")
def docs001(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")


@pytest.fixture(scope="session")
def labels001(spark):
    return spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
