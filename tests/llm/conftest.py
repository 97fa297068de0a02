import pytest
from pyspark.sql import types as T

#: Null and empty texts, white space, ties, repeated rows, missing and repeated ids, a long word.
ODD = [
    (1, None),
    (2, ""),
    (3, " \n\t "),
    (4, "One two three four five six seven eight nine ten eleven twelve"),
    (5, "One two three four five six seven eight nine ten eleven twelve"),
    (5, "One two three four five six seven eight nine ten eleven twelve"),
    (6, "!!! ### ---"),
    (None, "no id here at all, really none"),
    (None, "no id here at all, really none"),
    (None, None),
    (7, "é" * 3000),
    (7, "another text under an id that is taken"),
    (8, "long " * 30_000),
    (9, "token = abcdefgh12345 <|endoftext|> ▁ \u0000 𝒳"),
]
#: Columns whose names operators use for their own results.
CLASHING = [
    "start", "length", "rank", "task", "hash", "print", "pos", "line", "n_words", "spans", "labels", "score",
    "fingerprint", "component_id", "removed_lines", "leak", "words", "u", "v", "n_chars", "keys", "size", "key", "ids", "decoded",
    "_repeats", "_gone", "_left", "_removed", "_doc", "_text", "_row", "_key_id", "_key_row", "_key_id2", "_group", "_band", "_hot",
    "_leak_text", "_leak_found", "_leak", "_kept", "_n", "first", "root", "_linked", "_toxicity",
]


@pytest.fixture(scope="session")
def odd(spark):
    """Awkward documents with many further columns."""
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType())])
    for name in CLASHING:
        schema = schema.add(name, T.StringType())
    schema = schema.add("of any kind", T.MapType(T.StringType(), T.IntegerType()))
    return spark.createDataFrame([(*row, *["x"] * len(CLASHING), {"a": 1}) for row in ODD], schema)


@pytest.fixture(scope="session")
def none(odd):
    return odd.limit(0)


@pytest.fixture(scope="session")
def docs(spark):
    """The smallest document table as (doc_id, text)."""
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").cache()


@pytest.fixture(scope="session")
def texts(docs):
    return {r.doc_id: r.text for r in docs.collect()}
