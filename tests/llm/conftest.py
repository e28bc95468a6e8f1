import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def docs_of(spark):
    """Documents from texts, or from (doc_id, text, lang, source) tuples."""

    def make(*rows):
        full = []
        for i, r in enumerate(rows):
            doc, text, lang, source = r if isinstance(r, tuple) else (i, r, "en", "s")
            full.append((doc, text, lang, source, None if text is None else len(text)))
        return spark.createDataFrame(full, SCHEMA)

    return make


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls, empty and very long texts, ties and repeated rows."""
    long = " ".join(f"wort{i % 977}x{i // 500}" for i in range(60_000))
    return [
        (1, None, None, None), (2, "", "en", "a"), (3, " \t\n\x0b\x0c\r", "en", "a"),
        (4, long, "de", "b"), (5, long + " end", "de", "b"), (6, "one two", "en", None),
        (6, "one two", "en", None), (7, "one  two", "en", "a"), (None, "one two three", None, "c"),
        (8, " café 日本 \U0001f600 á 1234 <|endoftext|> İΣ", "fr", "a"), (9, "#### $$$ 12", "en", "z"),
        (10, "same same same same same same " * 20, "en", "a"), (11, "same same same same same same " * 20, "en", "a"),
    ]


@pytest.fixture(scope="session")
def odd(docs_of, odd_rows):
    """With columns whose names clash with those that operators make."""
    from pyspark.sql import functions as F

    names = ("size", "target", "taken", "block", "n", "start", "length", "kept", "group_size", "score",
             "place", "ids", "words", "spans", "base", "shards", "component_id", "__n", "text_sha256",
             "__own", "__copy", "__shard", "__room", "__size", "__fact_doc_id", "__row", "__spot", "__times")
    return docs_of(*odd_rows).withColumns({n: F.lit("x") for n in names})


@pytest.fixture(scope="session")
def none(docs_of):
    return docs_of((1, "x", "en", "s")).filter("false")


@pytest.fixture(scope="session")
def real_docs(spark):
    """The documents of a small test table."""
    return spark.read.parquet(f"{FOLDER}/documents.parquet")


@pytest.fixture(scope="session")
def real_rows(real_docs):
    return [tuple(r) for r in real_docs.collect()]
