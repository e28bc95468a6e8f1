"""The pipeline stage by stage against brute force, and the SQL forms."""

from collections import Counter, defaultdict

import duckdb
import pytest

import corpus_pipeline
from tallygrid.llm.queries import QUERIES, SQL
from tests.llm import test_exact, test_jaccard
from tests.llm.conftest import FOLDER


def test_stages(spark, real_docs):
    docs = real_docs
    columns = docs.columns
    tables = {}
    for name, stage in corpus_pipeline.STAGES:
        before = [tuple(r) for r in docs.collect()]
        out = stage(spark, docs, FOLDER)
        rows = [tuple(r) for r in out.collect()]
        tables[name] = (before, rows)
        if name != "packing":
            assert out.columns == columns
            docs = spark.createDataFrame(rows, docs.schema)
    before, rows = tables["language ID"]
    assert sorted(rows) == sorted(r for r in before if any(c.isalpha() for c in r[1]))
    before, rows = tables["exact dedup"]
    keep = {r[0] for r in test_exact.brute(before) if r[3]}
    assert sorted(rows) == sorted(r for r in before if r[0] in keep) and len(rows) < len(before)
    before, rows = tables["n-gram Jaccard join"]
    keep = {d for d, _, c in test_jaccard.brute(before) if d == c}
    assert sorted(rows) == sorted(r for r in before if r[0] in keep) and len(rows) < len(before)
    before, rows = tables["mixing sources"]
    size = {r[0]: len(r[1].split()) for r in before}
    taken = Counter()
    for r in rows:
        taken[r[0]] += len(r[1].split())
    assert all(n <= 2 * size[d] for d, n in taken.items())
    assert set(rows) <= set(before)
    assert abs(sum(taken.values()) - 1.5 * sum(size.values())) <= len({r[3] for r in before}) * (1 + max(size.values()) / 2)
    before, pieces = tables["packing"]
    tokens = defaultdict(int)
    for p in pieces:
        tokens[p[0]] += p[2]
    assert set(tokens) == {r[0] for r in before}


def test_run(spark):
    out = corpus_pipeline.run(spark, FOLDER)
    assert out.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    assert out.count() > 0


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "conversations"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{FOLDER}/{table}.parquet')")
    df = QUERIES[name](spark, FOLDER)
    theirs = con.execute(SQL[name])
    names = [c[0] for c in theirs.description]
    assert sorted(names) == sorted(df.columns)
    assert sorted(map(tuple, df.select(*names).collect())) == sorted(theirs.fetchall())


def test_rows_without_an_id_are_rows_of_their_own(docs_of):
    long = " ".join(f"w{i}" for i in range(60))
    texts = ["alpha beta gamma", "alpha  beta gamma", "delta epsilon", "zeta eta theta", long, long + " end"]
    rows = [(None, t, "en", "s") for t in texts] + [(5, "iota one", "en", "s"), (5, "kappa two three", "en", "s")]
    docs = docs_of(*rows)
    exact = {r["text"] for r in corpus_pipeline.exact.without_copies(docs).collect()}
    assert exact == {r[1] for r in rows} - {"alpha beta gamma"}
    near = [r["text"] for r in corpus_pipeline.jaccard.one_of_each(docs).collect()]
    assert len(near) == 6 and len({long, long + " end"} & set(near)) == 1
    mixed = Counter(r["text"] for r in corpus_pipeline.mixing.mixed_documents(
        docs, weights=(1,), share=1.0, most=1.0).collect())
    assert mixed == Counter(r[1] for r in rows)
