import math
import zlib
from collections import Counter

from tallygrid.llm import language
from tallygrid.llm.queries import op3_language
from tests.llm.conftest import FOLDER


def test_held_out_documents_are_recognised(spark):
    out = op3_language(spark, "/root/testdata/sf0.01").collect()
    lang = {r["doc_id"]: r["lang"] for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    for r in out:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1)
        assert 0 <= r["score"] <= 1
    held = [r for r in out if r["held_out"]]
    assert sum(r["lang_pred"] == lang[r["doc_id"]] for r in held) >= 0.98 * len(held)


def test_one_row_each(spark, real_rows):
    assert sorted(r["doc_id"] for r in op3_language(spark, FOLDER).collect()) == sorted(r[0] for r in real_rows)


def test_predictions_ignore_labels_and_sources(spark, real_docs):
    from pyspark.sql import functions as F

    model = language.fit(real_docs)
    plain = language.predicted(real_docs, model).collect()
    other = language.predicted(
        real_docs.withColumn("lang", F.lit("xx")).withColumn("source", F.lit(None)), model).collect()
    assert plain == other


def test_unseen_words_fall_back_to_shorter_pieces(docs_of):
    model = language.fit(docs_of((1, "zzap zzap zzop", "aa", "s"), (2, "qqirk qqirk qqark", "bb", "s")))
    got = {r["doc_id"]: r["lang_pred"] for r in language.predicted(
        docs_of((1, "zzup", None, "s"), (2, "QQORK", None, "s"), (3, "i", None, "s")), model).collect()}
    assert got == {1: "aa", 2: "bb", 3: "bb"}


def test_odd_rows(odd, none):
    model = language.fit(odd)
    got = language.predicted(odd, model).collect()
    assert len(got) == odd.count()
    unknown = {r["doc_id"] for r in got if r["lang_pred"] == "und"}
    assert unknown == {1, 2, 3, 9}
    assert language.predicted(none, model).count() == 0
    kept = language.with_language(odd, model)
    assert kept.columns == odd.columns and kept.count() == odd.count() - 4


def test_nothing_learned(odd, none):
    model = language.fit(none)
    assert {r["lang_pred"] for r in language.predicted(odd, model).collect()} == {"und"}


def plainly(model_texts, text, longest=5):
    """Language and share of a text, by the definition: words, then n-grams, by counting."""
    langs = sorted(model_texts)
    counts = {"word": {x: Counter(w for t in model_texts[x] for w in language.words_of(t)) for x in langs}}
    counts["gram"] = {x: Counter() for x in langs}
    for x in langs:
        for w, n in counts["word"][x].items():
            for size in range(1, longest + 1):
                for i in range(len(w) + 2 - size + 1):
                    counts["gram"][x][(size, f"_{w}_"[i : i + size])] += n

    def score(kind, name, x):
        known = len(set().union(*counts[kind].values()))
        return math.log((counts[kind][x][name] + 0.05) / (sum(counts[kind][x].values()) + 0.05 * (known + 1)))

    total = dict.fromkeys(langs, 0.0)
    for w in language.words_of(text):
        names = [("word", w)] if any(w in counts["word"][x] for x in langs) else []
        for size in range(longest, 0, -1):
            if not names:
                grams = [(size, f"_{w}_"[i : i + size]) for i in range(len(w) + 2 - size + 1)]
                names = [("gram", g) for g in grams if any(g in counts["gram"][x] for x in langs)]
        for x in langs:
            total[x] += sum(score(kind, name, x) for kind, name in names) / max(1, len(names))
    best = max(langs, key=lambda x: total[x])
    return best, 1 / sum(math.exp(v - total[best]) for v in total.values())


def test_scores_against_brute_force(docs_of, real_rows):
    taught = {"aa": ["zzap zzap zzop zzil", "ever ywhere zz"], "bb": ["qqirk qqirk qqark zzil", "été à"], "cc": ["zzil o"]}
    for r in real_rows[:40]:
        if r[1] and r[2]:
            taught.setdefault(r[2], []).append(r[1][:400])
    model = language.fit(docs_of(*[(i, t, x, "s") for i, (x, t) in enumerate((x, t) for x in taught for t in taught[x])]))
    texts = ["zzap qqob zzub qqirk zzil", "ux uy uz qqark", "zzop zzap", "zzub ux zzub qqob qqirk", "ÉTÉ zz", "日本 о",
             *(r[1][:300] for r in real_rows[40:80] if r[1] and language.words_of(r[1][:300]))]
    for got, t in zip(model.predict(texts), texts, strict=True):
        lang, score = plainly(taught, t)
        assert got[0] == lang and abs(got[1] - score) < 1e-4
    assert model.predict([texts[3]]) == [model.predict(texts)[3]]
    assert model.predict([None, "", "12 #"]) == [("und", 0.0)] * 3


def test_few_texts_among_many_copies_are_all_learned_once(docs_of):
    few = ["zzap zzop", "zzil zzum", "zzek zzal"]
    rows = [(i, few[0] if i < 1500 else few[i % 3], "aa", "s") for i in range(1503)]
    rows += [(9000 + i, f"qqirk qq{chr(97 + i)}", "bb", "s") for i in range(20)]
    model = language.fit(docs_of(*rows), per_language=3)
    rows = model.rows_of([w for text in few for w in text.split()])
    assert min(rows) >= 0
    assert len({tuple(model.above[model.begins[r] : model.begins[r + 1]]) for r in rows}) == 1
    assert sum(model.rows_of([f"qq{chr(97 + i)}" for i in range(20)]) >= 0) == 3


def test_many_labels(docs_of):
    """More labels than texts are wanted for: each has one text at least."""
    docs = docs_of(*[(i, f"only{'abcdefghij'[i // 1000]}x{'abcdefghij'[i // 100 % 10]}{'abcdefghij'[i // 10 % 10]}{'abcdefghij'[i % 10]}",
                      f"l{i:04}", "s") for i in range(1500)])
    model = language.fit(docs, texts=100)
    assert len(model.languages) == 1500
    rows = docs.collect()
    got = model.predict([r["text"] for r in rows])
    assert [x for x, _ in got] == [r["lang"] for r in rows]


def test_all_words_are_in_the_model(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    model = language.fit(docs)
    words = {w for r in docs.collect() if r["lang"] and r["text"] for w in language.words_of(r["text"])}
    assert min(model.rows_of(sorted(words))) >= 0


def test_rows_without_an_id_are_not_held_out(spark, tmp_path):
    from pyspark.sql import functions as F

    spark.read.parquet(f"{FOLDER}/documents.parquet").limit(20).withColumn(
        "doc_id", F.lit(None).cast("long")).write.parquet(f"{tmp_path}/documents.parquet")
    assert {r["held_out"] for r in op3_language(spark, str(tmp_path)).collect()} == {False}
