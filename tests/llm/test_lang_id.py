import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from llm.helpers import ODD, frame
from vecspark.llm import lang_id as L

SYLLABLES = {"aa": "ka to mi re no su", "bb": "sch ein ung ver ach ä", "cc": "eau ou ç qui é re", "dd": "ción ado ll ñ que os"}


def text(lang, seed, words=40):
    rng = random.Random(f"{lang}{seed}")
    parts = SYLLABLES[lang].split()
    return " ".join("".join(rng.choices(parts, k=rng.randint(1, 4))) for _ in range(words))


def labelled(spark, n=60, languages=tuple(SYLLABLES)):
    rows = [(text(lang, i), lang) for i in range(n) for lang in languages]
    return frame(spark, [t for t, _ in rows], [x for _, x in rows])


@pytest.mark.parametrize("n", [2, 3, 4, 6, 12, 40])
def test_codewords_differ_in_several_bits(n):
    book = L.code_book(n)
    gap = (book[:, None] != book[None]).sum(2) + np.eye(n, dtype=int) * 99
    assert gap.min() >= (1 if n == 2 else 2 if n == 3 else 4)


def test_held_out_accuracy_and_edge_rows(spark):
    model = L.train(labelled(spark))
    tests = [(text(lang, 1000 + i, 8), lang) for i in range(30) for lang in SYLLABLES]
    docs = frame(spark, [t for t, _ in tests] + ODD, [None] * (len(tests) + len(ODD)))
    got = {r["doc_id"]: r for r in L.identify(docs, model).collect()}
    right = sum(got[i]["lang_pred"] == lang for i, (_, lang) in enumerate(tests))
    assert right >= 0.98 * len(tests)
    for i, t in enumerate(ODD, len(tests)):
        letters = any(c.isalpha() for c in t or "")
        assert (got[i]["lang_pred"] != "und") == letters and 0 <= got[i]["lang_score"] <= 1
        if not letters:
            assert got[i]["lang_score"] == 0 and got[i]["lang_ambiguous"]


def test_predictions_do_not_depend_on_other_columns_or_rows(spark):
    model = L.train(labelled(spark))
    t = text("bb", 7)
    a = L.identify(frame(spark, [t], ["aa"], ids=[5]), model).first()
    b = L.identify(frame(spark, [t, "x"], ["cc", None], ids=[9, 1]), model).where("doc_id = 9").first()
    assert (a["lang_pred"], a["lang_score"]) == (b["lang_pred"], b["lang_score"])


def test_the_sample_is_bounded(spark):
    rows, per_language = L._sample(labelled(spark, 200).select("text", "lang"), 80)
    assert per_language == 20 and rows.count() <= 2.5 * 80


def test_one_language_none_and_empty(spark):
    docs = frame(spark, ["abc", "1", None])
    one = L.identify(docs, L.train(labelled(spark, 5, ("aa",)))).orderBy("doc_id").collect()
    assert [(r["lang_pred"], r["lang_score"]) for r in one] == [("aa", 1.0), ("und", 0.0), ("und", 0.0)]
    none = L.identify(docs, L.train(docs)).collect()
    assert {r["lang_pred"] for r in none} == {"und"}
    assert L.identify(docs.limit(0), L.train(docs.limit(0))).count() == 0


def test_clashing_names_are_refused_and_held_out_is_by_crc32(spark):
    docs = frame(spark, ["abc"]).withColumn("lang_pred", F.lit(1))
    with pytest.raises(ValueError):
        L.identify(docs, L.train(labelled(spark, 5)))
    import zlib
    got = {r[0]: r[1] for r in spark.range(200).select("id", L.held_out(F.col("id"))).collect()}
    assert got == {i: zlib.crc32(str(i).encode()) % 4 == 2 for i in range(200)}


def test_a_text_of_very_many_rows_neither_hides_languages_nor_crowds_the_driver(spark):
    df = spark.range(20_000).select(F.col("id").alias("doc_id"), F.lit("la casa es grande y la puerta es pequeña").alias("text"),
                                    F.when(F.col("id") % 2 == 0, "es").otherwise("en").alias("lang"))
    assert L.train(df, sample_rows=40).languages == ["en", "es"]
    for lang in ("es", "en"):
        drawn, _ = L._sample(df.where(F.col("lang") == lang), 40)
        assert drawn.count() == 1


def test_no_more_than_the_wanted_rows_reach_the_driver(spark, monkeypatch):
    """Of each language its first rows by the hash, in six bytes a feature; the model is the one of those rows."""
    docs = labelled(spark, 200)
    drawn, wanted = L._sample(docs.select("text", "lang"), 80)
    first = L._first(drawn, wanted).collect()
    by = {lang: sorted(r["__point"] for r in drawn.collect() if r["lang"] == lang)[:wanted] for lang in SYLLABLES}
    assert {lang: sorted(r["__point"] for r in first if r["lang"] == lang) for lang in SYLLABLES} == by
    sent, frame_type = [], type(docs)
    to_arrow = frame_type.toArrow
    monkeypatch.setattr(frame_type, "toArrow", lambda self: sent.append(to_arrow(self)) or sent[-1])
    L.train(docs, sample_rows=80)
    assert [t.num_rows for t in sent] == [4 * wanted]
    slots, values = (sum(map(len, sent[0].column(c).to_pylist())) for c in ("slots", "values"))
    assert 2 * slots == values
