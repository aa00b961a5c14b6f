import corpus_pipeline as C
from llm.helpers import frame
from llm.test_decontaminate import brute as leaks
from llm.test_minhash import brute as groups, edited
from llm.test_secrets import brute as secrets
from vecspark.llm.common import stored

from test_oracle import SF

import duckdb


def test_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("doc_id < 300")
    columns = docs.columns
    tables = {}
    for name, stage in C.STAGES:
        tables[name + ":in"] = {r["doc_id"]: r for r in docs.collect()}
        docs = stored(stage(spark, docs, SF), name)
        if name != "packing":
            assert docs.columns == columns
            tables[name] = {r["doc_id"]: r for r in docs.collect()}
    first = tables["language:in"]
    assert tables["language"].keys() == {i for i, r in first.items() if any(c.isalpha() for c in r["text"])}
    before = tables["near_duplicates:in"]
    ids = list(before)
    want = groups(ids, [before[i]["text"] for i in ids], 5, 80)
    assert tables["near_duplicates"].keys() == {i for i in ids if want[i][2]}
    items = duckdb.sql(f"select item_id, text from '{SF}/benchmark.parquet'").fetchall()
    for i, r in tables["benchmark_decontamination:in"].items():
        n, n_hit, _ = leaks(r["text"], items)
        after = tables["benchmark_decontamination"].get(i)
        if n_hit == 0:
            assert after == r
        else:
            assert after is None or leaks(after["text"], items)[1] < n_hit
    for i, r in tables["secret_scan:in"].items():
        after = tables["secret_scan"][i]
        assert (after == r) == (secrets(r["text"])[4] == "")
    assert {r["doc_id"] for r in docs.collect()} == tables["secret_scan"].keys()


def test_empty_and_odd_documents(spark):
    base = "some words about a thing that is written here twice over and again " * 3
    texts = [None, "", "12 34", base, base, edited(base, 1, 1), "password = hunter2hunter2 in a text with letters"]
    for docs in (frame(spark, texts, ["en"] * len(texts)), frame(spark, texts).limit(0)):
        for _, stage in C.STAGES:
            docs = stored(stage(spark, docs, SF), "stage")
        assert "sequence_id" in docs.columns
        docs.count()
