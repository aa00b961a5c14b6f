"""Small tables that every operator must take without crashing."""

import random

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, spans string, row string, comp string"


def frame(spark, texts, langs=None, ids=None):
    """``documents``-like rows with extra columns whose names clash with the operators' own."""
    ids = range(len(texts)) if ids is None else ids
    langs = langs or [None] * len(texts)
    rows = [(i, t, lang, None, None if t is None else len(t), "x", "y", "z") for i, t, lang in zip(ids, texts, langs, strict=True)]
    return spark.createDataFrame(rows, SCHEMA)


def prose(seed, words=80, vocabulary=300):
    rng = random.Random(seed)
    voc = [f"w{i * 7919 % 10007:04d}" for i in range(vocabulary)]
    return " ".join(rng.choice(voc) for _ in range(words))


ODD = [None, "", " ", "\n\t ", "é", "日本語 текст", "a", "a a a a", "\x00\x01", "!?.", "x" * 50_000, "the same text twice", "the same text twice"]
