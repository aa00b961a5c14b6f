import random
import re

from llm.helpers import ODD, frame
from vecspark.llm import decontaminate as D

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(text, items, window=10):
    w = words(text)
    hit, found = set(), set()
    for label, t in items:
        iw = words(t)
        n = min(window, len(iw))
        grams = {tuple(iw[i:i + n]) for i in range(len(iw) - n + 1)} if n else set()
        for i in range(len(w) - n + 1 if n else 0):
            if tuple(w[i:i + n]) in grams:
                hit |= set(range(i, i + n))
                if label is not None:
                    found.add(str(label))
    return len(w), len(hit), sorted(found)


def data():
    rng = random.Random(2)
    voc = list("abcdefgh")
    items = [(i, " ".join(rng.choices(voc, k=rng.choice([1, 3, 5, 10, 11, 30])))) for i in range(12)]
    items = [x for x in items if len(words(x[1])) > 1] + [(90, None), (91, ""), (92, "..."), (None, "q r s t"), (93, "q r s t"), (93, "q r s t")]
    docs = list(ODD)
    for _ in range(150):
        parts = [" ".join(rng.choices(voc + ["zz"], k=rng.randint(0, 12))) for _ in range(3)]
        item = rng.choice(items)[1] or ""
        docs.append(parts[0] + " " + item.upper() + ", " + parts[1] + "\n" + item[:rng.randint(0, 30)] + parts[2])
    docs.append("Clean Text é " * 2000)
    return docs, items


def bench(spark, items):
    return spark.createDataFrame(items, "item_id bigint, text string")


def test_scan_equals_brute_force_with_any_block_size(spark):
    docs, items = data()
    for block in (1_000_000, 20):
        got = {r["row"]["doc_id"]: (r["n_words"], r["n_hit"], list(r["items"]))
               for r in D.scan(frame(spark, docs), bench(spark, items), block_words=block).collect()}
        assert got == {i: brute(t, items) for i, t in enumerate(docs)}


def test_automaton_against_substrings():
    rng = random.Random(4)
    for _ in range(100):
        items = [(i, [rng.randrange(3) for _ in range(rng.randint(1, 12))]) for i in range(4)]
        window = rng.randint(1, 5)
        a, text = D.SuffixAutomaton(items, window), [rng.randrange(3) for _ in range(40)]
        ranges, found = a.scan(text)
        hit, want = set(), set()
        for label, w in items:
            n = min(window, len(w))
            for i in range(len(text) - n + 1):
                if any(text[i:i + n] == w[j:j + n] for j in range(len(w) - n + 1)):
                    hit |= set(range(i, i + n))
                    want.add(label)
        assert {p for x, y in ranges for p in range(x, y)} == hit and found == want


def test_decontaminate_cuts_hit_spans_only(spark):
    docs, items = data()
    frame_ = frame(spark, docs)
    kept = {r["doc_id"]: r for r in D.decontaminate(frame_, bench(spark, items)).collect()}
    for i, t in enumerate(docs):
        n, n_hit, _ = brute(t, items)
        if n_hit == 0:
            assert kept[i]["text"] == t
        elif n_hit >= D.MAX_COVERAGE * n:
            assert i not in kept
        else:
            assert len(kept[i]["text"]) < len(t)
            assert kept[i]["n_chars"] == len(kept[i]["text"])
    assert D.decontaminate(frame_, bench(spark, items)).columns == frame_.columns


def test_empty_tables(spark):
    docs, items = data()
    assert D.scan(frame(spark, docs).limit(0), bench(spark, items)).count() == 0
    got = D.scan(frame(spark, docs), bench(spark, items).limit(0)).collect()
    assert len(got) == len(docs) and all(r["n_hit"] == 0 for r in got)


def test_blocks_with_hot_texts_and_odd_columns(spark, monkeypatch):
    """Beyond one broadcast: parts of a hot block, equal texts, items cut in segments, joins without broadcasts."""
    docs, items = data()
    docs = docs + [docs[20]] * 300
    items = items + [(i, "long item " + " ".join(f"u{j * (i % 3 + 1)}" for j in range(70))) for i in range(200, 206)]
    docs += [items[-1][1].upper(), "zz " + items[-2][1][40:] + " zz", items[-3][1][:60]]
    want = {i: brute(t, items) for i, t in enumerate(docs)}
    for small in (1 << 20, 0):
        monkeypatch.setattr(D, "PART_TEXT", 500)
        monkeypatch.setattr(D, "SMALL_ROWS", small)
        monkeypatch.setattr(D, "SMALL_BYTES", small)
        found = D.scan(frame(spark, docs), bench(spark, items), block_words=25)
        got = {r["row"]["doc_id"]: (r["n_words"], r["n_hit"], list(r["items"])) for r in found.collect()}
        assert got == want


def test_blocks_and_one_broadcast_cut_the_same_spans(spark):
    docs, items = data()
    one, many = ({r["row"]["doc_id"]: r["spans"] for r in D.scan(frame(spark, docs), bench(spark, items), block_words=n).collect()}
                 for n in (1_000_000, 15))
    assert one == many
