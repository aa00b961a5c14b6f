import random
import re

from llm.helpers import ODD, frame
from vecspark.llm import licenses as L
from vecspark.llm.words import ALNUM, Words

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute(text):
    words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    joined = " " + "".join(w + " " for w in words)
    places, base = [], set()
    for phrase, label in L.PHRASES.items():
        p = phrase.split()
        for i in range(len(words) - len(p) + 1):
            if words[i:i + len(p)] == p:
                places.append(i)
                base.add(label)
    method = {label for label, t in L.TEMPLATES.items() if re.search(L._regex(t), joined)}
    return (len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(base)),
            ",".join(sorted(base | method)), 1.0 if method else 0.5 if places else 0.0)


def variants():
    rng = random.Random(1)
    voc = sorted({w for t in L.TEMPLATES.values() for w in re.findall("[a-z0-9]+", t)})
    for _ in range(600):
        out, skip = [], 0
        for part in L._PARTS.findall(rng.choice(list(L.TEMPLATES.values()))):
            if part == "[[":
                skip += skip or rng.random() < 0.5
            elif part == "]]":
                skip = max(0, skip - 1)
            elif not skip and part[0] == "{":
                out += [rng.choice(voc) for _ in range(rng.randint(0, int(part[2:-2]) + (rng.random() < 0.2)))]
            elif not skip:
                out.append(part.upper() if rng.random() < 0.2 else part)
        if rng.random() < 0.5:
            out[rng.randrange(len(out))] = rng.choice(voc)
        yield rng.choice([" ", ", ", "\n"]).join(["some", *out, "more"])


def test_scan_equals_brute_force(spark):
    rows = [*ODD, *variants(), "MIT License and the MIT license; CC BY, GNU General\nPublic License", "été mit license"]
    got = {r["doc_id"]: tuple(r)[1:] for r in L.scan(frame(spark, rows)).collect()}
    assert got == {i: brute(t) for i, t in enumerate(rows)}


def test_mandatory_words_are_exact():
    own = L.Scanner()

    def labels(t):
        return own.scan(Words([t.encode()], ALNUM), 1)[0][5].split(",")

    assert "gpl-3.0-notice" in labels("licensed under the terms of the GNU General Public License, version 3")
    assert "gpl-3.0-notice" not in labels("licensed under the GNU General Private License, version 3")
    assert "mit-notice" not in labels("released under the")
    assert labels("released under the") == [""]


def test_matches_do_not_cross_texts(spark):
    got = L.scan(frame(spark, ["released under the", "mit license"])).orderBy("doc_id").collect()
    assert [(r["n_base"], r["labels"]) for r in got] == [(0, ""), (1, "mit")]


def test_empty_table(spark):
    assert L.scan(frame(spark, ["x"]).limit(0)).count() == 0
