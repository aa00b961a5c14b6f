import random

import numpy as np

from vecspark.llm.words import NONSPACE, Words, prefix_sums, range_hash, shingle_hashes


def thue_morse(n):
    s = "a"
    while len(s) < n:
        s += s.translate(str.maketrans("ab", "ba"))
    return s


def test_thue_morse_strings_have_different_fingerprints():
    s = thue_morse(4096)
    t = s.translate(str.maketrans("ab", "ba"))
    words = Words([f"{s} {t} {s}".encode()], NONSPACE).hash
    assert words[0] == words[2] != words[1]
    assert len({int(x) for n in (64, 256, 1024, 2048) for x in Words([f"{s[:n]} {t[:n]}".encode()], NONSPACE).hash}) == 8


def test_fingerprints_are_equal_for_equal_bytes_only():
    rng = random.Random(5)
    data = bytes(rng.choice(b"ab") for _ in range(600))
    s = prefix_sums(np.frombuffer(data, dtype=np.uint8))
    for width in (1, 7, 11):
        at = np.arange(len(data) - width + 1)
        seen = {}
        for i, h in zip(at.tolist(), range_hash(s, at, at + width).tolist(), strict=True):
            assert seen.setdefault(data[i:i + width], h) == h
        assert len(set(seen.values())) == len(seen)


def test_a_text_longer_than_a_part_has_the_fingerprints_of_short_ones():
    long = ("word " * 300_000 + "last word").encode()
    found = Words([long], NONSPACE).hash
    assert len(set(found.tolist())) == 2 and found[0] == Words([b"word"], NONSPACE).hash[0] == found[-1]
    assert len(set(shingle_hashes(found, 5).tolist())) == 3
