"""Words of whole texts as 64-bit fingerprints, in NumPy.

Texts are handled as UTF-8 bytes.  A word is a maximal run of word bytes
after lower-casing A-Z; as every byte of a non-ASCII character is a word
byte in both alphabets below, runs of bytes are the runs of code points of
the stated patterns.  Word fingerprints are polynomial hashes of the bytes
modulo two primes (a modulus of 2**64 would collide on Thue-Morse strings
for every base); equal words always have equal fingerprints.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np

U64 = np.uint64
PART_BYTES = 1 << 20  # bytes handled at once; a longer text is handled alone

_b = np.arange(256)
LOWER = np.where((_b >= 65) & (_b <= 90), _b + 32, _b).astype(np.uint8)
#: ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]`` after lower-casing: digits, letters, non-ASCII.
ALNUM = ((_b >= 48) & (_b <= 57)) | ((_b >= 97) & (_b <= 122)) | (_b >= 128)
#: ``[^\x20\x09-\x0D]``: everything but white space.
NONSPACE = ~((_b == 32) | ((_b >= 9) & (_b <= 13)))

# Two primes below 2**31, so that products fit 64 bits; a fixed base for each.
_PRIMES = (2**31 - 1, 2**31 - 19)
_BASES = (1_431_655_781, 1_812_433_253 % (2**31 - 19))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = x.astype(U64, copy=True)
    with np.errstate(over="ignore"):
        x ^= x >> U64(30)
        x *= U64(0xBF58476D1CE4E5B9)
        x ^= x >> U64(27)
        x *= U64(0x94D049BB133111EB)
        x ^= x >> U64(31)
    return x


def _powers(base: int, prime: int, n: int) -> np.ndarray:
    """``base ** 0 ... base ** (n - 1)`` modulo ``prime``, by doubling."""
    out = np.ones(n, dtype=U64)
    done = 1
    while done < n:
        step = min(done, n - done)
        out[done:done + step] = out[:step] * U64(pow(base, done, prime)) % U64(prime)
        done += step
    return out


@lru_cache(maxsize=4)
def _cached(base: int, prime: int) -> np.ndarray:
    return _powers(base, prime, PART_BYTES + 4096)


def powers(which: int, n: int, inverse: bool = False) -> np.ndarray:
    """Powers of one of the bases, or of its inverse, modulo its prime."""
    prime, base = _PRIMES[which], _BASES[which]
    base = pow(base, -1, prime) if inverse else base
    kept = _cached(base, prime)
    return kept[:n] if n <= len(kept) else _powers(base, prime, n)


def prefix_sums(data: np.ndarray) -> list[np.ndarray]:
    """Per prime ``s`` with ``s[j] - s[i]`` the unshifted polynomial hash of ``data[i:j]``, up to multiples of the prime."""
    out, codes = [], data.astype(U64) + U64(1)
    for i, prime in enumerate(_PRIMES):
        terms = codes * powers(i, len(data))  # below 2**40
        if len(data) > 1 << 22:  # up to there, sums of unreduced terms stay below 2**62
            terms %= U64(prime)
        s = np.zeros(len(data) + 1, dtype=U64)
        np.cumsum(terms, out=s[1:])
        out.append(s)
    return out


def range_hash(sums: list[np.ndarray], start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Fingerprints of the byte ranges, equal for equal contents anywhere: 62 bits of two prime residues, and the length."""
    both = None
    for i, (s, prime) in enumerate(zip(sums, _PRIMES, strict=True)):
        own = (s[end] - s[start]) % U64(prime) * powers(i, len(s), inverse=True)[start] % U64(prime)
        both = own if both is None else (both << U64(31)) | own
    with np.errstate(over="ignore"):
        return mix(both + (end - start).astype(U64) * U64(0x9E3779B97F4A7C15))


class Words:
    """Words of consecutive texts: ``hash``, byte ``start`` and ``end`` in
    ``data``, and ``first[i]:first[i + 1]`` the words of text ``i``."""

    def __init__(self, texts: list[bytes], alphabet: np.ndarray):
        raw = np.frombuffer(b"\n".join(texts) + b"\n", dtype=np.uint8)
        self.data = LOWER[raw]
        inside = np.zeros(len(raw) + 2, dtype=np.int8)
        inside[1:-1] = alphabet[self.data]
        edge = np.diff(inside)
        self.start = np.flatnonzero(edge == 1)
        self.end = np.flatnonzero(edge == -1)
        self.hash = range_hash(prefix_sums(self.data), self.start, self.end)
        lengths = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
        self.text_start = np.concatenate(([0], np.cumsum(lengths + 1)))
        self.first = np.searchsorted(self.start, self.text_start)

    def text(self, i: int) -> slice:
        return slice(self.first[i], self.first[i + 1])


def shingle_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Fingerprints of each ``k`` consecutive words; of the whole sequence
    if there are fewer words; empty without words."""
    n = len(words)
    if n == 0:
        return words
    size = min(n, k)
    out = np.zeros(n - size + 1, dtype=U64)
    with np.errstate(over="ignore"):
        for j in range(size):
            out = (out + words[j:n - size + 1 + j]) * U64(0xF1357AEA2E62A9C5) + U64(j + 1)
    return mix(out + U64(size))
