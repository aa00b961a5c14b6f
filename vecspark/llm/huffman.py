"""Canonical length-limited Huffman codes of token ids, in NumPy.

``code_lengths`` is the package-merge algorithm; ``Code`` encodes an id
array into a bit string with a bit offset at every ``STEP`` ids, and decodes
from those offsets, all of them side by side, by one table look-up an id.
"""

from __future__ import annotations

import numpy as np

STEP = 256
LIMIT = 16
_MOST = 24  # bits a look-up can hold


def limit_for(symbols: int) -> int:
    """Longest code word allowed: ``LIMIT`` bits, more only for very many symbols."""
    return max(LIMIT, int(np.ceil(np.log2(max(2, symbols)))) + 1) if symbols > 1 << (LIMIT - 1) else LIMIT


def code_lengths(counts: np.ndarray, limit: int) -> np.ndarray:
    """Lengths of an optimal prefix code of at most ``limit`` bits; zero counts get none."""
    used = np.flatnonzero(counts)
    out = np.zeros(len(counts), dtype=np.uint8)
    if len(used) == 0:
        return out
    if len(used) == 1:
        out[used] = 1
        return out
    if len(used) > 1 << limit:
        raise ValueError(f"{len(used)} symbols need more than {limit} bits")
    used = used[np.argsort(counts[used], kind="stable")]
    weights = counts[used].astype(np.float64)
    single = [np.ones(len(weights), dtype=bool)]  # per level: which of the merged list are symbols
    packages = weights
    for _ in range(limit - 1):
        pairs = packages[:len(packages) // 2 * 2].reshape(-1, 2).sum(1)
        merged = np.concatenate((weights, pairs))
        order = np.argsort(merged, kind="stable")
        single.append(order < len(weights))
        packages = merged[order]
    lengths, take = np.zeros(len(weights), dtype=np.uint8), 2 * len(weights) - 2
    for level in reversed(single):
        symbols = int(level[:take].sum())
        lengths[:symbols] += 1
        take = 2 * (take - symbols)
    out[used] = lengths
    return out


class Code:
    """The canonical code of given lengths: words ascend by (length, id)."""

    def __init__(self, lengths: np.ndarray):
        self.lengths = lengths.astype(np.int64)
        used = np.flatnonzero(lengths)
        used = used[np.lexsort((used, lengths[used]))]
        self.bits = max(1, int(lengths.max(initial=0)))
        if self.bits > _MOST:
            raise ValueError(f"code words of {self.bits} bits")
        # A word's place in the table of all ``bits``-bit strings is the sum of the shares before it.
        share = 1 << (self.bits - self.lengths[used])
        first = np.cumsum(share) - share
        self.words = np.zeros(len(lengths), dtype=np.uint64)
        self.words[used] = first >> (self.bits - self.lengths[used])
        self.symbol = np.repeat(used, share).astype(np.uint32)
        self.length = np.repeat(self.lengths[used], share)
        gap = (1 << self.bits) - len(self.symbol)  # only with one symbol
        self.symbol, self.length = np.pad(self.symbol, (0, gap)), np.pad(self.length, (0, gap), constant_values=1)

    def encode(self, ids: np.ndarray) -> tuple[bytes, np.ndarray]:
        """Bit string and the bit offsets of every ``STEP``-th id."""
        size = self.lengths[ids]
        if (size == 0).any():
            raise ValueError("an id without a code word")
        end = np.cumsum(size)
        at = end - size
        cell, inside = at >> 5, (at & 31).astype(np.uint64)
        # Each word lies in at most two 32-bit cells; no two words share a bit, so sums are exact.
        wide = self.words[ids] << (np.uint64(64) - size.astype(np.uint64) - inside)
        cells = int(end[-1] >> 5) + 2 if len(ids) else 1
        sums = np.bincount(cell, (wide >> np.uint64(32)).astype(np.float64), cells)
        sums += np.bincount(cell + 1, (wide & np.uint64(0xFFFFFFFF)).astype(np.float64), cells)
        total = int(end[-1]) if len(ids) else 0
        return sums.astype(">u4").tobytes()[:(total + 7) // 8], at[::STEP].copy()

    def decode(self, payload: list[bytes], offsets: list[np.ndarray], counts: list[int]) -> list[np.ndarray]:
        """Ids of several blocks: all their checkpoints are lanes read in step."""
        base = np.cumsum([0, *(len(p) + 8 for p in payload)])
        data = np.frombuffer(b"".join(p + b"\0" * 8 for p in payload), dtype=np.uint8).astype(np.uint32)
        window = (data[:-3] << 24) | (data[1:-2] << 16) | (data[2:-1] << 8) | data[3:]
        at = np.concatenate([o + 8 * b for o, b in zip(offsets, base, strict=False)] or [np.zeros(0, np.int64)])
        lanes = [-(-n // STEP) for n in counts]
        out = np.zeros((len(at), STEP), dtype=np.uint32)
        ends = np.cumsum(lanes) - 1
        left = np.full(len(at), STEP)
        left[ends] = [n - (k - 1) * STEP for n, k in zip(counts, lanes, strict=True)]
        mask, shift = (1 << self.bits) - 1, 32 - self.bits
        last = len(window) - 1
        for t in range(STEP):
            value = (window[np.minimum(at >> 3, last)] >> (shift - (at & 7))) & mask
            out[:, t] = self.symbol[value]
            at = at + np.where(left > t, self.length[value], 0)
        flat, start, found = out.reshape(-1), 0, []
        for n, k in zip(counts, lanes, strict=True):
            found.append(flat[start * STEP:start * STEP + n])
            start += k
        return found
