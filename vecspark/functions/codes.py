"""Packed product codes and the lookup-table kernel.

A vector's ``m`` codes are stored as BINARY: two codes a byte (the lower
sub-space in the low half) where a codebook has at most 16 entries, a byte
each up to 256, two bytes (little-endian) beyond.

The asymmetric distance of a query to a stored vector is a sum of ``m``
entries of a table made once per (query, list).  Tables are laid out entry by
entry, all queries of a list side by side, so a stored row adds whole rows
of its entries and no vector is reconstructed; with two codes a byte one
table entry serves both.  Sums are single precision and only choose
candidates: whatever lies within their error bound of the k-th (or of the
radius) is scored in double precision from its reconstruction.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from vecspark.functions import kernels

_SUM_BYTES = 4 << 20  # sums of one step; small enough to stay in cache


def code_width(m: int, ks: int) -> int:
    """Bytes of a vector's packed codes."""
    return -(-m // 2) if ks <= 16 else m if ks <= 256 else 2 * m


def pack(codes: np.ndarray, ks: int) -> pa.Array:
    """(n, m) codes as a BINARY array."""
    n, m = codes.shape
    if ks <= 16:
        even = np.zeros((n, m + m % 2), dtype=np.uint8)
        even[:, :m] = codes
        data = even[:, ::2] | (even[:, 1::2] << 4)
    else:
        data = codes.astype("<u2" if ks > 256 else np.uint8).view(np.uint8).reshape(n, -1)
    ends = np.arange(n + 1, dtype=np.int32) * code_width(m, ks)
    return pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(data))])


def stored_words(col: pa.Array, m: int, ks: int) -> np.ndarray:
    """(n, words) of a BINARY column: bytes, or two-byte words beyond 256 entries."""
    n, width = len(col), code_width(m, ks)
    if col.null_count:
        raise ValueError("code column holds NULL")
    start = np.frombuffer(col.buffers()[1], dtype=np.int32)[col.offset:col.offset + n + 1]
    if n == 0:
        return np.zeros((0, width if ks <= 256 else m), dtype=np.uint8)
    data = np.frombuffer(col.buffers()[2], dtype=np.uint8)[start[0]:start[-1]]
    if len(data) != n * width:
        raise ValueError("stored codes do not fit the index's m and ks")
    return data.reshape(n, width) if ks <= 256 else data.view("<u2").reshape(n, m)


def unpack(words: np.ndarray, m: int, ks: int) -> np.ndarray:
    """(n, m) codes of stored words."""
    if ks > 16:
        return words.astype(np.int64)
    return np.stack((words & 15, words >> 4), 2).reshape(len(words), -1)[:, :m].astype(np.int64)


def code_array(col: Column | str, m: int, ks: int) -> Column:
    """Packed codes as ARRAY<INT>, by Spark functions."""
    c = F.col(col) if isinstance(col, str) else col

    def byte(at):
        return F.conv(F.hex(F.substring(c, at + 1, F.lit(1))), 16, 10).cast("int")

    def one(j):
        if ks <= 16:
            return F.when(j % 2 == 0, byte(F.floor(j / 2).cast("int")).bitwiseAND(F.lit(15))).otherwise(
                F.floor(byte(F.floor(j / 2).cast("int")) / 16).cast("int"))
        return byte(j) if ks <= 256 else byte(2 * j) + 256 * byte(2 * j + 1)

    return F.transform(F.sequence(F.lit(0), F.lit(m - 1)), one)


def tables(q: np.ndarray, centroid: np.ndarray, books: np.ndarray, metric: str) -> list[np.ndarray]:
    """One table a sub-space, (entries, queries) in double precision, whose entries add up to the distance
    (of which the largest is taken for linf)."""
    m, ks, dsub = books.shape
    out = []
    for j in range(m):
        part = slice(j * dsub, (j + 1) * dsub)
        if metric == "ip":
            out.append((books[j] + centroid[part]) @ q[:, part].T)
            continue
        r = q[:, part] - centroid[part]
        if metric == "l2":
            out.append((books[j] ** 2).sum(1)[:, None] - 2 * (books[j] @ r.T) + (r**2).sum(1)[None, :])
        else:
            gap = np.abs(books[j][:, None, :] - r[None])
            out.append(gap.sum(2) if metric == "l1" else gap.max(2))
    return out


def _by_word(parts: list[np.ndarray], ks: int, metric: str) -> list[np.ndarray]:
    """Tables by stored word: of each two sub-spaces that share a byte, one of 256 entries."""
    if ks > 16:
        return [p.astype(np.float32) for p in parts]
    out = []
    for j in range(0, len(parts), 2):
        low = np.zeros((16, parts[j].shape[1]))
        low[:ks] = parts[j]
        high = np.zeros_like(low)
        if j + 1 < len(parts):
            high[:ks] = parts[j + 1]
        both = np.maximum(low[None], high[:, None]) if metric == "linf" else low[None] + high[:, None]
        out.append(both.reshape(256, -1).astype(np.float32))
    return out


def search_codes(q: np.ndarray, words: np.ndarray, ids: np.ndarray, centroid: np.ndarray, books: np.ndarray, metric: str,
                 k: int | None = None, radius: float | None = None):
    """As ``kernels.search_block`` for stored codes of one list: ``(query row, item row, distance)``."""
    m, ks, _ = books.shape
    n, larger = len(words), kernels.larger_is_nearer(metric)
    asked = np.flatnonzero(np.isfinite(q).all(axis=1))
    if not len(asked) or not n or (k is not None and k <= 0):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    step = max(16, _SUM_BYTES // (4 * n))
    found = []
    for at in range(0, len(asked), step):
        rows = asked[at:at + step]
        qc = q[rows]
        parts = tables(qc, centroid, books, metric)
        most = sum(np.abs(p).max(0) for p in parts)
        # What the entries lose by their rounding, and the subtraction that made them.
        error = 4e-7 * (m + 2) * most + 1e-12 * ((qc**2).sum(1) + (centroid**2).sum() + 1)
        by_word = _by_word(parts, ks, metric)
        total = by_word[0][words[:, 0]]
        for j in range(1, len(by_word)):
            if metric == "linf":
                np.maximum(total, by_word[j][words[:, j]], out=total)
            else:
                total += by_word[j][words[:, j]]
        total = np.ascontiguousarray(total.T)
        if larger:
            np.negative(total, out=total)
        if radius is not None:
            edge = (-radius if larger else radius) + error
        elif k >= n:
            edge = np.full(len(rows), np.inf)
        else:
            edge = np.partition(total, k - 1, axis=1)[:, k - 1] + 2 * error
        qi, vi = np.nonzero(total <= np.nextafter(edge.astype(np.float32), np.float32(np.inf))[:, None])
        exact = _scored(qc, qi, words, vi, centroid, books, metric)
        if radius is not None:
            hit = exact > radius if larger else exact < radius
            qi, vi, exact = qi[hit], vi[hit], exact[hit]
        qi, vi, exact = kernels.rank_pairs(qi, vi, exact, ids, k, larger)
        found.append((rows[qi], vi, exact))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def _scored(q, qi, words, vi, centroid, books, metric) -> np.ndarray:
    """Distances of chosen pairs to the reconstructions, a bounded number of pairs at a time."""
    m, ks, _ = books.shape
    step = max(1, kernels.PAIR_BYTES // (24 * q.shape[1]))
    out = np.zeros(len(qi))
    for a in range(0, len(qi), step):
        codes = unpack(words[vi[a:a + step]], m, ks)
        whole = books[np.arange(m)[None, :], codes].reshape(len(codes), -1) + centroid
        out[a:a + step] = kernels.pair_exact(q[qi[a:a + step]], whole, metric)
    return out
