"""Jaccard join of word shingle sets by parity sketches; every link is found.

With ``d = (100 - percent) / (100 + percent)``, two sets of the similarity
differ in at most ``d * (n_a + n_b)`` shingles.

1. Sketches.  Each shingle flips one bit of a bit sketch (XOR-hashing).  A
   shingle in both sets leaves no trace in the XOR of their sketches, so the
   Hamming distance never exceeds the symmetric difference.
2. Size bands.  Sizes are cut into bands ``[lo, hi]``.  A set joins in its own
   band and as the smaller partner in those above whose least member it may
   reach.  In a band at most ``D = d * 2 hi`` shingles differ.
3. Pigeonhole.  The sketch is cut into ``S > D`` segments.  Every differing
   shingle falls into one segment, so at least ``S - D`` are equal in both
   sets; of a set with ``k`` segments that hold something, at least ``k - D``
   are equal and not empty.  A segment's key is the XOR of the whole hashes of
   its shingles, a finer parity than its bits.  ``S`` is chosen so that
   ``k > D`` but for odd cases; where ``k <= D``, all empty segments of the
   band count as one more key.  Keys that occur once go before any row is
   dealt by key.  For that, tasks send sorted prefixes of ``PREFIX_BITS`` bits
   by key range, packed in four bytes each; a bit array of at most
   ``2 ** MARK_BITS`` bits (64 MB) marks the places of those that occur twice
   or more, and what else falls on a marked place is one more bucket of one.
4. Buckets.  Sets of equal content are one class.  Classes sharing a key meet a
   hub of their bucket; the Hamming distance drops most pairs, the others are
   verified on the whole sets, and links join components.  What is left are
   pairs of different components:
   - in buckets of at most ``BUCKET`` classes they are paired directly, where
     they share as many keys there as the pigeonhole leaves: of ``k``, less
     ``D`` and less those in larger buckets, of either class;
   - larger buckets are needed only by classes that have too many keys in
     such (``k`` less those at most ``D``): any other class meets each partner in
     a small bucket.  Classes that need them form families over common large
     buckets.  All classes of a family meet about ``HELD`` of it first, which
     joins nearly all that belong together; then the classes outside its main
     component are dealt to blocks, and the whole family streams past each
     block.  A task holds one block, verifies what passes the Hamming bound,
     and emits only links that join components.
5. Components of the verified links by rounds over stored tables.

Defined results: null and wordless texts have size 0 and link with nothing;
texts are read whole, whatever their length; rows repeating a doc_id count each
with its own text, and each is returned; a null doc_id never names a component
unless all of its rows are null; an empty table gives an empty result; extra
columns are ignored.  Shingles are 64-bit fingerprints.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vecspark.llm.common import parts_of, stored, texts_of
from vecspark.llm.minhash import components
from vecspark.llm.words import NONSPACE, PART_BYTES, U64, Words, mix, shingle_hashes

BUCKET = 64
HUBS = 4
BLOCK = 512
REP_BROADCAST = 1 << 21  # ids: 32 MB of numbers
PREFIX_BITS, RANGE_BITS = 44, 12  # what is sent of a key, and how much of that its key range says
KEYS_HELD = 1 << 20  # keys that a task sorts at once
HELD = 128
SLICE = 20_000
MARK_BITS = 29
_GROWTH = 1.4
_HUB_SALTS = [0x2A5F3C19, 0x15E0D4B7, 0x3B19A6E2, 0x0C7725D8][:HUBS]


@lru_cache(maxsize=8)
def size_bands(percent: int, most: int = 1 << 33) -> tuple[tuple[int, int, int, int, int], ...]:
    """``(lo, hi, D, S, log2 of the places that the segments cut)`` of each band."""
    out, lo = [], 1
    while lo < most:
        hi = int(lo * _GROWTH)
        differ = 2 * hi * (100 - percent) // (100 + percent)
        bits = max(10, (4 * hi - 1).bit_length())
        out.append((lo, hi, differ, differ + 3 * differ // 20 + 3, bits))
        lo = hi + 1
    return tuple(out)


def bands_of(n: int, percent: int) -> list[int]:
    """The set's own band, and those it joins as the smaller partner; none where only equal sets can link."""
    bands = size_bands(percent)
    own = next(i for i, b in enumerate(bands) if n <= b[1])
    found = [own]
    while own + 1 < len(bands) and 100 * n >= percent * bands[own + 1][0]:
        own += 1
        found.append(own)
    return [i for i in found if bands[i][2] > 0]


def segment_keys(shingles: np.ndarray, band: int, percent: int) -> np.ndarray:
    """Keys of the segments of a band's sketch that hold something; the low byte is the band."""
    _, _, differ, segments, bits = size_bands(percent)[band]
    place = (shingles & U64((1 << bits) - 1)) * U64(segments) >> U64(bits)
    order = np.argsort(place, kind="stable")
    place, values = place[order], mix(shingles[order] ^ U64(0x7F4A7C159E3779B9))
    new = np.flatnonzero(np.concatenate(([True], place[1:] != place[:-1])))
    parity, place = np.bitwise_xor.reduceat(values, new), place[new]
    with np.errstate(over="ignore"):
        keys = mix(parity ^ mix(place + U64(band << 40)))
        if len(keys) <= differ:
            keys = np.append(keys, mix(np.full(1, band << 40, dtype=U64)))
    return (keys & ~U64(255)) | U64(band)


def parity_sketch(shingles: np.ndarray, percent: int) -> bytes:
    """The bit sketch of the set's own band: at least six bits for each of ``D``, where the band has as many places."""
    differ, places = next((b[2], b[4]) for b in size_bands(percent) if len(shingles) <= b[1])
    bits = min(places, max(8, (6 * differ - 1).bit_length()))
    flips = np.bincount((shingles & U64((1 << bits) - 1)).astype(np.int64), minlength=1 << bits) & 1
    return np.packbits(flips.astype(np.uint8), bitorder="little").tobytes()


def folded(sketch: np.ndarray, size: int) -> np.ndarray:
    """The sketch with as many bits as a shorter one: a place is the hash modulo the length, a power of two."""
    while len(sketch) > size:
        half = len(sketch) // 2
        sketch = sketch[:half] ^ sketch[half:]
    return sketch


def hamming(a: bytes, b: bytes) -> int:
    x, y = np.frombuffer(a, dtype=np.uint64), np.frombuffer(b, dtype=np.uint64)
    size = min(len(x), len(y))
    return int(np.bitwise_count(folded(x, size) ^ folded(y, size)).sum())


def _set_class(shingles: np.ndarray) -> bytes:
    """128-bit fingerprint of a set of sorted distinct shingles."""
    with np.errstate(over="ignore"):
        a = mix(shingles + U64(23)).sum(dtype=U64) + U64(len(shingles))
        b = mix(shingles ^ U64(0x3C3C5A5A99F00F66)).sum(dtype=U64)
    return int(a).to_bytes(8, "big") + int(b).to_bytes(8, "big")


def _sets(texts: list[bytes], shingle: int):
    """Sorted distinct shingle fingerprints of each text."""
    for a, b in parts_of(texts, PART_BYTES):
        w = Words(texts[a:b], NONSPACE)
        for i in range(b - a):
            yield np.unique(shingle_hashes(w.hash[w.text(i)], shingle))


def _sketched(rows: DataFrame, shingle: int, percent: int) -> DataFrame:
    """``doc_id, n, cls, keys, filled, sketch`` of ``doc_id, text`` rows; empty sets have a null class.

    ``filled`` holds ``256 * k + band`` for each band's number ``k`` of keys.
    """

    def run(batches):
        for batch in batches:
            held, at, size = [], 0, 0
            for own in _sets(texts_of(batch.column("text")), shingle):
                bands = bands_of(len(own), percent) if len(own) else []
                parts = [segment_keys(own, j, percent) for j in bands]
                held.append((len(own), _set_class(own) if len(own) else None,
                             np.concatenate(parts).view(np.int64) if parts else np.zeros(0, dtype=np.int64),
                             np.array([256 * len(p) + j for p, j in zip(parts, bands, strict=True)], dtype=np.int64),
                             parity_sketch(own, percent) if parts else None))
                size += len(held[-1][2])
                if size > 1 << 20:
                    yield _sketch_batch(batch.column("doc_id").slice(at, len(held)), held)
                    at, held, size = at + len(held), [], 0
            yield _sketch_batch(batch.column("doc_id").slice(at, len(held)), held)

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, n bigint, cls binary, keys array<bigint>, filled array<bigint>, sketch binary")


def _sketch_batch(ids, held) -> pa.RecordBatch:
    sizes, classes, keys, filled, sketches = zip(*held, strict=True) if held else ((),) * 5
    return pa.RecordBatch.from_arrays([ids, pa.array(sizes, pa.int64()), pa.array(classes, pa.binary()), _lists(keys), _lists(filled),
                                       pa.array(sketches, pa.binary())], names=["doc_id", "n", "cls", "keys", "filled", "sketch"])


def _lists(arrays) -> pa.ListArray:
    ends = np.concatenate(([0], np.cumsum([len(x) for x in arrays], dtype=np.int64)))
    flat = np.concatenate(arrays) if len(arrays) else np.zeros(0, dtype=np.int64)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))


def _class_sets(docs: DataFrame, wanted: DataFrame, shingle: int) -> DataFrame:
    """``id, shingles`` of the classes ``id, cls, rep`` from the texts of their smallest documents."""

    def run(batches):
        for batch in batches:
            found = list(_sets(texts_of(batch.column("text")), shingle))
            yield pa.RecordBatch.from_arrays(
                [pa.array([_set_class(x) if len(x) else None for x in found], pa.binary()),
                 pa.array([x.view(np.int64) for x in found], pa.list_(pa.int64()))], names=["cls", "shingles"])

    wanted = stored(wanted.select("id", "cls", "rep"), "wanted")
    reps = wanted.select("rep").distinct()
    if wanted.count() <= REP_BROADCAST:  # the texts stay where they are
        reps = F.broadcast(reps)
    texts = docs.join(reps, F.col("doc_id").eqNullSafe(F.col("rep")), "left_semi")
    # Rows repeating a doc_id with another text are other classes, wanted or not; copies among them are one.
    sets = texts.select("text").mapInArrow(run, "cls binary, shingles array<bigint>").dropDuplicates(["cls"])
    return sets.join(wanted.select("id", "cls"), "cls").select("id", "shingles")


def _near(pairs: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """Pairs ``a, b`` whose sizes and Hamming distance allow the similarity."""

    def run(batches):
        for batch in batches:
            n = batch.column("na").to_numpy() + batch.column("nb").to_numpy()
            most = n * (100 - percent) // (100 + percent)
            left, right = batch.column("sa"), batch.column("sb")
            kept = [i for i in range(batch.num_rows) if hamming(left[i].as_py(), right[i].as_py()) <= most[i]]
            yield pa.RecordBatch.from_arrays([batch.column(c).take(pa.array(kept, pa.int64())) for c in ("a", "b")], names=["a", "b"])

    left = sketches.select(F.col("id").alias("a"), F.col("n").alias("na"), F.col("sketch").alias("sa"))
    right = sketches.select(F.col("id").alias("b"), F.col("n").alias("nb"), F.col("sketch").alias("sb"))
    sized = pairs.join(left, "a").join(right, "b").where(100 * F.least("na", "nb") >= percent * F.greatest("na", "nb"))
    return sized.mapInArrow(run, "a bigint, b bigint")


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs ``a, b`` whose whole sets reach the similarity."""
    left = sets.select(F.col("id").alias("a"), F.col("shingles").alias("sa"))
    right = sets.select(F.col("id").alias("b"), F.col("shingles").alias("sb"))
    both = F.size(F.array_intersect("sa", "sb"))
    union = F.size("sa") + F.size("sb") - both
    return pairs.join(left, "a").join(right, "b").where(100 * both >= percent * union).select("a", "b")


def _compared(rows: DataFrame, comp: DataFrame) -> DataFrame:
    """``rows`` with the component of their ``id``."""
    known = comp.select(F.col("node").alias("id"), "comp")
    return rows.join(known, "id", "left").withColumn("comp", F.coalesce("comp", "id"))


def _least_shared(sketches: DataFrame, state: DataFrame, percent: int) -> DataFrame:
    """``id, band, least``: of a set's keys in a band, how many at least are equal in any partner there and in small buckets."""
    owned = sketches.select("id", F.explode("filled").alias("f")).select(
        "id", F.col("f").bitwiseAND(F.lit(255)).cast("int").alias("band"), F.shiftright("f", 8).alias("k"))
    large = state.where(F.col("m") > BUCKET).groupBy("id", _band("key").alias("band")).agg(F.count(F.lit(1)).alias("l"))
    differ = F.get(F.array(*[F.lit(b[2]) for b in size_bands(percent)]), F.col("band"))
    return owned.join(large, ["id", "band"], "left").select(
        "id", "band", (F.col("k") - F.coalesce("l", F.lit(0)) - differ).alias("least"))


def _band(key: str):
    return F.col(key).bitwiseAND(F.lit(255)).cast("int")


def _small_pairs(members: DataFrame, least: DataFrame) -> DataFrame:
    """Pairs of different components that share as many keys of a band, in buckets of at most ``BUCKET`` classes, as links must.

    All common buckets of such a pair are mixed, so every shared key counts.
    """
    mixed = members.groupBy("key").agg(F.min("comp").alias("c0"), F.max("comp").alias("c1")).where("c0 <> c1").select("key")
    rows = members.join(mixed, "key").select("key", "id", "comp")
    other = rows.select("key", F.col("id").alias("b"), F.col("comp").alias("other"))
    pairs = rows.join(other, "key").where("id < b and comp <> other").groupBy(
        F.col("id").alias("a"), "b", _band("key").alias("band")).agg(F.count(F.lit(1)).alias("c"))
    for end in ("a", "b"):
        pairs = pairs.join(least.withColumnRenamed("id", end), [end, "band"]).where(F.col("c") >= F.col("least")).drop("least")
    return pairs.select("a", "b").distinct()


def _family_links(rows: DataFrame, held, percent: int) -> DataFrame:
    """Verified links between components of a family, enough to join those that touch a held class.

    ``rows`` are ``fam, id, comp, n, sketch, shingles``, with the family's ``blocks``
    and ``slices``, and ``block``, the block that holds the class where ``held``.
    Every class streams past each block, slice by slice; a task holds one
    block and emits at most a link per component it joins.
    """
    columns = ("fam", "block", "slice", "held", "id", "comp", "n", "sketch", "shingles")
    passing = (rows.withColumn("own", F.when(held, F.col("block")))
               .withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
               .where(F.col("own").isNull() | (F.col("own") != F.col("block")))
               .select("fam", "block", F.pmod(F.xxhash64("id", F.lit(5)), F.col("slices")).alias("slice"), F.lit(False).alias("held"),
                       *columns[4:]))
    kept = rows.where(held).withColumn("slice", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("slices") - 1))).select(
        "fam", "block", "slice", F.lit(True).alias("held"), *columns[4:])
    dealt = kept.unionAll(passing).repartition("fam", "block", "slice").sortWithinPartitions("fam", "block", "slice", F.desc("held"))

    def run(batches):
        key, block = None, None
        for batch in batches:
            found = []
            places = list(zip(*[batch.column(c).to_pylist() for c in columns[:7]], strict=True))
            sketches, sets = batch.column("sketch"), batch.column("shingles")
            for i, (fam, number, part, holds, ident, comp, n) in enumerate(places):
                if (fam, number, part) != key:
                    if block is not None:
                        found.extend(block.among())
                    key, block = (fam, number, part), _Block(percent)
                row = (ident, comp, n, np.frombuffer(sketches[i].as_py(), dtype=np.uint64), sets[i].values.to_numpy())
                if holds:
                    block.rows.append(row)
                else:
                    found.extend(block.links(*row))
            yield _pair_batch(found)
        if block is not None:
            yield _pair_batch(block.among())

    return dealt.mapInArrow(run, "a bigint, b bigint")


def _pair_batch(found) -> pa.RecordBatch:
    pairs = np.array(list(found), dtype=np.int64).reshape(-1, 2)
    return pa.RecordBatch.from_arrays([pa.array(pairs.min(1)), pa.array(pairs.max(1))], names=["a", "b"])


class _Block:
    """Held classes ``(id, comp, n, sketch, shingles)``, and the components joined so far."""

    def __init__(self, percent: int):
        self.percent, self.rows, self.tables, self.joined = percent, [], {}, {}

    def _root(self, comp):
        while comp in self.joined:
            comp = self.joined[comp]
        return comp

    def _table(self, size: int):
        """Positions, components, sizes and sketches of the held, by sketch length, folded to at most ``size`` words."""
        if size not in self.tables:
            groups = {}
            for i, row in enumerate(self.rows):
                groups.setdefault(min(size, len(row[3])), []).append(i)
            self.tables[size] = [(width, np.array(at), np.array([self.rows[i][1] for i in at]), np.array([self.rows[i][2] for i in at]),
                                  np.array([folded(self.rows[i][3], width) for i in at])) for width, at in groups.items()]
        return self.tables[size]

    def links(self, ident, comp, n, sketch, shingles):
        """Verified links with held classes whose components are not joined yet."""
        for width, at, comps, sizes, sketches in self._table(len(sketch)):
            fits = np.flatnonzero((comps != comp) & (100 * np.minimum(sizes, n) >= self.percent * np.maximum(sizes, n)))
            most = (sizes[fits] + n) * (100 - self.percent) // (100 + self.percent)
            near = np.bitwise_count(sketches[fits] ^ folded(sketch, width)).sum(1, dtype=np.int64) <= most
            for i in at[fits[near]].tolist():
                other = self.rows[i]
                x, y = self._root(other[1]), self._root(comp)
                if x != y:
                    both = len(np.intersect1d(shingles, other[4], assume_unique=True))
                    if 100 * both >= self.percent * (n + other[2] - both):
                        self.joined[x] = y
                        yield ident, other[0]

    def among(self):
        for row in self.rows:
            yield from self.links(*row)


def _family_rows(families: DataFrame, contents: DataFrame) -> DataFrame:
    """``fam, id, comp`` with the family's ``size`` and ``slices``, and the classes' sizes, sketches and sets."""
    sizes = families.groupBy("fam").agg(F.count(F.lit(1)).alias("size"))
    return families.join(sizes, "fam").withColumn("slices", F.ceil(F.col("size") / SLICE)).join(contents, "id")


def _held_links(families: DataFrame, contents: DataFrame, percent: int) -> DataFrame:
    """Links of every class with about ``HELD`` classes of its family, chosen by a hash."""
    chosen = F.pmod(F.xxhash64("id", F.lit(77)), F.ceil(F.col("size") / HELD)) == 0
    rows = _family_rows(families, contents).withColumn("blocks", F.lit(1)).withColumn("block", F.lit(0))
    return _family_links(rows, chosen, percent)


def _outside_links(families: DataFrame, contents: DataFrame, percent: int) -> DataFrame:
    """Links of every class with all classes outside its family's main component."""
    main = families.groupBy("fam", "comp").agg(F.count(F.lit(1)).alias("c")).groupBy("fam").agg(
        F.max(F.struct("c", "comp")).alias("m")).select("fam", F.col("m.comp").alias("main"))
    rows = families.join(main, "fam").withColumn("outside", F.col("comp") != F.col("main"))
    blocks = rows.groupBy("fam").agg(F.sum(F.col("outside").cast("int")).alias("o")).where("o > 0").select(
        "fam", F.ceil(F.col("o") / BLOCK).cast("int").alias("blocks"))
    rows = _family_rows(rows.join(blocks, "fam"), contents)
    return _family_links(rows.withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")), F.col("outside"), percent)


def shared_prefixes(signed: DataFrame) -> DataFrame:
    """``key``: each prefix of ``PREFIX_BITS`` bits, in the upper bits, that two or more of the ``keys`` have."""
    ranges, low = 1 << RANGE_BITS, PREFIX_BITS - RANGE_BITS

    def packed(chunk):
        """Per key range the sorted lower parts; of equal ones, two tell as much as all."""
        keys = np.sort(np.concatenate(chunk) >> U64(64 - PREFIX_BITS))
        keys = keys[np.concatenate(([True] * min(2, len(keys)), keys[2:] != keys[:-2]))]
        ends = np.searchsorted(keys, np.arange(ranges + 1, dtype=U64) << U64(low))
        lows = (keys & U64((1 << low) - 1)).astype("<u4")
        some = np.flatnonzero(np.diff(ends))
        return pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array([lows[ends[p]:ends[p + 1]].tobytes() for p in some], pa.binary())],
                                          names=["p", "v"])

    def send(batches):
        chunk, size = [], 0
        for batch in batches:
            chunk.append(batch.column("keys").flatten().to_numpy().view(np.uint64))
            size += len(chunk[-1])
            if size > KEYS_HELD:
                yield packed(chunk)
                chunk, size = [], 0
        if size:
            yield packed(chunk)

    def repeated(place, parts):
        lows = np.sort(np.concatenate([np.frombuffer(v, dtype="<u4") for v in parts]))
        again = np.unique(lows[1:][lows[1:] == lows[:-1]]).astype(U64)
        keys = (U64(place << low) | again) << U64(64 - PREFIX_BITS)
        return pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64))], names=["key"])

    def count(batches):
        place, parts = None, []
        for batch in batches:
            for p, v in zip(batch.column("p").to_pylist(), batch.column("v").to_pylist(), strict=True):
                if p != place:
                    if parts:
                        yield repeated(place, parts)
                    place, parts = p, []
                parts.append(v)
        if parts:
            yield repeated(place, parts)

    sent = signed.where(F.size("keys") > 0).select("keys").mapInArrow(send, "p bigint, v binary")
    return sent.repartition("p").sortWithinPartitions("p").mapInArrow(count, "key bigint")


def marked_places(shared: DataFrame) -> np.ndarray:
    """A bit array with the places of the shared keys (their upper bits) set; at most ``MARK_BITS`` bits whatever their number."""
    count = shared.count()
    bits = min(MARK_BITS, max(16, (8 * count).bit_length()))
    slices = max(1, (1 << bits) >> 24)

    def run(batches):
        own = {}
        for batch in batches:
            place = (batch.column("key").to_numpy().view(np.uint64) >> U64(64 - bits)).astype(np.int64)
            part = place * slices >> bits
            for p in np.unique(part).tolist():
                flags = own.setdefault(p, np.zeros((1 << bits) // slices, dtype=bool))
                flags[place[part == p] - p * len(flags)] = True
        for p, flags in own.items():
            yield pa.RecordBatch.from_arrays([pa.array([p]), pa.array([np.packbits(flags, bitorder="little").tobytes()])], names=["p", "v"])

    dealt = shared.repartition(F.shiftright(F.shiftrightunsigned("key", 64 - bits) * slices, bits))
    out = np.zeros((slices, (1 << bits) // slices // 8), dtype=np.uint8)
    for row in dealt.mapInArrow(run, "p bigint, v binary").collect():
        out[row["p"]] |= np.frombuffer(row["v"], dtype=np.uint8)
    return out.reshape(-1)


def is_marked(marks: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Whether each key's place is set."""
    place = (keys >> U64(65 - (8 * len(marks)).bit_length())).astype(np.int64)
    return (marks[place >> 3] >> (place & 7).astype(np.uint8)) & 1 == 1


def _kept_keys(signed: DataFrame, marks: np.ndarray) -> DataFrame:
    """``id, keys`` with only the keys on marked places; rows without any go."""
    held = signed.sparkSession.sparkContext.broadcast(marks)

    def run(batches):
        table = held.value
        for batch in batches:
            keys = batch.column("keys")
            flat, ends = keys.flatten().to_numpy(), keys.offsets.to_numpy() - keys.offsets[0].as_py()
            on = is_marked(table, flat.view(np.uint64))
            sizes = np.diff(np.concatenate(([0], np.cumsum(on)))[ends])
            rows = np.flatnonzero(sizes)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").take(pa.array(rows)),
                 pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(sizes[rows]))), pa.int32()), pa.array(flat[on]))],
                names=["id", "keys"])

    return signed.select("id", "keys").mapInArrow(run, "id bigint, keys array<bigint>")


def jaccard_components(docs: DataFrame, shingle: int = 5, percent: int = 80, id_col: str = "doc_id",
                       text_col: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every row of ``docs``."""
    texts = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    signed = stored(_sketched(texts, shingle, percent).withColumn("id", F.monotonically_increasing_id()), "parity_sketches")
    classes = stored(signed.where("n > 0").groupBy("cls").agg(F.min("doc_id").alias("rep"), F.min("id").alias("id")), "classes")

    # Keys that occur once are dropped before any row is dealt by key; copies of one class still count here.
    marks = marked_places(stored(shared_prefixes(signed), "shared"))
    named = classes.select("id")
    if classes.count() <= REP_BROADCAST:  # the keys stay where they are
        named = F.broadcast(named)
    kept = _kept_keys(signed, marks).join(named, "id", "left_semi")
    keys = stored(kept.select("id", F.explode("keys").alias("key")), "keys")
    # Buckets of two or more classes, each with a hub; `m` classes share the key.
    salts = F.array(*[F.lit(s).cast("bigint") for s in _HUB_SALTS])
    salt = F.get(salts, F.pmod(F.shiftrightunsigned("key", 8), F.lit(HUBS)).cast("int"))
    buckets = keys.groupBy("key").agg(F.count(F.lit(1)).alias("m"), F.min(F.col("id").bitwiseXOR(salt)).alias("h")).where("m > 1")
    members = stored(keys.join(buckets.withColumn("hub", F.col("h").bitwiseXOR(salt)).drop("h"), "key"), "members")
    known = members.select("id").distinct()
    sketches = stored(signed.select("id", "n", "sketch", "filled").join(known, "id", "left_semi"), "sketches")

    def links_of(pairs: DataFrame) -> DataFrame:
        near = stored(_near(pairs, sketches, percent), "near")
        asked = near.select(F.explode(F.array("a", "b")).alias("id")).distinct()
        sets = stored(_class_sets(texts, classes.join(asked, "id", "left_semi"), shingle), "sets")
        return stored(_verified(near, sets, percent), "verified")

    tried = stored(members.where("id <> hub").select(F.least("id", "hub").alias("a"), F.greatest("id", "hub").alias("b")).distinct(), "met")
    links = links_of(tried)
    comp = components(links)
    state = stored(_compared(members, comp), "state")
    least = stored(_least_shared(sketches, state, percent), "least")
    more = links_of(_small_pairs(state.where(F.col("m") <= BUCKET), least).join(tried, ["a", "b"], "left_anti"))

    # Classes that may meet a partner in large buckets alone.
    large = state.where(F.col("m") > BUCKET).withColumn("band", _band("key"))
    needed = stored(large.join(least.where("least <= 0").select("id", "band"), ["id", "band"]), "needed")
    mixed = needed.groupBy("key").agg(F.min("comp").alias("c0"), F.max("comp").alias("c1")).where("c0 <> c1").select("key")
    needed = stored(needed.join(mixed, "key"), "needed")
    if not needed.isEmpty():
        # A family: classes joined by common large buckets of one band.
        place = F.concat_ws(":", "band", "id")
        first = needed.groupBy("key").agg(F.min(place).alias("v"))
        fam = components(needed.join(first, "key").select(place.alias("a"), F.col("v").alias("b")))
        rows = needed.select("id", "comp", place.alias("node")).distinct().join(fam.withColumnRenamed("comp", "fam"), "node", "left")
        families = rows.select(F.coalesce("fam", "node").alias("fam"), "id", "comp")
        asked = families.select("id").distinct()
        contents = stored(sketches.drop("filled").join(_class_sets(texts, classes.join(asked, "id", "left_semi"), shingle), "id"), "sets")
        families = stored(families, "families")
        more = stored(more.unionAll(_held_links(families, contents, percent)), "verified")
        comp = components(links.unionAll(more))
        more = more.unionAll(stored(_outside_links(_compared(families.drop("comp"), comp), contents, percent), "verified"))
    if not more.isEmpty():
        comp = components(links.unionAll(more))

    named = classes.select("cls", "id", "rep").join(comp, F.col("id") == F.col("node"), "left").select(
        "cls", "rep", F.coalesce("comp", "id").alias("comp"))
    named = stored(named, "named")
    least = named.groupBy("comp").agg(F.min("rep").alias("least"))
    found = signed.select("doc_id", "n", "cls").join(named.join(least, "comp").select("cls", "least"), "cls", "left")
    return found.select("doc_id", F.col("n").alias("n_shingles"),
                        F.when(F.col("cls").isNull(), F.col("doc_id")).otherwise(F.col("least")).alias("component_id"))


def op13_jaccard_join(spark, sf_dir: str) -> DataFrame:
    from vecspark.llm.common import table

    return jaccard_components(table(spark, sf_dir, "documents").select("doc_id", "text"))


OP13_SQL = r"""
WITH RECURSIVE w AS MATERIALIZED (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS MATERIALIZED (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + least(len(w), 5) - 1], ' ') AS g
  FROM w, unnest(range(1, len(w) - least(len(w), 5) + 2)) AS t(i) WHERE len(w) > 0),
n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
common AS MATERIALIZED (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k FROM s x JOIN s y ON x.g = y.g AND x.doc_id < y.doc_id GROUP BY 1, 2),
link AS MATERIALIZED (
  SELECT a, b FROM common JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * k >= 80 * (na.n + nb.n - k)),
edge AS MATERIALIZED (SELECT a, b FROM link UNION SELECT b, a FROM link),
reach(doc_id, r) AS (
  SELECT doc_id, doc_id FROM documents UNION SELECT e.b, reach.r FROM reach JOIN edge e ON e.a = reach.doc_id)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, c.r AS component_id
FROM documents d JOIN (SELECT doc_id, min(r) AS r FROM reach GROUP BY doc_id) c USING (doc_id) LEFT JOIN n USING (doc_id)
"""
