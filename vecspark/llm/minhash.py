"""MinHash near-duplicates with odd sketches and exact confirmation.

1. Signatures.  A document's set is its distinct ``shingle``-word shingles
   (words: maximal runs of non-space after lower-casing A-Z; with fewer words
   the whole sequence is one shingle).  ``BANDS * ROWS`` MinHash values are
   folded twice: into ``BANDS`` band keys, and into an odd sketch, a bitmap of
   ``SKETCH_BITS`` parities in which each (position, value) flips one bit.
2. Classes.  Documents of equal sets collapse into one class first (partial
   aggregation), so copies never meet each other.
3. Candidates.  Classes that share a band key are candidates.  They are
   never paired all with all: in every bucket the members meet a hub, one of
   at most ``HUBS`` for a group sharing many keys, and what is linked merges
   into components.  The classes near a hub form its neighbourhood; in each,
   those not yet linked with the hub are compared with all others by an
   inverted index, block by block, and only links that join components come
   out.  At last members of a bucket that are of different neighbourhoods and
   components are compared one by one.  Every pair sharing a band key thus
   ends in one component or has been compared.
4. Verification.  The population count of the XOR of two odd sketches
   estimates the similarity; pairs clearly below the threshold (over six
   standard deviations) are dropped, the others are confirmed on their full
   sets: ``100 * intersection >= percent * union``.
5. Components.  Confirmed links are joined by large-star and small-star
   rounds over stored tables.

A pair of similarity ``s`` shares no band with probability
``(1 - s ** ROWS) ** BANDS``: below 1e-10 at 0.85 and 1e-7 at 0.8.  Sets are
64-bit shingle fingerprints.

Defined results: null and wordless texts have size 0 and link with nothing;
rows repeating a doc_id form one class if their texts' sets are equal, and
each is returned; a null doc_id is never a component's name unless all of
the component are null, and is not kept.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vecspark.llm.common import parts_of, stored, texts_of
from vecspark.llm.words import NONSPACE, PART_BYTES, U64, Words, mix, shingle_hashes

BANDS, ROWS = 32, 4
SKETCH_BITS = 512
HUBS = 4
HOME_DEVIATIONS = 13  # a neighbourhood is wider than what is compared with its hub
INDEX_ROWS = 500
_HASHES = BANDS * ROWS
_FACTORS = mix(np.arange(1, _HASHES + 1, dtype=U64)) | U64(1)
_SHIFTS = mix(np.arange(1001, 1001 + _HASHES, dtype=U64))
_SALTS = mix(np.arange(5001, 5001 + _HASHES, dtype=U64))


def minhash(shingles: np.ndarray) -> np.ndarray:
    """``BANDS * ROWS`` minima of multiplicative hashes of the fingerprints."""
    best = None
    with np.errstate(over="ignore"):
        for i in range(0, len(shingles), 4096):  # bounded memory for long texts
            own = (np.multiply.outer(_FACTORS, shingles[i:i + 4096]) + _SHIFTS[:, None]).min(1)
            best = own if best is None else np.minimum(best, own)
    return best


def band_keys(values: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        rows = mix(values ^ _SALTS).reshape(BANDS, ROWS)
        return mix((rows * _FACTORS[:ROWS]).sum(1) + np.arange(BANDS, dtype=U64))


def odd_sketch(values: np.ndarray) -> np.ndarray:
    """Parity bitmap of the MinHash samples, as 64-bit words."""
    with np.errstate(over="ignore"):
        place = (mix(values + _SALTS) % U64(SKETCH_BITS)).astype(np.int64)
    parity = np.bincount(place, minlength=SKETCH_BITS) & 1
    return np.packbits(parity.astype(np.uint8)).view(np.uint64)


def _set_class(shingles: np.ndarray) -> bytes:
    """128-bit fingerprint of a set of sorted distinct shingles."""
    with np.errstate(over="ignore"):
        a = mix(shingles + U64(11)).sum(dtype=U64) + U64(len(shingles))
        b = mix(shingles ^ U64(0xA5A5A5A5A5A5A5A5)).sum(dtype=U64)
    return int(a).to_bytes(8, "big") + int(b).to_bytes(8, "big")


def signatures(docs: DataFrame, shingle: int, id_col: str, text_col: str) -> DataFrame:
    """``doc_id, n, cls, bands, sketch, k1, k2`` of every row; empty sets have null class, equal rows equal keys."""

    def run(batches):
        for batch in batches:
            texts = texts_of(batch.column("text"))
            sizes, classes, keys, sketches = [], [], [], []
            for a, b in parts_of(texts, PART_BYTES):
                w = Words(texts[a:b], NONSPACE)
                for i in range(b - a):
                    own = np.unique(shingle_hashes(w.hash[w.text(i)], shingle))
                    sizes.append(len(own))
                    if len(own) == 0:
                        classes.append(None), keys.append(None), sketches.append(None)
                        continue
                    values = minhash(own)
                    classes.append(_set_class(own))
                    keys.append(band_keys(values).view(np.int64))
                    sketches.append(odd_sketch(values).view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(classes, pa.binary()),
                 pa.array(keys, pa.list_(pa.int64())), pa.array(sketches, pa.list_(pa.int64())),
                 batch.column("k1"), batch.column("k2")],
                names=["doc_id", "n", "cls", "bands", "sketch", "k1", "k2"])

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), *_row_keys(id_col, text_col))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, n bigint, cls binary, bands array<bigint>, sketch array<bigint>, k1 bigint, k2 bigint")


def _row_keys(id_col: str, text_col: str):
    """``k1, k2``: rows of equal keys have equal ids and texts."""
    row = F.col(f"`{id_col}`"), F.col(f"`{text_col}`")
    return F.xxhash64(*row).alias("k1"), F.xxhash64(F.lit(7), *reversed(row)).alias("k2")


def _shingle_sets(docs: DataFrame, shingle: int) -> DataFrame:
    """``cls, shingles`` (sorted fingerprints) of ``doc_id, text`` rows."""

    def run(batches):
        for batch in batches:
            texts = texts_of(batch.column("text"))
            for a, b in parts_of(texts, PART_BYTES):
                w = Words(texts[a:b], NONSPACE)
                own = [np.unique(shingle_hashes(w.hash[w.text(i)], shingle)) for i in range(b - a)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([_set_class(x) if len(x) else None for x in own], pa.binary()),
                     pa.array([x.view(np.int64) for x in own], pa.list_(pa.int64()))], names=["cls", "shingles"])

    return docs.mapInArrow(run, "cls binary, shingles array<bigint>")


def most_differing(percent: int, deviations: float) -> int:
    """Bits in which the odd sketches of two sets of the threshold similarity may differ, that many standard
    deviations above the mean: of the number of differing MinHash values, and of their collisions in the bitmap."""
    s = percent / 100
    flips = 2 * _HASHES * (1 - s)
    stay = (1 - 2 / SKETCH_BITS) ** flips
    mean = SKETCH_BITS / 2 * (1 - stay)
    variance = (2 * stay) ** 2 * _HASHES * s * (1 - s) + 2 * flips**2 / SKETCH_BITS
    return int(mean + deviations * variance**0.5)


def _may_link(n_a, n_b, sketch_a, sketch_b, percent: int, deviations: float = 6):
    """Column: sizes allow the similarity, and so does the odd sketches' estimate."""
    differing = F.aggregate(F.zip_with(sketch_a, sketch_b, lambda x, y: F.bit_count(x.bitwiseXOR(y))),
                            F.lit(0), lambda total, x: total + x)
    return ((100 * F.least(n_a, n_b) >= percent * F.greatest(n_a, n_b)) & (differing <= most_differing(percent, deviations)))


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs ``a, b`` whose full sets reach the similarity."""
    left = sets.select(F.col("cls").alias("a"), F.col("shingles").alias("sa"))
    right = sets.select(F.col("cls").alias("b"), F.col("shingles").alias("sb"))
    both = F.size(F.array_intersect("sa", "sb"))
    union = F.size("sa") + F.size("sb") - both
    return (pairs.join(left, "a").join(right, "b").where(100 * both >= percent * union).select("a", "b"))


def _home_links(home: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links between different components of one neighbourhood, enough to join them.

    The classes outside the largest component are indexed in blocks of
    ``INDEX_ROWS`` by their shingles; all classes of the neighbourhood stream
    past each block, and the index counts their common shingles exactly.  A
    task holds one block and emits at most a link per component it joins.
    """
    main = home.groupBy("home", "comp").agg(F.count(F.lit(1)).alias("c")).groupBy("home").agg(
        F.max(F.struct("c", "comp")).alias("m")).select("home", F.col("m.comp").alias("main"))
    rows = home.join(main, "home").withColumn("inner", F.col("comp") == F.col("main"))
    counts = rows.groupBy("home").agg(F.sum((~F.col("inner")).cast("int")).alias("outside")).where("outside > 0").select(
        "home", F.ceil(F.col("outside") / INDEX_ROWS).cast("int").alias("blocks"))
    dealt = rows.join(counts, "home").select("home", "cls", "comp", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"),
                                             (~F.col("inner") & (F.pmod(F.xxhash64("cls"), F.col("blocks")) == F.col("block"))).alias("indexed"))
    # Which block holds a class depends on its hash, so a block may be somewhat larger than INDEX_ROWS.
    whole = (dealt.join(sets, "cls").select("home", "block", "indexed", "cls", "comp", "shingles")
             .repartition("home", "block").sortWithinPartitions("home", "block", F.desc("indexed")))

    def run(batches):
        index = None
        for batch in batches:
            homes, blocks, indexed = (batch.column(c).to_pylist() for c in ("home", "block", "indexed"))
            classes, comps = batch.column("cls").to_pylist(), batch.column("comp").to_pylist()
            flat, ends = batch.column("shingles").flatten().to_numpy().view(U64), batch.column("shingles").offsets.to_numpy()
            ends = ends - ends[0]
            out = []
            for i in range(batch.num_rows):
                if index is None or index.key != (homes[i], blocks[i]):
                    out.extend(index.among() if index else ())
                    index = _ShingleIndex((homes[i], blocks[i]), percent)
                own = flat[ends[i]:ends[i + 1]]
                if indexed[i]:
                    index.add(classes[i], comps[i], own)
                else:
                    out.extend(index.links(classes[i], comps[i], own))
            yield _links_batch(out)
        if index is not None:
            yield _links_batch(index.among())

    return whole.mapInArrow(run, "a binary, b binary")


def _links_batch(links) -> pa.RecordBatch:
    links = list(links)
    return pa.RecordBatch.from_arrays([pa.array([x for x, _ in links], pa.binary()), pa.array([y for _, y in links], pa.binary())],
                                      names=["a", "b"])


class _ShingleIndex:
    """Inverted index of a block's sets, with the components joined so far.

    Sets are added first; the first question sorts the index.
    """

    def __init__(self, key, percent: int):
        self.key, self.percent = key, percent
        self.classes, self.comps, self.sets = [], [], []
        self.keys = None
        self.joined: dict[bytes, bytes] = {}

    def _root(self, comp: bytes) -> bytes:
        while comp in self.joined:
            comp = self.joined[comp]
        return comp

    def add(self, cls: bytes, comp: bytes, own: np.ndarray) -> None:
        self.classes.append(cls), self.comps.append(comp), self.sets.append(own)

    def _sort(self) -> None:
        self.sizes = np.array([len(x) for x in self.sets], dtype=np.int64)
        keys = np.concatenate(self.sets) if self.sets else np.zeros(0, dtype=U64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.rows = keys[order], np.repeat(np.arange(len(self.sets)), self.sizes)[order]

    def among(self):
        """Links between the indexed sets themselves."""
        for cls, comp, own in zip(self.classes, self.comps, self.sets, strict=True):
            yield from self.links(cls, comp, own)

    def links(self, cls: bytes, comp: bytes, own: np.ndarray) -> list[tuple[bytes, bytes]]:
        """Links of a set with indexed ones whose components are not joined yet."""
        if self.keys is None:
            self._sort()
        lo, hi = np.searchsorted(self.keys, own, "left"), np.searchsorted(self.keys, own, "right")
        n = hi - lo
        at = np.repeat(lo - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(n.sum())
        common = np.bincount(self.rows[at], minlength=len(self.classes))
        union = self.sizes + len(own) - common
        out = []
        for i in np.flatnonzero(100 * common >= self.percent * union).tolist():
            x, y = self._root(self.comps[i]), self._root(comp)
            if x != y:
                self.joined[x] = y
                out.append((self.classes[i], cls))
        return out


def components(links: DataFrame, rounds: int = 50) -> DataFrame:
    """``node, comp``: the smallest node reachable over links ``a, b``.

    Large-star and small-star rounds; each is stored, so no lineage grows.
    Only a comparison of two counts reaches the driver.
    """
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct()
    edges = stored(edges, "links")
    check = None
    for _ in range(rounds):
        # Large star: every larger neighbour of a node is linked with the smallest of its neighbourhood.
        both = edges.select("u", "v").unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        big = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        # Small star: a node and its smaller neighbours are linked with the smallest of them.
        big = big.distinct()
        least = big.groupBy("u").agg(F.min("v").alias("m"))
        small = big.join(least, "u")
        edges = stored(small.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
                       .unionAll(least.select("u", F.col("m").alias("v"))).distinct(), "links")
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == check:
            break
        check = state
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("comp")).unionAll(
        edges.select(F.col("v").alias("node"), F.col("v").alias("comp"))).distinct()


def near_duplicates(docs: DataFrame, shingle: int = 5, percent: int = 80, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` of every row of ``docs``."""
    return _found(docs, shingle, percent, id_col, text_col).select("doc_id", "n_shingles", "component_id", "kept")


def _found(docs: DataFrame, shingle: int, percent: int, id_col: str, text_col: str) -> DataFrame:
    """The same with each row's component ``comp`` (null for empty sets) and keys ``k1, k2``."""
    sig = stored(signatures(docs, shingle, id_col, text_col), "signatures")
    classes = (sig.where("n > 0").groupBy("cls").agg(
        F.min("doc_id").alias("rep"), F.any_value("n").alias("n"), F.any_value("sketch").alias("sketch"),
        F.any_value("bands").alias("bands")))
    keys = classes.select("cls", "n", "sketch", F.posexplode("bands").alias("band", "key"))
    shared = keys.groupBy("band", "key").agg(F.count(F.lit(1)).alias("size")).where("size > 1").select("band", "key")
    # Members of buckets of two or more classes.
    members = stored(keys.join(shared, ["band", "key"]), "members")
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    wanted = members.select("cls").distinct()
    chosen = classes.select("cls", "rep").join(wanted, "cls", "left_semi").select("rep").distinct()
    sets = _shingle_sets(texts.join(chosen, F.col("doc_id").eqNullSafe(F.col("rep")), "left_semi"), shingle)
    # Rows repeating a doc_id with another text are other classes, wanted or not.
    sets = stored(sets.join(wanted, "cls", "left_semi"), "sets")

    # Members meet the hubs of their buckets; `near` says who was close enough to which to be compared.
    order = F.xxhash64("cls", F.col("band") % HUBS)
    hubs = members.groupBy("band", "key").agg(F.min(F.struct(order.alias("o"), "cls", "n", "sketch")).alias("hub"))
    met = members.join(hubs, ["band", "key"]).where(F.col("cls") != F.col("hub.cls"))
    signs = (F.col("n"), F.col("hub.n"), F.col("sketch"), F.col("hub.sketch"), percent)
    near = stored(met.where(_may_link(*signs, HOME_DEVIATIONS)).select(
        "cls", F.col("hub.cls").alias("hub"), _may_link(*signs).alias("tried")).distinct(), "near")
    tried = near.where("tried").select(F.least("cls", "hub").alias("a"), F.greatest("cls", "hub").alias("b")).distinct()
    links = stored(_confirmed(tried, sets, percent), "confirmed")
    # Each class joins the largest neighbourhood of a hub, and with it the largest one that this hub is itself
    # near to; inside one, what is not linked yet is compared.
    sizes = near.groupBy("hub").agg(F.count(F.lit(1)).alias("size"))
    both = near.select("cls", "hub").unionAll(near.select(F.col("hub").alias("cls"), "hub")).distinct()
    first = both.join(sizes, "hub").groupBy("cls").agg(F.max(F.struct("size", "hub")).alias("h")).select(
        "cls", F.col("h.hub").alias("hub"))
    first = stored(first, "first_home")
    second = first.select(F.col("cls").alias("hub"), F.col("hub").alias("home"))
    # Who is linked with a hub is in one component with it: that much is known without joining components.
    star = near.where("tried").select("cls", "hub", F.least("cls", "hub").alias("a"), F.greatest("cls", "hub").alias("b")).join(
        links, ["a", "b"]).join(sizes, "hub").groupBy("cls").agg(F.max(F.struct("size", "hub")).alias("h")).select(
        F.col("cls").alias("node"), F.col("h.hub").alias("star"))
    home = stored(first.join(second, "hub").join(star, F.col("cls") == F.col("node"), "left")
                  .select("cls", "home", F.coalesce("star", "cls").alias("comp")), "home")
    links = links.unionAll(stored(_home_links(home, sets, percent), "confirmed"))
    comp = components(links)
    # Members of a bucket from different neighbourhoods and components are compared one by one: whoever is
    # not of its hub's neighbourhood meets all others.
    state = home.select("cls", "home").join(comp, F.col("cls") == F.col("node"), "left").select(
        "cls", "home", F.coalesce("comp", "cls").alias("comp"))
    rows = stored(members.join(state, "cls", "left").withColumn("comp", F.coalesce("comp", "cls")), "rows")
    mixed = rows.groupBy("band", "key").agg(F.min(F.struct(order.alias("o"), "home")).alias("hub"), F.min("comp").alias("c0"),
                                            F.max("comp").alias("c1")).where("c0 <> c1").select("band", "key", F.col("hub.home").alias("main"))
    odd = rows.join(mixed, ["band", "key"]).where(F.col("home").isNull() | ~F.col("home").eqNullSafe(F.col("main"))).drop("main")
    other = rows.select("band", "key", F.struct("cls", "n", "sketch", "comp", "home").alias("y"))
    apart = (F.col("comp") != F.col("y.comp")) & (F.col("home").isNull() | ~F.col("home").eqNullSafe(F.col("y.home")))
    pairs = odd.join(other, ["band", "key"]).where(
        apart & _may_link(F.col("n"), F.col("y.n"), F.col("sketch"), F.col("y.sketch"), percent))
    pairs = pairs.select(F.least("cls", "y.cls").alias("a"), F.greatest("cls", "y.cls").alias("b")).distinct()
    last = stored(_confirmed(stored(pairs.join(tried, ["a", "b"], "left_anti"), "pairs"), sets, percent), "confirmed")
    if not last.isEmpty():
        comp = components(links.unionAll(last))
    out = sig.select("doc_id", "n", "cls", "k1", "k2")
    out = out.join(comp, out.cls == comp.node, "left").select("doc_id", "n", "cls", "k1", "k2", F.coalesce("comp", "cls").alias("comp"))
    names = out.where("cls is not null").groupBy("comp").agg(F.min("doc_id").alias("least"))
    found = out.join(names, "comp", "left")
    component = F.when(F.col("cls").isNull(), F.col("doc_id")).otherwise(F.col("least"))
    return found.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"),
                        F.coalesce(F.col("doc_id") == component, F.lit(False)).alias("kept"), "comp", "k1", "k2")


def keep_one(docs: DataFrame, shingle: int = 5, percent: int = 80, id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each component: of the smallest id, and of its rows one by a hash.

    So a row that repeats an id with another text is judged by its own text,
    and of equal rows one stays.  Rows without words stay, and so do rows with
    a null id, as nothing names them.
    """
    found = stored(_found(docs, shingle, percent, id_col, text_col).where(
        F.col("comp").isNotNull() & F.col("doc_id").isNotNull()).select("comp", "doc_id", "k1", "k2"), "found")
    best = found.groupBy("comp").agg(F.min(F.struct("doc_id", "k1", "k2")).alias("b"))
    dropped = found.join(best, "comp").where((F.col("k1") != F.col("b.k1")) | (F.col("k2") != F.col("b.k2"))).select("k1", "k2").distinct()
    twice = found.groupBy("k1", "k2").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("k1", "k2")
    k1, k2 = _row_keys(id_col, text_col)
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), k1, k2).join(dropped, ["k1", "k2"], "left_anti")
    once = rows.join(twice, ["k1", "k2"], "left_anti")
    one = rows.join(twice, ["k1", "k2"], "left_semi").dropDuplicates(["k1", "k2"])
    return once.unionAll(one).select("row.*")


def op9_minhash(spark, sf_dir: str) -> DataFrame:
    from vecspark.llm.common import table

    return near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"), shingle=3, percent=85)


OP9_SQL = r"""
WITH RECURSIVE w AS MATERIALIZED (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS MATERIALIZED (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + least(len(w), 3) - 1], ' ') AS g
  FROM w, unnest(range(1, len(w) - least(len(w), 3) + 2)) AS t(i) WHERE len(w) > 0),
n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
common AS MATERIALIZED (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k FROM s x JOIN s y ON x.g = y.g AND x.doc_id < y.doc_id GROUP BY 1, 2),
link AS MATERIALIZED (
  SELECT a, b FROM common JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * k >= 85 * (na.n + nb.n - k)),
edge AS MATERIALIZED (SELECT a, b FROM link UNION SELECT b, a FROM link),
reach(doc_id, r) AS (
  SELECT doc_id, doc_id FROM documents UNION SELECT e.b, reach.r FROM reach JOIN edge e ON e.a = reach.doc_id)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, c.r AS component_id, d.doc_id = c.r AS kept
FROM documents d JOIN (SELECT doc_id, min(r) AS r FROM reach GROUP BY doc_id) c USING (doc_id) LEFT JOIN n USING (doc_id)
"""
