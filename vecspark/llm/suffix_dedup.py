"""Removal of repeated byte strings with sparse suffix arrays in a logarithmic index family.

Every byte covered by a ``length``-byte string (default 400) that also
starts elsewhere goes; texts are UTF-8 bytes, matches never cross texts.

1. Anchors.  Each start of a ``length``-byte string is represented by the
   string's anchor, the leftmost of its ``GRAM``-byte grams with the smallest
   fingerprint.  Equal strings have equal anchors at equal offsets.
   Consecutive starts mostly share one; such a run (about half a string
   long) is one row: the anchor's fingerprint, that of the run's whole bytes
   (its class), and where it is.
2. Classes.  Runs of equal bytes are counted by partial aggregation.  A
   class of two or more runs is repeated from end to end; an anchor with a
   single class needs no more work.  So copies cost a counter each.
3. Index family.  Only one run of each class whose anchor has several
   classes sends its bytes on, dealt by anchor.  A task takes them in
   batches.  A batch gets its suffix array, its starts in the order of their
   first ``length`` bytes (of their 64-bit fingerprints, which is all the
   order that matches of that length need); it is merge-scanned against the
   arrays of all levels for equal neighbours; then it becomes a level, and
   levels of equal size merge, so there are logarithmically many.
   Anchors with over ``MOST_CLASSES`` classes are not dealt to one task:
   their starts are dealt by fingerprint and counted by aggregation.
4. Removal.  The starts found become byte ranges per class, then per text.

``create_index`` and ``add_batch`` keep the family on disk for documents that
arrive in batches.  A level is a table of classes in the order of their
anchors, with a place of each in the stored texts.  A batch is scanned against
all levels: only classes of its own anchors meet it, and old bytes are read
only of such with other surroundings.  Then it becomes a level, and levels
of equal size merge.  A manifest makes a version visible at the end, so a
failed batch leaves the version before it; levels and texts are never changed.
One writer at a time.

Strings are compared by 64-bit fingerprints of their bytes.

Defined results: null and short texts lose nothing of their own, except to
matches of full length; rows repeating a doc_id and text count as places
of their own and get equal results; extra columns are ignored.
"""

from __future__ import annotations

import json
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vecspark.llm.common import parts_of, stored, string_list, texts_of
from vecspark.llm.words import PART_BYTES, U64, mix, prefix_sums, range_hash

LENGTH = 400
GRAM = 32
MOST_CLASSES = 4000
STARTS_PER_TASK = 4_000_000
LEVEL = "ahash bigint, chash bigint, n int, places bigint, rep struct<k1: bigint, k2: bigint, a: int>, batch int"
_PLACE = U64((1 << 24) - 1)
_SEGMENT = 1 << 23  # starts of one text handled at once


def _window_minima(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` consecutive values: block-wise running minima from both sides."""
    n = len(x)
    padded = np.full(-(-n // width) * width, np.iinfo(np.uint64).max, dtype=U64)
    padded[:n] = x
    rows = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(rows, axis=1).reshape(-1)
    back = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return np.minimum(back[:n - width + 1], ahead[width - 1:n])


def runs_of(texts: list[bytes], length: int = LENGTH) -> dict[str, np.ndarray]:
    """Runs of consecutive texts: ``text, a`` (first start), ``n`` (starts),
    ``ahash`` (anchor) and ``chash`` (bytes ``a`` to ``a + n - 1 + length``)."""
    gram = min(GRAM, length)
    data = np.frombuffer(b"".join(texts), dtype=np.uint8)
    empty = {k: np.zeros(0, dtype=np.int64) for k in ("text", "a", "n", "ahash", "chash")}
    if len(data) < length:
        return empty
    sizes = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
    first = np.cumsum(sizes) - sizes
    s = prefix_sums(data)
    at = np.arange(len(data) - gram + 1)
    grams = range_hash(s, at, at + gram)
    packed = (mix(grams ^ U64(0x51ED270B76F1)) & ~_PLACE) | at.astype(U64)
    minima = _window_minima(packed, length - gram + 1)
    starts = np.arange(len(minima))
    text = np.repeat(np.arange(len(texts)), sizes)[:len(minima)]
    valid = starts + length <= first[text] + sizes[text]
    starts, text, anchor = starts[valid], text[valid], (minima[valid] & _PLACE).astype(np.int64)
    if len(starts) == 0:
        return empty
    new = np.flatnonzero(np.concatenate(([True], (np.diff(anchor) != 0) | (np.diff(text) != 0))))
    n = np.diff(np.append(new, len(starts)))
    a, anchor, text = starts[new], anchor[new], text[new]
    with np.errstate(over="ignore"):
        chash = mix(range_hash(s, a, a + n - 1 + length) + (anchor - a).astype(U64))
    return {"text": text, "a": a - first[text], "n": n, "ahash": grams[anchor].view(np.int64), "chash": chash.view(np.int64)}


def _segments(texts: list[bytes], length: int):
    """``(first text, start shift, texts)`` slices; a very long text in overlapping segments."""
    for i, j in parts_of(texts, PART_BYTES):
        if j - i == 1 and len(texts[i]) > _SEGMENT + length:
            for at in range(0, len(texts[i]) - length + 1, _SEGMENT):
                yield i, at, [texts[i][at:at + _SEGMENT + length - 1]]
        else:
            yield i, 0, texts[i:j]


class LevelFamily:
    """Suffix arrays of batches in levels of geometrically growing size.

    ``add`` takes the keys of a batch's starts, numbers them on, and marks
    every start whose key occurs twice so far, in any level.
    """

    def __init__(self):
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []
        self.marked = np.zeros(1024, dtype=bool)
        self.size = 0

    def add(self, keys: np.ndarray) -> None:
        number = np.arange(self.size, self.size + len(keys))
        self.size += len(keys)
        if self.size > len(self.marked):
            self.marked = np.concatenate((self.marked, np.zeros(max(len(self.marked), self.size), dtype=bool)))
        order = np.argsort(keys, kind="stable")
        keys, number = keys[order], number[order]
        same = np.flatnonzero(keys[1:] == keys[:-1])
        self.marked[number[same]] = self.marked[number[same + 1]] = True
        for level_keys, level_number in self.levels:  # merge-scan
            place = np.minimum(np.searchsorted(level_keys, keys), len(level_keys) - 1)
            equal = level_keys[place] == keys
            self.marked[number[equal]] = True
            self.marked[level_number[place[equal]]] = True  # others of an equal key in the level are marked already
        if len(keys):
            self.levels.append((keys, number))
        while len(self.levels) > 1 and 2 * len(self.levels[-1][0]) > len(self.levels[-2][0]):
            (k1, n1), (k0, n0) = self.levels.pop(), self.levels.pop()
            both = np.concatenate((k0, k1))
            order = np.argsort(both, kind="stable")
            self.levels.append((both[order], np.concatenate((n0, n1))[order]))


def _string_keys(context: bytes, length: int) -> np.ndarray:
    data = np.frombuffer(context, dtype=np.uint8)
    at = np.arange(len(data) - length + 1)
    return range_hash(prefix_sums(data), at, at + length)


def covered(starts: np.ndarray, length: int) -> np.ndarray:
    """Flat ``[first, end, first, end, ...]`` union of the strings at sorted ``starts``."""
    if len(starts) == 0:
        return np.zeros(0, dtype=np.int64)
    new = np.flatnonzero(np.concatenate(([True], np.diff(starts) > length)))
    last = np.append(new[1:] - 1, len(starts) - 1)
    return np.stack((starts[new], starts[last] + length), 1).reshape(-1)


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``doc_id, text, k1, k2``: rows of equal keys are equal rows."""
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    return rows.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("k1"),
                       F.xxhash64(F.lit(7), "text", "doc_id").alias("k2"))


def _runs(rows: DataFrame, length: int) -> DataFrame:
    def run(batches):
        for batch in batches:
            texts = texts_of(batch.column("text"))
            for i, shift, part in _segments(texts, length):
                found = runs_of(part, length)
                if len(found["a"]):
                    own = pa.array(found["text"] + i)
                    yield pa.RecordBatch.from_arrays(
                        [batch.column("k1").take(own), batch.column("k2").take(own),
                         pa.array((found["a"] + shift).astype(np.int32)), pa.array(found["n"].astype(np.int32)),
                         pa.array(found["ahash"]), pa.array(found["chash"])],
                        names=["k1", "k2", "a", "n", "ahash", "chash"])

    return rows.select("k1", "k2", "text").mapInArrow(
        run, "k1 bigint, k2 bigint, a int, n int, ahash bigint, chash bigint")


def _contexts(rows: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """``ahash, chash, n, context`` bytes of the wanted runs, cut out of their texts."""
    per_text = wanted.groupBy("k1", "k2").agg(F.collect_set(F.struct("a", "n", "ahash", "chash")).alias("cut"))

    def run(batches):
        for batch in batches:
            texts, out = texts_of(batch.column("text")), [[], [], [], []]
            for text, cut in zip(texts, batch.column("cut").to_pylist(), strict=True):
                for c in cut:
                    out[0].append(c["ahash"]), out[1].append(c["chash"]), out[2].append(c["n"])
                    out[3].append(text[c["a"]:c["a"] + c["n"] - 1 + length])
                if len(out[0]) >= 4096:
                    yield _context_batch(out)
                    out = [[], [], [], []]
            if out[0]:
                yield _context_batch(out)

    return rows.join(per_text, ["k1", "k2"]).select("text", "cut").mapInArrow(
        run, "ahash bigint, chash bigint, n int, context binary")


def _context_batch(out: list) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.int32(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(out, kinds, strict=True)],
                                      names=["ahash", "chash", "n", "context"])


def _indexed(contexts: DataFrame, partitions: int, length: int) -> DataFrame:
    """``ahash, chash, n, cover`` of contexts dealt by anchor: the index family's marks as byte ranges."""

    def run(batches):
        family, held = LevelFamily(), []
        for batch in batches:
            found = [_string_keys(c, length) for c in batch.column("context").to_pylist()]
            if found:
                family.add(np.concatenate(found))
                held.append((batch.column("ahash"), batch.column("chash"), batch.column("n")))
        at = 0
        for ahash, chash, n in held:
            sizes = n.to_numpy()
            ends = at + np.cumsum(sizes)
            ranges = [covered(np.flatnonzero(family.marked[e - s:e]), length) for s, e in zip(sizes, ends, strict=True)]
            at = int(ends[-1])
            offsets = np.concatenate(([0], np.cumsum([len(r) for r in ranges])))
            yield pa.RecordBatch.from_arrays(
                [ahash, chash, n, string_list(np.concatenate(ranges).astype(np.int32), offsets)],
                names=["ahash", "chash", "n", "cover"])

    return contexts.repartition(partitions, "ahash").mapInArrow(run, "ahash bigint, chash bigint, n int, cover array<int>")


def _counted(contexts: DataFrame, length: int) -> DataFrame:
    """The same for anchors with very many classes: starts dealt by fingerprint and counted."""

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                keys = _string_keys(batch.column("context")[i].as_py(), length)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(keys), batch.column(c)[i].as_py(), dtype=np.int64)) for c in ("ahash", "chash", "n")]
                    + [pa.array(np.arange(len(keys), dtype=np.int32)), pa.array(keys.view(np.int64))],
                    names=["ahash", "chash", "n", "s", "key"])

    starts = contexts.mapInArrow(run, "ahash bigint, chash bigint, n bigint, s int, key bigint")
    starts = stored(starts.withColumn("n", F.col("n").cast("int")), "starts")
    repeated = starts.groupBy("key").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("key")
    found = starts.join(repeated, "key").groupBy("ahash", "chash", "n").agg(F.sort_array(F.collect_list("s")).alias("ss"))
    # neighbouring strings are joined later, with those of the whole text
    return found.select("ahash", "chash", "n", F.flatten(F.transform("ss", lambda s: F.array(s, s + length))).alias("cover"))


def _classes(runs: DataFrame) -> DataFrame:
    return runs.groupBy("ahash", "chash", "n").agg(
        F.count(F.lit(1)).alias("places"), F.min(F.struct("k1", "k2", "a")).alias("rep"))


def repeated_ranges(rows: DataFrame, length: int = LENGTH) -> DataFrame:
    """``k1, k2, ranges``: flat byte ranges of each text to be removed (they may overlap)."""
    runs = stored(_runs(rows, length), "runs")
    anchors = runs.groupBy("ahash").agg(F.count(F.lit(1)).alias("runs"), (F.min(F.struct("chash", "n"))
                                        != F.max(F.struct("chash", "n"))).alias("several")).where("runs > 1")
    found = stored(_classes(runs).join(anchors, "ahash").drop("runs"), "classes")
    wanted = found.where("several").select("ahash", "chash", "n", "rep.*")
    return _ranges(runs, found, _contexts(rows, wanted, length), length)


def _ranges(runs: DataFrame, found: DataFrame, contexts: DataFrame, length: int) -> DataFrame:
    """Ranges of the texts of ``runs``, given all classes of repeated anchors and the bytes of those that have to be compared."""
    several = found.where("several")
    busy = several.groupBy("ahash").agg(F.count(F.lit(1)).alias("c")).where(F.col("c") > MOST_CLASSES).select("ahash")
    contexts = stored(contexts, "contexts")
    total = several.agg(F.sum("n")).first()[0] or 0
    partitions = max(1, -(-total // STARTS_PER_TASK), int(runs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    detail = _indexed(contexts.join(busy, "ahash", "left_anti"), partitions, length)
    if not busy.isEmpty():
        detail = detail.unionAll(_counted(contexts.join(busy, "ahash", "left_semi"), length))
    detail = stored(detail.where(F.size("cover") > 0), "cover")
    whole = found.where("places > 1").select("ahash", "chash", "n", F.array(
        F.lit(0), F.col("n") - 1 + length).alias("cover"))
    once = found.where("places = 1 and several").join(detail, ["ahash", "chash", "n"]).select("ahash", "chash", "n", "cover")
    cover = whole.unionAll(once)
    placed = runs.join(cover, ["ahash", "chash", "n"]).select(
        "k1", "k2", F.transform("cover", lambda x: x + F.col("a")).alias("r"))
    return placed.groupBy("k1", "k2").agg(F.flatten(F.collect_list("r")).alias("ranges"))


def _cut(text: bytes, ranges: np.ndarray) -> tuple[int, int, bytes]:
    """``(n_removed, n_spans, kept bytes)``: maximal removed runs join adjacent ranges."""
    pairs = ranges.reshape(-1, 2)
    pairs = pairs[np.argsort(pairs[:, 0], kind="stable")]
    reach = np.maximum.accumulate(pairs[:, 1])
    new = np.flatnonzero(np.concatenate(([True], pairs[1:, 0] > reach[:-1])))
    first, end = pairs[new, 0], reach[np.append(new[1:] - 1, len(pairs) - 1)]
    kept = [text[a:b] for a, b in zip(np.append(0, end), np.append(first, len(text)), strict=True)]
    return int((end - first).sum()), len(first), b"".join(kept)


def remove_repeats(docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept`` (remaining bytes) per row."""
    rows = _keyed(docs, id_col, text_col)
    return _without(rows, repeated_ranges(rows, length))


def _without(rows: DataFrame, ranges: DataFrame) -> DataFrame:
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            texts = texts_of(batch.column("text"))
            out = [(0, 0, t) if r is None else _cut(t, np.array(r, dtype=np.int64))
                   for t, r in zip(texts, batch.column("ranges").to_pylist(), strict=True)]
            removed, spans, kept = zip(*out, strict=True) if out else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([len(t) for t in texts], pa.int64()), pa.array(removed, pa.int64()),
                 pa.array(spans, pa.int64()), pa.array(kept, pa.binary())],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])

    joined = rows.join(ranges, ["k1", "k2"], "left").select("doc_id", "text", "ranges")
    return joined.mapInArrow(run, f"doc_id {kind}, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary")


def _commit(spark: SparkSession, path: str, manifest: dict) -> None:
    spark.createDataFrame([(json.dumps(manifest),)], "manifest string").coalesce(1).write.mode("error").text(
        f"{path}/manifests/{manifest['version']:08d}")


def index_state(spark: SparkSession, path: str) -> dict:
    """The manifest in force: ``version``, ``length``, ``batches`` and ``levels`` with their ``rows``, largest first."""
    rows = spark.read.text(f"{path}/manifests/*").collect()  # one short row a version
    return max((json.loads(r["value"]) for r in rows), key=lambda m: m["version"])


def create_index(spark: SparkSession, path: str, length: int = LENGTH) -> None:
    """An empty index family in a new folder."""
    _commit(spark, path, {"version": 0, "length": length, "batches": [], "levels": []})


def _level(spark: SparkSession, path: str, name: str) -> DataFrame:
    return spark.read.schema(LEVEL).parquet(f"{path}/levels/{name}")


def _write_level(classes: DataFrame, path: str, name: str) -> int:
    """Classes in the order of their anchors; returns how many."""
    spark = classes.sparkSession
    classes.repartitionByRange("ahash", "chash").sortWithinPartitions("ahash", "chash").write.parquet(f"{path}/levels/{name}")
    return _level(spark, path, name).count()


def _merged(classes: DataFrame) -> DataFrame:
    """One row for each class; its place is in the newest batch that has it."""
    return classes.groupBy("ahash", "chash", "n").agg(
        F.sum("places").alias("places"), F.max(F.struct("batch", "rep")).alias("at")).select(
        "ahash", "chash", "n", "places", "at.rep", "at.batch")


def add_batch(spark: SparkSession, path: str, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Judge a batch against itself and all batches before it, and take it into the index.

    Returns what ``remove_repeats`` returns, for the rows of the batch; batches
    before are not judged again.  A batch without long texts adds no level.
    """
    state = index_state(spark, path)
    length, number = state["length"], len(state["batches"])
    rows = stored(_keyed(docs, id_col, text_col), "batch")
    runs = stored(_runs(rows, length), "runs")
    own = stored(_classes(runs).withColumn("batch", F.lit(number)), "own")
    classes = own
    for level in state["levels"]:  # logarithmically many
        classes = classes.unionByName(_level(spark, path, level["name"]).join(own.select("ahash").distinct(), "ahash", "left_semi"))
    classes = stored(_merged(classes), "met")
    anchors = classes.groupBy("ahash").agg(F.sum("places").alias("runs"), (F.min(F.struct("chash", "n"))
                                           != F.max(F.struct("chash", "n"))).alias("several")).where("runs > 1")
    found = stored(classes.join(anchors, "ahash").drop("runs"), "classes")
    wanted = found.where("several").select("ahash", "chash", "n", "batch", "rep.*")
    contexts = _contexts(rows, wanted.where(F.col("batch") == number), length)
    met = [r["batch"] for r in wanted.select("batch").distinct().collect() if r["batch"] != number]  # at most one a batch
    if met:
        texts = spark.read.schema("k1 bigint, k2 bigint, text string").parquet(
            *[f"{path}/texts/{state['batches'][i]}" for i in met])
        contexts = contexts.unionAll(_contexts(texts, wanted.where(F.col("batch") != number), length))
    ranges = stored(_ranges(runs, found, contexts, length), "ranges")

    name = uuid.uuid4().hex
    (rows.where(F.octet_length("text") >= length).groupBy("k1", "k2").agg(F.first("text").alias("text"))
     .write.option("compression", "zstd").parquet(f"{path}/texts/{name}"))
    levels = state["levels"]
    size = own.count()
    if size:
        merging = own
        while levels and 2 * size > levels[-1]["rows"]:
            merging = merging.unionByName(_level(spark, path, levels[-1]["name"]))
            size, levels = size + levels[-1]["rows"], levels[:-1]
        levels = levels + [{"name": name, "rows": _write_level(_merged(merging), path, name)}]
    _commit(spark, path, {**state, "version": state["version"] + 1, "batches": state["batches"] + [name], "levels": levels})
    return _without(rows, ranges)


def op6_suffix_dedup(spark, sf_dir: str) -> DataFrame:
    from vecspark.llm.common import table

    found = remove_repeats(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


OP6_SQL = r"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, encode(coalesce(text, '')) AS x FROM documents),
starts AS MATERIALIZED (
  SELECT r, i, md5(x[i + 1:i + 400]) AS h FROM d, unnest(range(0, octet_length(x) - 399)) AS t(i) WHERE octet_length(x) >= 400),
hits AS MATERIALIZED (SELECT r, i FROM starts JOIN (SELECT h FROM starts GROUP BY h HAVING count(*) > 1) USING (h)),
steps AS (SELECT r, i, coalesce(i > lag(i) OVER (PARTITION BY r ORDER BY i) + 400, TRUE)::INT AS step FROM hits),
groups AS (SELECT r, i, sum(step) OVER (PARTITION BY r ORDER BY i) AS g FROM steps),
spans AS MATERIALIZED (SELECT r, g, min(i) AS a, max(i) + 400 AS b FROM groups GROUP BY r, g),
pieces AS (
  SELECT r, a AS place, x[coalesce(lag(b) OVER (PARTITION BY r ORDER BY a), 0) + 1:a] AS piece FROM spans JOIN d USING (r)
  UNION ALL SELECT r, max(b), any_value(x)[max(b) + 1:octet_length(any_value(x))] FROM spans JOIN d USING (r) GROUP BY r),
kept AS (SELECT r, unhex(string_agg(hex(piece), '' ORDER BY place)) AS x FROM pieces GROUP BY r),
removed AS (SELECT r, sum(b - a) AS n_removed, count(*) AS n_spans FROM spans GROUP BY r)
SELECT doc_id, octet_length(d.x)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0) AS n_spans,
  sha256(coalesce(kept.x, d.x)) AS kept_sha256
FROM d LEFT JOIN removed USING (r) LEFT JOIN kept USING (r)
"""
