"""Benchmark decontamination with a generalised suffix automaton.

Test items are normalised to words (A-Z lower-cased, maximal runs of
digits, letters and non-ASCII characters).  One automaton per block of
items accepts every run of consecutive item words.  Training texts are
streamed through it word by word; the state carries the longest suffix read
so far that occurs in an item.  Where that length reaches ``window`` words
(default 10) those words are hit; an item of fewer words counts as a whole.
``decontaminate`` removes the hit spans of a text whose spans or coverage
exceed the limits.

Words are compared by 64-bit fingerprints.  A run of words all of which
occur in some item is found in NumPy first; only such runs of at least the
shortest window reach the automaton, since every other word resets it.

Items are hashed on Spark and written once, long ones in segments that
overlap by a window less a word.  A benchmark of at most ``BLOCK_WORDS`` words
is one broadcast, and texts pass its automaton where they are.  Beyond that:

1. Items are dealt to blocks of about that many words.
2. A bit array of bounded size marks the fingerprints of all item windows;
   text windows on marked places are joined with the items' to pairs of a
   text and a block.  Most texts have none and are not moved.
3. The texts of a block are dealt to parts of about ``PART_TEXT`` bytes, so a
   block that very many texts hit is many tasks.  A task holds one block's
   automaton and one part.  Equal texts are scanned once.
4. Hit ranges and items of all blocks are put together for each text.

Defined results: null texts have no words; an item without words matches
nothing; a null item_id takes part in hits but is not listed or counted;
repeated item_ids are listed once; an empty benchmark leaves all clean;
repeated rows get equal results; texts are read whole, whatever their length;
extra columns, of any names, are carried in ``row``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vecspark.llm.common import parts_of, stored, string_list, texts_of
from vecspark.llm.jaccard_join import is_marked, marked_places
from vecspark.llm.words import ALNUM, PART_BYTES, Words, shingle_hashes

WINDOW = 10
BLOCK_WORDS = 100_000  # under 1 MB of fingerprints, about 100 MB as an automaton
PART_TEXT = 32 << 20
SMALL_ROWS, SMALL_BYTES = 1 << 20, 16 << 20  # most keys and most bytes of results that are broadcast
#: Limits of ``decontaminate``: spans of this many hit words are removed, and a text goes
#: when at least this share of its words is hit.
MIN_SPAN = 10
MAX_COVERAGE = 0.8


class SuffixAutomaton:
    """Generalised suffix automaton of word sequences.

    ``items`` are ``(label, words)``; ``labels[v]`` of a state holds the items
    with an occurrence of that state's window (``window`` words, or a whole
    shorter item).
    """

    def __init__(self, items: list[tuple[object, list[int]]], window: int):
        self.window = window
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        for _, words in items:
            last = 0
            for w in words:
                last = self._extend(last, w)
        self.labels: list[set | None] = [None] * len(self.next)
        self.short: list[int] = [0] * len(self.next)  # length of the whole short item that ends here
        self.above: list[int] = [-2] * len(self.next)  # nearest state up the links that ends a short item
        for label, words in items:
            size = min(window, len(words))
            state = matched = 0
            for w in words:
                state, matched = self.step(state, matched, w)
                if matched >= size:
                    at = self._at(state, size)
                    if self.labels[at] is None:
                        self.labels[at] = set()
                    self.labels[at].add(label)
                    if size < window:
                        self.short[at] = size

    def _extend(self, last: int, w: int) -> int:
        nxt, link, length = self.next, self.link, self.length
        if w in nxt[last]:
            q = nxt[last][w]
            return q if length[q] == length[last] + 1 else self._clone(last, w, q)
        cur = self._state({}, length[last] + 1)
        p = last
        while p >= 0 and w not in nxt[p]:
            nxt[p][w] = cur
            p = link[p]
        if p < 0:
            link[cur] = 0
        else:
            q = nxt[p][w]
            link[cur] = q if length[q] == length[p] + 1 else self._clone(p, w, q)
        return cur

    def _state(self, edges: dict, size: int) -> int:
        self.next.append(edges)
        self.link.append(0)
        self.length.append(size)
        return len(self.next) - 1

    def _clone(self, p: int, w: int, q: int) -> int:
        copy = self._state(dict(self.next[q]), self.length[p] + 1)
        self.link[copy] = self.link[q]
        self.link[q] = copy
        while p >= 0 and self.next[p].get(w) == q:
            self.next[p][w] = copy
            p = self.link[p]
        return copy

    def step(self, state: int, matched: int, w: int) -> tuple[int, int]:
        """Read a word: the state and length of the longest matching suffix."""
        while state and w not in self.next[state]:
            state = self.link[state]
            matched = self.length[state]
        if w in self.next[state]:
            return self.next[state][w], matched + 1
        return 0, 0

    def _at(self, state: int, size: int) -> int:
        """The state of the last ``size`` words of what ``state`` stands for."""
        while self.length[self.link[state]] >= size:
            state = self.link[state]
        return state

    def _shorts(self, state: int) -> int:
        """First state from ``state`` up the links that ends a whole short item, or -1."""
        chain = []
        while state > 0 and self.above[state] == -2:
            if self.short[state]:
                self.above[state] = state
                break
            chain.append(state)
            state = self.link[state]
        found = self.above[state] if state > 0 else -1
        for v in chain:
            self.above[v] = found
        return found

    def scan(self, words: list[int]) -> tuple[list[tuple[int, int]], set]:
        """Hit ranges ``[first, end)`` (they may overlap) and the items that occur."""
        ranges, found = [], set()
        state = matched = 0
        for i, w in enumerate(words):
            state, matched = self.step(state, matched, w)
            if matched >= self.window:
                ranges.append((i + 1 - matched, i + 1))
                if got := self.labels[self._at(state, self.window)]:
                    found |= got
            at = self._shorts(state)
            while at > 0:
                if self.short[at] <= matched:
                    ranges.append((i + 1 - self.short[at], i + 1))
                    found |= self.labels[at]
                at = self._shorts(self.link[at])
        return ranges, found


class _Block:
    """One block's automaton with its vocabulary."""

    def __init__(self, items: list[tuple[object, np.ndarray]], window: int):
        self.vocabulary = np.unique(np.concatenate([w for _, w in items]))
        self.shortest = min(min(window, len(w)) for _, w in items)
        self.automaton = SuffixAutomaton([(k, w.tolist()) for k, w in items], window)

    def scan(self, words: np.ndarray, first: np.ndarray, hit: np.ndarray, found: list[set]) -> None:
        """Mark hit words of consecutive texts and collect the items of each text."""
        place = np.searchsorted(self.vocabulary, words)
        known = self.vocabulary[np.minimum(place, len(self.vocabulary) - 1)] == words
        breaks = np.zeros(len(words) + 1, dtype=bool)
        breaks[first[:-1]] = True
        edge = np.flatnonzero(np.diff(np.concatenate(([0], known.astype(np.int8), [0]))))
        starts, ends = edge[::2], edge[1::2]
        long_enough = ends - starts >= self.shortest
        for s, e in zip(starts[long_enough], ends[long_enough], strict=True):
            cuts = [s, *(s + 1 + np.flatnonzero(breaks[s + 1:e])), e]
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                if b - a >= self.shortest:
                    ranges, items = self.automaton.scan(words[a:b].tolist())
                    for x, y in ranges:
                        hit[a + x:a + y] = True
                    if items:
                        found[int(np.searchsorted(first, a, side="right")) - 1] |= items


def _items(benchmark: DataFrame, window: int, id_col: str, text_col: str, block_words: int) -> DataFrame:
    """``item, words``: fingerprints of the items' words; every window lies whole in some segment of at most
    ``block_words`` windows."""

    def run(batches):
        for batch in batches:
            texts = texts_of(batch.column("text"))
            for a, b in parts_of(texts, PART_BYTES):
                w, row, found = Words(texts[a:b], ALNUM), [], []
                for i in range(b - a):
                    own = w.hash[w.text(i)].view(np.int64)
                    for at in range(0, max(len(own) - window + 1, min(len(own), 1)), block_words):
                        row.append(a + i), found.append(own[at:at + block_words + window - 1])
                if row:
                    ends = np.concatenate(([0], np.cumsum([len(x) for x in found])))
                    yield pa.RecordBatch.from_arrays(
                        [batch.column("item").take(pa.array(row)), string_list(np.concatenate(found), ends)], names=["item", "words"])

    rows = benchmark.select(F.col(f"`{id_col}`").cast("string").alias("item"), F.col(f"`{text_col}`").alias("text"))
    return rows.mapInArrow(run, "item string, words array<bigint>")


def _item_rows(items: pa.Table | pa.RecordBatch) -> list[tuple[str | None, np.ndarray]]:
    words = items.column("words")
    return [(k.as_py(), np.array(w.values).view(np.uint64)) for k, w in zip(items.column("item"), words, strict=True)]


def scan(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, text_col: str = "text",
         item_id_col: str = "item_id", item_text_col: str = "text", block_words: int = BLOCK_WORDS) -> DataFrame:
    """``docs`` (all columns, as struct ``row``) with ``n_words``, ``n_hit``,
    ``items`` (sorted ids) and ``spans`` (code point ``[start, end)`` pairs of
    maximal runs of hit words, each ending with its last word)."""
    items = stored(_items(benchmark, window, item_id_col, item_text_col, block_words), "items")
    size = items.agg(F.sum(F.size("words") + F.coalesce(F.length("item") / 8, F.lit(0)))).first()[0] or 0
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(f"`{text_col}`").alias("text"))
    if size <= block_words:
        return _scanned_in_place(packed, items, window)
    return _scanned_by_blocks(packed, items, window, block_words, int(size))


def _result_schema(packed: DataFrame) -> T.StructType:
    span = T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType()),
                         T.StructField("words", T.LongType())])
    return T.StructType([
        T.StructField("row", packed.schema["row"].dataType), T.StructField("n_words", T.LongType()), T.StructField("n_hit", T.LongType()),
        T.StructField("items", T.ArrayType(T.StringType())), T.StructField("spans", T.ArrayType(span))])


def _result_batch(row: pa.Array, out: list[list]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [row, pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.list_(pa.string())),
         pa.array(out[3], pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("words", pa.int64())])))],
        names=["row", "n_words", "n_hit", "items", "spans"])


def _scanned_in_place(packed: DataFrame, items: DataFrame, window: int) -> DataFrame:
    shared = packed.sparkSession.sparkContext.broadcast(_item_rows(items.toArrow()))

    def run(batches):
        block = _Block(shared.value, window) if shared.value else None
        for batch in batches:
            texts, out = texts_of(batch.column("text")), [[], [], [], []]
            for a, b in parts_of(texts, PART_BYTES):
                w = Words(texts[a:b], ALNUM)
                hit, found = np.zeros(len(w.hash), dtype=bool), [set() for _ in range(b - a)]
                if block:
                    block.scan(w.hash, w.first, hit, found)
                _collect(out, w, hit, found)
            yield _result_batch(batch.column("row"), out)

    return packed.mapInArrow(run, _result_schema(packed))


def _text_windows(texts: DataFrame, sizes: list[int], marks: np.ndarray) -> DataFrame:
    """``k1, k2, bytes, key`` of the texts' windows on marked places."""
    held = texts.sparkSession.sparkContext.broadcast(marks)

    def run(batches):
        for batch in batches:
            texts = texts_of(batch.column("text"))
            for a, b in parts_of(texts, PART_BYTES):
                w = Words(texts[a:b], ALNUM)
                text = np.repeat(np.arange(b - a), np.diff(w.first))
                for n in sizes:
                    if len(text) < n:
                        continue
                    keys, own = shingle_hashes(w.hash, n), text[:len(text) - n + 1]
                    at = np.flatnonzero((own == text[n - 1:]) & is_marked(held.value, keys))
                    own = own[at]
                    yield pa.RecordBatch.from_arrays(
                        [batch.column("k1").take(pa.array(own + a)), batch.column("k2").take(pa.array(own + a)),
                         pa.array(np.fromiter(map(len, texts[a:b]), np.int64, b - a)[own]), pa.array(keys[at].view(np.int64))],
                        names=["k1", "k2", "bytes", "key"])

    return texts.select("k1", "k2", "text").mapInArrow(run, "k1 bigint, k2 bigint, bytes bigint, key bigint")


def _block_windows(items: DataFrame, window: int) -> DataFrame:
    """``key, block, n``: distinct windows of the items, ``n`` words each."""

    def run(batches):
        for batch in batches:
            for (_, words), block in zip(_item_rows(batch), batch.column("block").to_pylist(), strict=True):
                keys = np.unique(shingle_hashes(words, window)).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys), pa.array(np.full(len(keys), block)),
                     pa.array(np.full(len(keys), min(window, len(words)), dtype=np.int32))], names=["key", "block", "n"])

    return items.mapInArrow(run, "key bigint, block bigint, n int").distinct()


def _hits_of_parts(window: int):
    """The cogroup's function: one block's items, and the texts of one part of those that it may hit."""

    def run(items: pa.Table, texts: pa.Table) -> pa.Table:
        block, bodies = _Block(_item_rows(items), window), texts_of(texts.column("text").combine_chunks())
        row, ranges, labels = [], [], []
        for a, b in parts_of(bodies, PART_BYTES):
            w = Words(bodies[a:b], ALNUM)
            hit, found = np.zeros(len(w.hash), dtype=bool), [set() for _ in range(b - a)]
            block.scan(w.hash, w.first, hit, found)
            for i in range(b - a):
                edge = np.flatnonzero(np.diff(np.concatenate(([0], hit[w.text(i)].astype(np.int8), [0]))))
                if len(edge):
                    row.append(a + i), ranges.append(edge), labels.append([x for x in found[i] if x is not None])
        at = pa.array(row, pa.int64())
        return pa.table([texts.column("k1").take(at), texts.column("k2").take(at), pa.array(ranges, pa.list_(pa.int32())),
                         pa.array(labels, pa.list_(pa.string()))], names=["k1", "k2", "ranges", "items"])

    return run


def _small(df: DataFrame, fits: bool) -> DataFrame:
    return F.broadcast(df) if fits else df


def _scanned_by_blocks(packed: DataFrame, items: DataFrame, window: int, block_words: int, size: int) -> DataFrame:
    rows = packed.select("row", "text", F.xxhash64("text").alias("k1"), F.xxhash64(F.lit(7), "text").alias("k2"))
    blocks = -(-size // block_words)
    items = items.distinct().withColumn("block", F.pmod(F.xxhash64("item", "words"), F.lit(blocks)))
    windows = stored(_block_windows(items, window), "windows")
    sizes = [r["n"] for r in windows.select("n").distinct().collect()]  # at most ``window``
    marks = marked_places(stored(windows.select("key").distinct(), "window_keys"))
    found = stored(_text_windows(rows, sizes, marks).distinct(), "text_windows")
    hits = stored(found.join(windows.select("key", "block"), "key").select("k1", "k2", "bytes", "block").distinct(), "hits")
    parts = hits.groupBy("block").agg(F.ceil(F.sum("bytes") / PART_TEXT).alias("parts"))
    keys = stored(hits.select("k1", "k2").distinct(), "hit_texts")
    own = rows.select("k1", "k2", "text").join(_small(keys, keys.count() <= SMALL_ROWS), ["k1", "k2"], "left_semi")
    own = own.groupBy("k1", "k2").agg(F.first("text").alias("text"))
    dealt = hits.join(parts, "block").withColumn("part", F.pmod(F.xxhash64("k2"), F.col("parts"))).select("k1", "k2", "block", "part")
    texts = dealt.join(own, ["k1", "k2"])
    copies = items.join(parts, "block").select("block", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1)).alias("part"),
                                               "item", "words")
    scanned = stored(copies.groupBy("block", "part").cogroup(texts.groupBy("block", "part")).applyInArrow(
        _hits_of_parts(window), "k1 bigint, k2 bigint, ranges array<int>, items array<string>"), "scanned")
    weight = scanned.agg(F.sum(64 + 4 * F.size("ranges") + F.aggregate("items", F.lit(0), lambda n, x: n + 8 + F.length(x)))).first()[0] or 0
    merged = scanned.groupBy("k1", "k2").agg(F.flatten(F.collect_list("ranges")).alias("ranges"),
                                             F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"))

    def run(batches):
        for batch in batches:
            texts, out = texts_of(batch.column("text")), [[], [], [], []]
            ranges, items = batch.column("ranges"), batch.column("items")
            for a, b in parts_of(texts, PART_BYTES):
                w = Words(texts[a:b], ALNUM)
                hit, labels = np.zeros(len(w.hash), dtype=bool), [set() for _ in range(b - a)]
                for i in range(b - a):
                    if ranges[a + i].is_valid:
                        for x, y in np.array(ranges[a + i].values).reshape(-1, 2):
                            hit[w.first[i] + x:w.first[i] + y] = True
                        labels[i].update(items[a + i].as_py())
                _collect(out, w, hit, labels)
            yield _result_batch(batch.column("row"), out)

    return rows.join(_small(merged, weight <= SMALL_BYTES), ["k1", "k2"], "left").select("row", "text", "ranges", "items").mapInArrow(
        run, _result_schema(packed))


def _collect(out: list[list], w: Words, hit: np.ndarray, found: list[set]) -> None:
    """Append ``n_words, n_hit, items, spans`` of a part's texts."""
    counts = np.concatenate(([0], np.cumsum(hit)))
    out[0].extend(np.diff(w.first).tolist())
    out[1].extend((counts[w.first[1:]] - counts[w.first[:-1]]).tolist())
    out[2].extend([sorted(x for x in f if x is not None) for f in found])
    out[3].extend(_spans(w, hit, i) if counts[w.first[i + 1]] > counts[w.first[i]] else [] for i in range(len(found)))


def _spans(w: Words, hit: np.ndarray, i: int) -> list[dict]:
    """Maximal runs of hit words of text ``i``, in code points of that text."""
    own = w.text(i)
    edge = np.flatnonzero(np.diff(np.concatenate(([0], hit[own].astype(np.int8), [0]))))
    starts, ends = w.start[own][edge[::2]], w.end[own][edge[1::2] - 1]
    base = w.text_start[i]
    points = np.concatenate(([0], np.cumsum((w.data[base:w.text_start[i + 1]] & 0xC0) != 0x80)))
    return [{"start": int(points[s - base]), "end": int(points[e - base]), "words": int(n)}
            for s, e, n in zip(starts, ends, edge[1::2] - edge[::2], strict=True)]


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, min_span: int = MIN_SPAN,
                  max_coverage: float = MAX_COVERAGE, text_col: str = "text", length_col: str | None = "n_chars",
                  **columns) -> DataFrame:
    """``docs`` with its columns, without contaminated passages.

    Spans of at least ``min_span`` hit words, or that are a whole shorter
    item, are cut out; a document goes when at least ``max_coverage`` of its
    words are hit.  Documents without hits stay as they are.
    """
    found = scan(docs, benchmark, window, text_col, **columns)
    keep = (F.col("n_hit") == 0) | (F.col("n_hit") < max_coverage * F.col("n_words"))
    # A run of fewer hit words than the window is always a whole short item.
    cut = F.filter("spans", lambda s: (s["words"] >= min_span) | (s["words"] < window))
    text = F.col("row")[text_col]
    starts = F.concat(F.array(F.lit(0).cast("long")), F.transform(cut, lambda s: s["end"]))
    ends = F.concat(F.transform(cut, lambda s: s["start"]), F.array(F.length(text).cast("long")))
    kept = F.array_join(F.zip_with(starts, ends, lambda a, b: F.substring(text, (a + 1).cast("int"), (b - a).cast("int"))), "")
    clean = F.when(F.size(cut) > 0, kept).otherwise(text)
    out = []
    for c in docs.columns:
        if c == text_col:
            out.append(clean.alias(c))
        elif c == length_col:
            out.append(F.when(F.size(cut) > 0, F.length(clean).cast(docs.schema[c].dataType))
                       .otherwise(F.col("row")[c]).alias(c))
        else:
            out.append(F.col("row")[c].alias(c))
    return found.where(keep).select(*out)


def op4_decontaminate(spark, sf_dir: str) -> DataFrame:
    from vecspark.llm.common import table

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = scan(docs, table(spark, sf_dir, "benchmark"))
    return found.select(
        F.col("row.doc_id").alias("doc_id"), "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"))


OP4_SQL = r"""
WITH d AS MATERIALIZED (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS MATERIALIZED (
  SELECT item_id::VARCHAR AS item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
win AS MATERIALIZED (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS g
  FROM b, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS t(i) WHERE len(w) > 0),
sizes AS (SELECT DISTINCT n FROM win),
grams AS (
  SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS g FROM d, sizes, unnest(range(1, len(w) - n + 2)) AS t(i)),
hits AS MATERIALIZED (SELECT doc_id, i, n, item_id FROM grams JOIN win USING (n, g)),
words AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM hits, unnest(range(i, i + n)) AS t(p) GROUP BY doc_id),
items AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, array_to_string(list_sort(list(DISTINCT item_id)), ',') AS ids
  FROM hits GROUP BY doc_id)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""
