"""Language identification by error-correcting output codes.

Every learned language gets a binary codeword; for each bit one logistic
classifier over hashed byte n-grams (1 to 3 bytes of the lower-cased text,
each ASCII byte that is no letter read as a space) predicts the bit.  Decoding is loss-weighted: the language whose codeword
has the smallest sum of logistic losses over the bits wins, each bit
weighted by how well it did in training, and the softmax of the negative
losses is the score.  A score below ``ambiguous_below`` flags the text.

Texts are read whole: all n-grams of a text are counted.  Features depend
on the text alone.

Training uses a bounded sample: ``sample_rows`` rows (default 4,000), shared
equally by the languages and drawn evenly by a hash of the text over all
labelled rows; everything else covers all rows.  The sample's feature rows
(2**13 counts as sparse bytes, six for each that is not zero) are the only
thing that reaches the driver.

Defined results: a null or letterless text is ``und`` with score 0; rows
with null language are not learned from; without labelled rows every text
is ``und``; with one language every text with letters has it with score 1.
Repeated rows are judged alike, extra columns are ignored.
"""

from __future__ import annotations

import itertools
import re
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vecspark.llm.common import parts_of, texts_of
from vecspark.llm.words import LOWER

DIMS = 1 << 13
SAMPLE_ROWS = 4000
AMBIGUOUS_BELOW = 0.5
UNDETERMINED = "und"
_LETTERS_ONLY = np.where((np.arange(256) >= 128) | ((np.arange(256) >= 97) & (np.arange(256) <= 122)),
                         np.arange(256), 32).astype(np.uint8)[LOWER]
_LETTER = re.compile(r"[^\W\d_]")


def held_out(doc_id):
    """Column: crc32 of the id as text modulo 4 is 2 (null ids: false)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def code_book(n: int, seed: int = 5) -> np.ndarray:
    """``n`` codewords of 0 and 1: the exhaustive code up to 6 languages,
    beyond that the random columns with the largest smallest distance."""
    if n <= 1:
        return np.zeros((n, 0), dtype=np.int8)
    if n <= 6:
        columns = [c for c in itertools.product((0, 1), repeat=n) if c[0] == 1 and 0 in c]
        return np.array(columns, dtype=np.int8).T
    rng, bits, best = np.random.default_rng(seed), int(np.ceil(10 * np.log2(n))), (-1, None)
    for _ in range(200):
        book = rng.integers(0, 2, (n, bits), dtype=np.int8)
        if ((book.sum(0) == 0) | (book.sum(0) == n)).any():
            continue
        gap = (book[:, None] != book[None]).sum(2) + np.eye(n, dtype=int) * bits
        if gap.min() > best[0]:
            best = (gap.min(), book)
    return best[1]


def _slots(data: np.ndarray):
    """Feature slots of all 1-, 2- and 3-grams."""
    x = data.astype(np.uint32)
    yield x
    yield (x[:-1] * 331 + x[1:] * 7919 + 257) % DIMS
    yield (x[:-2] * 2693 + x[1:-1] * 331 + x[2:] * 7919 + 8191) % DIMS


def features(text: bytes) -> np.ndarray:
    """Damped n-gram counts of a whole text, of unit length."""
    data = _LETTERS_ONLY[np.frombuffer(text, dtype=np.uint8)]
    counts = np.zeros(DIMS, dtype=np.float32)
    for slots in _slots(data):
        if len(slots):
            counts += np.bincount(slots, minlength=DIMS)
    np.sqrt(counts, out=counts)
    norm = float(np.sqrt(counts @ counts))
    return counts / norm if norm else counts


@dataclass
class Model:
    """Learned languages, their codewords, and a linear classifier per bit."""

    languages: list[str]
    book: np.ndarray
    weights: np.ndarray  # DIMS x bits
    bias: np.ndarray
    trust: np.ndarray  # weight of each bit in decoding
    ambiguous_below: float = AMBIGUOUS_BELOW

    def decode(self, margins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Best language and its score for each row of bit margins."""
        sign = 2.0 * self.book - 1.0
        loss = np.logaddexp(0.0, -margins[:, None, :] * sign[None]) @ self.trust
        p = np.exp(loss.min(1, keepdims=True) - loss)
        best = loss.argmin(1)
        return best, p[np.arange(len(p)), best] / p.sum(1)

    def predict(self, texts: list[bytes]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """``(language, score, ambiguous)`` of whole texts."""
        names, score = [UNDETERMINED] * len(texts), np.zeros(len(texts))
        rows = [i for i, t in enumerate(texts) if t and self.languages and _LETTER.search(t.decode("utf-8", "replace"))]
        if rows and len(self.languages) == 1:
            score[rows] = 1.0
            best = np.zeros(len(rows), dtype=int)
        elif rows:
            margins = np.array([features(texts[i]) @ self.weights + self.bias for i in rows], dtype=np.float64)
            best, score[rows] = self.decode(margins)
        for i, b in zip(rows, best if rows else (), strict=True):
            names[i] = self.languages[b]
        return names, score, score < self.ambiguous_below


def _logistic(x: np.ndarray, y: np.ndarray, steps: int = 120, rate: float = 40.0, decay: float = 1e-5):
    """All bits at once: full-batch gradient steps with momentum, from zero."""
    w, b = np.zeros((x.shape[1], y.shape[1]), dtype=np.float32), np.zeros(y.shape[1], dtype=np.float32)
    vw, vb = np.zeros_like(w), np.zeros_like(b)
    for _ in range(steps):
        gap = 1 / (1 + np.exp(-np.clip(x @ w + b, -30, 30))) - y
        vw = 0.9 * vw - rate * (x.T @ gap / len(x) + decay * w)
        vb = 0.9 * vb - rate * 0.02 * gap.mean(0)
        w, b = w + vw, b + vb
    return w, b


def _sample(docs: DataFrame, sample_rows: int) -> tuple[DataFrame, int]:
    """About twice the wanted rows of each language, one of each text, by a hash of the text; and the wanted number.

    Copies of a text are one before a share is drawn, so they neither crowd the
    sample nor the driver, and the share leaves a dozen rows and more, so
    every language with a usable row is learned.
    """
    point = F.xxhash64("text", F.lit(41))
    rows = docs.withColumn("__point", point.bitwiseAND(F.lit((1 << 40) - 1)) / float(1 << 40))
    texts = rows.select("lang", point.alias("t")).distinct()
    sizes = {r["lang"]: r["n"] for r in texts.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    per_language = max(1, sample_rows // max(1, len(sizes)))
    share = F.lit(0.0)
    for lang, n in sizes.items():
        share = F.when(F.col("lang") == lang, min(1.0, (1.5 * per_language + 12) / n)).otherwise(share)
    drawn = rows.where(F.col("__point") <= share).groupBy("lang", "__point", F.xxhash64("text").alias("__text"))
    return drawn.agg(F.min("text").alias("text")).drop("__text"), per_language


def _first(drawn: DataFrame, per_language: int) -> DataFrame:
    """The wanted number of each language's drawn rows, by the same hash: no other's features are computed or sent."""
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("__point", F.xxhash64("text"), "text"))
    return drawn.withColumn("__rank", rank).where(F.col("__rank") <= per_language).drop("__rank")


def train(docs: DataFrame, text_col: str = "text", lang_col: str = "lang",
          sample_rows: int = SAMPLE_ROWS, ambiguous_below: float = AMBIGUOUS_BELOW) -> Model:
    """Fit on labelled rows (non-null language, text with letters)."""
    rows = (docs.select(F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"))
            .where(F.col("text").rlike(r"\p{L}") & F.col("lang").isNotNull()))

    def sparse(batches):
        for batch in batches:
            texts = texts_of(batch.column("text"))
            found = [features(t) for t in texts]
            kept = [np.flatnonzero(f).astype(np.uint16) for f in found]
            yield pa.RecordBatch.from_pydict({
                "lang": batch.column("lang"), "point": batch.column("__point"),
                "slots": [k.tobytes() for k in kept],
                "values": [f[k].tobytes() for f, k in zip(found, kept, strict=True)]})

    taken = _first(*_sample(rows, sample_rows)).mapInArrow(
        sparse, "lang string, point double, slots binary, values binary").toArrow()
    langs, points = taken.column("lang").to_pylist(), taken.column("point").to_pylist()
    order = sorted(range(len(langs)), key=lambda i: (langs[i], points[i], zlib.crc32(taken["slots"][i].as_buffer())))
    languages = sorted(set(langs))
    book = code_book(len(languages))
    if len(languages) < 2:
        return Model(languages, book, np.zeros((DIMS, 0)), np.zeros(0), np.zeros(0), ambiguous_below)
    x = np.zeros((len(order), DIMS), dtype=np.float32)
    for to, i in enumerate(order):  # from the Arrow buffers: no second copy of the sample is held
        x[to, np.frombuffer(taken["slots"][i].as_buffer(), dtype=np.uint16)] = np.frombuffer(taken["values"][i].as_buffer(), dtype=np.float32)
    which = np.array([languages.index(langs[i]) for i in order])
    del taken
    pa.default_memory_pool().release_unused()
    y = book[which].astype(np.float32)
    w, b = _logistic(x, y)
    right = (((x @ w + b) > 0) == (y > 0.5)).mean(0)
    trust = np.maximum(right - 0.5, 0.01) * 2
    return Model(languages, book, w, b, trust / trust.mean(), ambiguous_below)


def identify(docs: DataFrame, model: Model, text_col: str = "text", prefix: str = "lang_") -> DataFrame:
    """``docs`` with ``<prefix>pred``, ``<prefix>score`` and ``<prefix>ambiguous``.

    The model is broadcast: ``DIMS`` x bits floats, whatever the corpus.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = [f"{prefix}pred", f"{prefix}score", f"{prefix}ambiguous"]
    if clash := set(names) & set(docs.columns):
        raise ValueError(f"columns {sorted(clash)} exist already; choose another prefix")
    schema = T.StructType(docs.schema.fields + [T.StructField(names[0], T.StringType()),
                                                T.StructField(names[1], T.DoubleType()),
                                                T.StructField(names[2], T.BooleanType())])

    def run(batches):
        for batch in batches:
            texts = texts_of(batch.column(text_col))
            out = ([], [], [])
            for first, end in parts_of(texts, 1 << 22):
                for have, got in zip(out, shared.value.predict(texts[first:end]), strict=True):
                    have.extend(got)
            columns = [*batch.columns, pa.array(out[0], pa.string()), pa.array(out[1], pa.float64()),
                       pa.array([bool(x) for x in out[2]], pa.bool_())]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, *names])

    return docs.mapInArrow(run, schema)


def op7_language_id(spark, sf_dir: str) -> DataFrame:
    from vecspark.llm.common import table

    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = train(docs.where(~held_out(F.col("doc_id"))))
    rows = docs.select("doc_id", "text", held_out(F.col("doc_id")).alias("held_out"))
    return identify(rows, model).select("doc_id", "held_out", "lang_pred", F.col("lang_score").alias("score"),
                                        F.col("lang_ambiguous").alias("ambiguous"))
