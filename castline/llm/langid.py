"""Language identification by a string kernel (operator 7).

The kernel of two texts is the blended-spectrum presence kernel: the number of
distinct byte n-grams (n = 1 to ``MAX_N``, lower case) they share, over the root
of the product of their own numbers.  N-grams are hashed to ``DIM`` places.

Fitting takes a bounded sample: ``TRAIN_ROWS`` labelled rows, shared out evenly
to the languages and taken in the order of a hash of the id; ``LANDMARKS`` of
them are the Nyström landmarks.  Features are the kernel values to the landmarks
times the inverse root of the landmarks' own kernel matrix; one ridge regression
for each language against the rest gives the weights.  As the kernel is a scalar
product, landmarks and weights multiply out to one matrix of ``DIM`` rows, and a
batch of documents is scored by one matrix product.

Rows whose ``crc32`` of the id as text leaves 2 on division by 4 are held out:
they are never fitted on.  Language, source and id are no inputs of a prediction.

Defined results: null text, or text without a letter, is ``und`` with score 0; no
labelled row at all makes every row ``und``; ties go to the first language by
name; a null id is held out by the remainder of the empty text (0: it is not);
repeated rows are each predicted; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from castline.llm.arrow import batch, slices
from castline.llm.common import staged, table

MAX_N = 4
DIM = 1 << 15
#: Bounds of the sample that is fitted on, over all languages.
TRAIN_ROWS = 2_000
LANDMARKS = 200
RIDGE = 1e-2
HOLD_OUT, FOLDS = 2, 4
UNKNOWN = "und"


def presence(text: str | None, out: np.ndarray) -> None:
    """Mark the hashed n-grams of a whole text in a zeroed row of DIM."""
    data = np.frombuffer((text or "").lower().encode(), np.uint8).astype(np.uint32)
    key = np.zeros(len(data), np.uint32)
    with np.errstate(over="ignore"):
        for n in range(1, MAX_N + 1):
            if len(data) < n:
                return
            key = key[:len(data) - n + 1] * np.uint32(0x01000193) + data[n - 1:] + np.uint32(n)
            out[(key * np.uint32(0x9E3779B1)) >> np.uint32(32 - DIM.bit_length() + 1)] = 1


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


@dataclass
class Model:
    languages: list[str]
    weights: np.ndarray      # DIM x languages
    bias: np.ndarray

    def scores(self, x: np.ndarray) -> np.ndarray:
        """One row of regression values for each row of presences."""
        size = np.sqrt(np.maximum(x.sum(1, keepdims=True), 1))
        return x @ self.weights / size + self.bias


def unit_rows(bits: np.ndarray) -> np.ndarray:
    """Rows of length 1 from rows of packed presences."""
    x = np.unpackbits(bits, axis=1).astype(np.float32)
    return x / np.sqrt(np.maximum(x.sum(1, keepdims=True), 1))


def fit(bits: np.ndarray, y: list[str], landmarks: int = LANDMARKS, ridge: float = RIDGE, step: int = 128) -> Model:
    """Nyström features and one-versus-rest kernel ridge regression; rows are unpacked ``step`` at a time."""
    languages = sorted(set(y))
    if not languages:
        return Model([], np.zeros((DIM, 0), np.float32), np.zeros(0, np.float32))
    # Landmarks in turn from each language, as the sample gives them.
    turn = sorted(range(len(y)), key=lambda i: (y[:i].count(y[i]), y[i]))[:landmarks]
    marks = unit_rows(bits[turn])
    values, vectors = np.linalg.eigh((marks @ marks.T).astype(np.float64))
    keep = values > 1e-9 * values.max()
    root = vectors[:, keep] / np.sqrt(values[keep])
    kernel = [unit_rows(bits[k:k + step]) @ marks.T for k in range(0, len(y), step)]
    features = np.concatenate(kernel).astype(np.float64) @ root
    target = np.where(np.array(y)[:, None] == np.array(languages)[None, :], 1.0, -1.0)
    share = np.array([y.count(k) for k in y], float)
    w = (1 / share)[:, None]                      # each language weighs the same
    mean, goal = (features * w).sum(0) / w.sum(), (target * w).sum(0) / w.sum()
    centred = features - mean
    solved = np.linalg.solve(centred.T @ (centred * w) + ridge * np.eye(features.shape[1]), centred.T @ ((target - goal) * w))
    weights = marks.T @ (root @ solved).astype(np.float32)
    return Model(languages, weights, (goal - mean @ solved).astype(np.float32))


def held_out() -> F.Column:
    return F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), F.lit(FOLDS)) == HOLD_OUT


def sample(docs: DataFrame, rows: int = TRAIN_ROWS) -> tuple[np.ndarray, list[str]]:
    """Packed presences and languages of at most ``rows`` labelled rows outside the held-out fold."""
    known = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
    counts = {r[0]: r[1] for r in known.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(rows).collect()}
    if not counts:
        return np.zeros((0, DIM // 8), np.uint8), []
    each = max(rows // len(counts), 1)
    # A cut on the hash of the id leaves about 1.5 * each rows of a language; the first of them by hash are taken.
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    cut = F.create_map(*[F.lit(v) for k, n in counts.items() for v in (k, min(1.0, (1.5 * each + 50) / n))])
    chosen = known.select("doc_id", "lang", "text", place.alias("place")).where(F.col("place") < cut[F.col("lang")])
    schema = pa.schema([("lang", pa.string()), ("place", pa.float64()), ("doc_id", pa.int64()), ("bits", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            x = np.zeros((b.num_rows, DIM), np.uint8)
            for i, text in enumerate(b.column(2).to_pylist()):
                presence(text, x[i])
            yield batch(schema, b.column(1), b.column(3), b.column(0), [r.tobytes() for r in np.packbits(x, axis=1)])

    made = staged(chosen.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"),
                                F.col("text").cast("string").alias("text"), "place")
                  .mapInArrow(run, "lang string, place double, doc_id bigint, bits binary"), "langid-sample")
    got = [r for lang in sorted(counts)
           for r in made.where(F.col("lang") == lang).orderBy("place", "doc_id", "bits").limit(each).collect()]
    return np.stack([np.frombuffer(r["bits"], np.uint8) for r in got]), [r["lang"] for r in got]


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, lang_pred, score`` of every document."""
    schema = pa.schema([("doc_id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64())])
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Model = sent.value
        for b in slices(batches):
            texts = b.column(1).to_pylist()
            x = np.zeros((len(texts), DIM), np.float32)
            known = [bool(model.languages) and has_letter(t) for t in texts]
            for i, text in enumerate(texts):
                if known[i]:
                    presence(text, x[i])
            if not model.languages:
                yield batch(schema, b.column(0), [UNKNOWN] * len(texts), [0.0] * len(texts))
                continue
            values = model.scores(x)
            best = values.argmax(1)
            # A value of -1 (the rest) to 1 (the language) becomes a score of 0 to 1.
            top = np.clip((values[np.arange(len(texts)), best] + 1) / 2, 0, 1)
            yield batch(schema, b.column(0), [model.languages[k] if ok else UNKNOWN for k, ok in zip(best, known, strict=True)],
                        [float(s) if ok else 0.0 for s, ok in zip(top, known, strict=True)])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        run, "doc_id bigint, lang_pred string, score double")


def identify(docs: DataFrame) -> DataFrame:
    model = fit(*sample(docs))
    return predict(docs, model).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(table(spark, sf_dir, "documents"))
