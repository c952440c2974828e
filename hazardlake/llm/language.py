"""Language identification by averaged hashed subword embeddings and a linear softmax.

A text is lower-cased and becomes its letters, with one gap for everything between words. Runs of
two and three of these symbols are subwords; each is hashed to a row of an embedding table. The
mean of the rows goes through a linear softmax. Table and softmax are trained together by
stochastic gradient descent in numpy on a bounded sample; a part of the sample that is not
trained on sets the temperature of the scores and the score below which a prediction is rejected.
Scoring folds table and softmax into one weight for each bucket and language.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hazardlake.llm.common import mix, slices

BUCKETS = 1 << 13
DIMENSION = 16
#: Bounds of the training sample: rows of a language, and languages (the most frequent ones).
PER_LANGUAGE = 600
LANGUAGES = 200
#: Length of the extracts that train the model on short texts beside the whole ones.
EXTRACT = 80
UNKNOWN = "und"
PRECISION = 0.99


@cache
def _letters() -> np.ndarray:
    """The code of each letter, 0 for any other character."""
    return np.fromiter((c if chr(c).isalpha() else 0 for c in range(0x110000)), np.uint32, 0x110000)


def subwords(texts: list[str], buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the subwords of all texts, and where those of each text begin (one more at the end)."""
    codes = np.frombuffer("\0".join(["", *texts, ""]).lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    # U+0000 within a text is a gap too; ends of texts are counted from lengths after lower-casing
    lengths = np.fromiter((len(t.lower()) for t in texts), np.int64, len(texts))
    begin = np.concatenate(([0], np.cumsum(lengths + 1)))
    symbols = _letters()[codes]
    keep = symbols > 0
    gap = ~keep
    keep[1:] |= gap[1:] & ~gap[:-1]
    keep[0] = True
    keep[begin[: len(texts)]] = True
    keep[-1] = True
    at = np.flatnonzero(keep)
    s = symbols[at].astype(np.uint64)
    first = np.searchsorted(at, begin)
    two = mix(s[:-1] * np.uint64(0x110000) + s[1:], 2)
    three = mix((s[:-2] * np.uint64(0x110000) + s[1:-1]) * np.uint64(0x110000) + s[2:], 3)
    out = np.full((len(s), 2), -1, np.int32)
    real = (s[:-1] > 0) | (s[1:] > 0)
    out[:-1, 0] = np.where(real, (two % np.uint64(buckets)).astype(np.int32), -1)
    # a run of three stands for its middle letter
    out[:-2, 1] = np.where(s[1:-1] > 0, (three % np.uint64(buckets)).astype(np.int32), -1)
    flat = out.ravel()
    used = flat >= 0
    counts = np.concatenate(([0], np.cumsum(used)))
    return flat[used], counts[2 * np.minimum(first, len(s))]


@dataclass
class Model:
    """Folded weights of a trained model."""

    languages: list[str]
    weights: np.ndarray  # bucket x language
    bias: np.ndarray
    temperature: float
    threshold: float

    def scores(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Probabilities (text x language), and which texts have a letter."""
        flat, bounds = subwords(texts)
        sizes = np.diff(bounds)
        known = sizes > 0
        logits = np.empty((len(texts), len(self.languages)))
        for k in range(len(self.languages)):
            sums = np.concatenate(([0.0], np.cumsum(self.weights[:, k][flat], dtype=np.float64)))
            logits[:, k] = (sums[bounds[1:]] - sums[bounds[:-1]]) / np.maximum(sizes, 1) + self.bias[k]
        return _softmax(logits / self.temperature), known


def _softmax(x: np.ndarray) -> np.ndarray:
    x = np.exp(x - x.max(1, keepdims=True))
    return x / x.sum(1, keepdims=True)


def train(
    rows: list[tuple[str, np.ndarray, np.ndarray]], *, epochs: int = 4, steps: int = 600, rate: float = 0.5, seed: int = 7
) -> Model | None:
    """A model from ``(language, buckets, counts)`` examples, after both so many epochs and steps; None without any."""
    if not rows:
        return None
    languages = sorted({r[0] for r in rows})
    label = {name: k for k, name in enumerate(languages)}
    y = np.array([label[r[0]] for r in rows])
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(rows))
    aside = order[: len(rows) // 5]
    trained = order[len(rows) // 5 :]

    def dense(chosen: np.ndarray) -> np.ndarray:
        x = np.zeros((len(chosen), BUCKETS), np.float32)
        for k, i in enumerate(chosen):
            x[k, rows[i][1]] = rows[i][2]
        return x / np.maximum(x.sum(1, keepdims=True), 1)

    table = rng.normal(0, 0.1, (BUCKETS, DIMENSION)).astype(np.float32)
    soft = rng.normal(0, 0.1, (DIMENSION, len(languages))).astype(np.float32)
    bias = np.zeros(len(languages), np.float32)
    past = [np.full(p.shape, 1e-6, np.float32) for p in (table, soft, bias)]
    for _ in range(max(epochs, -(-64 * steps // max(1, len(trained))))):
        rng.shuffle(trained)
        for at in range(0, len(trained), 64):
            some = trained[at : at + 64]
            x = dense(some)
            mean = x @ table
            error = _softmax(mean @ soft + bias).astype(np.float32)
            error[np.arange(len(some)), y[some]] -= 1
            error /= len(some)
            steps = (x.T @ (error @ soft.T), mean.T @ error, error.sum(0))
            for p, g, h in zip((table, soft, bias), steps, past, strict=True):
                h += g * g
                p -= rate * g / np.sqrt(h) * (0.2 if p is table else 0.1)
    weights = table @ soft
    held = np.concatenate([dense(aside[k : k + 256]) @ weights + bias for k in range(0, len(aside), 256)] or [np.zeros((0, len(languages)))])
    if not len(held):
        return Model(languages, weights, bias, 1.0, 0.0)
    truth = y[aside]
    temperatures = np.geomspace(0.05, 20, 60)
    losses = [-np.log(_softmax(held / t)[np.arange(len(truth)), truth] + 1e-12).mean() for t in temperatures]
    temperature = float(temperatures[int(np.argmin(losses))])
    p = _softmax(held / temperature)
    best, right = p.max(1), p.argmax(1) == truth
    # the least score from which on predictions are right as often as asked
    ranked = np.argsort(-best)
    precise = np.cumsum(right[ranked]) / np.arange(1, len(ranked) + 1) >= PRECISION
    threshold = float(best[ranked[np.flatnonzero(precise)[-1]]]) if precise.any() else 1.0
    return Model(languages, weights, bias, temperature, threshold)


def held_out(key, parts: int, part: int):
    """Whether crc32 of a key as text, modulo ``parts``, is ``part``; a null counts as the empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % parts == part


def _examples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        texts = [t or "" for t in batch.column("text").to_pylist()]
        names = batch.column("lang").to_pylist()
        lots = batch.column("lot").to_pylist()
        for k, t in enumerate(list(texts)):
            at = int(lots[k] * 1e9) % max(1, len(t) - EXTRACT)
            texts.append(t[at : at + EXTRACT])
            names.append(names[k])
        flat, bounds = subwords(texts)
        keep = [k for k in range(len(texts)) if bounds[k + 1] > bounds[k]]
        found = [np.unique(flat[bounds[k] : bounds[k + 1]], return_counts=True) for k in keep]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([names[k] for k in keep], pa.string()),
                pa.array([b for b, _ in found], pa.list_(pa.int32())),
                pa.array([np.maximum(1, np.round(c * min(1, 2000 / c.sum()))).astype(np.int32) for _, c in found], pa.list_(pa.int32())),
            ],
            names=["lang", "buckets", "counts"],
        )


def fit(labelled: DataFrame, *, per_language: int = PER_LANGUAGE, languages: int = LANGUAGES) -> Model | None:
    """A model from rows ``(doc_id, text, lang)``; None where no row has a language and a letter.

    The sample takes about ``per_language`` rows of each of the ``languages`` most frequent
    languages, drawn by a hash of ``doc_id`` and text; it is all that reaches the driver, as counts.
    """
    rows = labelled.select("doc_id", F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang")).filter(
        "lang is not null and text is not null"
    )
    counts = rows.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(languages)
    lot = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    sample = (
        rows.withColumn("lot", lot)
        .join(F.broadcast(counts), "lang")
        .filter(F.col("lot") * F.col("count") < per_language)
        .select("text", "lang", "lot")
        .limit(2 * per_language * languages)
    )
    found = sample.mapInArrow(_examples, "lang string, buckets array<int>, counts array<int>").toArrow()
    examples = [
        (name.as_py(), buckets.values.to_numpy(), counts.values.to_numpy())
        for name, buckets, counts in zip(*(found.column(c) for c in ("lang", "buckets", "counts")), strict=True)
    ]
    # the order of collected rows may differ from run to run, the model must not
    examples.sort(key=lambda e: (e[0], len(e[1]), e[1].tobytes(), e[2].tobytes()))
    return train(examples)


def identify(docs: DataFrame, model: Model | None) -> DataFrame:
    """``(row, language, score, rejected)`` for each row of ``docs``, from whole texts only.

    A null text and one without any letter are ``und`` with score 0, rejected; so is everything
    without a model. Other texts get the likeliest learned language, the first by name among
    equals, with its calibrated probability; ``rejected`` marks those below the threshold.
    Repeated rows get the same answer, an empty table gives an empty result.
    """
    whole = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("text").cast("string").alias("text")
    )
    shared = docs.sparkSession.sparkContext.broadcast(model)
    shape = T.StructType(
        [
            T.StructField("row", whole.schema["row"].dataType),
            T.StructField("language", T.StringType()),
            T.StructField("score", T.DoubleType()),
            T.StructField("rejected", T.BooleanType()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in slices(batches):
            texts = [t or "" for t in batch.column("text").to_pylist()]
            if model is None:
                names, scores, rejected = [UNKNOWN] * len(texts), [0.0] * len(texts), [True] * len(texts)
            else:
                p, known = model.scores(texts)
                names = [model.languages[k] if ok else UNKNOWN for k, ok in zip(p.argmax(1), known, strict=True)]
                scores = np.where(known, np.clip(p.max(1), 0, 1), 0.0)
                rejected = ~known | (scores < model.threshold)
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(names, pa.string()), pa.array(scores, pa.float64()), pa.array(rejected, pa.bool_())],
                names=["row", "language", "score", "rejected"],
            )

    return whole.mapInArrow(run, shape)
