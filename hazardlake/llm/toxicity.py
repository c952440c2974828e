"""Toxicity by multiple-instance learning: a document is a bag of sentences.

A sentence has a logistic score over its hashed words, above what a sentence without any
evidence has; that one scores 0, so that length alone makes no document toxic. A document is toxic unless
none of its sentences is: the scores are combined by a noisy-or, with a leak for labels that no
sentence explains. Only labels of documents train the weights; the sentence scores then say where the
offence stands.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hazardlake.llm.common import LOWER, slices, span_hashes, texts_of
from hazardlake.llm.span_dedup import sentences_of

BUCKETS = 1 << 18
#: Bound of the training sample, rows of each label.
PER_LABEL = 2000
THRESHOLD = 0.3
#: Bytes of text that a worker looks at together.
SLICE = 1 << 18

#: ASCII letters and whatever is not ASCII make words.
_WORD = np.array([97 <= b <= 122 or b >= 128 for b in range(256)])


def _logistic(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def _divergence(p: np.ndarray, q: float) -> np.ndarray:
    """Relative entropy of two chances."""
    q = min(max(q, 1e-9), 1 - 1e-9)
    p = np.clip(p, 1e-12, 1 - 1e-12)
    return p * np.log(p / q) + (1 - p) * np.log((1 - p) / (1 - q))


class Bags:
    """Words of a slice of texts with the sentence of each, and the sentences of each text."""

    def __init__(self, texts: list[bytes]):
        data = np.frombuffer(b"\n".join([*texts, b""]).translate(LOWER), np.uint8)
        lengths = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
        begin = np.cumsum(lengths) - lengths
        ends = [sentences_of(t) if t else [] for t in texts]
        self.counts = np.fromiter((len(e) for e in ends), np.int64, len(texts))
        #: ends of all sentences, as offsets in the slice and in their text
        self.ends = np.concatenate([np.array(e, np.int64) for e in ends] or [np.zeros(0, np.int64)])
        self.text = np.repeat(np.arange(len(texts)), self.counts)
        inside = np.concatenate(([False], _WORD[data], [False]))
        edge = np.flatnonzero(inside[1:] != inside[:-1])
        starts, stops = edge[::2], edge[1::2]
        self.sentence = np.searchsorted(self.ends + begin[self.text], starts, "right")
        self.word = (span_hashes(data, starts, stops) % np.uint64(BUCKETS)).astype(np.int32)


#: Log-odds of a sentence without evidence; only what lies above counts.
BIAS = -6.0


def _odds(sums: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Logistic values of sentences, and the logarithms of their chances not to be toxic."""
    z = np.maximum(sums, 0) + BIAS
    return _logistic(z), np.log1p(np.exp(BIAS)) - np.logaddexp(0, z)


@dataclass
class Model:
    weights: np.ndarray
    leak: float

    def sentence_scores(self, bags: Bags) -> np.ndarray:
        sums = np.bincount(bags.sentence, self.weights[bags.word], len(bags.ends))
        return -np.expm1(_odds(sums)[1])

    def scores(self, bags: Bags, sentences: np.ndarray) -> np.ndarray:
        """One score for each text: the noisy-or of its sentences and the leak."""
        silent = np.bincount(bags.text, np.log1p(-np.minimum(sentences, 1 - 1e-12)), len(bags.counts))
        return np.clip(1 - (1 - self.leak) * np.exp(silent), 0, 1)


@dataclass
class Sample:
    """Documents as flat arrays, one behind the other."""

    label: np.ndarray
    importance: np.ndarray
    words: np.ndarray  # hashed words of all documents
    n_words: np.ndarray  # of each document
    sizes: np.ndarray  # words of each sentence
    n_sentences: np.ndarray  # of each document


def train(
    sample: Sample,
    *,
    steps: int = 300,
    rate: float = 0.3,
    penalty: float = 1e-5,
    evidence: float = 16.0,
) -> Model:
    """A model of the sample.

    Full gradients of the likelihood of the labels, adaptive steps, and soft thresholds that
    pull weights to zero. A word gets a weight only if its share of toxic documents differs
    from that of all documents more than chance explains (Chernoff bound ``evidence``, about
    one in ten million), so that wrong labels are left to the leak.
    """
    n_documents = len(sample.label)
    if not n_documents:
        return Model(np.zeros(BUCKETS, np.float32), 0.0)
    y = sample.label.astype(np.float64)
    importance = sample.importance / sample.importance.sum()
    words, sizes = sample.words, sample.sizes
    document = np.repeat(np.arange(n_documents, dtype=np.int64), sample.n_words)
    pairs = np.unique(words * np.int64(n_documents) + document)
    n = np.bincount(pairs // n_documents, minlength=BUCKETS)
    toxic_n = np.bincount(pairs // n_documents, y[pairs % n_documents], BUCKETS)
    del pairs, document
    known = np.flatnonzero(n * _divergence(toxic_n / np.maximum(n, 1), y.mean()) > evidence)
    place = np.full(BUCKETS, -1, np.int64)
    place[known] = np.arange(len(known))
    use = np.flatnonzero(place[words] >= 0)
    word = place[words[use]]
    sentence = np.searchsorted(np.cumsum(sizes), use, "right")
    owner = np.repeat(np.arange(n_documents), sample.n_sentences)
    w = np.zeros(len(known))
    leak = -3.0
    past, past_leak = np.full(len(known), 1e-10), 1e-10
    for _ in range(steps):
        sums = np.bincount(sentence, w[word], len(sizes))
        p, quiet = _odds(sums)
        p = np.where(sums >= 0, p, 0)
        base = _logistic(np.array([leak]))[0]
        silent = np.bincount(owner, quiet, n_documents) + np.log1p(-base)
        toxic = np.maximum(-np.expm1(silent), 1e-9)
        # derivative of the loss by the log-odds of a sentence is this, times its score
        pull = importance * np.where(y > 0, -np.exp(silent) / toxic, 1.0)
        by_sentence = pull[owner] * p
        grad = np.bincount(word, by_sentence[sentence], len(known))
        past += grad * grad
        step = rate / np.sqrt(past)
        w -= step * grad
        w = np.sign(w) * np.maximum(np.abs(w) - step * penalty, 0)
        g = (pull * base).sum()
        past_leak += g * g
        leak -= rate * g / np.sqrt(past_leak)
    weights = np.zeros(BUCKETS, np.float32)
    weights[known] = w
    return Model(weights, float(_logistic(np.array([leak]))[0]))


def _bagged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, size=SLICE):
        bags = Bags(texts_of(batch))
        per_sentence = np.bincount(bags.sentence, minlength=len(bags.ends))
        first = np.concatenate(([0], np.cumsum(bags.counts)))
        at = np.concatenate(([0], np.cumsum(per_sentence)))
        rows = range(batch.num_rows)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                batch.column("label"),
                batch.column("importance"),
                pa.array([bags.word[at[first[k]] : at[first[k + 1]]] for k in rows], pa.list_(pa.int32())),
                pa.array([per_sentence[first[k] : first[k + 1]] for k in rows], pa.list_(pa.int32())),
            ],
            names=["doc_id", "label", "importance", "words", "sizes"],
        )


def fit(docs: DataFrame, labels: DataFrame, *, per_label: int = PER_LABEL) -> Model:
    """A model from texts of ``docs`` and ``labels (doc_id, label)``, label 0 or 1.

    About ``per_label`` documents of each label are drawn by a hash of ``doc_id``, weighted back
    to the shares of the labels; they are all that reaches the driver, as hashed words. A
    document with several labels is toxic if one says so; null labels and null ids do not count.
    """
    known = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("label").cast("int").alias("label"))
        .filter("doc_id is not null and label in (0, 1)")
        .groupBy("doc_id")
        .agg(F.max("label").alias("label"))
    )
    totals = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    lot = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    share = F.lit(1.0)
    for label, count in totals.items():
        share = F.when(F.col("label") == label, F.lit(min(1.0, per_label / count))).otherwise(share)
    chosen = known.withColumn("importance", 1 / share).filter(lot < share).limit(4 * per_label)
    rows = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
        .join(F.broadcast(chosen), "doc_id")
        .dropDuplicates(["doc_id"])
        .select("doc_id", "label", "importance", "text")
        .mapInArrow(_bagged, "doc_id long, label int, importance double, words array<int>, sizes array<int>")
        .toArrow()
        # the order of collected rows may differ from run to run, the model must not
        .sort_by("doc_id")
        .combine_chunks()
    )

    def flat(name: str) -> tuple[np.ndarray, np.ndarray]:
        lists = pa.concat_arrays(rows.column(name).chunks or [pa.array([], pa.list_(pa.int32()))])
        return lists.flatten().to_numpy(), lists.value_lengths().to_numpy()

    words, n_words = flat("words")
    sizes, n_sentences = flat("sizes")
    label, importance = (rows.column(c).to_numpy() for c in ("label", "importance"))
    return train(Sample(label, importance, words, n_words, sizes, n_sentences))


def score_documents(docs: DataFrame, model: Model, *, threshold: float = THRESHOLD) -> DataFrame:
    """``(row, score, offending)`` for each row of ``docs``, from whole texts only.

    ``offending`` lists the sentences whose own score reaches ``threshold`` as
    ``(start, end, score)`` in characters of the text, in their order. A null or empty text has
    no sentence: its score is the leak alone. Repeated rows get the same answer, an empty table
    gives an empty result.
    """
    whole = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("text").cast("string").alias("text")
    )
    spot = T.StructType(
        [T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()), T.StructField("score", T.DoubleType())]
    )
    shape = T.StructType(
        [
            T.StructField("row", whole.schema["row"].dataType),
            T.StructField("score", T.DoubleType()),
            T.StructField("offending", T.ArrayType(spot)),
        ]
    )
    shared = docs.sparkSession.sparkContext.broadcast(model)
    spots = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in slices(batches, size=SLICE):
            texts = texts_of(batch)
            bags = Bags(texts)
            sentences = model.sentence_scores(bags)
            offending = [[] for _ in texts]
            for k in np.flatnonzero(sentences >= threshold).tolist():
                text = texts[bags.text[k]]
                start = int(bags.ends[k - 1]) if k and bags.text[k - 1] == bags.text[k] else 0
                before = len(text[:start].decode())
                offending[bags.text[k]].append(
                    {"start": before, "end": before + len(text[start : bags.ends[k]].decode()), "score": float(sentences[k])}
                )
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(model.scores(bags, sentences)), pa.array(offending, spots)],
                names=["row", "score", "offending"],
            )

    return whole.mapInArrow(run, shape)
