"""Quality classifier: learned subword embeddings, averaged per document, with a softmax output.

Features of a text are its words, its doubled words (pairs of equal words side by side, which share one bucket: stuttering
is a mark of poor text whatever the word) and the character n-grams of its bytes with white space folded, each hashed to a
bucket; every bucket has a vector, a document is the mean of its features' vectors, and a softmax over a linear layer gives
the classes.  Training is plain numpy stochastic gradient descent on a bounded sample of labelled rows; a step takes all
features of a document, each different one once with its share.  Since averaging and the linear layer are both linear,
scoring folds them: each bucket carries its contribution to the logits, and a document's logits are the mean of its buckets'
contributions (the same numbers with one look-up per feature).

Scale: the sample is bounded by ``MAX_TRAIN_DOCS``; its texts become (bucket, count) pairs in parallel, at most ``BUCKETS`` a
text, and only these reach the one task that trains.  Scoring is a map-only pass over whole texts.  Long texts are read in
pieces; their features are counted in a table of ``BUCKETS`` numbers.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.sampling import labelled_sample, remainder
from strata.llm.textvec import MAX_BATCH_BYTES, SPACE_BYTES, Texts, mix64, pieces, slices, utf8

#: sample bound of training, in documents per label
MAX_TRAIN_DOCS = 1500
BUCKETS = 1 << 16
DIMENSIONS = 10
NGRAMS = (3, 4)
#: bucket of all word pairs whose two words are equal
DOUBLED = 0
EPOCHS, RATE = 6, 0.5
#: how much faster the vectors learn than the output layer: a bucket's share of a document is small
VECTOR_RATE = 8.0

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[SPACE_BYTES] = 0x20  # white space of any kind is one mark; letter case is kept: it tells about quality


def _ngrams(folded: np.ndarray, size: int) -> np.ndarray:
    """Bucket of the n-gram that starts at each byte."""
    n = max(len(folded) - size + 1, 0)
    packed = np.full(n, size, dtype=np.uint64)
    for j in range(size):
        packed <<= np.uint64(8)
        packed |= folded[j:j + n]
    return (mix64(packed) % np.uint64(BUCKETS)).astype(np.int32)


def features(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of every feature in the batch and the text that it belongs to."""
    starts, ends, text = texts.words()
    words = texts.hashes(starts, ends)
    doubled = text[1:][(words[1:] == words[:-1]) & (text[1:] == text[:-1])]
    found = [(words % np.uint64(BUCKETS)).astype(np.int32), np.full(len(doubled), DOUBLED, dtype=np.int32)]
    owner = [text.astype(np.int32), doubled.astype(np.int32)]
    folded = _FOLD[texts.buf].astype(np.uint64)
    place = np.repeat(np.arange(texts.n, dtype=np.int32), texts.ends + 1 - texts.starts)
    for size in NGRAMS:
        own = _ngrams(folded, size)
        n = len(own)
        inside = place[:n] == place[size - 1:] if n else np.zeros(0, dtype=bool)
        inside &= np.arange(n) + size <= texts.ends[place[:n]]
        found.append(own[inside])
        owner.append(place[:n][inside])
    return np.concatenate(found), np.concatenate(owner)


def feature_counts(text: bytes, size: int = MAX_BATCH_BYTES) -> np.ndarray:
    """Number of features in each bucket, of one text of any length (a piece at a time)."""
    counts, last = np.zeros(BUCKETS, dtype=np.int64), None
    for piece in pieces(text, size):
        own = Texts([piece])
        words = own.hashes(*own.words()[:2])
        counts += np.bincount((words % np.uint64(BUCKETS)).astype(np.int64), minlength=BUCKETS)
        if len(words):
            counts[DOUBLED] += np.count_nonzero(words[1:] == words[:-1]) + (last is not None and words[0] == last)
            last = words[-1]
    whole = np.frombuffer(text, dtype=np.uint8)
    for width in NGRAMS:
        for at in range(0, max(len(text) - width + 1, 0), size):
            own = _FOLD[whole[at:at + size + width - 1]].astype(np.uint64)
            counts += np.bincount(_ngrams(own, width), minlength=BUCKETS)
    return counts


@dataclass(frozen=True)
class Model:
    """Vectors of the buckets, output weights and bias; ``labels`` are the classes in the order of the outputs."""
    vectors: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    labels: tuple[int, ...]

    def folded(self) -> np.ndarray:
        """Contribution of each bucket to each logit (buckets x classes)."""
        return (self.vectors @ self.weights).astype(np.float32)

    def probabilities(self, texts: Texts, folded: np.ndarray) -> np.ndarray:
        bucket, text = features(texts)
        n = np.maximum(np.bincount(text, minlength=texts.n), 1)
        logits = np.stack([np.bincount(text, weights=folded[bucket, k], minlength=texts.n) / n + self.bias[k]
                           for k in range(len(self.labels))], axis=1)
        return _softmax(logits)

    def long_probabilities(self, text: bytes, folded: np.ndarray) -> np.ndarray:
        """``probabilities`` of one long text, from its counts."""
        counts = feature_counts(text)
        return _softmax((counts @ folded.astype(np.float64) / max(counts.sum(), 1) + self.bias)[None, :])


def _softmax(logits: np.ndarray) -> np.ndarray:
    e = np.exp(logits - logits.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def bag_of(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Different buckets of a text's features, ascending, and their counts."""
    counts = feature_counts(text)
    buckets = np.flatnonzero(counts)
    return buckets.astype(np.int32), counts[buckets].astype(np.int32)


def train(bags: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, classes: tuple[int, ...], seed: int = 7) -> Model:
    """Stochastic gradient descent, one document (its ``bag_of``) a step, with a linearly falling rate."""
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1, 1, (BUCKETS, DIMENSIONS)) / DIMENSIONS
    weights, bias = np.zeros((DIMENSIONS, len(classes))), np.zeros(len(classes))
    answer = np.searchsorted(classes, labels)
    counts = np.bincount(answer, minlength=len(classes))
    balance = len(answer) / (len(classes) * np.maximum(counts, 1))
    step, steps = 0, EPOCHS * len(bags)
    for _ in range(EPOCHS):
        for i in rng.permutation(len(bags)):
            rate = RATE * (1 - step / steps)
            step += 1
            buckets, n = bags[i]
            if not len(buckets):
                continue
            share = n / n.sum()
            own = vectors[buckets]
            hidden = share @ own
            logits = hidden @ weights + bias
            p = np.exp(logits - logits.max())
            p /= p.sum()
            p[answer[i]] -= 1
            p *= balance[answer[i]]
            back = weights @ p
            weights -= rate * np.outer(hidden, p)
            bias -= 0.1 * rate * p
            vectors[buckets] = own - (VECTOR_RATE * rate) * np.outer(share, back)
    return Model(vectors.astype(np.float32), weights.astype(np.float32), bias.astype(np.float32), classes)


def fit(documents: DataFrame, labels: DataFrame, label: str = "quality", fold: int = 3, held: int = 1,
        max_docs: int = MAX_TRAIN_DOCS) -> Model | None:
    """Train on a bounded sample of the labelled rows outside the held-out fold (``sampling.labelled_sample``); None
    without at least two labels and one text.
    """
    found = labelled_sample(documents, labels, label, fold, held, max_docs)
    if found is None:
        return None
    classes, sample = found

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text"):
                bags = [bag_of(t) for t in utf8(batch.column("text"))]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("label"), *(pa.array([bag[k].tobytes() for bag in bags], pa.binary()) for k in (0, 1))],
                    names=["label", "buckets", "counts"])

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = sorted(r for batch in batches for r in zip(*(batch.column(c).to_pylist() for c in ("label", "buckets", "counts")),
                                                          strict=True))
        if rows:
            bags = [(np.frombuffer(b, dtype=np.int32), np.frombuffer(n, dtype=np.int32)) for _, b, n in rows]
            model = train(bags, np.array([label for label, *_ in rows]), classes)
            yield pa.RecordBatch.from_arrays([pa.array([model.folded().tobytes()]), pa.array([model.bias.tobytes()])],
                                             names=["folded", "bias"])

    bags = sample.mapInArrow(count, "label int, buckets binary, counts binary")
    row = bags.repartition(1).mapInArrow(learn, "folded binary, bias binary").first()
    if row is None:
        return None
    folded = np.frombuffer(row["folded"], dtype=np.float32).reshape(BUCKETS, len(classes))
    # the folded table is the whole model for scoring: identity output weights
    return Model(folded, np.eye(len(classes), dtype=np.float32), np.frombuffer(row["bias"], dtype=np.float32), classes)


def score(documents: DataFrame, model: Model | None, positive: int = 1, fold: int = 3, held: int = 1) -> DataFrame:
    """Score of every whole text: (doc_id, held_out, score, predicted).

    ``score`` is the probability of label ``positive``.  Defined cases: null and empty texts have no features and get
    the softmax of the bias; without a model every score is 0.5; a null doc_id is not held out; repeated rows each get
    a row; other columns may have any name.
    """
    shipped = documents.sparkSession.sparkContext.broadcast(model)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shipped.value
        table = m.folded() if m else None
        for whole in batches:
            for batch in slices(whole, "text"):
                if m is None or positive not in m.labels:
                    p = np.full(batch.num_rows, 0.5)
                else:
                    texts = utf8(batch.column("text"))
                    long = len(texts) == 1 and len(texts[0]) > 2 * MAX_BATCH_BYTES
                    p = m.long_probabilities(texts[0], table) if long else m.probabilities(Texts(texts), table)
                    p = p[:, m.labels.index(positive)]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(p.astype(np.float64))],
                                                 names=["doc_id", "score"])

    kind = documents.schema["doc_id"].dataType.simpleString()
    return (documents.select("doc_id", "text").mapInArrow(apply, f"doc_id {kind}, score double")
            .select("doc_id", F.coalesce(remainder(F.col("doc_id"), fold) == held, F.lit(False)).alias("held_out"),
                    "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).cast("int").alias("predicted")))


def op7_subword_embeddings(spark, sf_dir: str) -> DataFrame:
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = fit(documents, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return score(documents, model)
