"""Toxicity severity by cumulative-link ordinal regression on sparse word features.

The grades are ordered, 0 (none) to 3 (severe).  One weight vector is shared by all thresholds:
P(grade > k) = sigmoid(w . x - t_k) with t_0 < t_1 < t_2, and the expected severity is the sum of these probabilities.
Features are hashed words (folded to lower case, punctuation cut off) and word beginnings, each with the weight
log2(1 + count); only those that occur much more often in toxic texts are used, so a
long clean text gains nothing from its length.

The labels only say toxic or not.  Toxic training documents are graded by the amount of marker words - words whose
document frequency among toxic training documents is much higher than among the others: grades 1, 2 and 3 are the
thirds of that amount, summed as the features are.

Scale: the training sample is bounded by ``MAX_TRAIN_DOCS`` a label; its texts become (bucket, count) pairs in parallel, and
only these reach the one task that trains.  Scoring is a map-only pass over whole texts, long ones in pieces.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.sampling import labelled_sample, remainder
from strata.llm.textvec import MAX_BATCH_BYTES, Texts, pieces, slices, utf8

MAX_TRAIN_DOCS = 4000
BUCKETS = 1 << 20
#: training documents that a word must occur in to be a feature, the least chi-square of its document counts against
#: toxic or not (rare words would only be learned by heart), and how much more often toxic texts must have it
MIN_DOCS, MIN_CHI2 = 3, 11.0
MIN_ODDS = 4.0
STEPS, RATE, PENALTY = 800, 0.5, 2e-5
#: a marker word's smoothed odds of occurring in toxic against other documents
MARKER_ODDS = 8.0
GRADES = 4
FOLD, HELD = 5, 2

#: lengths in bytes of the word beginnings that are features, and what sets them apart from words
STEMS, STEM_MARK = (5, 6, 7), 0x5DEECE66D

# bytes of a word, after folding: digits, letters and everything beyond ASCII
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[0x41:0x5B] += 32
_WORD = np.zeros(256, dtype=bool)
_WORD[0x30:0x3A] = _WORD[0x61:0x7B] = _WORD[0x80:] = True


Counts = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]


def word_counts(texts: list[bytes]) -> Counts:
    """Distinct (text, bucket) pairs in order, their counts, and the number of words of each text.

    Texts are taken a batch of MAX_BATCH_BYTES at a time and longer ones in pieces, so memory follows the distinct words,
    not the characters.
    """
    parts, start, size = [], 0, 0
    for i, text in enumerate(texts):
        if size and size + len(text) > MAX_BATCH_BYTES:
            parts.append(_batch_counts(texts[start:i], start))
            start, size = i, 0
        if len(text) > 2 * MAX_BATCH_BYTES:
            parts.append(_long_counts(text, i))
            start, size = i + 1, 0
        else:
            size += len(text)
    parts.append(_batch_counts(texts[start:], start))
    return tuple(np.concatenate(column) for column in zip(*parts, strict=True))


def _long_counts(text: bytes, number: int) -> Counts:
    """``word_counts`` of one long text."""
    totals, n_words = np.zeros(BUCKETS, dtype=np.int64), 0
    for piece in pieces(text):
        _, bucket, counts, n = _batch_counts([piece], 0)
        totals[bucket] += counts
        n_words += n[0]
    bucket = np.flatnonzero(totals)
    return np.full(len(bucket), number), bucket, totals[bucket], np.array([n_words])


def _batch_counts(texts: list[bytes], first: int) -> Counts:
    """``word_counts`` of one batch, whose texts are numbered from ``first``."""
    batch = Texts([t.translate(_FOLD.tobytes()) for t in texts])
    starts, ends, text = batch.spans(_WORD)
    found, owner = [batch.hashes(starts, ends)], [text]
    for size in STEMS:
        longer = ends - starts > size
        found.append(batch.hashes(starts[longer], starts[longer] + size) ^ np.uint64(STEM_MARK))
        owner.append(text[longer])
    n_words = np.bincount(text, minlength=len(texts))
    text, bucket = np.concatenate(owner), (np.concatenate(found) % np.uint64(BUCKETS)).astype(np.int64)
    pairs, counts = np.unique(text.astype(np.int64) * BUCKETS + bucket, return_counts=True)
    return pairs // BUCKETS + first, pairs % BUCKETS, counts, n_words


@dataclass(frozen=True)
class Model:
    """Weight of each bucket (most are 0) and ascending thresholds."""
    weights: np.ndarray
    thresholds: np.ndarray

    def exceed(self, texts: list[bytes]) -> np.ndarray:
        """P(grade > k) for each text and k."""
        text, bucket, counts, _ = word_counts(texts)
        used = self.weights[bucket] != 0
        x = np.log2(1 + counts[used])
        latent = np.bincount(text[used], weights=x * self.weights[bucket[used]], minlength=len(texts))
        return 1 / (1 + np.exp(np.clip(self.thresholds[None, :] - latent[:, None], -60, 60)))


def grade(counted: Counts, toxic: np.ndarray) -> np.ndarray:
    """Ordered grades of training texts, given by their ``word_counts``, from the binary label (see the module text)."""
    text, bucket, counts, _ = counted
    total = toxic.sum(), len(toxic) - toxic.sum()
    seen = [np.bincount(bucket[toxic[text] == k], minlength=BUCKETS) for k in (1, 0)]
    odds = ((seen[0] + 0.5) / (total[0] + 1)) / ((seen[1] + 0.5) / (total[1] + 1))
    marker = (odds >= MARKER_ODDS) & (seen[0] >= MIN_DOCS)
    amount = np.bincount(text, weights=np.log2(1 + counts) * marker[bucket], minlength=len(toxic))
    cuts = np.quantile(amount[toxic == 1], np.arange(1, GRADES - 1) / (GRADES - 1)) if total[0] else []
    return np.where(toxic == 1, 1 + np.searchsorted(cuts, amount, side="right"), 0).clip(0, GRADES - 1)


def _associated(bucket: np.ndarray, toxic: np.ndarray, n: int, n_toxic: int) -> np.ndarray:
    """Which buckets' document counts depend on the label (chi-square of the 2 x 2 table), on the toxic side."""
    docs = np.bincount(bucket, minlength=BUCKETS).astype(float)
    a = np.bincount(bucket[toxic], minlength=BUCKETS).astype(float)
    b, c = docs - a, n_toxic - a
    d = n - n_toxic - b
    chi2 = n * (a * d - b * c) ** 2 / np.maximum(docs * (n - docs) * n_toxic * (n - n_toxic), 1e-9)
    likelier = (a + 0.5) / (n_toxic + 1) >= MIN_ODDS * (b + 0.5) / (n - n_toxic + 1)
    return (docs >= MIN_DOCS) & (chi2 >= MIN_CHI2) & likelier


def train(counted: Counts, grades: np.ndarray, grade_count: int = GRADES) -> Model:
    """Maximum likelihood with an L2 penalty, by gradient steps with per-weight rates (Adagrad)."""
    text, bucket, counts, _ = counted
    used = _associated(bucket, (grades > 0)[text], len(grades), int((grades > 0).sum()))[bucket]
    names, column = np.unique(bucket[used], return_inverse=True)
    row, x = text[used], np.log2(1 + counts[used])
    n, cuts = len(grades), grade_count - 1
    share = np.array([(grades > k).mean() for k in range(cuts)]).clip(1e-3, 1 - 1e-3)
    base, gaps = -np.log(share[0] / (1 - share[0])), np.zeros(cuts - 1)
    above = np.log(share / (1 - share))
    gaps[:] = np.log(np.maximum(above[:-1] - above[1:], 0.1))
    w, params = np.zeros(len(names)), np.concatenate(([base], gaps))
    sums = [np.full_like(w, 1e-8), np.full_like(params, 1e-8)]
    for _ in range(STEPS):
        t = params[0] + np.concatenate(([0], np.cumsum(np.exp(params[1:]))))
        latent = np.bincount(row, weights=x * w[column], minlength=n)
        p = 1 / (1 + np.exp(np.clip(t[None, :] - latent[:, None], -60, 60)))
        edges = np.concatenate((np.ones((n, 1)), p, np.zeros((n, 1))), axis=1)
        own = np.maximum(edges[np.arange(n), grades] - edges[np.arange(n), grades + 1], 1e-9)
        slope = np.concatenate((np.zeros((n, 1)), p * (1 - p), np.zeros((n, 1))), axis=1)
        low, high = slope[np.arange(n), grades] / own, slope[np.arange(n), grades + 1] / own
        d_latent = -(low - high) / n
        d_t = np.array([(low[grades == k + 1].sum() - high[grades == k].sum()) for k in range(cuts)]) / n
        d_params = np.concatenate(([d_t.sum()], [d_t[k + 1:].sum() * np.exp(params[1 + k]) for k in range(cuts - 1)]))
        d_w = np.bincount(column, weights=x * d_latent[row], minlength=len(w)) + PENALTY * w
        for value, step, total in ((w, d_w, sums[0]), (params, d_params, sums[1])):
            total += step * step
            value -= RATE * step / np.sqrt(total)
        np.maximum(w, 0, out=w)  # the features are signs of toxicity, never of its absence
    weights = np.zeros(BUCKETS)
    weights[names] = w
    return Model(weights, params[0] + np.concatenate(([0], np.cumsum(np.exp(params[1:])))))


def fit(documents: DataFrame, labels: DataFrame, label: str = "toxic", fold: int = FOLD, held: int = HELD,
        max_docs: int = MAX_TRAIN_DOCS) -> Model | None:
    """Train on a bounded sample of the labelled rows outside the held-out fold; None without both labels."""
    found = labelled_sample(documents, labels, label, fold, held, max_docs)
    if found is None:
        return None

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text"):
                bags = [word_counts([t])[1:3] for t in utf8(batch.column("text"))]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("label"), *(pa.array([b[k].astype(np.int32).tobytes() for b in bags], pa.binary()) for k in (0, 1))],
                    names=["label", "buckets", "counts"])

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = sorted(r for batch in batches for r in zip(*(batch.column(c).to_pylist() for c in ("buckets", "counts", "label")),
                                                          strict=True))
        if rows:
            bags = [(np.frombuffer(b, dtype=np.int32), np.frombuffer(n, dtype=np.int32)) for b, n, _ in rows]
            toxic = np.array([int(label > 0) for *_, label in rows])
            counted = (np.repeat(np.arange(len(bags)), [len(b) for b, _ in bags]),
                       np.concatenate([b for b, _ in bags]).astype(np.int64), np.concatenate([n for _, n in bags]).astype(np.int64),
                       np.zeros(0))
            model = train(counted, grade(counted, toxic))
            at = np.flatnonzero(model.weights)
            yield pa.RecordBatch.from_arrays([pa.array([at.astype(np.int64).tobytes()]), pa.array([model.weights[at].tobytes()]),
                                              pa.array([model.thresholds.tobytes()])], names=["at", "weights", "thresholds"])

    bags = found[1].mapInArrow(count, "label int, buckets binary, counts binary")
    row = bags.repartition(1).mapInArrow(learn, "at binary, weights binary, thresholds binary").first()
    if row is None:
        return None
    weights = np.zeros(BUCKETS)
    weights[np.frombuffer(row["at"], dtype=np.int64)] = np.frombuffer(row["weights"])
    return Model(weights, np.frombuffer(row["thresholds"]))


def score(documents: DataFrame, model: Model | None, fold: int = FOLD, held: int = HELD) -> DataFrame:
    """Severity of every whole text: (doc_id, held_out, severity, grade, score, toxic).

    ``severity`` is the expected grade (0 to 3), ``grade`` the most likely one, ``score`` = P(grade >= 1), and
    ``toxic`` is score >= 0.5.  Defined cases: null and empty texts have no words and severity 0; without a model
    everything is 0; a null doc_id is not held out; repeated rows each get a row; other columns may have any name.
    """
    shipped = documents.sparkSession.sparkContext.broadcast(model)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shipped.value
        for whole in batches:
            for batch in slices(whole, "text"):
                texts = utf8(batch.column("text"))
                over = m.exceed(texts) if m else np.zeros((len(texts), GRADES - 1))
                over[[not t for t in texts]] = 0
                edges = np.concatenate((np.ones((len(texts), 1)), over, np.zeros((len(texts), 1))), axis=1)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), pa.array(over.sum(axis=1)),
                     pa.array(np.argmax(edges[:, :-1] - edges[:, 1:], axis=1).astype(np.int32)), pa.array(over[:, 0])],
                    names=["doc_id", "severity", "grade", "score"])

    kind = documents.schema["doc_id"].dataType.simpleString()
    return (documents.select("doc_id", "text")
            .mapInArrow(apply, f"doc_id {kind}, severity double, grade int, score double")
            .select("doc_id", F.coalesce(remainder(F.col("doc_id"), fold) == held, F.lit(False)).alias("held_out"),
                    "severity", "grade", "score", (F.col("score") >= 0.5).alias("toxic")))


def op10_cumulative_link(spark, sf_dir: str) -> DataFrame:
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return score(documents, fit(documents, spark.read.parquet(f"{sf_dir}/labels.parquet")))
