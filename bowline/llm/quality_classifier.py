"""Quality classifier: logistic regression on hashed word n-grams, trained by follow-the-regularised-leader updates.

The tokens of a text are its runs of letters and digits and its runs of other signs. Token 1-grams and 2-grams are
hashed into ``BUCKETS`` features of value log(1 + count), scaled to length 1; a document's score is one sparse dot
product with the weights. Learners are fitted side by side, each on a part of the labelled documents, in an order given
by a hash, with the per-coordinate FTRL-proximal update after each document; the model is their mean.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bowline.llm.bytewords import U64, WordHasher, chain
from bowline.llm.common import unused
from bowline.staging import stage

cloudpickle.register_pickle_by_value(sys.modules[__name__])

BUCKETS = 1 << 18
# At most about so many labelled documents are used for training, those of the lowest hashes.
MAX_TRAINING = 200_000
PER_LEARNER = 4_000


@dataclass(frozen=True)
class Ftrl:
    """alpha, beta: learning rate; l1, l2: penalties; passes over a learner's documents."""

    alpha: float = 8.0
    beta: float = 1.0
    l1: float = 0.01
    l2: float = 0.0
    passes: int = 4


def token_classes() -> np.ndarray:
    """1: letters, digits and all bytes beyond ASCII; 2: other signs; 0: white space and control bytes."""
    out = np.full(256, 2, np.uint8)
    out[:33] = 0
    out[127] = 0
    for low, high in ((48, 57), (65, 90), (97, 122), (128, 255)):
        out[low : high + 1] = 1
    return out


def features_of(hasher: WordHasher, column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """(lo, hi, features, values, firsts) for slices of the column; the last feature of a text is the constant."""
    for lo, hi, tokens, firsts in hasher.slices(column):
        owner = np.repeat(np.arange(hi - lo), np.diff(firsts))
        pairs = chain(tokens[:-1], tokens[1:])[owner[:-1] == owner[1:]] if len(tokens) > 1 else tokens[:0]
        of_pairs = owner[:-1][owner[:-1] == owner[1:]] if len(tokens) > 1 else owner[:0]
        places = np.concatenate([chain(tokens, tokens), pairs]) % U64(BUCKETS)
        owners = np.concatenate([owner, of_pairs])
        keys, counts = np.unique(owners.astype(np.int64) * BUCKETS + places.astype(np.int64), return_counts=True)
        rows, values = keys // BUCKETS, np.log1p(counts)
        norms = np.sqrt(np.bincount(rows, values**2, minlength=hi - lo))
        yield lo, hi, (keys % BUCKETS).astype(np.int32), values / norms[rows], np.searchsorted(rows, np.arange(hi - lo + 1))


def train_ftrl(rows: list[tuple[np.ndarray, np.ndarray, int]], options: Ftrl) -> np.ndarray:
    """Weights, the constant last, from (features, values, label) in the order given."""
    z, n = np.zeros(BUCKETS + 1), np.zeros(BUCKETS + 1)
    o = options

    def weights(z: np.ndarray, n: np.ndarray) -> np.ndarray:
        return np.where(np.abs(z) <= o.l1, 0.0, (np.sign(z) * o.l1 - z) / ((o.beta + np.sqrt(n)) / o.alpha + o.l2))

    for _ in range(o.passes):
        for features, known, label in rows:
            places, values = np.append(features, BUCKETS), np.append(known, 1.0)
            zi, ni = z[places], n[places]
            w = weights(zi, ni)
            p = 1 / (1 + np.exp(-np.clip(w @ values, -35, 35)))
            g = (p - label) * values
            sigma = (np.sqrt(ni + g * g) - np.sqrt(ni)) / o.alpha
            z[places] = zi + g - sigma * w
            n[places] = ni + g * g
    return weights(z, n)


def fit(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id", options: Ftrl = Ftrl(), most: int = MAX_TRAINING) -> np.ndarray:
    """Weights from ``labels`` (doc_id, label 0/1), one row per document. Without a usable label all weights are 0.

    If there are more than ``most`` labelled documents, those with the lowest hashes, about ``most``, are used.
    """
    labels = labels.filter("doc_id IS NOT NULL AND label IS NOT NULL").groupBy("doc_id").agg(F.min("label").alias("label"))
    labels = labels.withColumn("draw", F.shiftrightunsigned(F.xxhash64(F.lit(3), "doc_id"), 11) / float(1 << 53))
    known = stage(labels, "classifier-labels")
    total = known.count()
    known = known.filter(F.col("draw") < most / max(total, 1))
    learners = max(1, -(-min(total, most) // PER_LEARNER))
    # Not more than about ``most`` rows of fixed width, so they can be sent to every task.
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text")).join(F.broadcast(known), "doc_id")
    rows = rows.select("text", "label", "draw")

    def learn(table: pa.Table) -> pa.Table:
        table = table.sort_by("draw").combine_chunks()
        hasher, examples = WordHasher(token_classes(), lower=False), []
        known = table.column("label").to_numpy()
        for lo, hi, places, values, firsts in features_of(hasher, table.column("text").combine_chunks()):
            for i in range(lo, hi):
                part = slice(firsts[i - lo], firsts[i - lo + 1])
                examples.append((places[part], values[part].astype(np.float32), int(known[i])))
        weights = train_ftrl(examples, options)
        used = np.flatnonzero(weights)
        return pa.table({"place": pa.array(used, pa.int32()), "weight": pa.array(weights[used])})

    parted = rows.withColumn("learner", F.floor(F.col("draw") * total / max(1, min(total, most)) * learners).cast("int"))
    trained = parted.groupBy("learner").applyInArrow(learn, "place int, weight double")
    mean = trained.groupBy("place").agg((F.sum("weight") / learners).alias("weight"))
    out = np.zeros(BUCKETS + 1)
    for batch in mean.toArrow().to_batches():  # at most BUCKETS + 1 rows
        out[batch.column(0).to_numpy()] = batch.column(1).to_numpy()
    return out


def score(docs: DataFrame, weights: np.ndarray, text: str = "text", column: str = "score") -> DataFrame:
    """``docs``, without the text, with the probability of label 1.

    Empty and null texts get that of the constant. Repeated rows get equal scores, an empty table gives no rows. A
    ``column`` whose name is taken gets underscores.
    """
    spark = docs.sparkSession
    model = spark.sparkContext.broadcast(weights)  # of fixed size
    others = [c for c in docs.columns if c != text]
    kinds = {f.name: f.dataType.simpleString() for f in docs.schema}
    schema = ", ".join([*(f"c{i} {kinds[c]}" for i, c in enumerate(others)), "score double"])
    names = [*(f"c{i}" for i in range(len(others))), "score"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, w = WordHasher(token_classes(), lower=False), model.value
        for batch in batches:
            out = np.zeros(batch.num_rows)
            for lo, hi, places, values, firsts in features_of(hasher, batch.column(len(others))):
                owner = np.repeat(np.arange(hi - lo), np.diff(firsts))
                out[lo:hi] = np.bincount(owner, w[places] * values, minlength=hi - lo)
            p = 1 / (1 + np.exp(-np.clip(out + w[BUCKETS], -35, 35)))
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(others)], pa.array(p)], names=names)

    columns = [F.col(f"`{c}`").alias(n) for c, n in zip(others, names, strict=False)]
    scored = docs.select(*columns, F.col(f"`{text}`").cast("string").alias("text")).mapInArrow(run, schema)
    return scored.toDF(*others, *unused(docs.select(*[f"`{c}`" for c in others]), column))


def held_out(doc_id: str = "doc_id", parts: int = 5):
    """Whether the CRC-32 of the identifier as text is a multiple of ``parts``; a null identifier is not."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % parts == 0, F.lit(False))
