"""Distributed training of small feed-forward networks on sparse document vectors.

Spark partitions the documents; a task only ever holds one Arrow batch and one gradient. Per epoch the weights are
broadcast, each partition adds up its part, and the parts are summed block by block in a shuffle, so that neither a
task nor the driver holds more than one partition's worth next to the result. The driver keeps the weights.

``sync="gradient"``: one full-batch step per epoch, the same for any partitioning up to rounding. A task sends out the
numbers of its gradient that are not zero, so of the first layer the rows of the words that its documents have; they are
added up in two levels, first for groups of tasks, then for all.
``sync="average"``: learners take mini-batch steps of their own; their weights and velocities are averaged in proportion
to their documents, once per epoch or after every few batches. A hash of each document says whose it is.
"""

from __future__ import annotations

import os
import sys
import tempfile
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, cloudpickle
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

# Tasks carry this module's code along, so executors need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

BLOCK = 16_384  # parameters per block of the distributed sum
AT_ONCE = 1 << 20  # parameters whose sum comes to the driver at once, 8 MiB; of more, block after block
FAN_IN = 32  # tasks whose gradients are added up in one task of the first level
CELLS = 1 << 22  # numbers in a temporary array of one gradient step
# A layer of so many outputs takes its rows a few at once, in an array of about GATHERED numbers that stays in the cache.
WIDE, GATHERED, WIDE_CELLS = 256, 1 << 17, 1 << 20
# Weights go to every task and their gradient comes back through the driver as doubles: 512 MiB, half of Spark's
# default spark.driver.maxResultSize. Averaging brings back twice as much.
MAX_PARAMETERS = 1 << 26


@dataclass(frozen=True)
class Network:
    """Layer widths from input to classes, and the constants of training.

    Hidden layers use a leaky rectifier, the last one softmax with negative log-likelihood. ``learning_rate`` and
    ``l2`` are fixed values of the job; ``leak`` and ``momentum`` are the customary defaults. ``start``: ``normal``
    weights by seed, or ``separable`` ones by a formula (``separable_weights``), which others can repeat.
    """

    layers: tuple[int, ...]
    leak: float = 0.01
    learning_rate: float = 0.02
    momentum: float = 0.9
    l2: float = 1e-4
    seed: int = 0
    start: str = "normal"

    def __post_init__(self) -> None:
        if self.start not in ("normal", "separable"):
            raise ValueError("start must be 'normal' or 'separable'")
        if self.num_parameters > MAX_PARAMETERS:
            raise ValueError(f"{self.num_parameters} parameters exceed {MAX_PARAMETERS}; use narrower layers")

    @property
    def shapes(self) -> list[tuple[int, int]]:
        return list(zip(self.layers[:-1], self.layers[1:], strict=True))

    @property
    def num_parameters(self) -> int:
        return sum((n + 1) * m for n, m in self.shapes)

    def unpack(self, flat: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """Views of the flat vector: (weights, bias) per layer."""
        parts, at = [], 0
        for n, m in self.shapes:
            parts.append((flat[at : at + n * m].reshape(n, m), flat[at + n * m : at + (n + 1) * m]))
            at += (n + 1) * m
        return parts

    def initial(self) -> np.ndarray:
        """Normal or separable weights of variance 2 / (inputs + outputs), zero biases."""
        rng = np.random.default_rng(self.seed)
        flat = np.zeros(self.num_parameters)
        for weights, _ in self.unpack(flat):
            if self.start == "separable":
                separable_weights(*weights.shape, into=weights)
            else:
                weights[:] = rng.normal(0.0, np.sqrt(2.0 / sum(weights.shape)), weights.shape)
        return flat


def separable_weights(inputs: int, outputs: int, into: np.ndarray | None = None) -> np.ndarray:
    """3 sqrt(2 / (inputs + outputs)) u(i) v(j), where u and v step evenly through 16 values between -1 and 1.

    A layer's output is then one sum over a document's words times v(j), so SQL can repeat training. Hidden units whose
    numbers differ by 16 stay equal for ever: a start to check results with, not the one to learn best from.
    """
    steps = lambda n, factor, first: ((np.arange(n) * factor + first) % 16 + 0.5) / 8.0 - 1.0
    into = np.empty((inputs, outputs)) if into is None else into
    np.multiply.outer(steps(inputs, 7, 3), steps(outputs, 5, 1), out=into)
    into *= 3.0 * np.sqrt(2.0 / (inputs + outputs))
    return into


@dataclass(frozen=True)
class Rows:
    """A slice of documents: entries of all rows end to end, and the number of entries of each row."""

    indices: np.ndarray
    values: np.ndarray
    lengths: np.ndarray
    classes: np.ndarray | None = None

    @classmethod
    def of(cls, indices: pa.ListArray, values: pa.ListArray, classes: pa.Array | None = None) -> Rows:
        lengths = indices.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
        return cls(
            indices.flatten().to_numpy(zero_copy_only=False),
            values.flatten().to_numpy(zero_copy_only=False),
            lengths,
            None if classes is None else classes.to_numpy(zero_copy_only=False),
        )

    def slices(self, width: int, max_rows: int | None = None) -> Iterator[Rows]:
        """Consecutive slices whose entries times ``width`` stay within CELLS (or single rows), at most ``max_rows``.

        Of wide layers there is no array of all entries: their slices' rows times ``width`` stay within WIDE_CELLS.
        """
        ends = np.cumsum(self.lengths)
        wide = width >= WIDE
        budget = max(1, (WIDE_CELLS if wide else CELLS) // max(1, width))
        row, rows = 0, len(self.lengths)
        while row < rows:
            before = ends[row - 1] if row else 0
            stop = rows if wide else max(row + 1, int(np.searchsorted(ends, before + budget, side="right")))
            # The row count is bounded too: rows without entries still need a dense activation each.
            stop = min(stop, rows, row + min(max_rows or budget, budget))
            until = ends[stop - 1]
            yield Rows(
                self.indices[before:until],
                self.values[before:until],
                self.lengths[row:stop],
                None if self.classes is None else self.classes[row:stop],
            )
            row = stop

    def dot(self, weights: np.ndarray) -> np.ndarray:
        """(rows x inputs) @ weights."""
        out = np.zeros((len(self.lengths), weights.shape[1]))
        if weights.shape[1] >= WIDE:
            ends = np.cumsum(self.lengths)
            add_products(weights, self.indices, self.values, ends - self.lengths, ends, out, range(len(out)))
            return out
        filled = self.lengths > 0
        if filled.any():
            starts = (np.cumsum(self.lengths) - self.lengths)[filled]
            out[filled] = np.add.reduceat(weights[self.indices] * self.values[:, None], starts, axis=0)
        return out

    def add_outer(self, delta: np.ndarray, into: np.ndarray) -> None:
        """into += (rows x inputs).T @ delta, touching only the inputs that occur."""
        if len(self.indices) == 0:
            return
        order = np.argsort(self.indices, kind="stable")
        inputs, starts = np.unique(self.indices[order], return_index=True)
        of_row = np.repeat(np.arange(len(self.lengths)), self.lengths)[order]
        if delta.shape[1] >= WIDE:
            ends = np.append(starts[1:], len(order))
            add_products(delta, of_row, self.values[order], starts, ends, into, inputs.tolist())
            return
        into[inputs] += np.add.reduceat(delta[of_row] * self.values[order][:, None], starts, axis=0)


def add_products(
    table: np.ndarray, places: np.ndarray, factors: np.ndarray, starts: np.ndarray, ends: np.ndarray, into: np.ndarray, rows: Iterable[int]
) -> None:
    """Add to each of ``rows`` of ``into`` its run of ``factors`` times the rows of ``table`` at its run of ``places``."""
    if len(places) and (places.min() < 0 or places.max() >= len(table)):
        raise IndexError(f"places from {places.min()} to {places.max()} of {len(table)}")
    most = max(1, GATHERED // table.shape[1])
    room = np.empty((most, table.shape[1]), table.dtype)
    for row, start, end in zip(rows, starts.tolist(), ends.tolist(), strict=True):
        total = into[row]
        for lo in range(start, end, most):
            hi = min(lo + most, end)
            some = np.take(table, places[lo:hi], axis=0, out=room[: hi - lo], mode="clip")
            total += np.dot(factors[lo:hi], some)


def log_probabilities(network: Network, flat: np.ndarray, rows: Rows) -> tuple[np.ndarray, list[np.ndarray]]:
    """Class log-probabilities, and the outputs of the hidden layers."""
    layers = network.unpack(flat)
    hidden: list[np.ndarray] = []
    for depth, (weights, bias) in enumerate(layers):
        z = (rows.dot(weights) if depth == 0 else hidden[-1] @ weights) + bias
        if depth < len(layers) - 1:
            hidden.append(np.where(z > 0, z, network.leak * z))
    z -= z.max(axis=1, keepdims=True)
    return z - np.log(np.exp(z).sum(axis=1, keepdims=True)), hidden


def add_gradient(network: Network, flat: np.ndarray, rows: Rows, into: np.ndarray) -> float:
    """Add the rows' summed gradient of the data loss to ``into`` and return their summed loss."""
    layers, gradients = network.unpack(flat), network.unpack(into)
    log_p, hidden = log_probabilities(network, flat, rows)
    at = np.arange(len(rows.classes))
    delta = np.exp(log_p)
    delta[at, rows.classes] -= 1.0
    for depth in range(len(layers) - 1, -1, -1):
        grad_weights, grad_bias = gradients[depth]
        grad_bias += delta.sum(axis=0)
        if depth == 0:
            rows.add_outer(delta, grad_weights)
        else:
            below = hidden[depth - 1]
            grad_weights += below.T @ delta
            delta = (delta @ layers[depth][0].T) * np.where(below > 0, 1.0, network.leak)
    return float(-log_p[at, rows.classes].sum())


def add_penalty(network: Network, flat: np.ndarray, into: np.ndarray) -> float:
    """Add the gradient of l2/2 * |weights|^2 to ``into`` and return that penalty; biases are free."""
    penalty = 0.0
    for (weights, _), (grad_weights, _) in zip(network.unpack(flat), network.unpack(into), strict=True):
        grad_weights += network.l2 * weights
        penalty += 0.5 * network.l2 * float((weights * weights).sum())
    return penalty


def nesterov_step(network: Network, flat: np.ndarray, velocity: np.ndarray, gradient: np.ndarray) -> None:
    """Move ``flat`` and ``velocity`` in place."""
    before = velocity.copy()
    velocity *= network.momentum
    velocity -= network.learning_rate * gradient
    flat += (1.0 + network.momentum) * velocity - network.momentum * before


PART_SCHEMA = "block int, places binary, numbers binary, loss double, docs bigint"


def part_row(block: int, places: np.ndarray | None, numbers: np.ndarray, loss: float, docs: int) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict(
        {
            "block": pa.array([block], pa.int32()),
            "places": pa.array([None if places is None else places.astype(np.int32).tobytes()], pa.binary()),
            "numbers": pa.array([numbers.tobytes()], pa.binary()),
            "loss": pa.array([loss], pa.float64()),
            "docs": pa.array([docs], pa.int64()),
        }
    )


def emit_blocks(numbers: np.ndarray, loss: float, docs: int) -> Iterator[pa.RecordBatch]:
    """The vector cut into blocks, one row each; block 0 carries the loss and the document count.

    A block that is mostly zero is sent as the places and values of its other numbers, one of zeros not at all.
    """
    for block, at in enumerate(range(0, len(numbers), BLOCK)):
        part = numbers[at : at + BLOCK]
        filled = np.flatnonzero(part)
        counts = (loss, docs) if block == 0 else (0.0, 0)
        if 3 * len(filled) < 2 * len(part):  # a place and a number take 12 bytes, a number alone 8
            if len(filled) or block == 0:
                yield part_row(block, filled, part[filled], *counts)
        else:
            yield part_row(block, None, part, *counts)


def adder(size: int):
    """Adds up the blocks of a vector of ``size`` numbers that arrive in one partition."""

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, list] = {}
        for batch in batches:
            for row in batch.to_pylist():
                block = row["block"]
                if block not in sums:
                    sums[block] = [np.zeros(min(BLOCK, size - block * BLOCK)), 0.0, 0]
                total, numbers = sums[block], np.frombuffer(row["numbers"])
                if row["places"] is None:
                    total[0] += numbers
                else:
                    total[0][np.frombuffer(row["places"], np.int32)] += numbers
                total[1] += row["loss"]
                total[2] += row["docs"]
        for block, (numbers, loss, docs) in sums.items():
            yield part_row(block, None, numbers, loss, docs)

    return add_up


def gathered_blocks(parts: DataFrame, size: int) -> Iterator[Row]:
    """The sum over all partitions by block, one partition of them at a time on the driver when the vector is long: about
    AT_ONCE numbers, however small they are as Spark packs them."""
    add_up = adder(size)
    near = parts.withColumn("group", F.floor(F.spark_partition_id() / FAN_IN))
    count = [-(-size // AT_ONCE)] if size > AT_ONCE else []
    near = near.repartition(*count, "block", "group").select("block", "places", "numbers", "loss", "docs")
    summed = near.mapInArrow(add_up, PART_SCHEMA).repartition(*count, "block").mapInArrow(add_up, PART_SCHEMA)
    return summed.toLocalIterator() if count else iter(summed.collect())


def gather(parts: DataFrame, size: int) -> tuple[np.ndarray, float, int]:
    """The sum over all partitions: one vector as long as the weights, the loss, and the document count."""
    flat, loss, docs = np.zeros(size), 0.0, 0
    for r in gathered_blocks(parts, size):
        flat[r["block"] * BLOCK : (r["block"] + 1) * BLOCK] = np.frombuffer(r["numbers"])
        loss, docs = loss + r["loss"], docs + r["docs"]
    return flat, loss, docs


def batch_rows(batch: pa.RecordBatch) -> Rows:
    return Rows.of(batch.column("indices"), batch.column("values"), batch.column("class_id"))


@dataclass
class TrainedNetwork:
    network: Network
    flat: np.ndarray
    losses: list[float] = field(default_factory=list)
    _shared: tuple | None = field(default=None, init=False, repr=False, compare=False)

    def predict(self, data: DataFrame, output: str = "class_id_predicted") -> DataFrame:
        """Add the most probable class id of each row's ``indices`` and ``values``."""
        network = self.network
        context = data.sparkSession.sparkContext
        if self._shared is None or self._shared[0] is not context:  # sent once for all sets
            self._shared = context, context.broadcast(self.flat)
        weights = self._shared[1]
        width = max(network.layers[1:])

        @F.arrow_udf("int")
        def best(indices: pa.Array, values: pa.Array) -> pa.Array:
            picked = [
                log_probabilities(network, weights.value, rows)[0].argmax(axis=1)
                for rows in Rows.of(indices, values).slices(width)
            ]
            return pa.array(np.concatenate(picked) if picked else [], pa.int32())

        return data.withColumn(output, best("indices", "values"))


def deal(data: DataFrame, workers: int, key: Sequence[str] | None = None, batches: int | None = None) -> DataFrame:
    """``data`` with one partition per learner, sorted by ``_batch`` and a hash of the document.

    ``key``: the columns that tell documents apart; so equal documents are spread. The learner and the batch, which is
    0 unless there are several ``batches``, are taken from hexadecimal digits of the MD5 of these columns, joined by
    commas. Without a key the hash is of the entries and the class.
    """
    if key:
        digest = F.md5(F.concat_ws(",", *[F.col(c).cast("string") for c in key]))
        number = lambda first: F.conv(F.substring(digest, first, 7), 16, 10).cast("int")
    else:
        digest = F.xxhash64("indices", "values", "class_id")
        number = lambda first: F.pmod(F.shiftright(digest, 4 * (first - 1)), F.lit(1 << 28)).cast("int")
    batch = F.pmod(number(8), F.lit(batches)) if batches else F.lit(0)
    dealt = data.withColumns({"_order": digest, "_learner": F.pmod(number(1), F.lit(workers)), "_batch": batch})
    return dealt.repartitionById(workers, "_learner").sortWithinPartitions("_batch", "_order")


def runs(batches: np.ndarray) -> list[tuple[int, int, int]]:
    """(number, from, to) for every run of equal numbers."""
    bounds = [0, *(np.flatnonzero(batches[1:] != batches[:-1]) + 1).tolist(), len(batches)]
    return [(int(batches[a]), a, b) for a, b in zip(bounds, bounds[1:], strict=False) if b > a]


class LazyRows:
    """The first layer's weights and velocities, of which a step changes the rows that its documents touch.

    All other rows decay: with no gradient but that of the penalty a step takes (weight, velocity) to a fixed linear
    combination of both. A clock per row says up to which step it is current; what it missed is made up for, by a power
    of that 2 x 2 matrix, when the row is next used. So a step costs what its entries cost, and gives the dense result.
    """

    def __init__(self, network: Network, weights: np.ndarray, speed: np.ndarray):
        rate, momentum = network.learning_rate, network.momentum
        self.network, self.weights, self.speed = network, weights, speed
        self.gradient = np.zeros_like(weights)
        self.clock, self.now = np.zeros(len(weights), np.int64), 0
        decay = -rate * network.l2
        self.once = np.array([[1 + (1 + momentum) * decay, momentum * momentum], [decay, momentum]])
        self.powers = np.eye(2)[None]
        self.touched: list[np.ndarray] = []

    def refresh(self, rows: np.ndarray) -> None:
        """Bring rows, each named once, up to the present step."""
        missed = self.now - self.clock[rows]
        rows, missed = rows[missed > 0], missed[missed > 0]
        if not len(rows):
            return
        while len(self.powers) <= missed.max():
            self.powers = np.concatenate([self.powers, (self.once @ self.powers[-1])[None]])
        m = self.powers[missed][:, :, :, None]
        w, v = self.weights[rows], self.speed[rows]
        self.weights[rows] = m[:, 0, 0] * w + m[:, 0, 1] * v
        self.speed[rows] = m[:, 1, 0] * w + m[:, 1, 1] * v
        self.clock[rows] = self.now

    def use(self, indices: np.ndarray) -> None:
        """Rows that the next documents of this step read, and add to the gradient of."""
        rows = np.unique(indices)
        self.refresh(rows)
        self.touched.append(rows)

    def step(self, docs: int) -> None:
        rows = np.unique(np.concatenate([np.zeros(0, np.int64), *self.touched]))
        n = self.network
        gradient = self.gradient[rows] / docs + n.l2 * self.weights[rows]
        before = self.speed[rows]
        velocity = n.momentum * before - n.learning_rate * gradient
        self.weights[rows] += (1.0 + n.momentum) * velocity - n.momentum * before
        self.speed[rows] = velocity
        self.gradient[rows] = 0.0
        self.now += 1
        self.clock[rows] = self.now
        self.touched = []


def local_training(network: Network, weights: np.ndarray, speed: np.ndarray, batch_size: int | None):
    """Steps of one learner over its documents: (weights, velocity, loss, documents) afterwards.

    With ``batch_size`` every so many documents are a step, otherwise those of one ``_batch`` number, however many.
    """
    width = max(network.layers[1:])
    n, m = network.shapes[0]
    first = n * m  # the first layer's weights lead the vector; all that follows takes dense steps

    def run(batches: Iterator[pa.RecordBatch]) -> tuple[np.ndarray, np.ndarray, float, int]:
        flat, velocity, gradient = weights.copy(), speed.copy(), np.zeros(network.num_parameters)
        lazy = LazyRows(network, flat[:first].reshape(n, m), velocity[:first].reshape(n, m))
        lazy.gradient = gradient[:first].reshape(n, m)
        others = list(zip(network.unpack(flat)[1:], network.unpack(gradient)[1:], strict=True))
        loss, docs, open_docs, open_batch = 0.0, 0, 0, None

        def step() -> None:
            nonlocal open_docs
            if open_docs:
                lazy.step(open_docs)
                gradient[first:] /= open_docs
                for (w, _), (g, _) in others:
                    g += network.l2 * w
                nesterov_step(network, flat[first:], velocity[first:], gradient[first:])
                gradient[first:] = 0.0
                open_docs = 0

        for batch in batches:
            for number, lo, hi in runs(batch.column("_batch").to_numpy(zero_copy_only=False)):
                if number != open_batch:
                    step()
                    open_batch = number
                for rows in batch_rows(batch.slice(lo, hi - lo)).slices(width, batch_size):
                    lazy.use(rows.indices)
                    loss += add_gradient(network, flat, rows, gradient)
                    open_docs += len(rows.lengths)
                    docs += len(rows.lengths)
                    if batch_size:
                        step()
        step()
        lazy.refresh(np.arange(n))
        return flat, velocity, loss, docs

    return run


def gradient_parts(data: DataFrame, network: Network, shared: Broadcast) -> DataFrame:
    """The blocks of every task's summed gradient at the weights ``shared``; one pass over ``data``.

    Rows stay as sparse as they are: a task multiplies the entries of an Arrow batch and adds up one gradient. A long
    gradient is sent out once for each core, however many files there are.
    """
    width = max(network.layers[1:])
    if network.num_parameters > AT_ONCE:
        data = data.coalesce(data.sparkSession.sparkContext.defaultParallelism)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gradient, loss, docs = np.zeros(network.num_parameters), 0.0, 0
        for batch in batches:
            for rows in batch_rows(batch).slices(width):
                loss += add_gradient(network, shared.value, rows, gradient)
                docs += len(rows.lengths)
        if docs:
            yield from emit_blocks(gradient, loss, docs)

    return data.select("indices", "values", "class_id").mapInArrow(run, PART_SCHEMA)


def loss_and_gradient(data: DataFrame, network: Network, flat: np.ndarray) -> tuple[float, np.ndarray]:
    """Mean loss of all documents at the weights ``flat``, penalty included, and its gradient; one pass over ``data``."""
    shared = data.sparkSession.sparkContext.broadcast(flat)
    total, loss, docs = gather(gradient_parts(data, network, shared), len(flat))
    shared.destroy()
    if not docs:
        raise ValueError("there are no training documents")
    total /= docs
    return loss / docs + add_penalty(network, flat, total), total


def full_batch_step(data: DataFrame, docs: int, network: Network, flat: np.ndarray, velocity: np.ndarray) -> float:
    """``nesterov_step`` along ``loss_and_gradient`` of all ``docs`` documents, in place; the loss before it.

    The gradient is used block by block as it arrives, so the driver holds the weights and velocities but no third vector.
    """
    shared = data.sparkSession.sparkContext.broadcast(flat)
    free, at = [], 0  # the places of the biases
    for n, m in network.shapes:
        free.append((at + n * m, at + (n + 1) * m))
        at += (n + 1) * m
    missing, loss, penalty = set(range(-(-len(flat) // BLOCK))), 0.0, 0.0

    def move(block: int, gradient: np.ndarray) -> float:
        lo, hi = block * BLOCK, block * BLOCK + len(gradient)
        weights = flat[lo:hi].copy()
        for a, b in free:
            weights[max(a - lo, 0) : max(b - lo, 0)] = 0.0
        nesterov_step(network, flat[lo:hi], velocity[lo:hi], gradient / docs + network.l2 * weights)
        return 0.5 * network.l2 * float(weights @ weights)

    for r in gathered_blocks(gradient_parts(data, network, shared), len(flat)):
        missing.remove(r["block"])
        loss += r["loss"]
        penalty += move(r["block"], np.frombuffer(r["numbers"]))
    for block in missing:  # all zero, so not sent
        penalty += move(block, np.zeros(min(BLOCK, len(flat) - block * BLOCK)))
    shared.destroy()
    return loss / docs + penalty


def mapped(numbers: np.ndarray) -> np.ndarray:
    """A copy in a temporary file that has no name, whose pages the system can write down when memory is short."""
    with tempfile.TemporaryFile() as file:
        os.posix_fallocate(file.fileno(), 0, max(1, numbers.nbytes))  # a full disk is an error here, not later
        copy = np.asarray(np.memmap(file, numbers.dtype, "r+", shape=numbers.shape))
    copy[:] = numbers
    return copy


def two_loops(gradient: np.ndarray, steps: list[np.ndarray], changes: list[np.ndarray]) -> np.ndarray:
    """The inverse Hessian, as far as the last steps and the changes of the gradient tell it, times the gradient."""
    q, factors = gradient.copy(), []
    for s, y in zip(reversed(steps), reversed(changes), strict=True):
        factors.append((s @ q) / (y @ s))
        q -= factors[-1] * y
    if steps:
        q *= (steps[-1] @ changes[-1]) / (changes[-1] @ changes[-1])
    for s, y, factor in zip(steps, changes, reversed(factors), strict=True):
        q += (factor - (y @ q) / (y @ s)) * s
    return q


def fit_lbfgs(
    data: DataFrame,
    network: Network,
    iterations: int,
    memory: int = 10,
    tolerance: float = 1e-7,
    initial: np.ndarray | None = None,
) -> TrainedNetwork:
    """Train by limited-memory BFGS; ``data`` as for ``fit_network``, read once per trial of a step.

    The driver holds the weights and ``memory`` steps with their changes of the gradient. Ends after ``iterations``, or
    when the gradient or the gain is within ``tolerance``. ``losses``: before the first and after every iteration.
    """
    flat = network.initial() if initial is None else np.array(initial, float)
    loss, gradient = loss_and_gradient(data, network, flat)
    losses, steps, changes = [loss], [], []
    for _ in range(iterations):
        if np.abs(gradient).max() <= tolerance:
            break
        direction = -two_loops(gradient, steps, changes)
        slope = float(direction @ gradient)
        if slope >= 0:  # not downhill: begin again
            steps, changes, direction = [], [], -gradient
            slope = float(direction @ gradient)
        size = 1.0 if steps else min(1.0, 1.0 / float(np.abs(gradient).sum()))
        for _ in range(30):
            moved = flat + size * direction
            new_loss, new_gradient = loss_and_gradient(data, network, moved)
            if new_loss <= loss + 1e-4 * size * slope:
                break
            size /= 2
        else:
            break
        s, y = moved - flat, new_gradient - gradient
        if s @ y > 1e-12 * float(y @ y):
            steps, changes = [*steps, s][-memory:], [*changes, y][-memory:]
        gain = loss - new_loss
        flat, loss, gradient = moved, new_loss, new_gradient
        losses.append(loss)
        if gain <= tolerance * max(1.0, abs(loss)):
            break
    return TrainedNetwork(network, flat, losses)


def fit_network(
    data: DataFrame,
    network: Network,
    epochs: int,
    sync: str = "gradient",
    batch_size: int = 16,
    workers: int = 8,
    initial: np.ndarray | None = None,
    key: Sequence[str] | None = None,
    batches: int | None = None,
    average_every: int | None = None,
) -> TrainedNetwork:
    """Train on ``(indices, values, class_id)``, class ids from 0, each row's indices distinct.

    ``data`` is read once per epoch: pass a written table. ``initial``: weights to begin with. The other arguments
    matter to ``sync="average"`` only: documents go to ``workers`` learners by a hash (see ``deal``), and each learner
    takes them in the order of that hash, so the model does not depend on files or cores. ``batch_size``: documents per
    step. ``batches`` instead: the steps of a learner per epoch, with documents dealt to them by the hash as well;
    then ``average_every`` says after how many steps learners are averaged, without it once per epoch.
    """
    if sync not in ("gradient", "average"):
        raise ValueError("sync must be 'gradient' or 'average'")
    if average_every is not None and not batches:
        raise ValueError("average_every counts steps: give the number of batches too")
    context = data.sparkSession.sparkContext
    flat = network.initial() if initial is None else np.array(initial, float)
    velocity, losses = np.zeros(network.num_parameters), []
    if sync == "average":
        rounds = -(-batches // average_every) if average_every else 1
        data = deal(data, workers, key, batches)
    columns = ["indices", "values", "class_id"] + ["_batch"] * (sync == "average")
    data = data.select(*columns)

    def local_steps(shared):
        def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            train = local_training(network, *shared.value, None if batches else batch_size)
            weights, speed, loss, docs = train(parts)
            if docs:
                yield from emit_blocks(np.concatenate([weights, speed]) * docs, loss, docs)

        return run

    if sync == "gradient":
        docs = data.count() if epochs else 0
        if epochs and not docs:
            raise ValueError("there are no training documents")
        if epochs and len(flat) > AT_ONCE:  # the driver goes through them block by block
            flat = mapped(flat)
            velocity = mapped(velocity)
        losses = [full_batch_step(data, docs, network, flat, velocity) for _ in range(epochs)]
        return TrainedNetwork(network, flat, losses)
    for _ in range(epochs):
        epoch_loss, epoch_docs = 0.0, 0
        for n in range(rounds):
            part = data if rounds == 1 else data.filter(F.floor(F.col("_batch") / average_every) == n)
            shared = context.broadcast((flat, velocity))  # learners go on with the velocity too
            total, loss, docs = gather(part.mapInArrow(local_steps(shared), PART_SCHEMA), 2 * len(flat))
            shared.destroy()
            if docs:
                total /= docs
                flat, velocity = total[: len(flat)].copy(), total[len(flat) :].copy()
            epoch_loss, epoch_docs = epoch_loss + loss, epoch_docs + docs
        if not epoch_docs:
            raise ValueError("there are no training documents")
        losses.append(epoch_loss / epoch_docs)
    return TrainedNetwork(network, flat, losses)
