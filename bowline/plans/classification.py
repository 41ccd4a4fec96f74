"""The classification jobs: train one of four classifiers on processed vectors and report metrics on both sets."""

from __future__ import annotations

from dataclasses import dataclass
from itertools import accumulate

from pyspark.ml.classification import LogisticRegression, MultilayerPerceptronClassifier
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from bowline.functions.vectors import vector_struct
from bowline.operators import evaluate
from bowline.operators.docvectors import feature_count, from_csv_columns
from bowline.operators.trainer import Network, TrainedNetwork, fit_lbfgs, fit_network
from bowline.sources.processed import read_processed
from bowline.sources.raw import TRAINING, VALIDATION
from bowline.staging import staged_folder

# MLlib's perceptron keeps its training rows dense; a task holds about so many bytes of them.
DENSE_TASK = 64 << 20

KINDS = ("softmax", "shallow", "deep", "average")
SOLVERS = ("lbfgs", "mlp")


@dataclass(frozen=True)
class Classification:
    """A trained classifier, and both sets with their ``prediction`` in terms of the original labels."""

    kind: str
    model: object
    classes: list
    training: DataFrame
    validation: DataFrame

    def confusion(self) -> DataFrame:
        """``(split, label, prediction, num_docs)``; each set has a report of its own."""
        return self._per_split(evaluate.confusion)

    def metrics(self) -> DataFrame:
        """``(split, num_docs, accuracy, precision, recall, f1)``; every set is scored once."""
        return self._per_split(lambda predictions: evaluate.metrics(evaluate.confusion(predictions)))

    def _per_split(self, report) -> DataFrame:
        parts = [
            report(predictions).select(F.lit(split).alias("split"), "*")
            for split, predictions in (("training", self.training), ("validation", self.validation))
        ]
        return parts[0].unionByName(parts[1])


def class_table(rows: DataFrame, label: str = "label") -> DataFrame:
    """The distinct classes of the labelled rows, one row each."""
    return rows.select(F.col(label).alias("class")).filter("class is not null").distinct()


def class_count(rows: DataFrame, label: str = "label") -> DataFrame:
    """``(num_classes)``: how many classes the labelled rows have."""
    return class_table(rows, label).agg(F.count("*").alias("num_classes"))


def class_list(rows: DataFrame, label: str = "label") -> list:
    """The classes in order: class i has the id i."""
    return sorted(row["class"] for row in class_table(rows, label).collect())


def classify(
    training: DataFrame,
    validation: DataFrame,
    num_features: int,
    kind: str = "softmax",
    epochs: int = 0,
    label: str = "label",
    hidden: int | None = None,
    sparse: bool = False,
    solver: str = "lbfgs",
    batch_size: int = 16,
    workers: int = 8,
    batches: int | None = None,
    average_every: int | None = None,
    **constants: float | str,
) -> Classification:
    """Train on ``(label, indices, values)``; other columns are carried along to the predictions.

    ``softmax``: a perceptron with layers [features, classes] and ``epochs`` iterations of L-BFGS on the sparse rows.
    ``solver="mlp"`` fits it by MLlib's perceptron, which turns documents into dense rows, ``sparse=True`` by MLlib's
    multinomial logistic regression; neither has the penalty of ``Network``.
    ``shallow``: features -> classes -> classes. ``deep``: features -> ``hidden`` (half the features) -> classes ->
    classes. ``average``: ``shallow``, trained by averaging the weights of ``workers`` learners; ``batches`` and
    ``average_every`` are those of ``fit_network``, and the other columns say which documents are the same.
    ``constants`` go to ``Network``. Training rows without a label are left out; a validation label unknown to
    training stays as it is and counts as an error.
    """
    if kind not in KINDS:
        raise ValueError(f"kind must be one of {', '.join(KINDS)}")
    if solver not in SOLVERS:
        raise ValueError(f"solver must be one of {', '.join(SOLVERS)}")
    training = training.filter(F.col(label).isNotNull())
    classes = class_list(training, label)
    if not classes:
        raise ValueError("there are no labelled training documents")
    sets = {
        "training": stage_vectors(training, num_features, classes, label, "training"),
        "validation": stage_vectors(validation, num_features, classes, label, "validation"),
    }
    if kind == "softmax" and solver == "lbfgs" and not sparse:
        network = Network((num_features, len(classes)), **constants)
        rows, validation_rows = (vectors.as_arrays() for vectors in sets.values())
        model = fit_lbfgs(rows, network, epochs)
        scored = [model.predict(df, "prediction") for df in (rows, validation_rows)]
    elif kind == "softmax":
        model, scored = run_softmax(sets, num_features, len(classes), epochs, sparse, constants.get("seed", 0))
    else:
        middle = (num_features // 2 if hidden is None else hidden,) if kind == "deep" else ()
        network = Network((num_features, *middle, len(classes), len(classes)), **constants)
        sync = "average" if kind == "average" else "gradient"
        key = [c for c in training.columns if c not in (label, "indices", "values")]
        options = {"batch_size": batch_size, "workers": workers, "batches": batches, "average_every": average_every}
        model, scored = run_network(sets, network, epochs, sync, key=key, **options)
    names = F.array(*[F.lit(c) for c in classes])
    predictions = [
        df.withColumn("prediction", F.get(names, F.col("prediction").cast("int"))).drop("class_id") for df in scored
    ]
    return Classification(kind, model, classes, *predictions)


@dataclass(frozen=True)
class StagedVectors:
    """A folder of Parquet files in the layout of ML vectors, read with or without that type."""

    spark: SparkSession
    path: str
    schema: StructType

    def as_ml_vectors(self) -> DataFrame:
        """``features`` as ML vectors."""
        fields = [StructField(f.name, VectorUDT() if f.name == "features" else f.dataType) for f in self.schema]
        return self.spark.read.schema(StructType(fields)).parquet(self.path)

    def as_arrays(self) -> DataFrame:
        """``features`` as the columns ``indices`` and ``values``."""
        table = self.spark.read.schema(self.schema).parquet(self.path)
        return table.select("*", "features.indices", "features.values").drop("features")


def stage_vectors(df: DataFrame, num_features: int, classes: list, label: str, name: str) -> StagedVectors:
    """Write ``features`` in the layout of an ML vector, so that reading it back is all it takes to get one."""
    class_ids = F.create_map(*[F.lit(x) for i, c in enumerate(classes) for x in (c, i)])
    vectors = df.withColumns(
        {
            "class_id": F.element_at(class_ids, F.col(label)),
            "features": vector_struct(F.lit(num_features), F.col("indices"), F.col("values")),
        }
    ).drop("indices", "values")
    path = staged_folder(df.sparkSession, name)
    vectors.write.parquet(path)
    return StagedVectors(df.sparkSession, path, vectors.schema)


def spread_dense(rows: DataFrame, num_features: int, block: int) -> DataFrame:
    """Rows that are to become dense in parts of whole blocks, of about ``DENSE_TASK`` bytes, if they are more than one.

    Files of sparse rows say nothing of it: one of some MB may hold a GB of dense rows. MLlib takes the mean of the means
    of its blocks, so a block that is not full weighs its rows more; only the last one of all is not. ``rows`` is a
    written table, whose rows are numbered by the places of its scan.
    """
    size = max(1, DENSE_TASK // (8 * max(1, num_features) * block)) * block
    placed = rows.withColumn("_place", F.monotonically_increasing_id())
    piece = F.shiftright("_place", 33).cast("int")  # the row's number in the piece is in the low 33 bits
    counts = {r["piece"]: r["count"] for r in placed.groupBy(piece.alias("piece")).count().collect()}
    tasks = -(-sum(counts.values()) // size)
    if tasks <= 1:
        return rows
    offsets = accumulate((counts.get(p, 0) for p in range(max(counts) + 1)), initial=0)
    before = F.get(F.split(F.lit(",".join(map(str, offsets))), ",").cast("array<bigint>"), piece)
    number = before + F.col("_place").bitwiseAND(F.lit((1 << 33) - 1))
    return placed.repartitionById(tasks, F.floor(number / size).cast("int")).drop("_place")


def run_softmax(
    sets: dict[str, StagedVectors], num_features: int, num_classes: int, epochs: int, sparse: bool, seed: int
) -> tuple[object, list[DataFrame]]:
    columns = {"featuresCol": "features", "labelCol": "class_id", "predictionCol": "prediction"}
    if sparse:
        estimator = LogisticRegression(
            family="multinomial", maxIter=epochs, regParam=0.0, standardization=False, **columns
        )
    else:
        estimator = MultilayerPerceptronClassifier(
            layers=[num_features, num_classes], maxIter=epochs, seed=seed, **columns
        )
    training, validation = (vectors.as_ml_vectors() for vectors in sets.values())
    rows = training.select("features", "class_id")
    model = estimator.fit(rows if sparse else spread_dense(rows, num_features, estimator.getBlockSize()))
    return model, [model.transform(df).drop("rawPrediction", "probability") for df in (training, validation)]


def run_network(
    sets: dict[str, StagedVectors], network: Network, epochs: int, sync: str, key: list[str], **options: int | None
) -> tuple[TrainedNetwork, list[DataFrame]]:
    training, validation = (vectors.as_arrays() for vectors in sets.values())
    rows = training.select("indices", "values", "class_id", *key)
    model = fit_network(rows, network, epochs, sync, key=key or None, **options)
    return model, [model.predict(df, "prediction") for df in (training, validation)]


def classify_directory(
    spark: SparkSession, input_dir: str, kind: str = "softmax", epochs: int = 0, format: str = "csv", **options
) -> Classification:
    """Classify the processed files under ``input_dir/{Training,Validation}``."""
    training, validation = (
        from_csv_columns(read_processed(spark, f"{input_dir}/{name}", format)) for name in (TRAINING, VALIDATION)
    )
    return classify(training, validation, feature_count(training), kind, epochs, **options)
