"""``pyspark.ml`` stages on the long table: binarize, IDF, chi-square selection, and one vector per document at the end.

They take and return rows of ``(file, [label], word, ...)``, so that a fitted stage is a table keyed by word: nothing
per word is on the driver, at fitting, at saving, or at use. A lookup table is broadcast where its measured size allows,
and joined in a shuffle beyond that.
"""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Pipeline, Transformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, StructField, StructType

from bowline.operators import selection, weighting
from bowline.operators.docvectors import check_vector_size, pack_documents
from bowline.operators.lookup import lookup_join
from bowline.operators.stages import CommonElementFilter, WordColumns, _TableModel
from bowline.operators.vocabulary import WordTable
from bowline.staging import measure, stage

FEATURE = "feature"  # the column of a selected word's number


class LongColumns(WordColumns):
    """The word columns and ``valueCol``, the weight of a word in a document."""

    valueCol = Param(Params._dummy(), "valueCol", "value column", TypeConverters.toString)

    def __init__(self) -> None:
        super().__init__()
        self._setDefault(valueCol="value")

    def setValueCol(self, value: str):
        return self._set(valueCol=value)

    def keys(self, columns: list[str]) -> list[str]:
        label = self.name("labelCol")
        return [self.name("fileCol")] + ([label] if label in columns else [])

    def value_schema(self, schema: StructType) -> StructType:
        """With the value column, which the stage writes or needs."""
        self.check_schema(schema)
        value = self.name("valueCol")
        return StructType([*(f for f in schema if f.name != value), StructField(value, DoubleType())])

    def needs_value(self, schema: StructType) -> None:
        self.check_schema(schema)
        if self.name("valueCol") not in schema.names:
            raise ValueError(f"missing required column(s): {self.name('valueCol')}")


class LongBinarizer(Transformer, LongColumns, DefaultParamsWritable, DefaultParamsReadable):
    """A value of 1 where the word count is above ``threshold``, else 0."""

    threshold = Param(Params._dummy(), "threshold", "counts above it give 1", TypeConverters.toFloat)
    required = ("fileCol", "wordCol", "wordCountCol")

    @keyword_only
    def __init__(self, *, threshold: float = 0.0, **columns: str) -> None:
        super().__init__()
        self._setDefault(threshold=0.0)
        self._set(**self._input_kwargs)

    def transformSchema(self, schema: StructType) -> StructType:
        return self.value_schema(schema)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        self.check_schema(dataset.schema)
        counted = dataset.withColumn(self.name("valueCol"), F.col(self.name("wordCountCol")).cast("double"))
        return weighting.binarize(counted, self.getOrDefault(self.threshold), value=self.name("valueCol"))


class _LongModel(_TableModel, LongColumns):
    """A table keyed by word with the weight ``doc_freq``."""

    weight = "doc_freq"
    required = ("fileCol", "wordCol")

    def __init__(self, words: WordTable | None = None) -> None:
        LongColumns.__init__(self)
        self.words = words

    def _adopt(self, estimator: Estimator):
        super()._adopt(estimator)
        return self._set(valueCol=estimator.name("valueCol"))


class LongIDF(Estimator, LongColumns, DefaultParamsWritable, DefaultParamsReadable):
    """Weights words by inverse document frequency; 0 below ``minDocFreq`` documents."""

    minDocFreq = Param(Params._dummy(), "minDocFreq", "fewest documents of a word", TypeConverters.toInt)
    required = ("fileCol", "wordCol")

    @keyword_only
    def __init__(self, *, minDocFreq: int = 0, **columns: str) -> None:
        super().__init__()
        self._setDefault(minDocFreq=0)
        self._set(**self._input_kwargs)

    def transformSchema(self, schema: StructType) -> StructType:
        self.needs_value(schema)
        return schema

    def _fit(self, dataset: DataFrame) -> LongIDFModel:
        self.needs_value(dataset.schema)
        file, word, value = (self.name(c) for c in ("fileCol", "wordCol", "valueCol"))
        num_docs = dataset.select(file).distinct().count()
        weights = weighting.idf_weights(dataset, self.getOrDefault(self.minDocFreq), file, word, value, num_docs)
        table = stage(weights, "idf")
        return LongIDFModel(WordTable(table, measure(table, word, "doc_freq")))._adopt(self)


class LongIDFModel(_LongModel):
    """Multiplies values by their word's weight; rows of unknown words are left out."""

    def getWeights(self) -> DataFrame:
        return self.words.table.select(self.name("wordCol"), "doc_freq", "idf")

    def transformSchema(self, schema: StructType) -> StructType:
        self.needs_value(schema)
        return schema

    def _transform(self, dataset: DataFrame) -> DataFrame:
        self.needs_value(dataset.schema)
        return self.shuffled_once(weighting.apply_idf(dataset, self.words, self.name("wordCol"), self.name("valueCol")))


class LongChiSquare(Estimator, LongColumns, DefaultParamsWritable, DefaultParamsReadable):
    """Selects the ``numTopFeatures`` words with the best chi-square statistics against the label."""

    numTopFeatures = Param(Params._dummy(), "numTopFeatures", "how many words are kept", TypeConverters.toInt)
    required = ("fileCol", "wordCol", "labelCol")

    @keyword_only
    def __init__(self, *, numTopFeatures: int = 8000, **columns: str) -> None:
        super().__init__()
        self._setDefault(numTopFeatures=8000)
        self._set(**self._input_kwargs)

    def transformSchema(self, schema: StructType) -> StructType:
        self.needs_value(schema)
        return StructType([*(f for f in schema if f.name != FEATURE), StructField(FEATURE, IntegerType())])

    def _fit(self, dataset: DataFrame) -> LongChiSquareModel:
        self.needs_value(dataset.schema)
        file, word, label, value = (self.name(c) for c in ("fileCol", "wordCol", "labelCol", "valueCol"))
        totals = selection.fit_class_totals(dataset, label, file)
        scores = selection.chi2_statistics(selection.presence_by_class(dataset, word, label, value), totals, word, label)
        return LongChiSquareModel(selection.fit_selection(scores, self.getOrDefault(self.numTopFeatures), word))._adopt(self)


class LongChiSquareModel(_LongModel):
    """Adds the number of a selected word, null for the others, whose rows stay: their documents may have no other."""

    def getSelected(self) -> DataFrame:
        return self.words.table.select(self.name("wordCol"), "doc_freq", "chi2", FEATURE)

    def transformSchema(self, schema: StructType) -> StructType:
        self.needs_value(schema)
        return StructType([*(f for f in schema if f.name != FEATURE), StructField(FEATURE, IntegerType())])

    def _transform(self, dataset: DataFrame) -> DataFrame:
        self.needs_value(dataset.schema)
        word = self.name("wordCol")
        rows = dataset.drop(FEATURE)
        chosen = self.words.table.select(word, F.col(FEATURE).cast("int").alias(FEATURE))
        if self.words.size.fits_broadcast:
            return rows.join(F.broadcast(chosen), word, "left").select(*rows.columns, FEATURE)
        found = lookup_join(rows, self.words.table, word, [FEATURE], self.words.size)
        found = self.shuffled_once(found.select(*rows.columns, F.col(FEATURE).cast("int").alias(FEATURE)))
        every = rows.select(*self.keys(rows.columns)).distinct()  # a row for each document, so that none is lost
        return found.unionByName(every.withColumn(FEATURE, F.lit(None).cast("int")), allowMissingColumns=True)


class LongPacker(Estimator, LongColumns, DefaultParamsWritable, DefaultParamsReadable):
    """One row per document: ``num_features``, ``indices`` and ``values`` of its selected words."""

    required = ("fileCol",)

    @keyword_only
    def __init__(self, **columns: str) -> None:
        super().__init__()
        self._set(**self._input_kwargs)

    def transformSchema(self, schema: StructType) -> StructType:
        return _packed_schema(self, schema)

    def _fit(self, dataset: DataFrame) -> LongPackerModel:
        self.needs_value(dataset.schema)
        last = dataset.agg(F.max(FEATURE)).first()[0]
        size = check_vector_size(0 if last is None else last + 1)
        model = LongPackerModel()._resetUid(self.uid)._set(numFeatures=size)
        return model._set(**{p: self.name(p) for p in ("fileCol", "labelCol", "valueCol")})


class LongPackerModel(Model, LongColumns, DefaultParamsWritable, DefaultParamsReadable):
    numFeatures = Param(Params._dummy(), "numFeatures", "size of the vectors", TypeConverters.toInt)
    required = LongPacker.required

    def __init__(self) -> None:
        super().__init__()

    def getNumFeatures(self) -> int:
        return self.getOrDefault(self.numFeatures)

    def transformSchema(self, schema: StructType) -> StructType:
        return _packed_schema(self, schema)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        self.needs_value(dataset.schema)
        keys = self.keys(dataset.columns)
        packed = pack_documents(dataset, keys, FEATURE, self.name("valueCol"))
        return packed.select(*keys, F.lit(self.getNumFeatures()).alias("num_features"), "indices", "values")


def _packed_schema(packer: LongColumns, schema: StructType) -> StructType:
    packer.needs_value(schema)
    arrays = [StructField(n, ArrayType(t)) for n, t in (("indices", IntegerType()), ("values", DoubleType()))]
    return StructType([*(schema[k] for k in packer.keys(schema.names)), StructField("num_features", IntegerType()), *arrays])


def long_pipeline(
    drop_freq: float = 0.1, min_doc_freq: int = 2, num_top_features: int = 8000, **columns: str
) -> Pipeline:
    """The preprocessing chain as five stages on the long table. Fit it on a written table: stages read it again."""
    return Pipeline(
        stages=[
            CommonElementFilter(dropFreq=drop_freq, **columns),
            LongBinarizer(**columns),
            LongIDF(minDocFreq=min_doc_freq, **columns),
            LongChiSquare(numTopFeatures=num_top_features, **columns),
            LongPacker(**columns),
        ]
    )
