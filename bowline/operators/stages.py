"""``pyspark.ml`` stages over bag-of-words tables: the common-word filter and the word-count vectorizer.

Their models own Spark tables, which are saved as Parquet next to the parameters.
"""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Pipeline
from pyspark.ml.feature import IDF, Binarizer, UnivariateFeatureSelector
from pyspark.ml.linalg import VectorUDT
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import (
    DefaultParamsReadable,
    DefaultParamsReader,
    DefaultParamsWritable,
    DefaultParamsWriter,
    MLReadable,
    MLReader,
    MLWritable,
    MLWriter,
)
from pyspark.sql import DataFrame
from pyspark.sql.types import DataType, IntegerType, StringType, StructField, StructType

from bowline.operators import vocabulary
from bowline.operators.docvectors import (
    check_vector_size,
    document_features,
    empty_documents,
    pack_documents,
    with_vector,
)
from bowline.operators.lookup import drop_matching
from bowline.operators.vocabulary import WordTable
from bowline.staging import measure, stage

# The columns of the stages, their default names and their exact types.
COLUMN_DEFAULTS = {
    "fileCol": "input_file",
    "wordCol": "word",
    "wordCountCol": "word_count",
    "labelCol": "label",
    "indexCol": "word_index",
    "vectorCol": "raw_word_vector",
}
COLUMN_TYPES: dict[str, DataType] = {
    "fileCol": StringType(),
    "wordCol": StringType(),
    "wordCountCol": IntegerType(),
    "labelCol": IntegerType(),
    "indexCol": IntegerType(),
    "vectorCol": VectorUDT(),
}


class WordColumns(Params):
    """Column-name parameters with setters and getters (``setFileCol``, ``getFileCol``, ...), and the schema check."""

    fileCol = Param(Params._dummy(), "fileCol", "document id column", TypeConverters.toString)
    wordCol = Param(Params._dummy(), "wordCol", "word column", TypeConverters.toString)
    wordCountCol = Param(Params._dummy(), "wordCountCol", "word count column", TypeConverters.toString)
    labelCol = Param(Params._dummy(), "labelCol", "optional label column", TypeConverters.toString)
    indexCol = Param(Params._dummy(), "indexCol", "word index column", TypeConverters.toString)
    vectorCol = Param(Params._dummy(), "vectorCol", "output vector column", TypeConverters.toString)

    required: tuple[str, ...] = ()

    def __init__(self) -> None:
        super().__init__()
        self._setDefault(**COLUMN_DEFAULTS)

    def name(self, param: str) -> str:
        return self.getOrDefault(self.getParam(param))

    def check_schema(self, schema: StructType) -> None:
        """Every required column exists and has its declared type; nullability does not matter."""
        names = [self.name(param) for param in self.required]
        missing = [name for name in names if name not in schema.names]
        if missing:
            raise ValueError(f"missing required column(s): {', '.join(missing)}")
        wrong = [
            f"{name}: expected {COLUMN_TYPES[param].simpleString()}, got {schema[name].dataType.simpleString()}"
            for param, name in zip(self.required, names, strict=True)
            if schema[name].dataType != COLUMN_TYPES[param]
        ]
        if wrong:
            raise ValueError(f"incorrect column type(s): {'; '.join(wrong)}")

    def setFileCol(self, value: str):
        return self._set(fileCol=value)

    def setWordCol(self, value: str):
        return self._set(wordCol=value)

    def setCountCol(self, value: str):
        return self._set(wordCountCol=value)

    def setLabelCol(self, value: str):
        return self._set(labelCol=value)

    def setIndexCol(self, value: str):
        return self._set(indexCol=value)

    def setVectorCol(self, value: str):
        return self._set(vectorCol=value)


class _TableWriter(MLWriter):
    def __init__(self, model: _TableModel) -> None:
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.model, path, self.sparkSession)
        self.model.words.table.write.parquet(f"{path}/data")


class _TableReader(MLReader):
    def __init__(self, cls: type[_TableModel]) -> None:
        super().__init__()
        self.cls = cls

    def load(self, path: str) -> _TableModel:
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        model = self.cls()
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        table = self.sparkSession.read.parquet(f"{path}/data")
        model.words = WordTable(table, measure(table, model.name("wordCol"), self.cls.weight))
        return model


class _TableModel(Model, WordColumns, MLWritable, MLReadable):
    """A model made of a table keyed by word. ``copy`` keeps the table."""

    weight = "num_docs"  # the column with the rows that a word stands for

    def __init__(self, words: WordTable | None = None) -> None:
        super().__init__()
        self.words = words

    def write(self) -> MLWriter:
        return _TableWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _TableReader(cls)

    def shuffled_once(self, joined: DataFrame) -> DataFrame:
        """Rows joined in a shuffle are written: the stages after this one read them several times."""
        return joined if self.words.size.fits_broadcast else stage(joined, self.uid)

    def _adopt(self, estimator: Estimator):
        """Take over uid and column names from the estimator."""
        self._resetUid(estimator.uid)
        for param in COLUMN_DEFAULTS:
            self._set(**{param: estimator.name(param)})
        return self


class CommonElementFilter(Estimator, WordColumns, DefaultParamsWritable, DefaultParamsReadable):
    """Learns the words that fewer than ``dropFreq`` of the documents hold."""

    dropFreq = Param(Params._dummy(), "dropFreq", "maximum document frequency", TypeConverters.toFloat)
    countMode = Param(Params._dummy(), "countMode", "count 'rows' or distinct 'docs'", TypeConverters.toString)
    required = ("fileCol", "wordCol")

    @keyword_only
    def __init__(self, *, dropFreq: float = 0.2, countMode: str = "rows", **columns: str) -> None:
        super().__init__()
        self._setDefault(dropFreq=0.2, countMode="rows")
        self._set(**self._input_kwargs)

    def setDropFreq(self, value: float) -> CommonElementFilter:
        return self._set(dropFreq=value)

    def transformSchema(self, schema: StructType) -> StructType:
        self.check_schema(schema)
        return schema

    def _fit(self, dataset: DataFrame) -> CommonElementFilterModel:
        self.check_schema(dataset.schema)
        words = vocabulary.fit_common_words(
            dataset,
            self.getOrDefault(self.dropFreq),
            self.name("wordCol"),
            self.name("fileCol"),
            self.getOrDefault(self.countMode),
        )
        model = CommonElementFilterModel(words)._adopt(self)
        model.fitted_on = dataset
        return model


class CommonElementFilterModel(_TableModel):
    """Keeps the rows of known words that are not over-common."""

    required = ("fileCol", "wordCol")

    fitted_on: DataFrame | None = None  # not saved: a model that is loaded does not know its data

    def getWordsToKeep(self) -> DataFrame:
        return self.words.table.filter("keep").select(self.name("wordCol"))

    def transformSchema(self, schema: StructType) -> StructType:
        self.check_schema(schema)
        return schema

    def _transform(self, dataset: DataFrame) -> DataFrame:
        self.check_schema(dataset.schema)
        word = self.name("wordCol")
        if dataset is self.fitted_on:  # all its words are known, so the few common ones are all there is to look up
            common = self.words.table.filter("not keep")
            size = measure(common, word)
            kept = drop_matching(dataset, common, word, size)
            return kept if size.fits_broadcast else stage(kept, self.uid)
        return self.shuffled_once(vocabulary.filter_common(dataset, self.words, word).select(*dataset.columns))


class WordCountToVec(Estimator, WordColumns, DefaultParamsWritable, DefaultParamsReadable):
    """Numbers the words of a table and turns each document into a sparse vector of its counts."""

    keepEmpty = Param(
        Params._dummy(), "keepEmpty", "keep documents without a known word", TypeConverters.toBoolean
    )
    required = ("fileCol", "wordCol", "wordCountCol")

    @keyword_only
    def __init__(self, *, keepEmpty: bool = False, **columns: str) -> None:
        super().__init__()
        self._setDefault(keepEmpty=False)
        self._set(**self._input_kwargs)

    def transformSchema(self, schema: StructType) -> StructType:
        return _vector_schema(self, schema)

    def _fit(self, dataset: DataFrame) -> WordCountToVecModel:
        self.check_schema(dataset.schema)
        words = vocabulary.fit_dictionary(dataset, self.name("wordCol"), self.name("indexCol"))
        check_vector_size(words.size.rows)
        model = WordCountToVecModel(words)._adopt(self)
        return model._set(keepEmpty=self.getOrDefault(self.keepEmpty))


class WordCountToVecModel(_TableModel):
    keepEmpty = WordCountToVec.keepEmpty
    required = WordCountToVec.required

    def __init__(self, words: WordTable | None = None) -> None:
        super().__init__(words)
        self._setDefault(keepEmpty=False)

    def getDictionary(self) -> DataFrame:
        return self.words.table.select(self.name("wordCol"), self.name("indexCol"))

    def getDictionarySize(self) -> int:
        return self.words.size.rows

    def transformSchema(self, schema: StructType) -> StructType:
        return _vector_schema(self, schema)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        """``(file, [label], vector)``; the label is kept where the input has one."""
        self.check_schema(dataset.schema)
        keys = [self.name("fileCol")] + ([self.name("labelCol")] if self.name("labelCol") in dataset.columns else [])
        columns = (self.name("wordCol"), self.name("wordCountCol"), self.name("indexCol"))
        rows = dataset.select(*keys, *columns[:2])
        packed = pack_documents(document_features(rows, self.words, keys, *columns), keys, columns[2])
        if self.getOrDefault(self.keepEmpty):
            packed = packed.unionByName(empty_documents(rows, packed, keys))
        return with_vector(packed, self.words.size.rows, self.name("vectorCol"))


def _vector_schema(stage: WordColumns, schema: StructType) -> StructType:
    stage.check_schema(schema)
    label = stage.name("labelCol")
    kept = [schema[stage.name("fileCol")]] + ([schema[label]] if label in schema.names else [])
    return StructType([*kept, StructField(stage.name("vectorCol"), VectorUDT(), True)])


def idf_chi2_pipeline(
    drop_freq: float = 0.1, min_doc_freq: int = 2, num_top_features: int = 8000
) -> Pipeline:
    """The preprocessing chain as a ``Pipeline``, for use with other ML stages.

    MLlib holds one statistic per vocabulary word on the driver; for vocabularies beyond some millions of words use
    ``long_stages.long_pipeline``, whose stages are tables, or ``bowline.plans.preprocessing``.
    """
    return Pipeline(
        stages=[
            CommonElementFilter(dropFreq=drop_freq),
            WordCountToVec(),
            Binarizer(threshold=0.0, inputCol="raw_word_vector", outputCol="binarized_word_vector"),
            IDF(inputCol="binarized_word_vector", outputCol="tfidf_vector", minDocFreq=min_doc_freq),
            UnivariateFeatureSelector(
                featuresCol="tfidf_vector",
                labelCol="label",
                outputCol="chi_sel_features",
                selectionMode="numTopFeatures",
            )
            .setFeatureType("categorical")
            .setLabelType("categorical")
            .setSelectionThreshold(num_top_features),
        ]
    )
