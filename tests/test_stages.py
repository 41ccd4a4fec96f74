from __future__ import annotations

from dataclasses import replace

import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import Binarizer
from pyspark.sql import functions as F

from bowline.operators.stages import (
    CommonElementFilter,
    CommonElementFilterModel,
    WordCountToVec,
    WordCountToVecModel,
    idf_chi2_pipeline,
)
from bowline.staging import TableSize
from tests.conftest import rows_of

SCHEMA = "input_file string, label int, word string, word_count int"
ROWS = [
    ("d1", 0, "the", 1), ("d1", 0, "cat", 2), ("d2", 1, "the", 3), ("d2", 1, "dog", 1),
    ("d3", 1, "the", 1), ("d3", 1, "cat", 1), ("d4", 0, "the", 9), ("d4", 0, "emu", 4),
]


@pytest.fixture(scope="module")
def bow(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


def vectors(df, column="raw_word_vector"):
    return rows_of(df.select("input_file", F.col(column).cast("string")))


def test_filter_and_vectorizer(bow):
    model = CommonElementFilter().setDropFreq(0.6).fit(bow)
    assert rows_of(model.getWordsToKeep()) == [("cat",), ("dog",), ("emu",)]
    kept = model.transform(bow)
    assert kept.columns == bow.columns and kept.schema == model.transformSchema(bow.schema)
    vectorizer = WordCountToVec().fit(kept)
    assert vectorizer.getDictionarySize() == 3
    assert rows_of(vectorizer.getDictionary()) == [("cat", 0), ("dog", 1), ("emu", 2)]
    out = vectorizer.transform(kept)
    assert out.columns == ["input_file", "label", "raw_word_vector"]
    assert out.schema.names == vectorizer.transformSchema(kept.schema).names
    assert vectors(out) == [("d1", "(3,[0],[2.0])"), ("d2", "(3,[1],[1.0])"), ("d3", "(3,[0],[1.0])"), ("d4", "(3,[2],[4.0])")]
    assert vectorizer.transform(kept.drop("label")).columns == ["input_file", "raw_word_vector"]


def test_default_frequency(bow):
    assert CommonElementFilter().getOrDefault("dropFreq") == 0.2


def test_renamed_columns(bow):
    other = bow.toDF("f", "l", "w", "n")
    stage = WordCountToVec().setFileCol("f").setLabelCol("l").setWordCol("w").setCountCol("n")
    out = stage.setIndexCol("i").setVectorCol("v").fit(other).transform(other)
    assert out.columns == ["f", "l", "v"] and out.count() == 4


def test_documents_without_known_words(spark, bow):
    other = spark.createDataFrame([("x", 1, "new", 1), ("y", 1, "cat", 1)], SCHEMA)
    assert vectors(WordCountToVec().fit(bow).transform(other)) == [("y", "(4,[0],[1.0])")]
    kept = WordCountToVec(keepEmpty=True).fit(bow).transform(other)
    assert vectors(kept) == [("x", "(4,[],[])"), ("y", "(4,[0],[1.0])")]


def test_schema_errors(bow):
    with pytest.raises(ValueError, match=r"missing required column\(s\): word_count"):
        WordCountToVec().fit(bow.drop("word_count"))
    wrong = bow.withColumn("word_count", F.col("word_count").cast("bigint"))
    with pytest.raises(ValueError, match="word_count: expected int, got bigint"):
        WordCountToVec().fit(wrong)
    with pytest.raises(ValueError, match="missing required"):
        CommonElementFilter(wordCol="nope").transformSchema(bow.schema)
    with pytest.raises(ValueError, match="incorrect column type"):
        WordCountToVec().fit(bow).transform(wrong)


def test_save_load_and_copy(spark, bow, tmp_path):
    filter_model = CommonElementFilter(dropFreq=0.6).fit(bow)
    vector_model = WordCountToVec(keepEmpty=True).fit(filter_model.transform(bow))
    for model, cls in ((filter_model, CommonElementFilterModel), (vector_model, WordCountToVecModel)):
        path = str(tmp_path / cls.__name__)
        model.write().overwrite().save(path)
        loaded = cls.load(path)
        assert loaded.uid == model.uid and loaded.words.size == model.words.size
        for twin in (loaded, model.copy()):
            assert twin.extractParamMap().values().__len__() == model.extractParamMap().values().__len__()
            assert rows_of(twin.transform(bow).drop("raw_word_vector")) == rows_of(model.transform(bow).drop("raw_word_vector"))
    estimator = WordCountToVec(keepEmpty=True, vectorCol="v")
    estimator.save(str(tmp_path / "estimator"))
    assert WordCountToVec.load(str(tmp_path / "estimator")).getOrDefault("vectorCol") == "v"


def test_pipeline_save_and_load(spark, bow, tmp_path):
    stages = [
        CommonElementFilter(dropFreq=0.6),
        WordCountToVec(),
        Binarizer(threshold=0.0, inputCol="raw_word_vector", outputCol="ones"),
    ]
    model = Pipeline(stages=stages).fit(bow)
    model.save(str(tmp_path / "p"))
    loaded = PipelineModel.load(str(tmp_path / "p"))
    assert vectors(loaded.transform(bow), "ones") == vectors(model.transform(bow), "ones")


def test_whole_pipeline(bow):
    out = idf_chi2_pipeline(0.6, 1, 2).fit(bow).transform(bow)
    assert out.first()["chi_sel_features"].size == 2 and out.count() == 4


def test_fitting_an_empty_table(spark):
    model = WordCountToVec().fit(spark.createDataFrame([], SCHEMA))
    assert model.getDictionarySize() == 0


def test_the_filter_drops_the_few_common_words_of_the_rows_it_was_fitted_on(spark, monkeypatch):
    rows = spark.createDataFrame([*ROWS, ("d5", 0, None, 1)], SCHEMA)
    model = CommonElementFilter(dropFreq=0.6).fit(rows)
    model.words = replace(model.words, size=TableSize(10**9, 10**10))
    expected = rows_of(model.transform(rows.filter("true")))
    assert expected == rows_of(rows.filter("word in ('cat', 'dog', 'emu')"))

    def refused(*args):
        raise AssertionError("all rows written or all words shuffled")

    monkeypatch.setattr("bowline.operators.stages.stage", refused)
    monkeypatch.setattr("bowline.operators.lookup.salt_hot", refused)
    assert rows_of(model.transform(rows)) == expected
