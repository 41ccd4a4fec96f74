from __future__ import annotations

import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from bowline.operators import long_stages
from bowline.operators.long_stages import LongBinarizer, LongChiSquare, LongIDF, LongPacker, long_pipeline
from bowline.operators.stages import CommonElementFilter, idf_chi2_pipeline
from bowline.operators.docvectors import from_vector
from bowline.sources.raw import malformed_lines, raw_documents, read_raw, write_raw
from tests.conftest import rows_of

SCHEMA = "input_file string, label int, word string, word_count int"


@pytest.fixture(scope="module")
def bow(spark):
    rows = [
        (f"d{d}", d % 3, w, 1 + d % 2)
        for d in range(30)
        for w in {f"c{d % 3}", f"m{d % 7}", f"n{(d * d) % 11}", f"x{d // 2}", "all"}
    ]
    rows += [("bare", 1, "all", 2), ("rare", 1, "onlyhere", 1)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def test_five_stages_equal_those_on_vectors(spark, bow, tmp_path):
    model = long_pipeline(0.5, 2, 8).fit(bow)
    model.save(str(tmp_path / "long"))
    loaded = PipelineModel.load(str(tmp_path / "long"))
    got = rows_of(loaded.transform(bow))
    assert got == rows_of(model.transform(bow))
    packed = from_vector(idf_chi2_pipeline(0.5, 2, 8).fit(bow).transform(bow).select("input_file", "label", "chi_sel_features"), "chi_sel_features")
    mine = {r[0]: r for r in got}
    assert mine["rare"][3:] == ((), ())  # a vocabulary word, but none selected
    assert "bare" not in mine
    for row in packed.collect():  # the same words by their weights; MLlib breaks ties otherwise
        assert mine[row["input_file"]][2] == row["num_features"] == 8
    assert sum(len(r[3]) for r in got) == sum(len(r["indices"]) for r in packed.collect())


def test_models_broadcast_or_shuffle_alike(bow, no_broadcast, monkeypatch):
    shuffled = rows_of(long_pipeline(0.5, 2, 8).fit(bow).transform(bow))
    monkeypatch.undo()
    assert shuffled == rows_of(long_pipeline(0.5, 2, 8).fit(bow).transform(bow))


def test_schemas_of_the_stages(spark, bow):
    for name, stage in (("value", LongIDF()), ("value", LongChiSquare()), ("value", LongPacker())):
        with pytest.raises(ValueError, match=name):
            stage.transformSchema(bow.schema)
        with pytest.raises(ValueError, match=name):
            stage.fit(bow)
    with pytest.raises(ValueError, match="word_count"):
        LongBinarizer().transform(bow.drop("word_count"))
    schema = bow.schema
    for stage in long_pipeline().getStages():
        schema = stage.transformSchema(schema)
    assert schema.names == ["input_file", "label", "num_features", "indices", "values"]
    renamed = bow.withColumnsRenamed({"word": "w", "label": "y"})
    out = long_pipeline(0.5, 2, 8, wordCol="w", labelCol="y").fit(renamed).transform(renamed)
    assert out.columns == ["input_file", "y", "num_features", "indices", "values"]
    empty = long_pipeline(0.5, 2, 8).fit(bow).transform(bow.limit(0))
    assert empty.count() == 0
    assert long_stages.LongPacker().fit(bow.withColumns({"value": F.lit(1.0), "feature": F.lit(None).cast("int")})).getNumFeatures() == 0


def test_small_files_written_and_read_back(spark, bow, tmp_path):
    names = {0: "Training/classA", 1: "Training/classBC", 2: "Training/class"}
    folder = F.element_at(F.create_map(*[F.lit(x) for kv in names.items() for x in kv]), F.col("label"))
    content = raw_documents(bow.withColumn("folder", folder), "input_file", extra=F.lit("\nnot a count"))
    write_raw(content, str(tmp_path))
    assert len(list(tmp_path.glob("Training/*/*.txt"))) == 32
    every = read_raw(spark, str(tmp_path / "Training"), files="*/*.txt")
    assert every.select("input_file").distinct().count() == 32
    assert {(r["label_str"], r["label"]) for r in every.collect()} == {("A", 0), ("BC", 1 + 2 * 26), (None, None)}
    labelled = read_raw(spark, str(tmp_path / "Training"), files="class[A-Z]*/*.txt")
    assert labelled.filter("label_str is null").isEmpty()
    count = lambda df: rows_of(df.groupBy("word").agg(F.sum("word_count")))
    assert count(every) == count(bow)
    bad = malformed_lines(spark, str(tmp_path / "Training"), files="*/*.txt")
    assert {r["num_lines"] for r in bad.collect()} == {1} and bad.count() == 32


def test_a_shuffled_join_of_a_stage_is_not_repeated_by_later_stages(spark, no_broadcast):
    rows = [(f"d{d}", f"w{(d * w) % 7}", 1) for d in range(8) for w in range(3)]
    bow = spark.createDataFrame(rows, "input_file string, word string, word_count int").distinct()
    kept = CommonElementFilter(dropFreq=0.6).fit(bow).transform(bow)
    plan = kept._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan
    common = {w for w in {r[1] for r in rows} if len({r[0] for r in rows if r[1] == w}) >= 0.6 * 8}
    assert common and {tuple(r) for r in kept.collect()} == {r for r in rows if r[1] not in common}
