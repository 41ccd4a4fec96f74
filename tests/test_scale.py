"""Properties of the physical plans that matter on a large cluster."""

from __future__ import annotations

import re

import pytest

from bowline.operators import vocabulary
from bowline.operators.lookup import lookup_join
from bowline.sources.text import bow_from_text, read_table
from bowline.staging import TableSize, stage
from bowline.plans import catalog, preprocessing
from tests.conftest import DATA

TRAINED = {"train_softmax", "train_softmax_sparse", "train_shallow", "train_average", "train_deep", "train_languages", "predict_softmax", "job_classify", "losses_average", "losses_shallow", "predict_average", "dir_classify", "train_softmax_mlp", "softmax_gradient"}


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def plans(monkeypatch):
    """Executed plans of every table a query stages, collected while it runs."""
    seen = []
    import bowline.staging as staging

    original = staging.stage

    def recording(df, name):
        seen.append(plan_of(df))
        return original(df, name)

    for module in ("operators.lookup", "operators.vocabulary", "operators.weighting", "plans.preprocessing", "plans.catalog"):
        monkeypatch.setattr(f"bowline.{module}.stage", recording)
    return seen


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - TRAINED))
def test_plans_stay_in_the_jvm_and_distributed(spark, plans, name):
    plans.append(plan_of(catalog.QUERIES[name](spark, DATA)))
    for plan in plans:
        for bad in ("Python", "ArrowEval", "MapInArrow", "CartesianProduct", "BroadcastNestedLoopJoin"):
            assert bad not in plan, f"{bad} in\n{plan}"
        assert not re.search(r"^.*\bWindow\b", plan, re.M)


def test_counting_words_of_unique_documents_needs_no_shuffle(spark):
    docs = read_table(spark, DATA, "documents", "doc_id", "text")
    assert "Exchange" not in plan_of(bow_from_text(docs, unique=True))


def test_lines_made_of_documents_need_no_shuffle(spark):
    """Words were shuffled by document and word, once tables are too large to be dealt by document."""
    assert "Exchange" not in plan_of(catalog.raw_lines(spark, DATA))


def test_words_of_a_few_classes_are_shuffled_once(spark):
    bow = spark.createDataFrame([(1, 0, "a", 1), (2, 1, "a", 1)], "doc_id long, label int, word string, word_count int")
    assert plan_of(preprocessing.count_by_class(bow, "label", [0, 1])).count("Exchange hashpartitioning") == 1
    assert plan_of(preprocessing.count_by_class(bow, "label")).count("Exchange hashpartitioning") == 2


def test_scans_read_only_what_they_need(spark):
    docs = read_table(spark, DATA, "documents")
    plan = plan_of(bow_from_text(docs, unique=True))
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in plan


def test_large_lookup_tables_are_not_broadcast(spark):
    df = spark.range(1000).selectExpr("cast(id as string) word", "id doc_id")
    table = stage(df.selectExpr("word", "doc_id n", "1L num_docs"), "t")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(lookup_join(df, table, "word", ["n"], TableSize(10**9, 10**10, 10**12)))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("BroadcastHashJoin") == 2 and "SortMergeJoin" in plan  # the hot keys only, on both sides
    assert "BroadcastHashJoin" in plan_of(lookup_join(df, table, "word", ["n"], TableSize(1000, 3000, 1000)))


def test_common_words_are_few(spark):
    """The broadcast side of the common-word filter obeys its bound."""
    bow = stage(bow_from_text(read_table(spark, DATA, "documents", "doc_id", "text")), "bow")
    rows, docs = bow.count(), vocabulary.document_count(bow).first()[0]
    for drop_freq in (0.02, 0.1, 0.5):
        words = vocabulary.fit_common_words(bow, drop_freq).table
        assert words.filter("not keep").count() <= rows / docs / drop_freq
