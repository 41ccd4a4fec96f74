from __future__ import annotations

import random
import re
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from bowline.operators import vocabulary
from bowline.operators.docvectors import document_features, empty_documents, pack_documents, unpack_documents
from bowline.operators.lookup import drop_matching, lookup_join, number_rows, number_top, salt_hot
from bowline.staging import TableSize, measure, stage
from tests.conftest import rows_of


def bow(spark, rows, partitions=3):
    return spark.createDataFrame(rows, "doc_id string, label int, word string, word_count int").repartition(partitions)


ROWS = [
    ("d1", 0, "the", 1), ("d1", 0, "cat", 2), ("d2", 1, "the", 3), ("d2", 1, "dog", 1),
    ("d3", 1, "the", 1), ("d3", 1, "cat", 1), ("d4", 0, "the", 9), ("d4", 0, None, 4),
]


def test_common_words(spark):
    df = bow(spark, ROWS)
    assert vocabulary.document_count(df).first()[0] == 4
    # strict: 2 < 0.5 * 4 does not hold, so "cat" goes as well
    assert rows_of(vocabulary.keep_words(df.filter("word is not null"), 0.5)) == [("dog",)]
    assert rows_of(vocabulary.keep_words(df.filter("word is not null"), 0.75)) == [("cat",), ("dog",)]
    kept = rows_of(vocabulary.drop_common(df, 0.75).select("doc_id", "word"))
    assert kept == [("d1", "cat"), ("d2", "dog"), ("d3", "cat")]
    words = vocabulary.fit_common_words(df, 0.75)
    assert rows_of(vocabulary.filter_common(df, words).select("doc_id", "word")) == kept
    # a second data set: words never seen are dropped by the fitted filter
    other = bow(spark, [("x", 0, "cat", 1), ("x", 0, "new", 1), ("x", 0, "the", 1), ("x", 0, None, 1)])
    assert rows_of(vocabulary.filter_common(other, words).select("word")) == [("cat",)]


def test_count_modes(spark):
    df = bow(spark, [("d1", 0, "a", 1), ("d1", 0, "a", 1), ("d2", 0, "b", 1)])
    assert rows_of(vocabulary.word_frequencies(df)) == [("a", 2), ("b", 1)]
    assert rows_of(vocabulary.word_frequencies(df, count_mode="docs")) == [("a", 1), ("b", 1)]


@pytest.mark.parametrize("partitions", [1, 7, 40])
def test_numbering_is_dense_sorted_and_independent_of_partitions(spark, partitions):
    words = [f"w{i * 7919 % 5000:05d}" for i in range(5000)] + ["é", "Z", "😀"]
    df = spark.createDataFrame([(w, 1) for w in words], "word string, n int").repartition(partitions)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        table, size = number_rows(df, "word", weight="n")
        assert table.rdd.getNumPartitions() > 1
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    expected = {w: i for i, w in enumerate(sorted(words))}
    assert {r["word"]: r["word_index"] for r in table.collect()} == expected
    assert size == TableSize(5003, sum(len(w.encode()) for w in words), 5003)


def test_numbering_nothing(spark):
    table, size = number_rows(spark.createDataFrame([], "word string"), "word")
    assert table.collect() == [] and size.rows == 0
    assert vocabulary.dictionary_size(table).first()[0] == 0


def test_number_top(spark):
    df = spark.range(100).select("id", (F.col("id") * 37 % 100).alias("score")).repartition(5)
    best = sorted(sorted(range(100), key=lambda i: -(i * 37 % 100))[:10])
    table, size = number_top(df, [F.col("score").desc()], 10, "id", "feature")
    assert [(r["id"], r["feature"]) for r in table.orderBy("id").collect()] == [(w, i) for i, w in enumerate(best)]
    assert size.rows == 10


def skewed(spark):
    """A third of all rows on one word, a third on one document, plus unknown and null words."""
    rng = random.Random(5)
    rows = [(f"d{i}", 0, "hot", 1) for i in range(3000)]
    rows += [("big", 1, f"w{i}", 2) for i in range(3000)]
    rows += [(f"d{rng.randrange(500)}", 1, f"w{rng.randrange(4000)}", 1) for _ in range(3000)]
    rows += [("d1", 0, None, 1), ("d2", 0, "unknown", 1)]
    return bow(spark, rows, 6)


@pytest.mark.parametrize("hot_share", [2, 50, 10_000])
def test_lookup_join_is_the_same_broadcast_or_shuffled(spark, monkeypatch, hot_share):
    monkeypatch.setattr("bowline.operators.lookup.HOT_SHARE", hot_share)
    df = skewed(spark)
    counted = df.filter("word <> 'unknown'").groupBy("word").agg(F.count("*").alias("num_docs"))
    table = stage(counted.filter("word is not null").withColumn("keep", F.col("word") != "w7"), "t")
    size = measure(table, "word", "num_docs")
    assert size.fits_broadcast
    for known in (None, "keep"):
        small = lookup_join(df, table, "word", ["num_docs"], size, known)
        large = lookup_join(df, table, "word", ["num_docs"], TableSize(10**9, 10**10, size.weight), known)
        columns = ["doc_id", "label", "word", "word_count", "num_docs"]
        assert rows_of(large.select(columns)) == rows_of(small.select(columns))
        expected = 9000 if known is None else 9000 - table.filter("word = 'w7'").first()["num_docs"]
        assert large.count() == expected


@pytest.mark.parametrize("hot_share", [2, 10_000])
def test_drop_matching_is_the_same_broadcast_or_shuffled(spark, monkeypatch, hot_share):
    monkeypatch.setattr("bowline.operators.lookup.HOT_SHARE", hot_share)
    df = skewed(spark)
    table = stage(spark.createDataFrame([("hot",), ("w7",), ("w8",), ("elsewhere",)], "word string"), "t")
    small = drop_matching(df, table, "word", TableSize(4, 20))
    large = drop_matching(df, table, "word", TableSize(10**9, 10**10))
    assert rows_of(large) == rows_of(small)
    assert 0 < large.count() < 6003


@pytest.mark.parametrize("few_hashes", [False, True])
def test_a_shuffled_join_sorts_by_one_number_and_compares_keys_last(spark, monkeypatch, few_hashes):
    df = skewed(spark)
    table = stage(spark.createDataFrame([("hot", 1), ("w7", 2), ("elsewhere", 3)], "word string, n int"), "t")
    joined = lookup_join(df, table, "word", ["n"], TableSize(3, 20))
    left_out = drop_matching(df, table, "word", TableSize(3, 20))
    if few_hashes:  # keys share three hashes
        real = F.xxhash64
        monkeypatch.setattr("bowline.operators.lookup.F.xxhash64", lambda *c: real(*c) % 2)
    for how, expected in (
        (lambda size: lookup_join(df, table, "word", ["n"], size), joined),
        (lambda size: drop_matching(df, table, "word", size), left_out),
    ):
        large = how(TableSize(10**9, 10**10))
        assert rows_of(large) == rows_of(expected)
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        try:
            plan = how(TableSize(10**9, 10**10))._jdf.queryExecution().executedPlan().toString()
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        assert re.search(r"SortMergeJoin \[\(.*xxhash64\(word#\d+, 42\).* \^ cast\(_salt#\d+ as bigint\)\)\], \[\(", plan), plan


def test_a_shuffled_join_takes_keys_of_two_number_types(spark, monkeypatch):
    monkeypatch.setattr("bowline.operators.lookup.HOT_SHARE", 1)  # no key is hot
    rows, table = spark.range(5).selectExpr("cast(id as int) k", "id m"), spark.range(3, 9).selectExpr("id k", "id n")
    assert rows_of(lookup_join(rows, table, "k", ["n"], TableSize(10**9, 0))) == [(3, 3, 3), (4, 4, 4)]


def test_rows_that_a_shuffled_join_scattered_are_shuffled_once_more(spark):
    df = skewed(spark)
    small = vocabulary.fit_dictionary(df)
    large = replace(small, size=TableSize(10**9, 10**10))
    packed = pack_documents(document_features(df, large))
    assert rows_of(packed) == rows_of(pack_documents(document_features(df, small)))
    merged = document_features(df, large, merged=True)
    scattered = pack_documents(merged, scattered=True)
    assert [(r[0], sorted(r[2])) for r in rows_of(scattered)] == [(r[0], sorted(r[2])) for r in rows_of(pack_documents(merged))]
    for plan in (p._jdf.queryExecution().executedPlan().toString() for p in (packed, scattered)):
        after = plan[: plan.index("Join")]
        assert after.count("Exchange hashpartitioning(doc_id") == 1 and "partial_collect_list" in after, plan
        assert after.index("partial_collect_list") < after.index("Exchange hashpartitioning(doc_id"), plan


def test_a_large_table_is_narrowed_to_few_words(spark):
    df = skewed(spark)
    words = vocabulary.fit_common_words(df, 0.5)
    large = replace(words, size=TableSize(10**9, 10**10))
    few = df.filter("word in ('w7', 'w8', 'hot', 'unseen') or word is null")
    cut = vocabulary.narrowed(large, few)
    assert cut.size.fits_broadcast and cut.table.count() <= 4
    assert rows_of(vocabulary.filter_common(few, cut)) == rows_of(vocabulary.filter_common(few, words))
    assert vocabulary.narrowed(words, few) is words


def test_a_key_that_is_hot_in_the_rows_alone_is_salted(spark):
    df = skewed(spark)
    left, right = salt_hot(df.filter("word is not null"), spark.createDataFrame([("hot",), ("w1",)], "word string"), "word")
    assert left.filter("word = 'hot'").select("_salt").distinct().count() > 30
    assert right.filter("word = 'hot'").count() == 64
    assert left.filter("word = 'unknown'").select("_salt").distinct().count() == 1


@pytest.mark.parametrize("partitions", [1, 4])
def test_repeated_words_add_up_whatever_the_partitions(spark, partitions):
    df = bow(spark, [("d", 0, "a", 1), ("d", 0, "a", 2), ("d", 0, "b", 5)] * 3, partitions)
    features = document_features(df, vocabulary.fit_dictionary(df))
    assert rows_of(features) == [("d", 0, 0, 9.0), ("d", 0, 1, 15.0)]


def test_vectors_do_not_depend_on_partitions(spark, no_broadcast):
    df = skewed(spark)
    dictionary = vocabulary.fit_dictionary(df)
    packed = [
        rows_of(pack_documents(document_features(df.repartition(n), dictionary))) for n in (1, 9)
    ]
    assert packed[0] == packed[1]
    assert sum(len(row[2]) for row in packed[0]) == df.filter("word is not null").select("doc_id", "label", "word").distinct().count()


def test_pack_and_unpack(spark):
    df = skewed(spark)
    features = document_features(df, vocabulary.fit_dictionary(df))
    assert rows_of(unpack_documents(pack_documents(features))) == rows_of(
        features.withColumn("word_index", F.col("word_index").cast("int"))
    )


def test_documents_without_known_words(spark):
    train = bow(spark, [("d1", 0, "a", 1)])
    dictionary = vocabulary.fit_dictionary(train)
    other = bow(spark, [("x", 1, "a", 2), ("y", 1, "new", 2)])
    packed = pack_documents(document_features(other, dictionary))
    assert rows_of(packed) == [("x", 1, (0,), (2.0,))]
    assert rows_of(empty_documents(other, packed)) == [("y", 1, (), ())]


def test_vocabulary_in_one_pass_equals_filter_then_dictionary(spark):
    df = skewed(spark)
    one = vocabulary.fit_vocabulary(df, 0.001)
    two = vocabulary.fit_dictionary(vocabulary.drop_common(df, 0.001))
    assert rows_of(one.table.select("word", "word_index")) == rows_of(two.table.select("word", "word_index"))


def test_document_sketches_of_slices_merge(spark):
    rows = spark.range(50_000).selectExpr("id % 20000 AS doc_id", "'w' AS word")
    slices = [vocabulary.document_sketch(rows.filter(f"doc_id % 3 = {n}")) for n in range(3)]
    merged = vocabulary.merge_document_sketches(slices[0].unionByName(slices[1]).unionByName(slices[2]))
    whole = vocabulary.merge_document_sketches(vocabulary.document_sketch(rows))
    row, other = merged.first(), whole.first()
    assert row["estimate"] == pytest.approx(other["estimate"], rel=1e-6)
    assert abs(row["estimate"] - 20_000) <= 4 * vocabulary.sketch_error() * 20_000
    again = vocabulary.merge_document_sketches(merged.select("sketch").unionByName(slices[0])).first()
    assert again["estimate"] == row["estimate"]  # a slice that is merged twice counts once
    names = rows.selectExpr("cast(doc_id as string) AS doc_id", "word").limit(0)
    assert vocabulary.merge_document_sketches(vocabulary.document_sketch(names)).first()["estimate"] == 0
