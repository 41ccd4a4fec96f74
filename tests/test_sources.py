from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from bowline.functions.labels import base26_code, label_from_path
from bowline.operators.docvectors import (
    feature_count,
    from_csv_columns,
    from_vector,
    to_csv_columns,
    with_vector,
)
from bowline.sources import raw as raw_files
from bowline.sources.processed import read_processed, write_processed
from bowline.sources.raw import encode_labels, fit_labels, malformed_lines, read_lines, read_raw, write_raw
from bowline.sources.text import bow_from_text, ids_unique
from tests.conftest import rows_of


def tree(root, files: dict[str, str]) -> str:
    for name, content in files.items():
        (root / name).parent.mkdir(parents=True, exist_ok=True)
        (root / name).write_text(content)
    return str(root)


@pytest.fixture
def raw(tmp_path):
    return tree(
        tmp_path / "myclass" / "T",
        {
            "classA/x.res": "The 1\nthe 2\nb x\nc 2 3\nd\nE  4\n f 5\n\nbig 99999999999\n",
            "classAB/y.res": "the 7\nzz 0\n",
            "class/z.res": "no 1\n",
            "other/w.res": "no 1\n",
            "classB/ignored.txt": "no 1\n",
            "loose.res": "free 3\n",
        },
    )


def by_name(df):
    return rows_of(df.withColumn("input_file", F.regexp_extract("input_file", "([^/]*)$", 1)))


def test_raw_scan_keeps_exactly_the_valid_lines(spark, raw):
    df = read_raw(spark, raw, merge=False)
    expected = [("x.res", "A", 0, "the", 1), ("x.res", "A", 0, "the", 2), ("y.res", "AB", 26, "the", 7), ("y.res", "AB", 26, "zz", 0)]
    assert by_name(df) == expected
    # The same rows whatever columns a query needs.
    assert df.count() == df.select("word").count() == len(df.select("word_count").collect()) == 4


def test_raw_scan_merges_words_that_normalize_alike(spark, raw):
    assert by_name(read_raw(spark, raw)) == [("x.res", "A", 0, "the", 3), ("y.res", "AB", 26, "the", 7), ("y.res", "AB", 26, "zz", 0)]


def test_raw_scan_unlabelled(spark, raw):
    assert by_name(read_raw(spark, raw, labelled=False)) == [("loose.res", None, None, "free", 3)]


def test_malformed_lines_are_counted(spark, raw):
    assert by_name(malformed_lines(spark, raw)) == [("x.res", 6)]


def test_dense_labels(spark, raw):
    bow = read_raw(spark, raw)
    labels = fit_labels(bow)
    assert rows_of(labels) == [("A", 0), ("AB", 1)]
    assert {row["label"] for row in encode_labels(bow, labels).collect()} == {0, 1}
    only_a = fit_labels(bow.filter("label_str = 'A'"))
    assert {(r["label_str"], r["label"]) for r in encode_labels(bow, only_a).collect()} == {("A", 0), ("AB", -1)}


def test_letter_codes(spark):
    codes = {"A": 0, "B": 1, "Z": 25, "BA": 1, "AB": 26, "AA": 0, "ZZZZZZ": 26**6 - 1, "": None, None: None}
    df = spark.createDataFrame([(k,) for k in codes], "s string").select("s", base26_code("s").alias("code"))
    assert {row["s"]: row["code"] for row in df.collect()} == codes
    with pytest.raises(Exception, match="OVERFLOW"):
        spark.range(1).select(base26_code(F.lit("ZZZZZZZZ"))).collect()


def test_label_from_path(spark):
    paths = {
        "file:///myclass/T/classB/v.res": "B",
        "file:///a/classAB/v.res": "AB",
        "file:///a/classABx/v.res": "AB",
        "file:///classA/other/v.res": None,
        "file:///a/class/v.res": None,
    }
    df = spark.createDataFrame([(p,) for p in paths], "p string")
    assert {r["p"]: r["l"] for r in df.select("p", label_from_path("p").alias("l")).collect()} == paths
    with pytest.raises(Exception, match="unlabelled file path"):
        df.select(label_from_path("p", strict=True)).collect()


TEXTS = [(1, "B a  b\tA\nb"), (2, ""), (3, None), (4, "  x "), (5, "Éa éA\r\nz")]


def test_text_counts_agree_with_and_without_unique_ids(spark):
    table = spark.createDataFrame(TEXTS, "doc_id long, text string")
    expected = [(1, "a", 2), (1, "b", 3), (4, "x", 1), (5, "z", 1), (5, "éa", 2)]
    assert rows_of(bow_from_text(table, unique=True)) == expected
    assert rows_of(bow_from_text(table, unique=False)) == expected


def test_text_with_repeated_ids_is_merged(spark):
    table = spark.createDataFrame([*TEXTS, (1, "a q"), (4, "x")], "doc_id long, text string")
    assert not ids_unique(table, "doc_id")
    expected = [(1, "a", 3), (1, "b", 3), (1, "q", 1), (4, "x", 2), (5, "z", 1), (5, "éa", 2)]
    assert rows_of(bow_from_text(table)) == expected


def test_text_counts_can_keep_the_case(spark):
    table = spark.createDataFrame([*TEXTS, (6, "A a\u00a0a A\n\n")], "doc_id long, text string")
    expected = [(1, "A", 1), (1, "B", 1), (1, "a", 1), (1, "b", 2), (4, "x", 1), (5, "z", 1), (5, "Éa", 1), (5, "éA", 1)]
    expected += [(6, "A", 2), (6, "a\u00a0a", 1)]
    assert rows_of(bow_from_text(table, unique=True, lower=False)) == sorted(expected)
    assert rows_of(bow_from_text(table, unique=False, lower=False)) == sorted(expected)


PACKED = [("a", 1, [0, 17], [1.5, 2.0]), ("b", None, [], []), ("c", 0, [204], [-0.25])]
PACKED_SCHEMA = "doc_id string, label int, indices array<int>, values array<double>"


@pytest.mark.parametrize("format", ["csv", "parquet"])
def test_processed_round_trip(spark, tmp_path, format):
    packed = spark.createDataFrame(PACKED, PACKED_SCHEMA)
    folder = str(tmp_path / "out")
    write_processed(to_csv_columns(packed, 300), folder, format)
    back = from_csv_columns(read_processed(spark, folder, format))
    assert feature_count(back) == 300
    assert rows_of(back.select("label", "indices", "values")) == rows_of(packed.drop("doc_id"))


def test_feature_count_rejects_disagreement(spark):
    with pytest.raises(ValueError, match="disagree"):
        feature_count(spark.createDataFrame([(1,), (2,)], "num_features int"))
    assert feature_count(spark.createDataFrame([], "num_features int")) == 0


def test_vectors_round_trip_and_dense_vectors(spark):
    from pyspark.ml.linalg import Vectors

    packed = spark.createDataFrame(PACKED, PACKED_SCHEMA)
    vectors = with_vector(packed, 300)
    assert vectors.filter("doc_id = 'a'").first()["raw_word_vector"] == Vectors.sparse(300, [0, 17], [1.5, 2.0])
    assert rows_of(from_vector(vectors).select("doc_id", "label", "indices", "values")) == rows_of(packed)
    dense = spark.createDataFrame([(Vectors.dense([0.0, 3.0, 0.0, 4.0]),)], ["raw_word_vector"])
    assert rows_of(from_vector(dense)) == [(4, (1, 3), (3.0, 4.0))]


def test_raw_scan_lists_directories_and_not_each_file(spark, tmp_path):
    directory = tree(tmp_path / "many", {f"class{c}/{n}.res": f"w{n} 1\n" for c in "AB" for n in range(20)} | {"classA/x.txt": "no 1\n"})
    lines = read_lines(spark, directory)
    leaf = lines._jdf.queryExecution().optimizedPlan().collectLeaves().head()
    assert leaf.relation().location().rootPaths().size() == 2
    assert lines.select("input_file").distinct().count() == 40


def test_raw_files_are_one_per_document_without_companions(spark, tmp_path):
    rows = [(f"class{'AB'[n % 2]}", f"word{n} {n}\n\u00e9 1") for n in range(30)] + [(None, "lost 1"), ("classA", None), ("classA", "")]
    directory = tmp_path / "out"
    write_raw(spark.createDataFrame(rows, "folder string, content string").repartition(3), str(directory))
    files = [f for f in directory.rglob("*") if f.is_file()]
    assert all(f.name.endswith(".txt") and not f.name.startswith(".") for f in files)
    assert sorted((f.parent.name, f.read_text()) for f in files) == sorted((d, (c or "") + "\n") for d, c in rows if d)
    with pytest.raises(FileExistsError):  # as before, nothing is added to files that are there
        write_raw(spark.createDataFrame(rows, "folder string, content string"), str(directory))


def many_kinds(root) -> str:
    texts = {
        "classA/a b%20ü+#[1].res": "The 1\nthe 2\nb x\nc 2 3\nd\nE  4\n f 5\n\nbig 99999999999\n 7\n 8\nΑΣ 3\nας 4\nασ 1",
        "classA/nothing.res": "", "classA/feed.res": "\n", "classAB/.hidden.res": "no 1", "classAB/_hidden.res": "no 1",
        "classAB/x.txt": "no 1", "classAB/below/x.res": "no 1\n", "class/z.res": "no 1\n", "classAB/twice.res": "a 1\nA 2\na -5\nB 2\nx\n",
        "classC/long.res": "".join(f"w{i % 50} {i}\n" for i in range(900)),
    }
    directory = tree(root, texts)
    (root / "classA" / "marked.res").write_bytes(b"\xef\xbb\xbfone 1\r\ntwo 2\rthree 3\n\r\n\n")
    (root / "classA" / "broken.res").write_bytes(b"\xe9t\xe9 1\n\xe9T\xe9 2\nx\xe2\x82\xc3 3\n")
    return directory


@pytest.mark.parametrize("whole", [8 << 20, 1000])
def test_files_listed_and_read_by_tasks_give_the_rows_of_the_scan(spark, tmp_path, monkeypatch, whole):
    """The driver held the name of every file; beyond the limit it holds none."""
    directory = many_kinds(tmp_path / "kinds")

    def scans(files):
        lines = read_lines(spark, directory, files=files)
        found = [lines, malformed_lines(spark, directory, files=files)]
        found += [read_raw(spark, directory, merge=merge, files=files) for merge in (True, False)]
        return lines, [rows_of(df) for df in [*found, read_raw(spark, directory, False, files=files or "*/*.res")]]

    for files in (None, "*/*"):
        monkeypatch.setattr(raw_files, "LISTED", 1000)
        expected = scans(files)[1]
        monkeypatch.setattr(raw_files, "LISTED", 5)
        monkeypatch.setattr(raw_files, "WHOLE", whole)
        lines, found = scans(files)
        assert found == expected
        leaves = lines._jdf.queryExecution().optimizedPlan().collectLeaves()
        formats = [leaves.apply(i).relation().fileFormat().toString() for i in range(leaves.size())]
        assert formats == ["Parquet"] + ["Text"] * (whole == 1000)  # the table of names; a file too long for a row


def test_merging_a_file_inside_its_row_needs_no_shuffle_by_word(spark, tmp_path, monkeypatch):
    directory = tree(tmp_path / "some", {f"classA/{n}.res": "A 1\na 2\nb 1" for n in range(9)})
    monkeypatch.setattr(raw_files, "LISTED", 5)
    rows = read_raw(spark, directory)
    assert rows.count() == 18 and rows.agg(F.sum("word_count")).first()[0] == 36
    assert rows._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1  # of names, to tasks


def test_contents_made_in_rows_are_those_made_of_words(spark):
    texts = [(*row, f"class{row[0]}") for row in [*TEXTS, (6, "b b a")]]
    table = spark.createDataFrame(texts, "doc_id long, text string, folder string")
    extra = F.concat(F.lit("doc#"), "doc_id")
    expected = rows_of(raw_files.raw_documents(bow_from_text(table, keep=["folder"]), extra=extra))
    contents = raw_files.raw_contents(table, extra=extra)
    assert rows_of(contents) == expected and len(expected) == 4
    assert "Exchange" not in contents._jdf.queryExecution().executedPlan().toString()
