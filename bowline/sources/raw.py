"""Raw word-count files: one directory per class, one ``.res`` file per document, ``word count`` lines."""

from __future__ import annotations

import os
import re
import sys
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote

import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bowline.functions.labels import base26_code, label_from_path
from bowline.functions.words import normalize_word
from bowline.operators.lookup import number_rows
from bowline.sources.text import word_runs
from bowline.staging import broadcast_if_small, stage

# Tasks carry this module's code along, so executors need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# The layout of a raw dataset.
LABELLED_FILES = "class[A-Z]*/*.res"
UNLABELLED_FILES = "*.res"
TRAINING, VALIDATION = "Training", "Validation"

# The label of a class that training does not know; no prediction can be equal to it.
UNSEEN = -1

# Small files are read by a task per so many bytes of them, but not by fewer tasks than four per core.
SCAN_TASK = 8 << 20

# Directories with more entries than this are listed by tasks, so that the driver holds no file's name, and their files
# are read by tasks, at most TASK_FILES by one. Files of more than WHOLE bytes, and packed ones, are read by Spark.
LISTED, TASK_FILES, WHOLE = 10_000, 10_000, 8 << 20
PACKED = (".gz", ".bz2", ".deflate", ".snappy", ".lz4", ".zst", ".xz")


@dataclass(frozen=True)
class ManyFiles:
    """``contents``: (input_file, content), a row per file. ``lines``: (input_file, value) of the other files, if any."""

    contents: DataFrame
    lines: DataFrame | None


def files_of(directory: str, labelled: bool, files: str | None) -> tuple[str, str]:
    """The pattern of the directories, and that of the names in them."""
    return f"{directory.rstrip('/')}/{files or (LABELLED_FILES if labelled else UNLABELLED_FILES)}".rsplit("/", 1)


def many_files(spark: SparkSession, folders: str, name: str) -> ManyFiles | None:
    """The files of directories with more than ``LISTED`` entries; None if there are fewer, or if they are not on a
    ``file:`` system, which tasks can open files of."""
    hadoop, conf = spark.sparkContext._jvm.org.apache.hadoop.fs, spark.sparkContext._jsc.hadoopConfiguration()
    root = hadoop.Path(folders)
    system = root.getFileSystem(conf)
    if system.getUri().getScheme() != "file":
        return None
    uris = [status.getPath().toUri() for status in system.globStatus(root) or [] if status.isDirectory()]
    found = [(uri.getPath(), "file://" + uri.getRawPath()) for uri in uris]
    if not more_entries([path for path, _ in found], LISTED):
        return None
    pattern = hadoop.GlobPattern.compile(name).pattern()
    listed = spark.createDataFrame(found, "folder string, uri string").mapInArrow(file_lister(pattern), FILES_SCHEMA)
    listed = stage(listed, "files")
    whole = listed.filter(f"whole and size <= {WHOLE}")
    number, size = whole.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
    tasks = max(-(-size // SCAN_TASK), -(-number // TASK_FILES), 4 * spark.sparkContext.defaultParallelism)
    contents = whole.repartition(tasks, "uri", "name").mapInArrow(read_files, "input_file string, content binary")
    rest = listed.filter(f"not (whole and size <= {WHOLE})").select("folder", "name").toLocalIterator()
    paths = [re.sub(r"([\\{}\[\]*?])", r"\\\1", f"file://{r['folder']}/{r['name']}") for r in rest]
    lines = spark.read.text(paths).select(F.input_file_name().alias("input_file"), "value") if paths else None
    return ManyFiles(contents.withColumn("content", F.col("content").cast("string")), lines)


def more_entries(folders: list[str], limit: int) -> bool:
    """Whether the directories have more than ``limit`` entries; no more are looked at."""
    left = limit
    for folder in folders:
        with os.scandir(folder) as entries:
            for _ in entries:
                left -= 1
                if left < 0:
                    return True
    return False


FILES_SCHEMA = "folder string, uri string, name string, size bigint, whole boolean"


def file_lister(pattern: str):
    """Lists the files of each ``folder`` whose names match, without those that Spark takes for hidden."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matches = re.compile(pattern, re.DOTALL).fullmatch

        def batch_of(folder: str, uri: str, names: list[str], sizes: list[int]) -> pa.RecordBatch:
            n, whole = len(names), [not name.endswith(PACKED) for name in names]
            columns = [pa.array([folder] * n, pa.string()), pa.array([uri] * n, pa.string()), pa.array(names, pa.string())]
            columns += [pa.array(sizes, pa.int64()), pa.array(whole, pa.bool_())]
            return pa.RecordBatch.from_arrays(columns, names=["folder", "uri", "name", "size", "whole"])

        for batch in batches:
            for folder, uri in zip(batch.column("folder").to_pylist(), batch.column("uri").to_pylist(), strict=True):
                names, sizes = [], []
                with os.scandir(folder) as entries:
                    for entry in entries:
                        name = entry.name
                        hidden = name.startswith(".") or name.startswith("_") and "=" not in name
                        if hidden or name.endswith("._COPYING_") or not matches(name) or not entry.is_file():
                            continue
                        names.append(name)
                        sizes.append(entry.stat().st_size)
                        if len(names) == 10_000:
                            yield batch_of(folder, uri, names, sizes)
                            names, sizes = [], []
                yield batch_of(folder, uri, names, sizes)

    return run


def escaped(name: str) -> str:
    """A file's name in a URI, as Java escapes it: letters beyond ASCII stay."""
    keep = lambda c: c > "\x7f" and unicodedata.category(c) not in ("Zs", "Zl", "Zp", "Cc")
    return "".join(c if keep(c) else quote(c, safe=";:@&=+$,_-!.~'()*") for c in name)


def read_files(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The lines of every file that has any, with line feeds between them, a MB or so at once."""

    def batch_of(uris: list[str], contents: list[bytes]) -> pa.RecordBatch:
        columns = [pa.array(uris, pa.string()), pa.array(contents, pa.binary())]
        return pa.RecordBatch.from_arrays(columns, names=["input_file", "content"])

    for batch in batches:
        uris, contents, size = [], [], 0
        for folder, uri, name in zip(*(batch.column(c).to_pylist() for c in ("folder", "uri", "name")), strict=True):
            with open(f"{folder}/{name}", "rb") as file:
                content = file.read().removeprefix(b"\xef\xbb\xbf")  # a byte order mark
            if not content:
                continue
            if b"\r" in content:
                content = content.replace(b"\r\n", b"\n").replace(b"\r", b"\n")
            uris.append(f"{uri}/{escaped(name)}")
            contents.append(content.removesuffix(b"\n"))
            size += len(content)
            if size >= 1 << 20:
                yield batch_of(uris, contents)
                uris, contents, size = [], [], 0
        if uris:
            yield batch_of(uris, contents)


def unfolded(contents: DataFrame, lines: Column) -> DataFrame:
    """``contents`` with a row per line, cut at single spaces as ``fields``."""
    rest = [c for c in contents.columns if c != "content"]
    return contents.select(*rest, F.explode(lines).alias("value")).select(*rest, F.split("value", " ").alias("fields"))


def content_lines(content: str = "content") -> Column:
    return F.split(content, "\n")


def bound(value: Column, use) -> Column:
    """``use`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def merged_lines(content: str = "content") -> Column:
    """The lines of a file; if two of them begin with words that normalization makes equal, instead of its valid lines
    one for each normalized word, with the sum of its counts."""
    zero = F.lit(0).cast("bigint")

    def pair(fields: Column) -> Column:
        word = F.coalesce(normalize_word(F.get(fields, F.lit(0))), F.lit(""))
        return F.struct(word.alias("word"), F.get(fields, F.lit(1)).cast("bigint").alias("n"))

    def line(pairs: Column, start: Column, end: Column) -> Column:
        total = F.aggregate(F.slice(pairs, start + 1, end - start), zero, lambda total, p: total + p["n"])
        return F.concat_ws(" ", F.get(pairs, start)["word"], total.cast("int").cast("string"))

    def runs(pairs: Column) -> Column:
        first = lambda i: (i == 0) | (F.get(pairs, i)["word"] != F.get(pairs, i - 1)["word"])
        starts = F.filter(F.sequence(F.lit(0), F.size(pairs) - 1), first)
        ends = lambda starts, k: F.coalesce(F.get(starts, k + 1), F.size(pairs))
        merged = bound(starts, lambda starts: F.transform(starts, lambda start, k: line(pairs, start, ends(starts, k))))
        return F.when(F.size(pairs) > 0, merged).otherwise(F.array().cast("array<string>"))

    lines = content_lines(content)
    words = F.transform(F.split(F.lower(content), "\n"), lambda line: F.substring_index(line, " ", 1))
    valid = F.filter(F.transform(lines, lambda line: F.split(line, " ")), is_valid_line)
    distinct = bound(words, lambda words: F.size(F.array_distinct(words)) == F.size(words))
    return F.when(distinct, lines).otherwise(bound(F.sort_array(F.transform(valid, pair)), runs))


def read_lines(spark: SparkSession, directory: str, labelled: bool = True, files: str | None = None) -> DataFrame:
    """``(input_file, fields)``: every line cut at single spaces. Document ids are the files' escaped URIs.

    ``files``: a pattern below ``directory`` in place of the usual one, such as ``*/*.txt`` for every class directory.
    """
    folders, name = files_of(directory, labelled, files)
    many = many_files(spark, folders, name)
    if many is not None:
        lines = unfolded(many.contents, content_lines())
        return lines if many.lines is None else lines.unionByName(fields_of(many.lines))
    # Directories are listed, not files: a path per file would take a listing of its own for each.
    text = spark.read.option("pathGlobFilter", name).text(folders)
    size = int(text._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    tasks = max(-(-size // SCAN_TASK), 4 * spark.sparkContext.defaultParallelism)
    return fields_of(text.select(F.input_file_name().alias("input_file"), "value")).coalesce(tasks)


def fields_of(lines: DataFrame) -> DataFrame:
    return lines.select("input_file", F.split("value", " ").alias("fields"))


def is_valid_line(fields: str | Column = "fields") -> Column:
    """Exactly a word and a whole number that fits in 32 bits, whatever columns a query goes on to use."""
    count = F.get(fields, F.lit(1))
    return (F.size(fields) == 2) & count.rlike("^[+-]?[0-9]+$") & count.try_cast("int").isNotNull()


def cut_once(lines: DataFrame, fields: str = "fields") -> DataFrame:
    """The same rows; inline() of a one-element array keeps the optimizer from cutting a line anew in each use of it."""
    rest = [c for c in lines.columns if c != fields]
    return lines.select(*rest, F.inline(F.array(F.struct(F.col(fields)))))


def parse_lines(lines: DataFrame, fields: str = "fields") -> DataFrame:
    """The valid lines, with ``fields`` replaced by ``word`` and ``word_count``."""
    rest = [c for c in lines.columns if c != fields]
    return cut_once(lines, fields).filter(is_valid_line(fields)).select(
        *rest,
        normalize_word(F.get(fields, F.lit(0))).alias("word"),
        F.get(fields, F.lit(1)).cast("int").alias("word_count"),
    )


def malformed_lines(spark: SparkSession, directory: str, labelled: bool = True, files: str | None = None) -> DataFrame:
    """``(input_file, num_lines)``: how many lines of a file the scan leaves out. Blank lines are not counted."""
    lines = cut_once(read_lines(spark, directory, labelled, files))
    blank = (F.size("fields") == 1) & (F.get("fields", F.lit(0)) == "")
    return lines.filter(~is_valid_line() & ~blank).groupBy("input_file").agg(F.count("*").alias("num_lines"))


def read_raw(
    spark: SparkSession, directory: str, labelled: bool = True, merge: bool = True, files: str | None = None
) -> DataFrame:
    """``(input_file, label_str, label, word, word_count)``; ``label`` is the base-26 code of the letters.

    ``merge`` adds up the counts of words that normalization makes equal, leaving one row per document and word.
    Both label columns are null when not ``labelled`` or when the path holds no class directory.
    """
    many = many_files(spark, *files_of(directory, labelled, files))
    if many is None:
        rows = labelled_rows(merged_words(parse_lines(read_lines(spark, directory, labelled, files)), merge), labelled)
    else:
        # Once per file, before its lines are unfolded.
        contents = labelled_rows(many.contents, labelled)
        rows = parse_lines(unfolded(contents, merged_lines() if merge else content_lines()))
        if many.lines is not None:
            rows = rows.unionByName(labelled_rows(merged_words(parse_lines(fields_of(many.lines)), merge), labelled))
    return rows.select("input_file", "label_str", "label", "word", "word_count")


def merged_words(rows: DataFrame, merge: bool) -> DataFrame:
    if not merge:
        return rows
    return rows.groupBy("input_file", "word").agg(F.sum("word_count").cast("int").alias("word_count"))


def labelled_rows(rows: DataFrame, labelled: bool) -> DataFrame:
    label = label_from_path("input_file") if labelled else F.lit(None).cast("string")
    return rows.withColumn("label_str", label).withColumn("label", base26_code("label_str"))


def raw_documents(
    bow: DataFrame, doc: str = "doc_id", folder: str = "folder", extra: Column | None = None
) -> DataFrame:
    """``(doc, folder, content)``: the ``word count`` lines of every document, ``extra`` lines after them."""
    lines = F.sort_array(F.collect_list(F.concat_ws(" ", "word", "word_count")))
    content = F.concat_ws("\n", lines, *([F.first(extra)] if extra is not None else []))
    return bow.groupBy(doc, folder).agg(content.alias("content"))


def raw_contents(
    table: DataFrame, doc: str = "doc_id", folder: str = "folder", text: str = "text", extra: Column | None = None
) -> DataFrame:
    """``raw_documents`` of the words of ``text``, made inside each row, without a shuffle: ``doc`` must not repeat."""
    counted = F.expr("transform(starts, (at, run) -> concat_ws(' ', words[at], coalesce(get(starts, run + 1), size(words)) - at))")
    content = F.concat_ws("\n", F.sort_array(counted), *([extra] if extra is not None else []))
    return word_runs(table, doc, text, [folder]).select(doc, folder, content.alias("content"))


def write_raw(documents: DataFrame, directory: str, folder: str = "folder", content: str = "content") -> None:
    """One small text file per document, in the directory ``folder`` (``Training/classA``) below ``directory``.

    Files end in ``.txt``: read them with ``files``. A folder must not be there before. Rows without a folder are left
    out. ``documents`` is read twice: pass a written table. A task that runs again writes files of the same names.
    """
    spark = documents.sparkSession
    folders = [r[0] for r in documents.select(folder).distinct().orderBy(folder).collect()]  # one per set and class
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(directory.rstrip("/"))
    files = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if files.getUri().getScheme() == "file":
        # Spark's writer starts processes for the mode of every file on such a file system, which takes far longer than
        # the file; tasks write the files themselves.
        local = files.makeQualified(root).toUri().getPath()
        for name in filter(None, folders):
            os.makedirs(f"{local}/{name}")
        placed = documents.filter(F.col(folder).isNotNull()).select(F.col(folder).alias("folder"), F.col(content).alias("content"))
        placed.mapInArrow(file_writer(local), "files bigint").agg(F.sum("files")).collect()
        return
    # Tasks move their files into place: one after another, on the driver, takes long for many small files.
    options = {"maxRecordsPerFile": 1, "mapreduce.fileoutputcommitter.algorithm.version": 2}
    for name in folders:
        mine = documents.filter(F.col(folder) == name).select(content)
        mine.write.options(**options).text(f"{directory.rstrip('/')}/{name}")


def file_writer(directory: str):
    """Writes every row's ``content``, as a line, to a file of its own in its ``folder`` below a shared ``directory``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context, written = TaskContext.get(), 0
        for batch in batches:
            for folder, content in zip(batch.column("folder"), batch.column("content"), strict=True):
                path = f"{directory}/{folder.as_py()}"
                name = f"part-{context.partitionId():05d}-{written:07d}.txt"
                # Hidden until it is whole; attempts do not share the file.
                part = f"{path}/.{name}.{context.taskAttemptId()}"
                with open(part, "wb") as file:
                    file.write((content.as_py() or "").encode() + b"\n")
                os.replace(part, f"{path}/{name}")
                written += 1
        yield pa.RecordBatch.from_pydict({"files": pa.array([written], pa.int64())})

    return run


def fit_labels(bow: DataFrame, label: str = "label_str") -> DataFrame:
    """``(label_str, label)``: dense class ids 0, 1, 2, ... in the order of the sorted distinct names."""
    names = bow.select(F.col(label).alias("label_str")).filter("label_str is not null").distinct()
    table, size = number_rows(names, "label_str", "label")
    return broadcast_if_small(table.withColumn("label", F.col("label").cast("int")), size)


def encode_labels(bow: DataFrame, labels: DataFrame) -> DataFrame:
    """Replace ``label`` by the dense id of ``label_str``: ``UNSEEN`` for a name the table does not hold, null for none."""
    columns = bow.columns
    joined = bow.drop("label").join(labels, "label_str", "left")
    unseen = F.when(F.col("label_str").isNotNull(), UNSEEN)
    return joined.withColumn("label", F.coalesce("label", unseen)).select(*columns)
