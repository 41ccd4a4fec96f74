"""The pipeline as a whole: what it writes, what it leaves behind, and what it does with odd tables."""

from __future__ import annotations

import pytest

from bowline import staging
from tests.llm.test_native import ODD, SCHEMA

LABELS = "doc_id long, quality int, toxic int"


@pytest.mark.parametrize("rows", ["odd", "empty"])
def test_pipeline_run_leaves_its_result_alone(spark, tmp_path, rows):
    pipeline = pytest.importorskip("corpus_pipeline")
    odd = spark.createDataFrame(ODD, SCHEMA)
    long = spark.createDataFrame([(50 + i, " ".join(f"w{i}_{k}" for k in range(60)), "en", "s", 1) for i in range(3)], SCHEMA)
    docs = odd.unionByName(long)
    (docs if rows == "odd" else docs.limit(0)).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], LABELS).write.parquet(str(tmp_path / "labels.parquet"))
    before = staging.staged_count()
    out = pipeline.run(spark, str(tmp_path))
    assert staging.staged_count() == before + 1  # the result; the stages' own tables are gone
    got = out.collect()
    assert set(out.columns) == {"doc_id", "lang", "source", "n_tokens", "token_ids", "decoded_sha256"}
    assert (rows == "empty") == (not got)
    assert all(r["n_tokens"] == len(r["token_ids"]) for r in got)
