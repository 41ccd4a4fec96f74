from __future__ import annotations

import random

import pytest

from bowline.plans.classification import KINDS, classify_directory
from bowline.plans.preprocessing import PreprocessModel, preprocess_directory
from bowline.sources.processed import read_processed
from tests.conftest import rows_of


@pytest.fixture(scope="module")
def raw_root(tmp_path_factory):
    root, rng = tmp_path_factory.mktemp("raw"), random.Random(3)
    for split, docs in (("Training", 30), ("Validation", 12)):
        for n in range(docs):
            label = "ABC"[n % 3]
            words = {f"{label.lower()}{rng.randrange(6)}": rng.randrange(1, 5) for _ in range(5)}
            words |= {f"x{rng.randrange(12)}": 1 for _ in range(3)} | {"common": 3, "Common": 1}
            folder = root / split / f"class{label}"
            folder.mkdir(parents=True, exist_ok=True)
            (folder / f"{n}.res").write_text("".join(f"{w} {c}\n" for w, c in words.items()) + "bad line here\n")
    return str(root)


def test_preprocess_and_classify_directories(spark, raw_root, tmp_path):
    out = str(tmp_path / "processed")
    model = preprocess_directory(spark, raw_root, out, num_top_features=20, drop_freq=0.5)
    assert rows_of(model.labels) == [("A", 0), ("B", 1), ("C", 2)]
    training = read_processed(spark, f"{out}/Training")
    assert training.count() == 30 and read_processed(spark, f"{out}/Validation").count() == 12
    assert {r["num_features"] for r in training.collect()} == {model.num_features}
    model.save(str(tmp_path / "model"))
    assert PreprocessModel.load(spark, str(tmp_path / "model"), labels=True).labels.count() == 3
    for kind in KINDS:
        result = classify_directory(spark, out, kind, 20, **({} if kind == "softmax" else {"learning_rate": 0.3}))
        scores = {r["split"]: r for r in result.metrics().collect()}
        assert scores["training"]["num_docs"] == 30 and scores["validation"]["num_docs"] == 12
        assert scores["validation"]["accuracy"] > 0.6


def test_other_encodings_and_formats(spark, raw_root, tmp_path):
    out = str(tmp_path / "both")
    model = preprocess_directory(
        spark, raw_root, out, encoding="base26", formats=("csv", "parquet"), num_top_features=20, drop_freq=0.5
    )
    assert model.labels is None
    as_csv = rows_of(read_processed(spark, f"{out}/csv/Training"))
    assert as_csv == rows_of(read_processed(spark, f"{out}/parquet/Training", "parquet"))
    with pytest.raises(ValueError, match="encoding"):
        preprocess_directory(spark, raw_root, out, encoding="other")
