"""Rank-queue encoding, whitening and hard negatives against libraries, numpy and plain Python."""

from __future__ import annotations

import base64
import hashlib
import random
from decimal import Decimal

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from bowline.llm import hard_negatives, queries, rank_bpe, whitening
from tests.conftest import DATA
from tests.llm.test_native import ODD, SCHEMA


# Encoding by ranks.


@pytest.fixture(scope="module")
def library():
    lines = rank_bpe.rank_file().splitlines()
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def encoder():
    return rank_bpe.Encoder(rank_bpe.rank_file())


def test_queue_gives_lowest_rank_then_leftmost_position():
    rng, queue, held = random.Random(2), rank_bpe.RankQueue(70_000), []
    for _ in range(3000):
        if held and rng.random() < 0.5:
            assert queue.pop() == min(held)
            held.remove(min(held))
        else:
            held.append((rng.choice([0, 255, 256, 65_535, 69_999, rng.randrange(70_000)]), rng.randrange(50)))
            queue.push(*held[-1])
        assert bool(queue.top) == bool(held)


@pytest.mark.parametrize("letters", ["ab", "a", "aAb ", "\n\t x", "日本語ab", "🙂é'st 12", " \x1c\x85　a", "<|endoftext|>"])
def test_encoder_equals_library(encoder, library, letters):
    rng = random.Random(7)
    for size in (0, 1, 2, 9, 70, 700, 7000):
        text = "".join(rng.choice(letters) for _ in range(size))
        ids = encoder.encode(text)
        assert ids.tolist() == library.encode_ordinary(text)
        assert encoder.decode(ids).decode() == text


def test_one_very_long_pretoken(encoder, library):
    rng = random.Random(8)
    for text in ("a" * 200_000, "".join(rng.choice("abcdefgh") for _ in range(200_000))):
        assert encoder.encode(text).tolist() == library.encode_ordinary(text)


def test_memory_of_pretokens_is_bounded(monkeypatch, library):
    monkeypatch.setattr(rank_bpe, "REMEMBERED", 10)
    monkeypatch.setattr(rank_bpe, "PIECES", 7)
    small = rank_bpe.Encoder(rank_bpe.rank_file())
    text = " ".join(f"wort{i * i} x" for i in range(300))
    assert small.encode(text).tolist() == library.encode_ordinary(text)
    assert len(small) + len(small.older) <= 10


def test_ids_outside_the_file_spell_nothing_and_single_bytes_are_needed(encoder):
    assert encoder.decode(np.array([-1, 10**6, encoder.ranks[b"a"]])) == b"a"
    with pytest.raises(ValueError, match="single bytes"):
        rank_bpe.Encoder(base64.b64encode(b"a") + b" 0\n")


def test_rank_bpe_on_odd_rows(spark, library):
    odd = spark.createDataFrame(ODD, SCHEMA).repartition(3).withColumn("token_ids", F.lit("mine"))
    got = rank_bpe.encode_and_decode(odd)
    assert [c for c in got.columns if c not in odd.columns] == ["token_ids_", "decoded"]
    texts = sorted((r.doc_id is None, r.doc_id or 0, r.text or "") for r in odd.collect())
    coded = sorted((r.doc_id is None, r.doc_id or 0, bytes(r.decoded).decode()) for r in got.collect())
    assert coded == texts
    for r in got.collect():
        assert r.token_ids == "mine" and r.token_ids_ == library.encode_ordinary(bytes(r.decoded).decode())
    assert rank_bpe.encode_and_decode(odd.limit(0)).count() == 0


def test_rank_bpe_query(spark, library):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}
    rows = queries.op11_rank_bpe(spark, DATA).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = library.encode_ordinary(texts[r.doc_id])
        packed = np.array(ids, "<u4").tobytes()
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(packed).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


# Whitening.


def symmetric(kind: str, n: int) -> np.ndarray:
    rng = np.random.default_rng(n)
    a = rng.standard_normal((n, n))
    q, _ = np.linalg.qr(a)
    if kind == "random":
        return a @ a.T
    if kind == "repeated":  # eigenvalues 5, 5, 5, 1, 1, ...
        return (q * np.where(np.arange(n) < 3, 5.0, 1.0)) @ q.T
    if kind == "close":
        return (q * (1.0 + 1e-9 * np.arange(n))) @ q.T
    if kind == "diagonal":
        return np.diag(np.arange(n, dtype=float) + 1)
    return np.outer(a[0], a[0]) * 1e200  # of rank one, large


@pytest.mark.parametrize("n", [1, 2, 3, 9, 40])
@pytest.mark.parametrize("kind", ["random", "repeated", "close", "diagonal", "thin"])
def test_components_of_a_matrix(kind, n):
    v = symmetric(kind, n)
    values, vectors = whitening.leading_components(v, 8)
    want = np.linalg.eigvalsh(v / np.abs(v).max())[::-1][:8] * np.abs(v).max()
    assert len(values) == (1 if kind == "thin" else min(n, 8))
    assert np.allclose(values, want[: len(values)], rtol=1e-12, atol=1e-13 * np.abs(v).max())
    assert np.abs(vectors.T @ vectors - np.eye(len(values))).max() < 1e-12
    unit = v / np.abs(v).max()
    assert np.abs(unit @ vectors - vectors * (values / np.abs(v).max())).max() < 1e-12 * n


def test_sturm_counts():
    diagonal, off, q = whitening.tridiagonal(symmetric("random", 12))
    t = np.diag(diagonal) + np.diag(off, 1) + np.diag(off, -1)
    assert np.allclose(q @ t @ q.T, symmetric("random", 12))
    values = np.linalg.eigvalsh(t)
    at = np.linspace(values[0] - 1, values[-1] + 1, 50)
    assert whitening.count_below(diagonal, off, at).tolist() == [(values < x).sum() for x in at]


def test_exact_squares_beyond_64_bits():
    rows = np.array([[3, -5], [10**6, 7]])
    for n in (4, 10**12):
        want = [Decimal(sum((n * x + r) ** 2 for x, r in zip(row, (1, -2), strict=True))) for row in rows.tolist()]
        assert whitening.exact_squares(rows, n, [1, -2]) == want


VECTORS = "vec_id long, embedding array<float>, label int, whitened string"


def vectors_by_hand(rows, k):
    """vec_id -> (deviation, whitened up to sign), by numpy's own solver."""
    used = [r for r in rows if r[1] and all(c is not None and np.isfinite(c) for c in r[1])]
    x = np.floor(1024 * np.array([r[1] for r in used], np.float32).astype(float)) + 100_000
    values, vectors = np.linalg.eigh(np.cov(x.T, bias=True))
    order = np.argsort(-values)[:k]
    out = (x - x.mean(0)) @ vectors[:, order] / np.sqrt(values[order])
    sums = [int(s) for s in x.sum(0)]
    deviation = [sum((len(x) * int(v) - s) ** 2 for v, s in zip(row, sums, strict=True)) for row in x]
    return [r[0] for r in used], deviation, out


def test_whitening_of_odd_rows(spark):
    rng = np.random.default_rng(4)
    rows = [(i, (rng.standard_normal(5) * [3, 2, 1, 0.5, 0.2]).astype(np.float32).tolist(), 1, "x") for i in range(60)]
    rows += [rows[0], (None, rows[1][1], None, None), (70, None, 1, "x"), (71, [], 1, "x")]
    rows += [(72, [1.0, None, 1.0, 1.0, 1.0], 1, "x"), (73, [float("nan")] * 5, 1, "x"), (74, [float("inf")] + [0.0] * 4, 1, "x")]
    df = spark.createDataFrame(rows, VECTORS).repartition(5)
    model = whitening.fit(df, components=3)
    got = whitening.transform(df, model)
    assert got.columns == ["vec_id", "label", "whitened", "deviation", "whitened_"]
    ids, deviation, out = vectors_by_hand(rows, 3)
    key = lambda t: (t[0] is None, t[0] or 0, t[1], t[2])
    mine = sorted(((r.vec_id, int(r.deviation), np.abs(r.whitened_).round(9).tolist()) for r in got.collect()), key=key)
    want = sorted(((i, d, np.abs(w).round(9).tolist()) for i, d, w in zip(ids, deviation, out, strict=True)), key=key)
    assert [m[:2] for m in mine] == [w[:2] for w in want]
    assert np.allclose([m[2] for m in mine], [w[2] for w in want], atol=1e-8)
    assert whitening.identity_error(got, 3, "whitened_") < 1e-10


def test_whitening_without_variance_or_rows(spark):
    df = spark.createDataFrame([(i, [1.0, 2.0], 0, "") for i in range(4)], VECTORS)
    for rows, n in ((df, 4), (df.limit(0), 0), (df.withColumn("embedding", F.lit(None).cast("array<float>")), 0)):
        model = whitening.fit(rows)
        assert (model.n, len(model.values)) == (n, 0)
        assert whitening.transform(rows, model).count() == n
    with pytest.raises(Exception, match="lengths|entries"):
        whitening.fit(df.union(df.withColumn("embedding", F.array(F.lit(1.0)))))


def test_whitening_query(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{DATA}/embeddings.parquet").collect()]
    ids, deviation, out = vectors_by_hand(rows, 8)
    got = sorted(queries.op12_whitening(spark, DATA).collect(), key=lambda r: (r.vec_id, r.component))
    assert len(got) == 8 * len(ids)
    assert {(r.vec_id, r.deviation) for r in got} == set(zip(ids, deviation, strict=True))
    mine = np.array([r.whitened for r in got]).reshape(-1, 8)
    out = out[np.argsort(ids)]
    assert np.allclose(mine * np.sign((mine * out).sum(0)), out, atol=1e-7)
    assert {r.n for r in got} == {len(ids)} and max(r.identity_error for r in got) < 1e-10
    x = np.floor(1024 * np.array([r[1] for r in rows], np.float32).astype(float))
    values = np.linalg.eigvalsh(np.cov(x.T, bias=True))[::-1]
    assert np.allclose([r.explained for r in got[:8]], values[:8] / values.sum(), rtol=1e-9)


# Hard negatives.


def mined_by_hand(rows, is_anchor, positives=5, negatives=5):
    used = [(n, v, lab, [int(np.floor(256 * float(np.float32(c)))) for c in x]) for n, (v, x, lab) in enumerate(rows)]
    out = []
    for n, v, lab, x in used:
        if not is_anchor(v):
            continue
        scored = sorted((-sum(a * b for a, b in zip(x, y, strict=True)), w, m, other) for m, w, other, y in used if m != n)
        near = [(w, -s) for s, w, _, other in scored if other == lab][:positives]
        for positive, score in near:
            hard = [(w, -s) for s, w, _, other in scored if other != lab and 80 * score <= -100 * s <= 100 * score]
            out += [(v, positive, k + 1, w, score, s) for k, (w, s) in enumerate(hard[:negatives])]
    return sorted(out)


def random_vectors(count, dimensions, seed=5):
    rng = np.random.default_rng(seed)
    base = rng.standard_normal((8, dimensions))
    rows = []
    for i in range(count):
        x = base[rng.integers(8)] + 0.7 * rng.standard_normal(dimensions)
        rows.append((i, (x / np.linalg.norm(x)).astype(np.float32).tolist(), int(rng.integers(3))))
    return rows


@pytest.mark.parametrize("dimensions", [1, 3, 64, 100])
def test_hard_negatives_by_hand(spark, monkeypatch, dimensions):
    monkeypatch.setattr(hard_negatives, "ROWS", 40)
    monkeypatch.setattr(hard_negatives, "ANCHORS", 7)
    rows = random_vectors(150, dimensions)
    rows += [(200 + i, rows[0][1], i % 2) for i in range(40)]  # a group of equal vectors
    odd = [(None, rows[0][1], 1), (300, None, 1), (301, rows[0][1], None), (302, [], 1), (303, [float("nan")] * dimensions, 1)]
    df = spark.createDataFrame([(*r, "x") for r in rows + odd], VECTORS).repartition(5)
    got = hard_negatives.mine(df, F.col("vec_id") % 10 == 0)
    assert sorted(map(tuple, got.collect())) == mined_by_hand(rows, lambda v: v % 10 == 0)


def test_repeated_rows_ties_and_empty_tables(spark):
    rows = [(0, [1.0, 0.0], 1), (0, [1.0, 0.0], 1), (1, [1.0, 0.0], 2), (1, [1.0, 0.0], 2), (2, [0.9, 0.1], 2), (3, [-1.0, 0.0], 3)]
    df = spark.createDataFrame([(*r, "x") for r in rows], VECTORS)
    got = hard_negatives.mine(df, F.col("vec_id") == 0)
    assert sorted(map(tuple, got.collect())) == mined_by_hand(rows, lambda v: v == 0)
    assert hard_negatives.mine(df.limit(0), F.col("vec_id") == 0).count() == 0
    assert hard_negatives.mine(df, F.lit(False)).count() == 0
    assert hard_negatives.mine(df, F.col("vec_id") == 3).count() == 0  # no positives
    large = spark.createDataFrame([(i, [3e5 * (i + 1), 1.0], i % 2, "x") for i in range(6)], VECTORS)
    want = mined_by_hand([(r[0], r[1], r[2]) for r in large.collect()], lambda v: v == 0)
    assert sorted(map(tuple, hard_negatives.mine(large, F.col("vec_id") == 0).collect())) == want


def test_intervals_hold_and_rule_rows_out():
    rng = np.random.default_rng(9)
    base = rng.standard_normal((10, 64))
    v = np.floor(256 * (base[rng.integers(10, size=500)] + 0.3 * rng.standard_normal((500, 64))) / 8)
    q = v[:40]
    turn = hard_negatives.rotation(64)
    words, aligned, left = hard_negatives.codes_of(v @ turn, 3)
    low, high = hard_negatives.intervals(hard_negatives.Rounded(q @ turn), slice(0, 40), words, aligned, left)
    true = q @ v.T
    assert (low <= true).all() and (true <= high).all()
    assert (high < 0.8 * np.sort(true, axis=1)[:, -6:-5]).mean() > 0.5
