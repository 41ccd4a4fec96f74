"""The operators that work in tasks (classifier, Jaccard join, licence scans, BPE, LM) against plain Python."""

from __future__ import annotations

import hashlib
import math
import random
import re
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from bowline.llm import bpe, bytewords, components, jaccard_join, license_scan, lm, quality_classifier
from tests.llm.test_native import ODD, SCHEMA

LOWER = lambda t: re.sub("[A-Z]", lambda m: m.group().lower(), t or "")


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, SCHEMA).repartition(3)


# Words of bytes.


def test_word_hashes_tell_words_apart(monkeypatch):
    monkeypatch.setattr(bytewords, "SLICE", 50)
    rng = random.Random(3)
    texts = ["".join(rng.choice("abcÄé日 \t\n") for _ in range(rng.randint(0, 130))) for _ in range(200)] + [None, "x" * 300]
    hasher = bytewords.WordHasher(bytewords.not_spaces(), lower=True)
    names, back, row = {}, {}, 0
    for lo, hi, hashes, firsts in hasher.slices(pa.array(texts)):
        for i in range(lo, hi):
            assert i == row
            row += 1
            found = hashes[firsts[i - lo] : firsts[i - lo + 1]].tolist()
            want = re.findall(r"[^\x20\x09-\x0D]+", LOWER(texts[i]))
            assert len(found) == len(want)
            for h, w in zip(found, want, strict=True):
                assert names.setdefault(h, w) == w
                assert back.setdefault(w, h) == h
    assert row == len(texts)


# Components.


def test_components(spark):
    rng = random.Random(5)
    edges = [(i, i + 1) for i in range(100, 160)] + [(rng.randrange(200, 300), rng.randrange(200, 300)) for _ in range(60)]
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        ra, rb = root(a), root(b)
        parent[max(ra, rb)] = min(ra, rb)
    got = dict(components.components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert got == {x: root(x) for a, b in edges if a != b for x in (a, b)}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


# Jaccard join.


def sets_by_hand(rows, ngram):
    out = {}
    for doc_id, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", LOWER(text))
        grams = {tuple(w[i : i + ngram]) for i in range(len(w) - ngram + 1)} if len(w) >= ngram else {tuple(w)} if w else set()
        out[doc_id] = grams
    return out


def links_by_hand(rows, ngram, threshold):
    sets = sets_by_hand(rows, ngram)
    part = {i: i for i in sets}

    def root(x):
        while part[x] != x:
            x = part[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            common = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * common >= threshold * len(sets[a] | sets[b]):
                x, y = root(a), root(b)
                part[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), root(i)) for i in ids}


def near_copies(seed, documents=60, most=60):
    rng = random.Random(seed)
    rows = []
    for _ in range(documents):
        base = [f"w{rng.randrange(40)}" for _ in range(rng.randint(1, most))]
        for _ in range(rng.choice([1, 1, 2, 5])):
            w = list(base)
            for _ in range(rng.randint(0, 3)):
                at = rng.randrange(len(w) + 1)
                w[at : at + rng.randint(0, 1)] = rng.choice([[], ["new"], [f"W{rng.randrange(40)}"]])
            rows.append((len(rows), " ".join(w)))
    return rows


@pytest.mark.parametrize(("ngram", "threshold"), [(1, 70), (3, 90), (5, 80)])
def test_jaccard_join(spark, ngram, threshold):
    rows = near_copies(ngram)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {r[0]: (r[1], r[2]) for r in jaccard_join.link(df, ngram=ngram, threshold=threshold).collect()}
    assert got == links_by_hand(rows, ngram, threshold)
    assert any(i != c for i, (_, c) in got.items())


@pytest.mark.parametrize("plan", ["skip", "deletions", "plain", "both"])
def test_every_plan_of_a_level_finds_all_pairs(plan):
    rng = np.random.default_rng(1)
    threshold, lows = 80, jaccard_join.limits(200, 80)
    for _ in range(300):
        x = rng.integers(0, 1 << 60, rng.integers(1, 120)).astype(np.uint64)
        y = np.unique(np.concatenate([x[rng.random(len(x)) > 0.1], rng.integers(0, 1 << 60, rng.integers(0, 8)).astype(np.uint64)]))
        x = np.unique(x)
        if not len(y) or len(np.intersect1d(x, y)) * 100 < threshold * len(np.union1d(x, y)):
            continue
        level = int(np.searchsorted(lows, max(len(x), len(y)), "right")) - 1
        differ = (100 - threshold) * 2 * (lows[level + 1] - 1) // (100 + threshold)
        chosen = {"plain": (differ + 1, -1, 0, False), "skip": (differ + 4, 1, 3, False), "deletions": (differ // 2 + 1, -1, 0, True), "both": (differ // 2 + 4, 2, 3, True)}
        a, b = (jaccard_join.signatures(s, level, chosen[plan]) for s in (x, y))
        assert len(np.intersect1d(a, b))


def test_level_plans_have_enough_segments():
    seen = set()
    for threshold in (60, 80, 90):
        lows = jaccard_join.limits(5000, threshold)
        for k in range(len(lows) - 1):
            for sets in (2, 10**4, 10**9):
                m, skip, slack, deletions = jaccard_join.level_plan(lows[max(0, k - 1)], lows[k + 1] - 1, sets, threshold)
                differ = (100 - threshold) * 2 * (lows[k + 1] - 1) // (100 + threshold)
                assert (2 * (m - slack) if deletions else m - slack) > differ
                seen.add(deletions)
    assert seen == {True, False}


def test_jaccard_join_odd_rows(odd, spark):
    named = odd.withColumns({"gone_id": F.lit(1), "entry": F.lit("e"), "n": F.lit(2)})
    got = sorted(((r[0], r[1], r[2]) for r in jaccard_join.link(named, ngram=3, threshold=90).collect()), key=str)
    want = []
    linked = {3: 3, 4: 3}
    for doc_id, text, *_ in ODD:
        n = len(sets_by_hand([(0, text)], 3)[0])
        want.append((doc_id, n, None if doc_id is None else linked.get(doc_id, doc_id)))
    assert got == sorted(want, key=str)
    out = jaccard_join.drop_near_copies(named)
    assert out.columns == named.columns
    assert out.count() == len(ODD) - 3
    assert jaccard_join.link(odd.limit(0)).count() == 0


def test_one_large_group_of_near_copies(spark):
    base = [f"word{i}" for i in range(200)]
    rows = [(i, " ".join([*base[: i % 190], f"x{i}", *base[i % 190 + 1 :]])) for i in range(400)]
    rows += [(1000 + i, " ".join(f"u{i}_{k}" for k in range(100))) for i in range(100)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    got = {r[0]: r[2] for r in jaccard_join.link(df).collect()}
    assert got == {i: 0 if i < 1000 else i for i, _ in rows}


# Classifier.


def test_classifier_learns_and_handles_odd_rows(spark, odd):
    rng = random.Random(1)
    rows = [(i, " ".join(f"{rng.choice('abcdefgh')}{rng.randrange(50)}{'###' if i % 4 == 0 else ''}" for _ in range(60))) for i in range(600)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 4 != 0)) for i in range(600)] + [(0, 0), (None, 1), (3, None)], "doc_id long, label int")
    held = quality_classifier.held_out()
    weights = quality_classifier.fit(df, labels.filter(~held))
    scored = quality_classifier.score(df.withColumn("score", F.lit("mine")), weights)
    assert scored.columns == ["doc_id", "score", "score_"]
    for doc_id, _, p in scored.filter(held).collect():
        assert (p >= 0.3) == (doc_id % 4 != 0)
    out = quality_classifier.score(odd, weights)
    assert out.count() == len(ODD)
    constant = 1 / (1 + math.exp(-weights[-1]))
    assert all(math.isclose(r["score"], constant) for r in out.filter("doc_id IN (1, 2, 6)").collect())
    assert not quality_classifier.fit(df, labels.limit(0)).any()
    assert quality_classifier.score(odd.limit(0), weights).count() == 0


def test_ftrl_matches_the_formula():
    o = quality_classifier.Ftrl(alpha=0.5, l1=0.01, l2=0.1, passes=2)
    rows = [(np.array([1, 5]), np.array([0.6, 0.8]), 1), (np.array([5, 9]), np.array([0.8, 0.6]), 0)]
    z, n = Counter(), Counter()
    last = quality_classifier.BUCKETS

    def weight(i):
        if abs(z[i]) <= o.l1:
            return 0.0
        return (math.copysign(o.l1, z[i]) - z[i]) / ((o.beta + math.sqrt(n[i])) / o.alpha + o.l2)

    for _ in range(2):
        for places, values, label in rows:
            x = dict(zip([*places, last], [*values, 1.0], strict=True))
            w = {i: weight(i) for i in x}
            p = 1 / (1 + math.exp(-sum(w[i] * x[i] for i in x)))
            for i in x:
                g = (p - label) * x[i]
                sigma = (math.sqrt(n[i] + g * g) - math.sqrt(n[i])) / o.alpha
                z[i] += g - sigma * w[i]
                n[i] += g * g
    got = quality_classifier.train_ftrl(rows, o)
    assert all(math.isclose(got[i], weight(i), abs_tol=1e-12) for i in (1, 5, 9, last))


# Licence scans.


def test_license_scan(spark, odd):
    template = license_scan.TEMPLATES[7][1]
    broken = template.replace("free of charge, ", "").replace("any person", "any other nice person")
    filler = " ".join(f"filler{i}" for i in range(500))
    rows = [
        (1, f"{filler} Released under the MIT-License! {filler}"),
        (2, f"{filler}\n{template}\n{filler}"),
        (3, f"{filler} {broken} {filler}"),
        (4, " ".join(template.split()[:25]) + " " + filler),
        (5, "GNU general public LICENSE, gnu General Public license. CC-BY"),
        (6, "Licensed under CC BY-NC 4.0. Licensed under the Apache License, Version 2.0."),
        (7, None),
        (8, "the mit"),
        (8, "mit license"),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"row": F.lit(1), "gram": F.lit(2)})
    got = {}
    for r in license_scan.scan_licenses(df).collect():
        got.setdefault(int(r["doc_id"]), []).append((r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"], r["labels"], r["score"]))
    (one,) = got[1]
    assert one[1:6] == (1, 503, 503, "mit", "mit") and one[6] == 1.0
    assert got[2][0][1:] == (0, None, None, "", "mit", 1.0)
    assert got[3][0][5] == "mit" and 0.9 < got[3][0][6] < 1
    assert got[4][0][5] == "" and 0 < got[4][0][6] < license_scan.VERIFIED
    assert got[5] == [(10, 3, 0, 8, "cc-by,gpl", "cc-by,gpl", 0.5)]
    assert got[6][0][4:6] == ("apache,cc-by", "apache,cc-by,cc-by-nc")
    assert got[7] == [(0, 0, None, None, "", "", 0.0)]
    assert sorted(x[1] for x in got[8]) == [0, 1]
    assert license_scan.scan_licenses(odd).count() == len(ODD)
    assert license_scan.scan_licenses(odd.limit(0)).count() == 0


# BPE.


@pytest.fixture(scope="module")
def reference_tokenizer():
    public = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public.path("byte_bpe_50k.json"))
    t.no_truncation()
    t.no_padding()
    return t


def test_codec_matches_the_library(reference_tokenizer, monkeypatch):
    monkeypatch.setattr(bpe, "CHUNK", 400)
    monkeypatch.setattr(bpe, "REMEMBERED", 200)
    rng = random.Random(2)
    signs = ["a", "b", "the", " ", " ", "\n", "  ", "\t", "'s", "é", "日本", "😀", "12", "<|endoftext|>", "!#", " ", "\x1c", "　", "\r", "I'll"]
    texts = ["".join(rng.choice(signs) for _ in range(rng.randint(0, 150))) for _ in range(600)]
    texts += ["", "x" * 700, "ab" * 33, "y" * 64, "y" * 65, "the " * 300, "<|endoftext|>", " a", "a ", "\na", "日" * 100, "\x00\x7f"]
    codec = bpe.Codec(bpe.vocabulary())
    ids = codec.encode(texts)
    for text, mine, theirs in zip(texts, ids, reference_tokenizer.encode_batch(texts, add_special_tokens=False), strict=True):
        assert mine.tolist() == theirs.ids
        decoded = codec.decode(mine).decode("utf-8", "replace")
        assert decoded == reference_tokenizer.decode(theirs.ids, skip_special_tokens=False) == text


def test_both_trees_agree():
    codec = bpe.Codec(bpe.vocabulary())
    rng = random.Random(4)
    for _ in range(200):
        raw = bytes(rng.choice(b"thernadio s") for _ in range(rng.randint(2, 60)))
        symbols = codec.first[np.frombuffer(raw, np.uint8)]
        (ids, _) = codec.merge_all([raw.decode()])
        assert ids.tolist() == codec.merge_alone(symbols.tolist())


def test_encode_and_decode(odd, reference_tokenizer):
    named = odd.withColumns({"token_ids": F.lit("mine"), "c0": F.lit(1)})
    out = bpe.encode_and_decode(named)
    assert out.columns == [c for c in named.columns if c != "text"] + ["token_ids_", "decoded_text"]
    want = sorted((str(r[0]), reference_tokenizer.encode(r[1] or "", add_special_tokens=False).ids, r[1] or "") for r in ODD)
    assert sorted((str(r["doc_id"]), r["token_ids_"], r["decoded_text"]) for r in out.collect()) == want
    assert bpe.encode_and_decode(odd.limit(0)).count() == 0


# LM scoring.


def small_model(seed=1):
    rng = np.random.default_rng(seed)
    weight = rng.random(lm.CLASSES) + 0.1
    prior = lm.prior_from(rng.integers(0, 3, (lm.CLASSES, lm.CLASSES)).astype(float), weight)
    flat = lm.initial(seed).astype(np.float64)
    flat += rng.normal(0, 0.1, len(flat))
    return flat, lm.Prior(prior.group.astype(np.float64), prior.member.astype(np.float64)), rng


def test_gradient_by_finite_differences():
    flat, prior, rng = small_model()
    x, y, _ = lm.windows_of([rng.integers(0, lm.CLASSES, 50).astype(np.int32)], 3, lm.CLASSES)
    _, g = lm.gradient(lm.unpack(flat), prior, x, y)
    for j in np.argsort(-np.abs(g))[:: len(g) // 200][:60]:
        up, down = flat.copy(), flat.copy()
        up[j] += 1e-4
        down[j] -= 1e-4
        slope = (lm.gradient(lm.unpack(up), prior, x, y)[0] - lm.gradient(lm.unpack(down), prior, x, y)[0]) / 2e-4
        assert math.isclose(slope, g[j], rel_tol=1e-3, abs_tol=1e-6)


def plain_gradient(w, prior, x, y):
    """Mean loss over the targets and its gradient, every array by its formula."""
    d, lead, n = lm.WIDTH, lm.WINDOW - lm.STEP, len(x)
    h0 = w["token"][x] + w["place"]
    tail = h0[:, lead:]
    q, k, v = tail @ w["query"], h0 @ w["key"], h0 @ w["value"]
    hidden = (np.arange(lm.WINDOW)[None, :] > np.arange(lead, lm.WINDOW)[:, None]) | (x == lm.CLASSES)[:, None, :]
    a = np.where(hidden, -np.inf, q @ k.transpose(0, 2, 1) / math.sqrt(d))
    a = np.exp(a - a.max(2, keepdims=True))
    a /= a.sum(2, keepdims=True)
    c = a @ v
    h1 = tail + c @ w["mix"]
    z = np.maximum(h1 @ w["up"] + w["up_bias"], 0)
    h2 = h1 + z @ w["down"]
    g, loss, d_h2 = {name: np.zeros(shape) for name, shape in lm.shapes().items()}, 0.0, np.zeros_like(h2)
    real = [(i, j) for i in range(n) for j in range(lm.STEP) if y[i, j] < lm.CLASSES]
    for i, j in real:
        before, (of, inside), state = x[i, lead + j], divmod(y[i, j], lm.MEMBERS), h2[i, j]
        for name, logits, picked in (
            ("group", state @ w["group"] + prior.group[before], of),
            ("member", state @ w["member"][of] + prior.member[before * lm.GROUPS + of], inside),
        ):
            share = np.exp(logits - logits.max())
            share /= share.sum()
            loss -= math.log(share[picked]) / len(real)
            share[picked] -= 1
            to, slope = (w[name], g[name]) if name == "group" else (w[name][of], g[name][of])
            slope += np.outer(state, share) / len(real)
            d_h2[i, j] += to @ share / len(real)
    over = lambda m, o: np.einsum("nij,nik->jk", m, o)
    d_z = d_h2 @ w["down"].T * (z > 0)
    d_h1 = d_h2 + d_z @ w["up"].T
    d_c = d_h1 @ w["mix"].T
    d_a = d_c @ v.transpose(0, 2, 1)
    d_s = a * (d_a - (d_a * a).sum(2, keepdims=True)) / math.sqrt(d)
    d_q, d_k, d_v = d_s @ k, d_s.transpose(0, 2, 1) @ q, a.transpose(0, 2, 1) @ d_c
    d_h0 = d_k @ w["key"].T + d_v @ w["value"].T
    d_h0[:, lead:] += d_h1 + d_q @ w["query"].T
    np.add.at(g["token"], x, d_h0)
    g["token"][lm.CLASSES] = 0
    g |= {"place": d_h0.sum(0), "query": over(tail, d_q), "key": over(h0, d_k), "value": over(h0, d_v), "mix": over(c, d_h1)}
    g |= {"up": over(h1, d_z), "up_bias": d_z.sum((0, 1)), "down": over(z, d_h2)}
    return loss, np.concatenate([g[name].reshape(-1) for name in lm.shapes()])


def some_windows(rng, sizes=(50, 3, 700, 0, 24)):
    x, y, _ = lm.windows_of([rng.zipf(1.3, n).clip(1, lm.CLASSES).astype(np.int32) - 1 for n in sizes], 3, lm.CLASSES)
    assert (x == lm.CLASSES).any() and (y == lm.CLASSES).any()
    return x, y


@pytest.mark.parametrize("size", [1, 30])  # 30: shares of attention and of classes that underflow without a shift by row
def test_gradient_by_plain_formulas(size):
    flat, prior, rng = small_model()
    x, y = some_windows(rng)
    w = lm.unpack(flat)
    for name in ("query", "key", "group", "member"):
        w[name][:] *= size
    want, got = plain_gradient(w, prior, x, y), lm.gradient(w, prior, x, y)
    assert math.isclose(want[0], got[0], rel_tol=1e-6)
    assert np.allclose(want[1], got[1], rtol=1e-6, atol=1e-9 * np.abs(want[1]).max())


def test_training_is_adam_on_the_gradients():
    flat, prior, rng = small_model()
    x, y = some_windows(rng)
    options = lm.Training(batch=4)
    assert len(x) % 4  # the last batch is smaller
    want, first, second = flat.copy(), np.zeros_like(flat), np.zeros_like(flat)
    order = np.random.default_rng(7).permutation(len(x))
    for t, lo in enumerate(range(0, len(x), 4), 1):
        rows = order[lo : lo + 4]
        g = plain_gradient(lm.unpack(want), prior, x[rows], y[rows])[1]
        first, second = 0.9 * first + 0.1 * g, 0.99 * second + 0.01 * g * g
        want -= options.rate * math.sqrt(1 - 0.99**t) / (1 - 0.9**t) * first / (np.sqrt(second) + 1e-8)
    prepared, got = lm.PREPARED, []
    for lm.PREPARED in (2, prepared):
        got.append(lm.train(flat, prior, x, y, options, 7))
    assert lm.PREPARED == prepared
    assert (got[0] == got[1]).all() and np.abs(want - flat).max() > 1e-2
    assert np.allclose(want, got[0], atol=1e-6)


def test_training_steps_use_their_arrays_again():
    flat, prior, rng = small_model()
    flat, prior = flat.astype(np.float32), lm.Prior(prior.group.astype(np.float32), prior.member.astype(np.float32))
    x, y = some_windows(rng, (400,))
    step = lm.Gradient(lm.unpack(flat), prior, 16)
    batches = list(lm.batches_of(x[None, :16], y[None, :16])) * 2
    tracemalloc.start()
    try:
        for b in batches:
            step(b)
        assert tracemalloc.get_traced_memory()[1] < 300_000  # a step's arrays have some 2 MB
    finally:
        tracemalloc.stop()


def test_scores_are_probabilities_and_causal():
    flat, prior, rng = small_model()
    w = lm.unpack(flat.astype(np.float32))
    scorer = lm.Scorer(w, lm.Prior(prior.group.astype(np.float32), prior.member.astype(np.float32)))
    x = rng.integers(0, lm.CLASSES, (1, lm.WINDOW))
    total = np.zeros(lm.STEP)
    for c in range(lm.CLASSES):
        total += np.exp(scorer(x, np.full((1, lm.STEP), c))[0])
    assert np.allclose(total, 1, atol=1e-3)
    y = rng.integers(0, lm.CLASSES, (1, lm.STEP))
    later = x.copy()
    later[0, -1] = (later[0, -1] + 1) % lm.CLASSES
    assert np.allclose(scorer(x, y)[0, :-1], scorer(later, y)[0, :-1], atol=1e-4)


@pytest.mark.parametrize("ids", [50, 50_000])
def test_count_pairs(ids):
    rng = np.random.default_rng(ids)
    first, second = (rng.integers(0, ids, 20_000).astype(np.int32) for _ in range(2))
    pairs, counts = lm.count_pairs(first, second)
    got = {divmod(p, lm.PAIR): n for p, n in zip(pairs.tolist(), counts.tolist(), strict=True)}
    assert got == Counter(zip(first.tolist(), second.tolist(), strict=True))
    assert not len(lm.count_pairs(first[:0], second[:0])[0])


def test_variants_of_licences_are_not_taken_for_each_other(spark):
    cc, gnu = "This work is licensed under a Creative Commons Attribution{} 4.0 International License.", "GNU {} Public License, version 3"
    cases = [(cc.format(""), "cc-by")]
    cases += [(cc.format(a), b) for a, b in (("-NonCommercial", "cc-by-nc"), ("-ShareAlike", "cc-by-sa"), ("-NoDerivatives", "cc-by-nd"))]
    cases += [(cc.format(f"-NonCommercial-{a}"), f"cc-by-nc-{b}") for a, b in (("ShareAlike", "sa"), ("NoDerivatives", "nd"))]
    cases += [(f"Licensed under CC BY{a.upper()} 4.0.", f"cc-by{a}") for a in ("", "-nc", "-sa", "-nd", "-nc-sa", "-nc-nd")]
    cases += [(f"This work is licensed under the {gnu.format(a)}.", b) for a, b in (("General", "gpl"), ("Lesser General", "lgpl"), ("Affero General", "agpl"))]
    both = f"{cc.format('-ShareAlike')} {'word ' * 30} {cc.format('-NonCommercial')}"
    cases += [(both, "cc-by-nc,cc-by-sa"), (cc.format("").replace("4.0", "as we said before and will say again 4.0"), "")]
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(cases)], "doc_id long, text string")
    got = {int(r["doc_id"]): r for r in license_scan.scan_licenses(df).collect()}
    for i, (text, label) in enumerate(cases):
        mine = set(got[i]["labels"].split(",")) - set(got[i]["base_labels"].split(","))
        base = set(got[i]["base_labels"].split(",")) - {""}
        assert mine | (base & {label}) == set(label.split(",")) or (mine == set() and not label and not base), text
        assert 0 <= got[i]["score"] <= 1


def test_base_columns_of_the_licence_query_by_hand(spark):
    from bowline.llm import queries
    from tests.conftest import DATA

    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}
    for r in queries.op8_license_scan(spark, DATA).collect():
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", LOWER(texts[r["doc_id"]]))
        places = [
            (i, label)
            for phrase, label in license_scan.PHRASES.items()
            for i in range(len(words))
            if words[i : i + len(phrase.split())] == phrase.split()
        ]
        assert (r["n_words"], r["n_base"]) == (len(words), len(places))
        assert (r["first_word"], r["last_word"]) == ((min(places)[0], max(places)[0]) if places else (None, None))
        assert r["base_labels"] == ",".join(sorted({label for _, label in places}))
        assert {label for _, label in places} <= set(r["labels"].split(","))


def test_sketches_never_hide_a_link():
    rng = np.random.default_rng(7)
    threshold, rows = 90, []
    base = np.arange(300)
    sets = [set(rng.permutation(base)[: rng.integers(270, 300)].tolist()) for _ in range(60)]
    for i, s in enumerate(sets):
        buckets = 2 * jaccard_join.buckets_of(len(s), threshold)
        sketch = jaccard_join.parities_of(np.array(sorted(s), np.uint64), buckets)
        smaller = jaccard_join.parities_of(np.array(sorted(s), np.uint64), buckets // 4)
        assert np.array_equal(jaccard_join.folded_parities(sketch.tobytes(), len(smaller)), smaller)
        rows.append((1, 0, 0, len(s), i, i, sketch.tobytes()))
    linked = {(i, k) for i in range(60) for k in range(i) if 100 * len(sets[i] & sets[k]) >= threshold * len(sets[i] | sets[k])}
    both = [(*r[:3], side, *r[3:]) for side in (0, 1) for r in rows]
    names = ["entry", "i", "j", "side", "n", "rep", "component", "sketch"]
    table = pa.table({c: list(v) for c, v in zip(names, zip(*both, strict=True), strict=True)})
    found = jaccard_join.allowed(table, [0, len(both)], threshold)
    pairs = list(zip(found.column("a").to_pylist(), found.column("b").to_pylist(), strict=True))
    trees = trees_of(pairs, range(60))
    assert len(pairs) < 60  # a forest, however many pairs are allowed
    assert linked and all(trees[a] == trees[b] for a, b in linked)


def trees_of(pairs, nodes):
    tree = {i: i for i in nodes}
    for a, b in pairs:
        x, y = tree[a], tree[b]
        tree = {i: min(x, y) if t in (x, y) else t for i, t in tree.items()}
    return tree


@pytest.mark.parametrize("threshold", [60, 90])
def test_blocks_send_out_forests_of_true_links(threshold):
    """One group of near copies, many of them just above or below the threshold."""
    rng = np.random.default_rng(threshold)
    base = rng.integers(0, 1 << 63, 200).astype(np.uint64)
    sets = []
    for _ in range(150):
        kept = base[rng.random(200) > rng.choice([0.02, (100 - threshold) / 200])]
        sets.append(np.unique(np.concatenate([kept, rng.integers(0, 1 << 63, rng.integers(1, 9)).astype(np.uint64)])))
    side = rng.integers(0, 2, 150)
    shared = [[len(np.intersect1d(x, y)) for y in sets] for x in sets]
    linked = lambda a, b: 100 * shared[a][b] >= threshold * (len(sets[a]) + len(sets[b]) - shared[a][b])
    for sides in (np.zeros(150, int), side):
        table = pa.table({"rep": np.arange(150), "n": [len(x) for x in sets], "side": sides, "tree": np.arange(150)})
        table = table.append_column("tokens", pa.array([x.tobytes() for x in sets], pa.binary()))
        found = jaccard_join.verified_forest(table, threshold).to_pydict()
        pairs = list(zip(found["a"], found["b"], strict=True))
        wanted = [(a, b) for a in range(150) for b in range(a) if linked(a, b) and 0 in (sides[a], sides[b])]
        assert len(pairs) < 150 < len(wanted)
        assert all(linked(a, b) for a, b in pairs)
        assert trees_of(pairs, range(150)) == trees_of(wanted, range(150))


def thue_morse(n, letters="ab"):
    return "".join(letters[bin(i).count("1") % 2] for i in range(n))


@pytest.mark.parametrize("n", [1024, 2048])
def test_words_that_collide_under_every_polynomial(spark, n):
    """Thue-Morse words and their complements collide modulo 2 ** 64 under every odd base."""
    hasher = bytewords.WordHasher(bytewords.not_spaces(), lower=True)
    (_, _, hashes, _), = hasher.slices(pa.array([f"{thue_morse(n)} {thue_morse(n, 'ba')} {thue_morse(n)}"]))
    assert hashes[0] == hashes[2] != hashes[1]
    rows = [(1, thue_morse(n) + " x y"), (2, thue_morse(n, "ba") + " x y")]
    got = {r[0]: r[2] for r in jaccard_join.link(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: 1, 2: 2}


def test_a_group_of_several_blocks(spark, monkeypatch):
    """Near copies in blocks of few tokens: the first step leaves components that the second one joins."""
    monkeypatch.setattr(jaccard_join, "TOKENS", 3000)
    monkeypatch.setattr(jaccard_join, "BLOCK", 20)
    rng = random.Random(4)
    base = [f"word{i}" for i in range(120)]
    rows = []
    for i in range(90):
        w = list(base)
        for _ in range(rng.choice([1, 2, 3, 4])):
            w[rng.randrange(120)] = f"new{rng.randrange(1000)}"
        rows.append((i, " ".join(w)))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {r[0]: (r[1], r[2]) for r in jaccard_join.link(df).collect()}
    assert got == links_by_hand(rows, 5, 80)


def test_windows_score_every_position_once():
    sequences = [np.arange(n, dtype=np.int32) + 10 for n in (0, 1, 23, 24, 100)]
    x, y, owners = lm.windows_of(sequences, 7, -1)
    for i, s in enumerate(sequences):
        assert y[owners == i][y[owners == i] >= 0].tolist() == [*s.tolist(), 7]
    seen = x[:, lm.WINDOW - lm.STEP :][y >= 0]
    assert (seen >= 0).all()


def test_lm_scores(spark, odd):
    rng = random.Random(6)
    rows = [(i, " ".join(rng.choice(["The", "cat", "sat", "on", "mats", f"n{rng.randrange(99)}"]) for _ in range(rng.randint(1, 80)))) for i in range(300)]
    rows += [(1000, None), (1001, ""), (1001, "the Cat")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"row": F.lit(1), "key": F.lit("k")})
    tokens = [re.findall(r"[^\x20\x09-\x0D]+", LOWER(t)) + ["\n"] for _, t in rows]
    held = [zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in rows]
    counts = Counter(w for t, h in zip(tokens, held, strict=True) if not h for w in t)
    total, kinds = sum(counts.values()), len(counts)
    want = sorted(
        (str(i), h, len(t), sum(counts[w] > 0 for w in t), total, round(sum(math.log10((counts[w] + 1) / (total + kinds + 1)) for w in t), 6))
        for (i, _), t, h in zip(rows, tokens, held, strict=True)
    )
    for frequent in (lm.FREQUENT, 4):
        lm.FREQUENT, before = frequent, lm.FREQUENT
        try:
            out = lm.score_documents(df).collect()
        finally:
            lm.FREQUENT = before
        assert sorted((*r[:5], round(r["base_score"], 6)) for r in out) == want
        assert all(r["score"] < 0 for r in out)
    assert lm.score_documents(odd).count() == len(ODD)
    assert lm.score_documents(odd.limit(0)).count() == 0


def test_the_model_is_not_cut_for_speed():
    assert (lm.WIDTH, lm.HIDDEN, lm.Training().batch) == (32, 64, 16)


def gathered_runs(df):
    file = df.sparkSession.sparkContext.broadcast(bpe.vocabulary())
    rows = df.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("string").alias("doc_id"), "text")
    return lm.gather(rows, file, 5).filter("kind = 2").collect()


def test_copies_of_a_window_spread_over_the_learners(spark):
    text = " ".join(f"word{i}" for i in range(600))
    rows = [(i if i % 2 else None, text) for i in range(300)]
    found = gathered_runs(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))
    learners = Counter(r["key"] % 8 for r in found)
    assert len(learners) == 8 and max(learners.values()) < 1.5 * len(found) / 8
    assert len({r["key"] for r in found}) == len(found)


def test_every_window_trains(spark):
    text = " ".join(f"word{i}" for i in range(100))
    found = gathered_runs(spark.createDataFrame([(i, text) for i in range(20)] + [(99, None)], "doc_id long, text string"))
    ids = bpe.codec_of(bpe.vocabulary()).encode([text])[0]
    assert sum(r["n"] for r in found) == 20 * -(-(len(ids) + 1) // lm.STEP) + 1


def test_runs_hold_the_windows_with_all_their_targets():
    sequences = [np.arange(n, dtype=np.int32) + 10 for n in (0, 1, 23, 24, 100, lm.RUN * lm.STEP - 1, 3 * lm.RUN * lm.STEP)]
    inputs, targets, starts, owners = lm.lay_out(sequences, 7, -1)
    x, y = lm.cut(inputs, targets, starts)
    for end in (9_000, 70_000):
        heads, sizes, packed = lm.pack_runs(inputs, targets, starts, owners, lm.packed_type(end))
        assert sizes.max() <= lm.RUN and len(heads) == len(packed)
        got_x, got_y = lm.unpack_runs(packed, sizes, lm.packed_type(end))
        assert (got_y == y).all()
        seen = (np.arange(lm.WINDOW) < lm.WINDOW - lm.STEP) | (np.pad(y, ((0, 0), (lm.WINDOW - lm.STEP, 0))) >= 0)
        assert (got_x[seen] == x[seen]).all()


def test_every_row_is_one_learner(spark):
    text = " ".join(f"word{i}" for i in range(600))
    rows = spark.createDataFrame([(i, text) for i in range(60)], "doc_id long, text string")
    lm.PER_LEARNER, before = 300, lm.PER_LEARNER
    try:
        scores = [sorted(r["score"] for r in lm.score_documents(rows.repartition(n)).collect()) for n in (2, 5)]
    finally:
        lm.PER_LEARNER = before
    assert np.allclose(*scores, rtol=1e-4)


def test_training_beats_the_prior():
    rng = np.random.default_rng(3)
    base = rng.integers(10, 30, 12).astype(np.int32)
    sequences = [np.roll(base, k % 12).repeat(1 + k % 2)[:20] for k in range(200)]
    x, y, _ = lm.windows_of(sequences, 7, lm.CLASSES)
    prior = lm.prior_from(np.zeros((lm.CLASSES, lm.CLASSES)), np.ones(lm.CLASSES))
    flat = lm.initial(1)
    loss = lambda f: lm.gradient(lm.unpack(f), prior, x, y)[0]
    trained = lm.train(flat, prior, x, y, lm.Training(batch=8, rate=1e-2), 1)
    assert loss(trained) < 0.6 * loss(flat)


# Pipeline.


def test_pipeline_against_plain_python(spark, tmp_path, reference_tokenizer):
    pipeline = pytest.importorskip("corpus_pipeline")
    rng = random.Random(8)
    rows, labels = [], []
    for i in range(240):
        w = [f"w{rng.randrange(3000)}" for _ in range(rng.randint(30, 120))]
        rows.append((i, " ".join(w), "en", f"s{i % 3}", 1))
    for i in range(0, 60, 3):
        rows.append((300 + i, rows[i][1].replace(" ", "  ", 3), "en", "s9", 1))
        rows.append((400 + i, rows[i][1] + " tail", "de", "s9", 1))
    rows.append((999, None, None, None, None))
    spark.createDataFrame(rows, SCHEMA).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    text = {r[0]: r[1] for r in rows}
    expected, left = [], [i for i, t, *_ in rows if t and len(t.split()) >= 50]
    expected.append(left)
    first = {}
    for i in sorted(left):
        first.setdefault(" ".join(text[i].split()), i)
    left = sorted(first.values())
    expected.append(left)
    linked = links_by_hand([(i, text[i]) for i in left], 5, 80)
    left = [i for i in left if linked[i][1] == i]
    expected.append(left)
    for k, (_, stage_of) in enumerate(pipeline.STAGES):
        docs = stage_of(spark, docs, str(tmp_path))
        docs.write.parquet(str(tmp_path / f"out{k}"))
        docs = spark.read.parquet(str(tmp_path / f"out{k}"))
        ids = [r[0] for r in docs.select("doc_id").collect()]
        if k < 3:
            assert sorted(ids) == sorted(expected[k])
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        else:
            assert set(ids) <= set(left)
            assert max(Counter(ids).values()) <= 2
            mixed = sum(len(text[i].split()) for i in ids)
            assert abs(mixed - 1.5 * sum(len(text[i].split()) for i in left)) < 250
    for r in docs.collect():
        assert r["token_ids"] == reference_tokenizer.encode(text[r["doc_id"]], add_special_tokens=False).ids
        assert r["n_tokens"] == len(r["token_ids"])
        assert r["decoded_sha256"] == hashlib.sha256(text[r["doc_id"]].encode()).hexdigest()
