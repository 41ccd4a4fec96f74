"""Quality rules, exact dedup, sharding, mixing and line dedup against plain Python on small tables."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from bowline.llm import exact_dedup, line_dedup, mixing, quality_rules, sharding

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
ODD = [
    (1, None, None, None, None),
    (2, "", "en", "a", 0),
    (3, "one two  three\tfour", "en", "a", 1),
    (4, "one two three four", "en", "b", 2),
    (4, "one two three four", "en", "b", 2),
    (4, "one two three four", "de", "b", 3),
    (5, "word " * 30_000, "de", None, 4),
    (6, "  \n\v \f", "de", "a", 5),
    (None, "one two three four", "fr", "c", 6),
    (None, "nobody has this", "fr", "c", 7),
    (7, "ünïcode wörds 日本 語", "fr", "c", 8),
    (8, "a b c a b c a b c\nx\nx\n\nx", "fr", "c", 9),
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


# Exact dedup.


def test_exact_dedup_decisions(odd):
    groups = {}
    for doc_id, text, *_ in ODD:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", text or ""), []).append(doc_id)
    rows = exact_dedup.decide(odd, fan_in=2).collect()
    assert len(rows) == len(ODD)
    by_text = {hashlib.sha256(t.encode()).digest(): (t, ids) for t, ids in groups.items()}
    for r in rows:
        _, ids = by_text[bytes(r["digest"])]
        known = [i for i in ids if i is not None]
        assert r["keep_id"] == (min(known) if known else None)
        assert r["group_size"] == len(ids)
    kept = [r for r in rows if r["kept"]]
    assert len(kept) == len(groups)
    assert all(r["doc_id"] == r["keep_id"] for r in kept)


@pytest.mark.parametrize("fan_in", [2, 3, 16])
def test_exact_dedup_rounds_agree(spark, fan_in):
    rows = [(i, f"text {i % 7}") for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(13)
    got = {r["doc_id"]: (r["keep_id"], r["group_size"]) for r in exact_dedup.decide(df, fan_in=fan_in).collect()}
    assert got == {i: (i % 7, len(range(i % 7, 200, 7))) for i in range(200)}


def test_exact_dedup_keeps_columns_and_names(odd, empty):
    named = odd.withColumns({"digest": F.lit("mine"), "place": F.lit(1), "nth": F.lit(2)})
    out = exact_dedup.exact_dedup(named)
    assert out.columns == named.columns
    texts = {re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for _, t, *_ in ODD}
    assert out.count() == len(texts)
    assert exact_dedup.exact_dedup(empty).count() == 0
    assert exact_dedup.decide(empty).count() == 0


def test_a_hot_copy_group_goes_by_broadcast(spark):
    rows = [(i, "hot" if i % 3 == 0 else f"t{i}") for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = exact_dedup.decide(df)
    assert out.filter("kept").count() == 2001
    assert out.filter("group_size = 1000").count() == 1000


# Sharding.


def check_shards(out, n):
    seen = {}
    for r in out:
        seen.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(v) == list(range(len(v))) for v in seen.values())
    assert sum(map(len, seen.values())) == n


def test_sharding_law_and_slots(odd, empty):
    out = sharding.shuffle_into_shards(odd, shards=4, bucket_bytes=64).collect()
    check_shards(out, len(ODD))
    assert all(r["grown_shard"] in (r["shard"], 4) for r in out)
    assert sorted(str(tuple(r[c] for c in ("doc_id", "text", "lang"))) for r in out) == sorted(
        str(r[:3]) for r in ODD
    )
    by_id = {}
    for r in out:
        by_id.setdefault(r["doc_id"], set()).add(r["shard"])
    assert all(len(v) == 1 for v in by_id.values())
    assert sharding.shuffle_into_shards(empty).count() == 0


def test_sharding_agrees_with_itself_and_shuffles(spark):
    df = spark.createDataFrame([(i, f"text {i}") for i in range(2000)], "doc_id long, text string")
    place = lambda d: {r["doc_id"]: (r["shard"], r["slot"]) for r in sharding.shuffle_into_shards(d).collect()}
    one = place(df)
    assert one == place(df)
    shard_0 = sorted((slot, i) for i, (shard, slot) in one.items() if shard == 0)
    order = [i for _, i in shard_0]
    assert 200 < len(order) < 300
    rises = sum(a < b for a, b in zip(order, order[1:], strict=False)) / (len(order) - 1)
    assert 0.35 < rises < 0.65


def test_sharding_takes_clashing_names(odd, tmp_path):
    named = odd.withColumns({"shard": F.lit("s"), "bucket": F.lit("b"), "record": F.lit("r"), "n": F.lit(1)})
    out = sharding.shuffle_into_shards(named)
    assert set(named.columns) <= set(out.columns)
    assert out.filter("shard = 's'").count() == len(ODD)
    sharding.write_shards(sharding.shuffle_into_shards(odd, shards=2), str(tmp_path / "out"))
    assert odd.sparkSession.read.parquet(str(tmp_path / "out")).count() == len(ODD)


# Mixing.


def water(sizes, weights, share, laps):
    """Targets by repeated resharing."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, capped = share * sum(sizes.values()), {}
    while True:
        free = [s for s in names if s not in capped]
        left = total - sum(capped.values())
        target = {s: left * w[s] / sum(w[x] for x in free) for s in free}
        over = [s for s in free if target[s] >= laps * sizes[s]]
        if not over:
            return capped | target
        capped |= {s: float(laps * sizes[s]) for s in over}


def test_mixing_targets_and_takes(spark):
    rows = [
        (i, "w " * (1 + (i * 37) % 90), ["big", "b", "c", None, "é"][0 if i % 3 == 0 else i % 5]) for i in range(900)
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5)
    plan = mixing.plan_mix(mixing.number_rows(df)).collect()
    sizes = {}
    for _, text, source in rows:
        sizes[source] = sizes.get(source, 0) + len(words(text))
    want = water(sizes, mixing.WEIGHTS, 1.5, 2)
    taken = dict.fromkeys(sizes, 0)
    for r in plan:
        assert math.isclose(r["target"], want[r["source"]], rel_tol=1e-9)
        assert r["source_size"] == sizes[r["source"]]
        assert r["taken"] in (0, r["size"], 2 * r["size"])
        assert len(r["shards"]) * r["size"] == r["taken"]
        taken[r["source"]] += r["taken"]
    for s in sizes:
        assert abs(taken[s] - want[s]) <= max(2, 0.01 * want[s])
    per_shard = {}
    for r in plan:
        for s in r["shards"]:
            per_shard[s["shard"]] = per_shard.get(s["shard"], 0) + r["size"]
    assert set(per_shard) == set(range(8))
    mean = sum(per_shard.values()) / 8
    assert all(0.8 * mean < v < 1.2 * mean for v in per_shard.values())
    again = mixing.plan_mix(mixing.number_rows(df.repartition(2))).collect()
    key = lambda plan: sorted((r["doc_id"], r["taken"], str(r["shards"])) for r in plan)
    assert key(plan) == key(again)


def test_mixing_fills_targets_past_a_very_long_document(spark):
    rng = random.Random(4)
    rows = [(i, str(i), "a", rng.randint(300, 470)) for i in range(10_000)] + [(10_000, "long", "a", 1_000_000)]
    df = spark.createDataFrame(rows, "row long, doc_id string, source string, size long")
    targets = mixing.source_targets(df)
    (before,) = mixing.draw_documents(df, targets, mixing.SEED).filter("doc_id = 'long'").select("start").first()
    target = before + 500_000  # inside the long document
    assert target < 4_000_000
    drawn = mixing.draw_documents(df, targets.withColumn("target", F.lit(float(target))), mixing.SEED)
    taken = drawn.agg(F.sum(F.col("size") * F.col("laps"))).first()[0]
    assert target - 470 < taken <= target


def test_mixing_rows(odd, empty):
    named = odd.withColumns({"row": F.lit("r"), "size": F.lit("s"), "mix_shard": F.lit("m"), "nth": F.lit(0)})
    out = mixing.mix_sources(named)
    assert out.columns == named.columns
    taken = {}
    for r in mixing.plan_mix(mixing.number_rows(odd)).collect():
        taken[(r["doc_id"], r["size"])] = taken.get((r["doc_id"], r["size"]), 0) + len(r["shards"])
    got = {}
    for r in out.collect():
        k = (r["doc_id"], len(words(r["text"])))
        got[k] = got.get(k, 0) + 1
    assert got == {k: v for k, v in taken.items() if v}
    assert mixing.mix_sources(empty).count() == 0


def test_mixing_reads_a_table_in_files_in_place(spark, odd, tmp_path):
    rng = random.Random(9)
    rows = [(i, "w " * rng.randint(0, 60) + str(i), rng.choice(["a", "b", None]), "r") for i in range(400)]
    rows += rows[:5]  # repeated rows
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, row string")
    docs.repartition(7).write.parquet(f"{tmp_path}/docs")
    docs.filter("source = 'a'").write.parquet(f"{tmp_path}/docs/more=1")  # the same names may stand in other folders
    odd.write.parquet(f"{tmp_path}/odd")
    for filed in (spark.read.option("recursiveFileLookup", True).parquet(f"{tmp_path}/docs"), spark.read.parquet(f"{tmp_path}/odd")):
        place = mixing.file_places(filed)
        assert filed.select(place.alias("p")).distinct().count() == filed.count()
        moved = spark.createDataFrame(filed.collect(), filed.schema)
        assert mixing.file_places(moved) is None and mixing.file_places(filed.distinct()) is None
        key = lambda df: sorted(map(str, df.collect()))
        assert key(mixing.mix_sources(filed)) == key(mixing.mix_sources(moved))
    assert mixing.file_places(odd.withColumn("_metadata", F.lit(1))) is None


def test_hypergeometric_matches_its_distribution(spark):
    n, marked, drawn = 20, 8, 7
    rows = spark.range(4000).select(
        mixing.hypergeometric(F.lit(n), F.lit(marked), F.lit(drawn), (F.col("id") + 0.5) / 4000).alias("x")
    )
    got = dict(rows.groupBy("x").count().collect())
    for x in range(8):
        p = math.comb(marked, x) * math.comb(n - marked, drawn - x) / math.comb(n, drawn)
        assert abs(got.get(x, 0) / 4000 - p) < 0.001
    edges = [(5, 5, 3), (5, 0, 3), (5, 2, 5), (5, 2, 0), (1, 1, 1), (9, 7, 6)]
    for n, marked, drawn in edges:
        x = spark.range(1).select(mixing.hypergeometric(F.lit(n), F.lit(marked), F.lit(drawn), F.lit(0.999))).first()[0]
        assert max(0, drawn + marked - n) <= x <= min(marked, drawn)


def test_splitting_tree_keeps_quotas(spark):
    quotas = spark.createDataFrame([([(0, 40), (1, 3), (2, 21)],)], "quotas array<struct<nth:int,blocks:bigint>>")
    rows = mixing.split_quotas(quotas, 5, 3).collect()
    assert sorted(r["shard"] for r in rows) == list(range(5))
    for k, total in enumerate((40, 3, 21)):
        assert sum(r["quotas"][k]["blocks"] for r in rows) == total
    sums = [sum(q["blocks"] for q in r["quotas"]) for r in rows]
    assert max(sums) - min(sums) <= 2


# Quality rules.


def plain_counts(text):
    w = words(text)
    windows = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    covered = {i + k for i, x in enumerate(windows) if windows.count(x) > 1 for k in range(3)}
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if words(line):
            dup += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), sum((text or "").count(c) for c in "#*$%&|<>"), dup, len(covered)


def test_base_counts(spark, odd, empty):
    labels = spark.createDataFrame([], "doc_id long, quality int")
    texts = [r for r in ODD if r[0] != 5] + [(20 + i, t, "en", "a", 0) for i, t in enumerate(["x y z x y z x", "a a a a", "<b> #1 | ** b\nb\nb", "q w"])]
    df = spark.createDataFrame(texts, SCHEMA)
    got = {}
    for r in quality_rules.judge(df, labels, keep=("doc_id", "text")).collect():
        counts = plain_counts(r["text"])
        assert tuple(r[c] for c in quality_rules.COUNTS) == counts
        assert r["base_failed"] == (counts[0] < 50 or 100 * counts[4] > 50 * counts[0])
        assert r["kept"] == (not r["base_failed"])
        got[r["doc_id"]] = r
    assert quality_rules.judge(empty, labels).count() == 0
    long_ = quality_rules.judge(odd.filter("doc_id = 5"), labels).first()
    assert (long_["n_words"], long_["n_repeat_words"]) == (30_000, 30_000)


def test_binomial_tail(spark):
    for n, k, p in ((100, 3, 0.05), (10, 0, 0.3), (5000, 20, 0.01), (7, 7, 0.9)):
        want = sum(math.comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1))
        got = spark.range(1).select(quality_rules.binomial_tail(F.lit(n), F.lit(k), p)).first()[0]
        assert math.isclose(got, want, rel_tol=1e-9)


def test_cutoffs_are_certified_or_absent(spark):
    clean = " ".join(f"word{i}" for i in range(60))
    junk = " ".join(f"word{i}###" for i in range(60))
    rows = [(i, clean, "en") for i in range(4000)] + [(4000 + i, junk, "en") for i in range(400)]
    rows += [(5000 + i, junk, "de") for i in range(20)] + [(5100 + i, junk, None) for i in range(5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("kept", F.lit("mine"))
    labels = [(i, 1) for i in range(4000)] + [(4000 + i, 0) for i in range(200)] + [(5000 + i, 0) for i in range(10)]
    labels += [(4000, 1), (None, 1), (1, None), (99_999, 0)]
    labels = spark.createDataFrame(labels, "doc_id long, quality int")
    judged = quality_rules.judge(df, labels, keep=("doc_id", "lang", "kept"))
    by = {r["doc_id"]: r for r in judged.collect()}
    assert all(by[i]["kept_"] for i in range(4000))
    assert not any(by[4000 + i]["kept_"] for i in range(400))
    assert by[4000]["rejected_by"] == ["symbol_share"]
    assert all(by[5000 + i]["kept_"] for i in range(20))  # too few labels to certify anything
    assert all(by[5100 + i]["kept_"] for i in range(5))
    out = quality_rules.quality_rules(df, labels)
    assert out.columns == df.columns
    assert out.count() == 4025


def test_a_risky_cutoff_is_not_certified(spark):
    # 2 per cent of good documents have symbols: more than a signal's share of the risk.
    rows = [(i, "en", True, 0.35 if i % 50 == 0 else 0.0) for i in range(3000)]
    rows += [(i, "en", False, 0.5) for i in range(300)]
    others = {s: F.lit(0.0) for s in quality_rules.SIGNALS if s != "symbol_share"}
    holdout = spark.createDataFrame(rows, "id long, stratum string, good boolean, symbol_share double").withColumns(others)
    (cut,) = quality_rules.certified_cutoffs(holdout).collect()
    assert (cut["signal"], cut["cutoff"]) == ("symbol_share", 0.4)


def test_small_strata_are_certified_by_combined_rules(spark):
    clean = " ".join(f"word{i}" for i in range(60))
    junk = " ".join(f"word{i}" + "#" * (i % 5 == 0) for i in range(60))  # 0.2 symbols a word
    langs = ("de", "es", "fr", None)
    rows = [(1000 * k + i, junk if i >= 300 else clean, lang) for k, lang in enumerate(langs) for i in range(340)]
    rows += [(9000 + i, junk if i >= 100 else clean, "it") for i in range(140)]  # not even for the whole risk
    labels = [(i, int(i % 1000 < 300)) for i, _, lang in rows if lang != "it" and i % 1000 < 320]
    labels += [(i, int(i % 1000 < 100)) for i, _, lang in rows if lang == "it"]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame(labels, "doc_id long, quality int")
    left = {r["doc_id"] for r in quality_rules.quality_rules(df, labels).collect()}
    assert left == {i for i, text, lang in rows if text == clean or lang == "it"}


def test_combined_rules_keep_the_bound(spark):
    # 2 per cent of good documents have symbols: as much as the whole risk.
    rows = [(i, "en", True, 0.35 if i % 50 == 0 else 0.0) for i in range(3000)]
    rows += [(i, "en", False, 0.5 if i % 2 else 0.3) for i in range(300)]
    others = {s: F.lit(0.0) for s in quality_rules.SIGNALS if s != "symbol_share"}
    holdout = spark.createDataFrame(rows, "id long, stratum string, good boolean, symbol_share double").withColumns(others)
    cuts = {r["signal"]: r["cutoff"] for r in quality_rules.combined_cutoffs(holdout).collect()}
    assert cuts == {s: grid[3] for s, grid in quality_rules.GRID.items()}


# Line dedup.


def test_line_dedup(spark):
    page = lambda i, host, extra="": (i, f"https://{host}:80/p/{i}?q#f", f"<head><title>t</title></head><nav>Home</nav><p>text {i}</p>{extra}<script>x</script>")
    rows = [page(i, "A.example.org") for i in range(10)] + [page(i, "b.example.org", "<p>rare</p>") for i in range(10, 12)]
    rows += [(50, None, None), (51, "no url", "a\nb\n a "), (52, "http://c.org/", ""), page(3, "a.example.org")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({"row": F.lit(1), "host": F.lit("h")})
    got = {}
    for r in line_dedup.drop_boilerplate(df).collect():
        got.setdefault(r["page_id"], []).append((r["host_"], r["clean_text"], r["n_lines"], r["n_dropped"]))
    assert got[0] == [("a.example.org", "text 0", 2, 1)]
    assert got[3] == [("a.example.org", "text 3", 2, 1)] * 2
    assert got[10] == [("b.example.org", "Home\ntext 10\nrare", 3, 0)]
    assert got[50] == [("", "", 0, 0)]
    assert got[51] == [("", "a\nb\na", 3, 0)]
    assert got[52] == [("c.org", "", 0, 0)]
    assert line_dedup.drop_boilerplate(df.limit(0)).count() == 0


def test_crc_rule_of_queries(spark):
    from bowline.llm.quality_classifier import held_out

    rows = spark.range(50).select(F.col("id").alias("doc_id"), held_out().alias("h")).collect()
    assert all(r["h"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)


def test_shards_are_the_same_however_the_rows_come(spark):
    rows = [(i, f"text {i} " * (i % 9)) for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    orders = (df, df.repartition(7), df.orderBy(F.rand(3)), df.coalesce(1))
    first, *others = [
        {r["doc_id"]: (r["shard"], r["slot"]) for r in sharding.shuffle_into_shards(d, bucket_bytes=4000).collect()} for d in orders
    ]
    assert all(first == other for other in others)
    for shard in range(8):
        mine = sorted((slot, doc) for doc, (s, slot) in first.items() if s == shard)
        assert [slot for slot, _ in mine] == list(range(len(mine)))
        assert [doc for _, doc in mine] != sorted(doc for _, doc in mine)


@pytest.mark.parametrize(("partitions", "fan_in", "rounds"), [(1, 2, 0), (2, 2, 1), (5, 2, 3), (9, 3, 2)])
def test_exact_dedup_merges_runs_in_rounds(spark, monkeypatch, partitions, fan_in, rounds):
    seen, original = [], exact_dedup.stage

    def counting(df, name):
        out = original(df, name)
        if name == "digest-level":
            seen.append((out.select("run").distinct().count(), df._jdf.queryExecution().executedPlan().toString()))
        return out

    monkeypatch.setattr(exact_dedup, "stage", counting)
    monkeypatch.setattr(exact_dedup, "SLICE_ROWS", 50)
    rows = [(i, f"text {i % 40}" if i % 3 else "hot") for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(partitions)
    got = {r["doc_id"]: (r["keep_id"], r["group_size"]) for r in exact_dedup.decide(df, fan_in=fan_in).collect()}
    groups = {}
    for i, t in rows:
        groups.setdefault(t, []).append(i)
    assert got == {i: (min(groups[t]), len(groups[t])) for i, t in rows}
    assert len(seen) == rounds + 1 and [n for n, _ in seen][-1] == 1
    assert all(a > b for (a, _), (b, _) in zip(seen, seen[1:], strict=False))
    for _, plan in seen[1:]:
        assert plan.count("Exchange") == 1 and "Window" in plan and "Sort" in plan


def test_combined_rules_act_in_every_stratum_as_their_sql_says(spark):
    """1,200 labelled documents in each of three languages, the junk of each caught by another signal."""
    import duckdb

    from bowline.llm import queries

    rng, rows, labels = random.Random(6), [], []
    junk = {"en": "$$ ## %%", "de": "ha! what!? no!", "fr": "ABC DEF GHI"}
    for lang in junk:
        for k in range(1200):
            words = [f"w{rng.randrange(500)}" for _ in range(80)]
            bad = k % 4 == 0
            text = " ".join(words) + (f" {junk[lang]} " * 25 if bad else "") + "".join(f" {w}" for w in words[:3])
            labels.append((len(rows), int(not bad), 0))
            rows.append((len(rows), text, lang))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    judged = quality_rules.judge(docs, marks, combined=True)
    got = {r["doc_id"]: r for r in judged.collect()}
    con = duckdb.connect()
    documents, table = docs.toPandas(), marks.toPandas()
    con.register("documents", documents), con.register("labels", table)
    want = {r[0]: r[-1] for r in con.sql(queries.ORACLE["op1_quality_rules"]).fetchall()}
    assert {i: r["kept"] for i, r in got.items()} == want
    for lang in junk:
        mine = [(want[i], good) for (i, _, of), (_, good, _) in zip(rows, labels, strict=True) if of == lang]
        assert not any(kept for kept, good in mine if not good)  # the junk goes
        assert sum(not kept for kept, good in mine if good) <= 0.02 * 900
