"""Quality rules whose cutoffs carry a bound on the share of good documents they reject.

Some signals of a text (symbols per word, shouted words, ...) have a grid of cutoffs each, from lenient to strict. On
the labelled documents of a stratum every cutoff is a hypothesis "this rule rejects more than ``risk`` of the good
documents", tested exactly: with k of n good documents rejected its p-value is P(Binomial(n, risk) <= k), and it falls
at the level where the Clopper-Pearson bound of the false rejection rate falls below ``risk``. Within a signal the
grid is tested from lenient to strict until the first failure, which costs nothing; over signals and strata the level
is divided (Bonferroni). Of the certified cutoffs the one that separates best is used. So with probability
1 - ``error`` no stratum loses more than ``total_risk`` of its good documents to all the rules together, each signal
having an equal part of that share. That takes some 1,850 good labels in each of four strata; ``combined_cutoffs`` tests
all signals as one rule at the whole share, for which some 220 are enough. A stratum with too few labels certifies nothing and loses nothing.

The base rules (too short, too repetitive) come first and are not up for learning: they are neither tested nor part
of the bound, and documents they drop are not counted in the holdout.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bowline.llm.common import bind, text_or_empty, unused, words_of
from bowline.staging import broadcast_if_small, measure, stage

TOTAL_RISK = 0.02
ERROR = 0.05

# Signal -> cutoffs from lenient to strict; a document at or above the cutoff is rejected.
GRID: dict[str, tuple[float, ...]] = {
    "symbol_share": (1.0, 0.8, 0.6, 0.4, 0.3, 0.2, 0.1),  # characters of #*$%&|<> per word
    "exclaim_share": (1.0, 0.8, 0.6, 0.4, 0.3, 0.2, 0.1),  # ! and ? per word
    "upper_share": (0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3),  # capital letters per letter or digit of words
    "dup_line_share": (0.9, 0.7, 0.5, 0.4, 0.3, 0.2),  # lines equal to an earlier line per line
    "repeat_share": (0.45, 0.4, 0.35, 0.3, 0.25, 0.2),  # words in repeated 3-word windows per word
    "long_words": (40.0, 30.0, 20.0, 16.0, 13.0),  # mean length of words
}
SIGNALS = tuple(GRID)
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
MIN_WORDS = 50


def repeated_words(words: Column) -> Column:
    """Words covered by 3-word windows found twice or more.

    Windows are compared by a 64-bit hash of their words, sorted, so the work is n log n in the length of the text.
    """

    def covered(sorted_windows: Column) -> Column:
        same = lambda x, j, step: F.get(sorted_windows, j + F.lit(step))["h"] == x["h"]
        starts = F.transform(
            sorted_windows,
            lambda x, j: F.when(same(x, j, 1) | (F.when(j > 0, same(x, j, -1))), x["i"]),
        )
        return F.aggregate(
            F.sort_array(F.filter(starts, lambda i: i.isNotNull())),
            F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n")),
            lambda acc, i: F.struct(
                (i + 3).alias("end"), (acc["n"] + i + 3 - F.greatest(acc["end"], i)).cast("long").alias("n")
            ),
            lambda acc: acc["n"],
        )

    def of(w: Column) -> Column:
        windows = F.transform(
            F.slice(w, F.lit(1), F.greatest(F.size(w) - 2, F.lit(0))),
            lambda first, i: F.struct(F.xxhash64(first, F.get(w, i + 1), F.get(w, i + 2)).alias("h"), i.alias("i")),
        )
        return bind(F.sort_array(windows), covered)

    return F.coalesce(bind(words, of), F.lit(0).cast("long"))


def base_counts(text: str) -> dict[str, Column]:
    """The counts of a text and whether the base rules drop it. A null text counts as empty."""
    t = text_or_empty(text)
    words = words_of(t)
    lines = F.filter(F.split(t, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    return {
        "n_words": F.size(words).cast("long"),
        "word_chars": F.length(F.regexp_replace(t, r"[\x20\x09-\x0D]+", "")).cast("long"),
        "n_symbols": F.length(F.regexp_replace(t, r"[^#*$%&|<>]+", "")).cast("long"),
        "n_dup_lines": bind(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long"),
        "n_repeat_words": repeated_words(words),
        "n_lines": F.size(lines).cast("long"),
        "n_exclaim": F.length(F.regexp_replace(t, r"[^!?]+", "")).cast("long"),
        "n_upper": F.length(F.regexp_replace(t, r"[^A-Z]+", "")).cast("long"),
        "n_alnum": F.length(F.regexp_replace(t, r"[^A-Za-z0-9]+", "")).cast("long"),
    }


def signals() -> dict[str, Column]:
    """The signals from the counts; without words or lines they are 0."""
    per = lambda a, b: F.coalesce(F.try_divide(F.col(a), F.col(b)), F.lit(0.0))
    return {
        "symbol_share": per("n_symbols", "n_words"),
        "exclaim_share": per("n_exclaim", "n_words"),
        "upper_share": per("n_upper", "n_alnum"),
        "dup_line_share": per("n_dup_lines", "n_lines"),
        "repeat_share": per("n_repeat_words", "n_words"),
        "long_words": per("word_chars", "n_words"),
    }


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def binomial_tail(n: Column, k: Column, p: float) -> Column:
    """P(Binomial(n, p) <= k), summed term by term from logarithms. Takes k steps, so ask it for k <= n * p."""
    import math

    step = lambda i: F.log((n - i + 1) / i) + math.log(p) - math.log1p(-p)
    start = n * F.lit(math.log1p(-p))
    return F.aggregate(
        F.filter(F.sequence(F.lit(0).cast("long"), k.cast("long")), lambda i: i > 0),
        F.struct(start.cast("double").alias("log"), F.exp(start).cast("double").alias("sum")),
        lambda acc, i: F.struct(
            (acc["log"] + step(i)).alias("log"), (acc["sum"] + F.exp(acc["log"] + step(i))).alias("sum")
        ),
        lambda acc: acc["sum"],
    )


def certified_cutoffs(holdout: DataFrame, total_risk: float = TOTAL_RISK, error: float = ERROR) -> DataFrame:
    """From (stratum, good, signals) of labelled documents: stratum, signal, cutoff. One row per certified signal."""
    risk = total_risk / len(SIGNALS)
    pairs = [
        F.struct(F.lit(s).alias("signal"), F.lit(rank).alias("rank"), F.lit(c).alias("cutoff"), (F.col(s) >= c).alias("hit"))
        for s in SIGNALS
        for rank, c in enumerate(GRID[s])
    ]
    tried = holdout.select("stratum", "good", F.inline(F.array(*pairs)))
    level = error / max(1, strata(holdout) * len(SIGNALS))
    return best_certified(tried, ("stratum", "signal"), risk, level).select("stratum", "signal", "cutoff")


def combined_cutoffs(holdout: DataFrame, total_risk: float = TOTAL_RISK, error: float = ERROR) -> DataFrame:
    """The same table from one sequence of combined rules: all signals at their first cutoff, at their second, ...

    A document is hit if any signal hits it, so the rules are nested and each is tested at the whole risk; the level is
    divided by the strata alone. A signal whose grid is at its end stays at its strictest cutoff.
    """
    at = lambda s, rank: GRID[s][min(rank, len(GRID[s]) - 1)]
    steps = [
        F.struct(
            F.lit(rank).alias("rank"),
            F.array(*[F.struct(F.lit(s).alias("signal"), F.lit(at(s, rank)).alias("cutoff")) for s in SIGNALS]).alias("cutoff"),
            reduce(Column.__or__, [F.col(s) >= at(s, rank) for s in SIGNALS]).alias("hit"),
        )
        for rank in range(max(map(len, GRID.values())))
    ]
    tried = holdout.select("stratum", "good", F.inline(F.array(*steps)))
    level = error / max(1, strata(holdout))
    return best_certified(tried, ("stratum",), total_risk, level).select("stratum", F.inline("cutoff"))


def strata(holdout: DataFrame) -> int:
    """How many strata there are; null is one."""
    return holdout.agg(F.count_distinct("stratum") + F.max(F.col("stratum").isNull().cast("int"))).first()[0] or 0


def best_certified(tried: DataFrame, family: tuple[str, ...], risk: float, level: float) -> DataFrame:
    """Of each family of ``tried`` (family, rank, cutoff, good, hit), the certified cutoff that separates best, if any."""
    counted = tried.groupBy(*family, "rank", "cutoff").agg(
        F.count_if("good").alias("n"),
        F.count_if(F.col("good") & F.col("hit")).alias("k"),
        F.count_if(~F.col("good")).alias("bad"),
        F.count_if(~F.col("good") & F.col("hit")).alias("caught"),
    )
    p_value = F.when(F.col("k") <= F.col("n") * risk, binomial_tail(F.col("n"), F.col("k"), risk)).otherwise(1.0)
    lenient_first = Window.partitionBy(*family).orderBy("rank")
    tested = counted.withColumn("failures", F.sum((p_value > level).cast("int")).over(lenient_first))
    gain = F.try_divide(F.col("caught"), F.col("bad")) - F.col("k") / F.col("n")
    best_first = Window.partitionBy(*family).orderBy(F.desc("gain"), "rank")
    return (
        tested.filter("failures = 0 AND n > 0")
        .withColumn("gain", F.coalesce(gain, F.lit(0.0)))
        .filter("gain > 0")
        .withColumn("place", F.row_number().over(best_first))
        .filter("place = 1")
    )


def judge(
    docs: DataFrame,
    labels: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    stratum: str = "lang",
    keep: tuple[str, ...] = ("doc_id",),
    total_risk: float = TOTAL_RISK,
    error: float = ERROR,
    combined: bool = False,
) -> DataFrame:
    """The columns ``keep`` of every row with the counts, ``base_failed``, ``rejected_by`` (signals) and ``kept``.

    ``labels`` has doc_id and quality (1: good). An identifier with several labels is good only if all say so;
    labels that are null or without a document do not count. Null strata form a stratum. Documents of a stratum
    without labels meet the base rules only. An empty or null text fails the base rules. Repeated rows are judged
    alike. ``combined`` learns by ``combined_cutoffs``. Empty tables of either kind do no harm. A column of the result whose name is taken gets underscores.
    """
    counts = base_counts(text)
    added = (*COUNTS, "base_failed", "rejected_by", "kept")
    names = dict(zip(added, unused(docs.select(*keep), *added), strict=True))
    own = [F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row")]
    own += [F.col(doc_id).alias("id"), F.col(stratum).cast("string").alias("stratum")]
    counted = stage(docs.select(*own, *[c.alias(k) for k, c in counts.items()]), "quality-counts")
    scored = counted.withColumns(signals()).withColumn("base_failed", base_failed())

    verdicts = labels.filter("quality IS NOT NULL AND doc_id IS NOT NULL").groupBy(F.col("doc_id").alias("id"))
    verdicts = verdicts.agg((F.min("quality") == 1).alias("good"))
    holdout = scored.filter("NOT base_failed").select("id", "stratum", *SIGNALS).join(verdicts, "id")
    learn = combined_cutoffs if combined else certified_cutoffs
    cutoffs = stage(learn(holdout, total_risk, error), "quality-cutoffs")
    by_stratum = cutoffs.groupBy("stratum").agg(
        *[F.min(F.when(F.col("signal") == s, F.col("cutoff"))).alias(f"cut_{s}") for s in SIGNALS]
    )
    # One row per stratum: sent to every task if that is measured to be small.
    by_stratum = broadcast_if_small(by_stratum, measure(by_stratum, "stratum"))
    joined = scored.join(by_stratum, scored["stratum"].eqNullSafe(by_stratum["stratum"]), "left")
    reasons = F.array_compact(F.array(*[F.when(F.col(s) >= F.col(f"cut_{s}"), F.lit(s)) for s in SIGNALS]))
    return joined.select(
        "row.*",
        *[F.col(c).alias(names[c]) for c in (*COUNTS, "base_failed")],
        reasons.alias(names["rejected_by"]),
        (~F.col("base_failed") & (F.size(reasons) == 0)).alias(names["kept"]),
    )


def quality_rules(docs: DataFrame, labels: DataFrame, combined: bool = True, **options) -> DataFrame:
    """The rows of ``docs`` that all rules keep, with their columns. See ``judge``."""
    columns = docs.columns
    inside = [f"input_{i}" for i in range(len(columns))]  # clear of the names that ``judge`` adds
    found = {k: inside[columns.index(options.pop(k, d))] for k, d in (("text", "text"), ("doc_id", "doc_id"), ("stratum", "lang"))}
    judged = judge(docs.toDF(*inside), labels, keep=tuple(inside), combined=combined, **found, **options)
    return judged.filter("kept").select(*inside).toDF(*columns)
