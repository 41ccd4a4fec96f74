"""Licence scans by diagonal voting.

Every rolling word k-gram of every text is joined, as a hash, with the positions of the k-grams of the templates. A
match at text position p and template position q votes for the diagonal p - q, where the template would begin in the
text. Votes are counted by diagonal; diagonals of a template that are close to each other (words were left out or put
in between) are merged into one span; a span is verified word by word: it is cut to the first and last word of the
template that it has in order, and its share is that of those words in the template or, if it is longer, in the cut
span. A span is not a template if one of the two has a word that makes it another licence (``VARIANTS``); of verified
spans that overlap and have different labels the best one counts.

The templates are notices, as they stand in files and on pages, not the full texts of licences.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bowline.llm import bytewords
from bowline.llm.bytewords import WordHasher, chain, list_array, signed
from bowline.staging import broadcast_if_small, measure, stage

cloudpickle.register_pickle_by_value(sys.modules[__name__])

K = 3
NEAR = 4  # diagonals up to so many words apart are neighbours
VERIFIED = 0.8  # share of a template's words
HINT = 0.5  # score of a document that has a phrase and no verified span

# Phrases and their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# Words that tell a licence from its variants.
VARIANTS = frozenset(
    b"affero lesser library noncommercial nc noderivs noderivatives nd sharealike sa".split()
)

# Public licence notices and their labels.
TEMPLATES = (
    ("gpl", "This work is licensed under the GNU General Public License, version 3."),
    (
        "gpl",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version.",
    ),
    (
        "gpl",
        "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the "
        "implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License "
        "for more details.",
    ),
    ("apache", "Licensed under the Apache License, Version 2.0."),
    (
        "apache",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in '
        "compliance with the License. You may obtain a copy of the License at",
    ),
    (
        "apache",
        'Unless required by applicable law or agreed to in writing, software distributed under the License is '
        'distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See '
        "the License for the specific language governing permissions and limitations under the License.",
    ),
    ("mit", "Released under the MIT License."),
    (
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without '
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of "
        "the Software, and to permit persons to whom the Software is furnished to do so, subject to the following "
        "conditions:",
    ),
    (
        "bsd",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met: Redistributions of source code must retain the above copyright notice, "
        "this list of conditions and the following disclaimer.",
    ),
    (
        "isc",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0."),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0."),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("cc-by-nd", "Licensed under CC BY-ND 4.0."),
    ("cc-by-nd", "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License."),
    ("cc-by-nc-sa", "Licensed under CC BY-NC-SA 4.0."),
    (
        "cc-by-nc-sa",
        "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License.",
    ),
    ("cc-by-nc-nd", "Licensed under CC BY-NC-ND 4.0."),
    (
        "cc-by-nc-nd",
        "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International "
        "License.",
    ),
    ("lgpl", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("agpl", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("cc-by", "Licensed under CC BY 4.0."),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
)

WORD = re.compile(rb"[0-9a-z\x80-\xff]+")


def words_in(text: str | bytes) -> list[bytes]:
    raw = text.encode("utf-8", "replace") if isinstance(text, str) else text
    return WORD.findall(bytes(raw).lower())  # bytes.lower() changes A-Z alone


def hashes_of(texts: list[str], n: int) -> list[np.ndarray]:
    """The hashes of the word n-grams of each text."""
    hasher = WordHasher(bytewords.alphanumerics(), lower=True)
    out = []
    for text in texts:
        _, _, words, _ = next(hasher.slices(pa.array([text])))
        out.append(chain(*[words[i : len(words) - n + 1 + i] for i in range(n)]) if len(words) >= n else words[:0])
    return out


def scan_words(docs: DataFrame, text: str, doc_id: str, grams: bool, phrases: dict[str, str] | None = None) -> DataFrame:
    """Per row: row, doc_id, n_words and either ``grams``, the k-gram hashes, or what the phrases found."""
    phrases = PHRASES if phrases is None else phrases
    lengths = {p: len(words_in(p)) for p in phrases}
    wanted = {p: hashes_of([p], n)[0][0] for p, n in lengths.items()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher(bytewords.alphanumerics(), lower=True)
        for batch in batches:
            for lo, hi, words, firsts in hasher.slices(batch.column(2)):
                ids = [batch.column(i).slice(lo, hi - lo) for i in (0, 1)]
                sizes = np.diff(firsts)
                if grams:
                    n = len(words) - K + 1
                    all_grams = chain(*[words[i : i + n] for i in range(K)]) if n > 0 else words[:0]
                    whole = np.arange(max(n, 0)) + K <= np.repeat(firsts[1:], sizes)[: max(n, 0)]
                    ends = np.concatenate([[0], np.cumsum(whole)])[np.minimum(firsts, max(n, 0))]
                    yield pa.RecordBatch.from_arrays(
                        [*ids, list_array(signed(all_grams[whole]), ends, pa.int64())], names=["row", "doc_id", "grams"]
                    )
                    continue
                n_base, first, last = np.zeros(hi - lo, np.int64), np.full(hi - lo, 1 << 62), np.full(hi - lo, -1)
                labels: list[set[str]] = [set() for _ in range(hi - lo)]
                for phrase, k in lengths.items():
                    n = len(words) - k + 1
                    if n <= 0:
                        continue
                    at = np.flatnonzero(chain(*[words[i : i + n] for i in range(k)]) == wanted[phrase])
                    owner = np.searchsorted(firsts, at, "right") - 1
                    good = at + k <= firsts[owner + 1]
                    at, owner = at[good], owner[good]
                    np.add.at(n_base, owner, 1)
                    np.minimum.at(first, owner, at - firsts[owner])
                    np.maximum.at(last, owner, at - firsts[owner])
                    for i in set(owner.tolist()):
                        labels[i].add(phrases[phrase])
                none = n_base == 0
                yield pa.RecordBatch.from_arrays(
                    [*ids, pa.array(sizes), pa.array(n_base), pa.array(first, mask=none), pa.array(last, mask=none), pa.array([sorted(x) for x in labels], pa.list_(pa.string()))],
                    names=["row", "doc_id", "n_words", "n_base", "first_word", "last_word", "base"],
                )

    shape = "grams array<long>" if grams else "n_words long, n_base long, first_word long, last_word long, base array<string>"
    rows = docs.select("row", F.col(doc_id).cast("string").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(run, f"row long, doc_id string, {shape}")


def template_grams(spark, templates=TEMPLATES) -> DataFrame:
    """(gram, template, at): where the k-grams of the templates are. A parameter, so of known size."""
    rows = [
        (int(g), t, q)
        for t, grams in enumerate(hashes_of([text for _, text in templates], K))
        for q, g in enumerate(signed(grams))
    ]
    return spark.createDataFrame(rows, "gram long, template int, at int")


def spans(grams: DataFrame, templates=TEMPLATES) -> DataFrame:
    """(row, template, from, to, votes): spans of text, in words, where a template may be. ``grams``: row, grams."""
    positions = template_grams(grams.sparkSession, templates)
    positions = broadcast_if_small(positions, measure(positions, "gram"))
    votes = grams.select("row", F.posexplode("grams").alias("pos", "gram")).join(positions, "gram")
    diagonals = votes.groupBy("row", "template", (F.col("pos") - F.col("at")).alias("diagonal")).agg(
        F.count("*").alias("votes"), F.min("pos").alias("low"), F.max("pos").alias("high")
    )
    along = Window.partitionBy("row", "template").orderBy("diagonal", "low")
    apart = (F.col("diagonal") - F.lag("diagonal").over(along) > NEAR).cast("int")
    merged = diagonals.withColumn("apart", F.coalesce(apart, F.lit(1))).withColumn("part", F.sum("apart").over(along))
    return merged.groupBy("row", "template", "part").agg(
        F.min(F.least("low", F.greatest("diagonal", F.lit(0)))).cast("long").alias("from"),
        (F.max("high") + K).cast("long").alias("to"),
        F.sum("votes").alias("votes"),
    )


def common_length(a: np.ndarray, b: list[int]) -> tuple[int, int]:
    """(length, end) of the longest common subsequence of a and b, and where in b it can end first."""
    row, best, end = np.zeros(len(a) + 1, np.int64), 0, 0
    for at, word in enumerate(b):
        if word >= 0:
            row[1:] = np.maximum.accumulate(np.maximum(row[1:], row[:-1] + (a == word)))
            if row[-1] > best:
                best, end = int(row[-1]), at + 1
    return best, end


def alignment(template: list[bytes], span: list[bytes]) -> tuple[float, int, int]:
    """(share, first, end): the words of the template that the span has in order, over the template's words or those of
    the span from its first to its last match, whichever are more."""
    ids = {w: i for i, w in enumerate(dict.fromkeys(template))}
    a, b = np.array([ids[w] for w in template]), [ids.get(w, -1) for w in span]
    best, end = common_length(a, b)
    if not best:
        return 0.0, 0, 0
    first = end - common_length(a[::-1], b[:end][::-1])[1]
    return best / max(len(a), end - first), first, end


def same_variant(template: list[bytes], span: list[bytes]) -> bool:
    return VARIANTS.intersection(template) == VARIANTS.intersection(span)


def best_of_each_place(found: list[tuple]) -> set[int]:
    """Numbers of the spans (label, words of the template, from, to, share) that no better one of another label overlaps."""
    kept: list[int] = []
    for k in sorted(range(len(found)), key=lambda k: (-found[k][4], -found[k][1], found[k][2], found[k][0])):
        label, _, lo, hi, _ = found[k]
        if all(found[o][0] == label or hi <= found[o][2] or found[o][3] <= lo for o in kept):
            kept.append(k)
    return set(kept)


def verify_spans(found: DataFrame, docs: DataFrame, text: str, templates=TEMPLATES) -> DataFrame:
    """``found``, cut to the words that match, with ``share`` and ``kept``: whether the span is the template's."""
    words, names = [words_in(t) for _, t in templates], [label for label, _ in templates]
    ids = found.select("row").distinct()
    ids = broadcast_if_small(ids, measure(ids, "row"))
    texts = docs.join(ids, "row", "left_semi").select("row", F.col(text).cast("string").alias("text"))
    listed = found.groupBy("row").agg(F.collect_list(F.struct("template", "from", "to")).alias("spans"))
    listed = listed.join(texts, "row").select("row", "spans", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for row, places, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).cast(pa.large_binary()).to_pylist(), strict=True):
                has = words_in(content or b"")
                mine, good = [], []
                for s in places:
                    t = s["template"]
                    share, first, end = alignment(words[t], has[s["from"] : s["to"]])
                    first, end = s["from"] + first, s["from"] + end
                    mine.append((row, t, first, end, share))
                    good.append(share >= VERIFIED and same_variant(words[t], has[first:end]))
                at = [k for k in range(len(mine)) if good[k]]
                best = best_of_each_place([(names[mine[k][1]], len(words[mine[k][1]]), *mine[k][2:]) for k in at])
                kept = {at[k] for k in best}
                out += [(*m, k in kept) for k, m in enumerate(mine)]
            columns = list(zip(*out, strict=True)) if out else [[]] * 6
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.float64(), pa.bool_())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["row", "template", "from", "to", "share", "kept"])

    return listed.mapInArrow(run, "row long, template int, `from` long, `to` long, share double, kept boolean")


def scan_licenses(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", templates=TEMPLATES) -> DataFrame:
    """Per row of ``docs``: doc_id (as string), n_words, the phrases' n_base, first_word, last_word and base_labels,
    and labels, score and ``verified``, the array of verified spans (label, from, to, share).

    ``score`` is the largest share of a template that the text has, at least HINT if it has a phrase, otherwise 0.
    Words are ASCII letters and digits, A-Z lower-cased, and all characters beyond ASCII. A null text counts as
    empty: no words and labels, score 0. Texts of any length are scanned whole. Repeated rows are scanned each; an empty table gives no rows.
    """
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(doc_id).alias("id"), F.col(text).alias("text"))
    base = stage(scan_words(rows, "text", "id", grams=False), "license-words")
    found = spans(scan_words(rows, "text", "id", grams=True), templates)
    sizes = [max(1, len(words_in(t)) - K + 1) for _, t in templates]
    needed = F.element_at(F.array(*[F.lit(n) for n in sizes]), F.col("template") + 1)
    found = stage(found.filter(F.col("votes") * 4 >= needed), "license-spans")
    checked = stage(verify_spans(found, rows, "text", templates), "license-verified")
    label = F.element_at(F.array(*[F.lit(x) for x, _ in templates]), F.col("template") + 1)
    by_row = checked.withColumn("label", label).groupBy("row").agg(
        F.max("share").alias("best"),
        F.collect_list(F.when(F.col("kept"), F.struct("label", "from", "to", "share"))).alias("verified"),
    )
    none = F.array().cast("array<struct<label:string,from:bigint,to:bigint,share:double>>")
    out = base.join(by_row, "row", "left").withColumn("verified", F.coalesce("verified", none))
    joined = lambda a: F.array_join(F.array_sort(F.array_distinct(a)), ",")
    return out.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word",
        joined(F.col("base")).alias("base_labels"),
        joined(F.concat("base", "verified.label")).alias("labels"),
        F.greatest(F.coalesce("best", F.lit(0.0)), F.when(F.col("n_base") > 0, HINT).otherwise(0.0)).alias("score"),
        "verified",
    )
