"""Exact Jaccard join of word n-gram sets: universe partition, pigeonhole principle, one-deletion neighbourhoods.

Two sets with Jaccard similarity of at least t differ in at most H = (1-t)/(1+t) * (sum of their sizes) tokens. Sizes
fall into bands, each 1/t wide, so that a set can only be linked within its band and with the two next to it. For a
level (band of the larger set) a hash cuts the universe of tokens into m segments. Tokens of a set in one segment are
its segment subset. If m > H, two linked sets have an equal segment subset, so subsets are the index:

* cost-based allocation: subsets of few tokens are shared by unrelated sets. The plan of a level may skip subsets of
  up to c tokens, for which it adds s segments (m > H + s): a set with at most s such subsets still has an equal larger
  one with each partner; a set with more of them indexes them all the same.
* or it may halve the segments (2m > H + 2s) and index the one-deletion neighbourhood too: each subset without one of
  its tokens. Then some segment differs in at most one token, so a subset equals the other's or the other's less a
  token. Here subsets of c tokens are indexed, as others less a token may equal them, but not without a token.

The plan with the lowest expected cost, from the number of sets and their size, is taken. Every plan finds all links.

Equal sets count once, and every set has a sketch: one bit per bucket, whether it holds an odd number of the set's tokens,
so that two sets differ in at least as many tokens as their sketches in bits. Sketches find groups of sets that may be linked; nothing is decided
by them. Members of an index entry, in order of size, are held against the member before them and the first. For every
entry that then still has members of several groups, those outside its main group are held against all others, inside
the tasks, in blocks; a block sends out a forest of what its sketches allow, fewer pairs than it has members. So all
links lie within groups, whatever the entries.

Then each group's whole sets meet, once, and links are verified exactly there: in blocks of a bounded number of tokens,
each with the group's smallest set next to its own, and, if a group has several blocks, once more between what the
first step left outside its main component and all others. A block sends out a forest of verified links. No pair
of candidates leaves a task, and no text meets another in a join.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bowline.llm import bytewords
from bowline.llm.bytewords import U64, WordHasher, chain, mix, signed
from bowline.llm.common import unused
from bowline.llm.components import components
from bowline.staging import broadcast_if_small, measure, stage

cloudpickle.register_pickle_by_value(sys.modules[__name__])

NGRAM = 5
THRESHOLD = 80  # per cent
# The chance that a token of a set is also in an unrelated set of the band, for the cost model only.
SHARED = 0.0001
PAIR_COST = 20.0  # of verifying a pair, in index rows
BLOCK = 2000  # members of an entry that are in one task together, twice
TOKENS = 1 << 21  # tokens of the sets of a group that are in one task together
MAX_BUCKETS = 4096  # of the sketches that order the work inside a group


def sets_of(hasher: WordHasher, column: pa.Array, ngram: int) -> Iterator[tuple[int, np.ndarray]]:
    """(row, sorted distinct n-gram hashes). A shorter text is one token as a whole; no word: an empty set."""
    for lo, hi, words, firsts in hasher.slices(column):
        n = len(words) - ngram + 1
        grams = chain(*[words[i : i + n] for i in range(ngram)]) if n > 0 else None
        for i in range(lo, hi):
            a, b = firsts[i - lo], firsts[i - lo + 1]
            if b - a >= ngram:
                yield i, np.unique(grams[a : b - ngram + 1])
            elif b > a:
                yield i, chain(np.array([b - a], U64), *words[a:b].reshape(-1, 1))
            else:
                yield i, words[a:b]


def print_of(tokens: np.ndarray) -> tuple[int, int]:
    """Two hashes of a set."""
    sums = [int(mix(tokens ^ U64(salt)).sum(dtype=U64)) for salt in (0x51ED270B, 0xB492B66F)]
    return tuple(np.array(sums, U64).view(np.int64).tolist())


def limits(most: int, threshold: int) -> list[int]:
    """Lower limits of the bands, from 1 up to beyond ``most``."""
    out = [1]
    while out[-1] <= most:
        out.append(max(out[-1] + 1, -(-out[-1] * 100 // threshold)))
    return out


def level_plan(low: int, top: int, sets: int, threshold: int) -> tuple[int, int, int, bool]:
    """(segments, c, s, deletions) of a level with sets of up to ``top`` tokens: see the module. ``sets``: how many."""
    differ = (100 - threshold) * 2 * top // (100 + threshold)
    size = (low + top) / 2

    def shared(segments: int, skipped: int) -> float:
        """The chance that an unrelated set has the same indexed subset: all its tokens and no other."""
        mean = size / segments
        chances = [math.exp(-mean + j * math.log(mean) - math.lgamma(j + 1)) for j in range(skipped + 1)]
        return math.exp(-mean) * (math.exp(-mean * (1 - SHARED)) - sum(p * SHARED**j for j, p in enumerate(chances)))

    plans = []
    for deletions in (False, True):
        least = differ // 2 + 1 if deletions else differ + 1
        for skip in (-1, 0, 1, 2, 3):  # -1: nothing is skipped
            slack = 0
            for _ in range(50 if skip >= 0 else 0):  # enough segments for most sets: mean and three deviations
                mean = size / (least + slack)
                few = (least + slack) * sum(math.exp(-mean + j * math.log(mean) - math.lgamma(j + 1)) for j in range(skip + 1))
                wanted = math.ceil(few + 3 * math.sqrt(few))
                if wanted <= slack:
                    break
                slack = wanted
            m = least + slack
            if slack <= 2 * least:
                entries = m + (size if deletions else 0)
                alike = max(0.0, shared(m, skip - 1 if deletions else skip))
                plans.append((entries + PAIR_COST * sets * m * alike, (m, skip, slack, deletions)))
    return min(plans)[1]


def signatures(tokens: np.ndarray, level: int, plan: tuple[int, int, int, bool]) -> np.ndarray:
    """The index entries of a set at a level."""
    segments, skip, slack, deletions = plan
    salted = mix(tokens + U64((level + 1) * 0x632BE5AB))
    segment = (salted >> U64(33)).astype(np.int64) % segments
    order = np.argsort(segment, kind="stable")
    sums, count = np.zeros(segments, U64), np.bincount(segment, minlength=segments)
    present = np.flatnonzero(count)
    ends = np.cumsum(count)
    values = mix(salted ^ U64(0xA5A5A5A5))[order]
    sums[present] = np.add.reduceat(values, (ends - count)[present])

    def entries(s: np.ndarray, total: np.ndarray, n: np.ndarray) -> np.ndarray:
        return chain(total, s.astype(U64) + U64(level << 32), n.astype(U64))

    if (count <= skip).sum() > slack:
        skip = -1
    kept = np.flatnonzero(count >= skip if deletions else count > skip)
    out = entries(kept, sums[kept], count[kept])
    if deletions:
        s = segment[order]
        less = entries(s, sums[s] - values, count[s] - 1)
        out = np.concatenate([out, less[count[s] > skip]])
    return out


def fingerprints(docs: DataFrame, text: str, doc_id: str, ngram: int, threshold: int) -> DataFrame:
    """(doc_id, n, p1, p2, sketch) of every row: size, prints and sketch of its set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher(bytewords.not_spaces(), lower=True)
        for batch in batches:
            n, prints = np.zeros(batch.num_rows, np.int64), np.zeros((batch.num_rows, 2), np.int64)
            drawn = [b""] * batch.num_rows
            for i, tokens in sets_of(hasher, batch.column(1), ngram):
                n[i] = len(tokens)
                prints[i] = print_of(tokens)
                drawn[i] = parities_of(tokens, 2 * buckets_of(len(tokens), threshold)).tobytes()
            columns = [pa.array(n), pa.array(prints[:, 0].copy()), pa.array(prints[:, 1].copy()), pa.array(drawn, pa.binary())]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=["doc_id", "n", "p1", "p2", "sketch"])

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, n long, p1 long, p2 long, sketch binary")


def index_entries(docs: DataFrame, text: str, doc_id: str, ngram: int, plans: dict, lows: list[int]) -> DataFrame:
    """(entry, n, doc_id): the index. Of equal sets in one task only the first is indexed."""
    bounds = np.array(lows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher(bytewords.not_spaces(), lower=True)
        seen: set[tuple[int, int]] = set()

        def batch_of(entries: list, sizes: list, ids: list) -> pa.RecordBatch:
            counts = [len(e) for e in entries]
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(signed(np.concatenate(entries))),
                    pa.array(np.repeat(np.array(sizes, np.int32), counts)),
                    pa.array(np.repeat(np.array(ids, np.int64), counts)),
                ],
                names=["entry", "n", "doc_id"],
            )

        for batch in batches:
            ids = batch.column(0).to_pylist()
            entries, sizes, owners, rows = [], [], [], 0
            for i, tokens in sets_of(hasher, batch.column(1), ngram):
                if not len(tokens) or (prints := print_of(tokens)) in seen:
                    continue
                seen.add(prints)
                n = len(tokens)
                band = int(np.searchsorted(bounds, n, "right")) - 1
                for level in (band, band + 1):
                    if level in plans:
                        entries.append(signatures(tokens, level, plans[level]))
                        sizes.append(n)
                        owners.append(ids[i])
                        rows += len(entries[-1])
                if rows > 200_000:
                    yield batch_of(entries, sizes, owners)
                    entries, sizes, owners, rows = [], [], [], 0
            if entries:
                yield batch_of(entries, sizes, owners)

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.filter("doc_id IS NOT NULL").mapInArrow(run, "entry long, n int, doc_id long")


def parities_of(tokens: np.ndarray, buckets: int) -> np.ndarray:
    """A bit per bucket, eight to a byte: whether it has an odd number of tokens. ``buckets``: a power of two from 8."""
    counts = np.bincount((mix(tokens ^ U64(0x3C6EF372)) & U64(buckets - 1)).astype(np.int64), minlength=buckets)
    return np.packbits((counts & 1).astype(np.uint8), bitorder="little")


def folded_parities(sketch: bytes, size: int) -> np.ndarray:
    """The sketch of the same set with ``size`` bytes, which is not more than it has."""
    return np.bitwise_xor.reduce(np.frombuffer(sketch, np.uint8).reshape(-1, size), axis=0)


def sketch_of(tokens: np.ndarray, buckets: int) -> np.ndarray:
    """Sums of the tokens by bucket, as bytes; ``buckets`` is a power of two. Closer than parities, and larger."""
    mixed = mix(tokens ^ U64(0x3C6EF372))
    sums = np.bincount((mixed & U64(buckets - 1)).astype(np.int64), (mixed >> U64(40)) % U64(255) + U64(1), buckets)
    return (sums.astype(np.int64) & 255).astype(np.uint8)


def shared_tokens(x: np.ndarray, y: np.ndarray) -> int:
    """How many tokens two sorted sets have in common."""
    if len(x) > len(y):
        x, y = y, x
    at = np.searchsorted(y, x)
    at[at == len(y)] = 0
    return int((y[at] == x).sum())


def verified_forest(table: pa.Table, threshold: int) -> pa.Table:
    """Links (a, b) that join the sets of a block into its components, each verified on the whole sets.

    Rows: rep, n, tokens, side, tree. Rows of one ``tree`` need no link. Side 0 is held against all rows, others only
    against side 0.
    """
    rep, n, side = (table.column(c).to_numpy() for c in ("rep", "n", "side"))
    order = np.lexsort((rep, n))
    rep, n, side = rep[order], n[order].astype(np.int64), side[order]
    raw = table.column("tokens").to_pylist()
    sets = [np.frombuffer(raw[k], U64) for k in order]
    tree = np.unique(table.column("tree").to_numpy()[order], return_inverse=True)[1]
    buckets = min(MAX_BUCKETS, buckets_of(int(n.max(initial=1)), threshold))
    drawn = np.stack([sketch_of(x, buckets) for x in sets]) if len(sets) else np.zeros((0, 1), np.uint8)
    out = []
    for k in range(len(rep)):
        low = int(np.searchsorted(n, -(-n[k] * threshold // 100)))
        open_ = (tree[low:k] != tree[k]) & ((side[low:k] == 0) | (side[k] == 0))
        at = np.flatnonzero(open_) + low
        if not len(at):
            continue
        most = (100 - threshold) * (n[at] + n[k]) // (100 + threshold)
        for c in at[(drawn[at] != drawn[k]).sum(1) <= most]:
            if tree[c] == tree[k]:
                continue
            common = shared_tokens(sets[c], sets[k])
            if 100 * common >= threshold * (n[c] + n[k] - common):
                out.append((min(rep[c], rep[k]), max(rep[c], rep[k])))
                tree[tree == tree[c]] = tree[k]
    pairs = np.array(out, np.int64).reshape(-1, 2)
    return pa.table({"a": pairs[:, 0].copy(), "b": pairs[:, 1].copy()})


def verify_groups(docs: DataFrame, text: str, doc_id: str, groups: DataFrame, ngram: int, threshold: int) -> DataFrame:
    """Links (a, b) that join the sets of each group (node, component, n) into its components, written down."""

    def make_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher(bytewords.not_spaces(), lower=True)
        for batch in batches:
            n, raw = [0] * batch.num_rows, [b""] * batch.num_rows
            for i, tokens in sets_of(hasher, batch.column(4), ngram):
                n[i], raw[i] = len(tokens), np.sort(tokens).tobytes()
            columns = [pa.array(n, pa.int64()), pa.array(raw, pa.binary())]
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], *columns], names=["group", "blocks", "head", "rep", "n", "tokens"])

    sizes = groups.groupBy("component").agg(
        F.greatest(F.ceil(F.sum("n") / TOKENS), F.ceil(F.count("*") / BLOCK)).cast("int").alias("blocks")
    )
    members = groups.join(sizes, "component").select(F.col("component").alias("group"), "blocks", F.col("node").alias("rep"))
    members = stage(members.select("*", (F.col("rep") == F.col("group")).alias("head")), "group-members")
    whole = docs.select(F.col(doc_id).cast("long").alias("rep"), F.col(text).cast("string").alias("text"))
    whole = whole.join(broadcast_if_small(members, measure(members, "rep")), "rep")
    schema = "group long, blocks int, head boolean, rep long, n long, tokens binary"
    sets = whole.select("group", "blocks", "head", "rep", "text").mapInArrow(make_sets, schema).filter("n > 0")
    several = not members.filter("blocks > 1").isEmpty()
    if several:  # read twice
        sets = stage(sets, "group-sets")
    run = lambda table: verified_forest(table, threshold)
    every = F.sequence(F.lit(0), F.col("blocks") - 1)
    own = F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int")
    columns = ["rep", "n", "tokens"]
    # The group's smallest set goes into every block; sides are all 0: every row is held against every other.
    dealt = sets.select("group", F.explode(F.when(F.col("head"), every).otherwise(F.array(own))).alias("i"), *columns, F.lit(0).alias("side"), F.col("rep").alias("tree"))
    found = stage(dealt.groupBy("group", "i").applyInArrow(run, "a long, b long"), "links-inside")
    if not several:
        return found
    parts = stage(components(found), "parts-inside")
    large = members.filter("blocks > 1").select("group", "rep").join(parts.withColumnRenamed("node", "rep"), "rep", "left")
    large = large.select("group", "rep", F.coalesce("component", "rep").alias("tree"))
    main = large.groupBy("group", "tree").count().groupBy("group").agg(F.max_by("tree", F.struct("count", "tree")).alias("main"))
    large = stage(large.join(main, "group").select("rep", "tree", (F.col("tree") != F.col("main")).alias("outside")), "group-trees")
    rows = sets.filter("blocks > 1").join(broadcast_if_small(large, measure(large, "rep")), "rep")
    left = rows.filter("outside").select("group", own.alias("i"), F.explode(every).alias("j"), *columns, F.lit(0).alias("side"), "tree")
    right = rows.filter("not outside").select("group", F.explode(every).alias("i"), own.alias("j"), *columns, F.lit(1).alias("side"), "tree")
    # What is outside also meets what else is outside: as side 1 of the other blocks.
    again = rows.filter("outside").select("group", F.explode(every).alias("i"), own.alias("j"), *columns, F.lit(1).alias("side"), "tree")
    dealt = left.unionByName(right).unionByName(again)
    more = dealt.groupBy("group", "i", "j").applyInArrow(run, "a long, b long")
    return stage(found.unionByName(more), "links-between")


def sketches(prints: DataFrame, shared: DataFrame) -> DataFrame:
    """(rep, sketch) of the representatives that share an entry, written down."""
    ids = stage(shared.select(F.col("rep").alias("doc_id")).distinct(), "sharing-ids")
    drawn = prints.join(broadcast_if_small(ids, measure(ids, "doc_id")), "doc_id", "left_semi")
    # A document of several texts has no one sketch: null lets all its pairs pass.
    grouped = drawn.groupBy(F.col("doc_id").alias("rep")).agg(F.when(F.count("*") == 1, F.first("sketch")).alias("sketch"))
    return stage(grouped, "sketches")


def plausible(pairs: DataFrame, drawn: DataFrame, threshold: int) -> DataFrame:
    """The pairs (a, b, n_a, n_b) whose sketches allow a link, as (a, b), written down."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch.column(2).to_numpy() + batch.column(3).to_numpy()
            most = (100 - threshold) * sizes // (100 + threshold)
            good = []
            for k, (x, y) in enumerate(zip(batch.column(4).to_pylist(), batch.column(5).to_pylist(), strict=True)):
                if x is not None and y is not None:
                    size = min(len(x), len(y))
                    u, v = folded_parities(x, size), folded_parities(y, size)
                    if np.bitwise_count(u ^ v).sum() > most[k]:
                        continue
                good.append(k)
            yield batch.select(["a", "b"]).take(pa.array(good, pa.int32()))

    one = pairs.join(drawn.select(F.col("rep").alias("a"), F.col("sketch").alias("s_a")), "a")
    two = one.join(drawn.select(F.col("rep").alias("b"), F.col("sketch").alias("s_b")), "b")
    rows = two.select("a", "b", F.col("n_a").cast("long"), F.col("n_b").cast("long"), "s_a", "s_b")
    return stage(rows.mapInArrow(run, "a long, b long").distinct(), "pairs-plausible")


def buckets_of(n: int, threshold: int) -> int:
    """Buckets of a sketch: a power of two, at least twice the tokens that two linked sets of this size differ in."""
    return 1 << max(5, (2 * (100 - threshold) * 2 * n // (100 + threshold)).bit_length())


def across(placed: DataFrame, drawn: DataFrame, threshold: int) -> DataFrame:
    """(a, b): a forest, for every entry, of pairs of members in different components that sketches allow to be linked."""
    rows = placed.join(drawn, "rep").withColumn("blocks", F.ceil(F.col("all") / BLOCK).cast("int"))
    own = F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int")
    every = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    columns = ["rep", "n", "component", "sketch"]
    left = rows.filter("component != major").select("entry", own.alias("i"), every.alias("j"), F.lit(0).alias("side"), *columns)
    right = rows.select("entry", every.alias("i"), own.alias("j"), F.lit(1).alias("side"), *columns)
    dealt = left.unionByName(right).repartition("entry", "i", "j").sortWithinPartitions("entry", "i", "j", "side", "rep")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            table = pa.Table.from_batches([*held, batch]).combine_chunks()
            keys = np.stack([table.column(c).to_numpy() for c in ("entry", "i", "j")])
            new = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(0)) + 1
            done = int(new[-1]) if len(new) else 0
            held = table.slice(done).to_batches()
            if done:
                yield allowed(table.slice(0, done), [0, *new.tolist()], threshold)
        if held:
            table = pa.Table.from_batches(held).combine_chunks()
            yield allowed(table, [0, table.num_rows], threshold)

    return dealt.mapInArrow(run, "a long, b long").distinct()


def allowed(table: pa.Table, bounds: list[int], threshold: int) -> pa.RecordBatch:
    """A forest of the pairs of side 0 and side 1 that are allowed in each group of rows, bounds[k] to bounds[k + 1]."""
    side, rep, n, component = (table.column(c).to_numpy() for c in ("side", "rep", "n", "component"))
    n = n.astype(np.int64)
    drawn = table.column("sketch").to_pylist()
    out = [np.zeros((2, 0), np.int64)]
    for lo, hi in zip(bounds, bounds[1:], strict=False):
        cut = int(np.searchsorted(side[lo:hi], 1))
        if cut == 0 or cut == hi - lo:
            continue
        ids, sizes = rep[lo:hi], n[lo:hi]
        tree = np.unique(component[lo:hi], return_inverse=True)[1]
        known = [x for x in drawn[lo:hi] if x is not None]
        size = min(map(len, known), default=1)
        folded = np.zeros((hi - lo, size), np.uint8)
        for k, x in enumerate(drawn[lo:hi]):
            if x is not None:
                folded[k] = folded_parities(x, size)
        blind = np.array([x is None for x in drawn[lo:hi]])
        for i in range(cut):
            right = sizes[cut:]
            fits = (tree[cut:] != tree[i]) & (np.minimum(right, sizes[i]) * 100 >= np.maximum(right, sizes[i]) * threshold)
            at = np.flatnonzero(fits) + cut
            if len(at):
                apart = np.bitwise_count(folded[at] ^ folded[i]).sum(1, dtype=np.int64)
                most = (100 - threshold) * (sizes[at] + sizes[i]) // (100 + threshold)
                at = at[(apart <= most) | blind[at] | blind[i]]
                trees, first = np.unique(tree[at], return_index=True)
                other = ids[at[first]]
                out.append(np.stack([np.minimum(other, ids[i]), np.maximum(other, ids[i])]))
                tree[np.isin(tree, trees)] = tree[i]
    a, b = np.unique(np.concatenate(out, 1), axis=1)
    return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])


def link(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", ngram: int = NGRAM, threshold: int = THRESHOLD
) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row.

    Words are runs of other bytes than space and \\t\\n\\v\\f\\r, A-Z lower-cased; the set of a text is that of its
    ``ngram``-word sequences, or, if it has fewer words, its words as one. Sets link when their Jaccard similarity is
    at least ``threshold`` per cent. Texts without words, nulls too, have an empty set and link with nothing. Rows
    that repeat an identifier are one document, with links of any of their texts. Rows without an identifier take no
    part: their component is null. An empty table gives no rows.
    """
    if not 0 < threshold <= 100 or ngram < 1:
        raise ValueError("threshold is 1 to 100 per cent, ngram at least 1")
    prints = stage(fingerprints(docs, text, doc_id, ngram, threshold), "set-prints")
    classes = prints.filter("n > 0 AND doc_id IS NOT NULL").groupBy("n", "p1", "p2")
    classes = stage(classes.agg(F.min("doc_id").alias("rep"), F.count("*").alias("copies")), "set-classes")
    most = classes.agg(F.max("n")).first()[0] or 0
    lows = limits(most, threshold)
    bands = F.array(*[F.lit(x) for x in lows])
    counts = dict(
        classes.groupBy(F.size(F.filter(bands, lambda x: x <= F.col("n"))).alias("band")).count().collect()
    )  # one row per band: their number grows with the logarithm of the longest text
    plans = {
        k: level_plan(lows[k - 1] if k else lows[k], lows[k + 1] - 1, counts.get(k + 1, 0) + counts.get(k, 0), threshold)
        for k in range(len(lows) - 1)
        if counts.get(k + 1, 0)  # a level needs a larger set
    }
    index = index_entries(docs, text, doc_id, ngram, plans, lows)
    in_entry = Window.partitionBy("entry").orderBy("n", "doc_id")
    marked = index.select("*", F.lag("doc_id").over(in_entry).alias("before"), F.lead("doc_id").over(in_entry).alias("after"), F.first("doc_id").over(in_entry).alias("head"))
    members = stage(marked.filter("before IS NOT NULL OR after IS NOT NULL"), "index-members")

    # From documents to the representatives of equal sets.
    reps = prints.join(classes, ["n", "p1", "p2"]).select("doc_id", "rep", "n")
    shared = stage(reps.join(members.select("doc_id").distinct(), "doc_id", "left_semi").distinct(), "set-reps")
    sides = lambda df, a, b: (
        df.join(shared.select(F.col("doc_id").alias(a), F.col("rep").alias("r_a"), F.col("n").alias("n_a")), a)
        .join(shared.select(F.col("doc_id").alias(b), F.col("rep").alias("r_b"), F.col("n").alias("n_b")), b)
        .filter((F.col("r_a") != F.col("r_b")) & (F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * threshold))
        .select(F.least("r_a", "r_b").alias("a"), F.greatest("r_a", "r_b").alias("b"), "n_a", "n_b")
        .groupBy("a", "b")
        .agg(F.max("n_a").alias("n_a"), F.max("n_b").alias("n_b"))  # sizes are only ever added up
    )
    near = members.filter("before IS NOT NULL").select(
        F.explode(F.array(F.struct("doc_id", F.col("before").alias("other")), F.struct("doc_id", F.col("head").alias("other")))).alias("p")
    )
    near = near.select("p.*").filter("doc_id != other").distinct()
    tested = stage(sides(near, "doc_id", "other"), "pairs-near")
    drawn = sketches(prints, shared)
    maybe = plausible(tested, drawn, threshold)
    parts = stage(components(maybe), "parts-near")

    # Entries with members of several components.
    placed = members.select("entry", "doc_id").join(shared, "doc_id").join(
        parts.select(F.col("node").alias("rep"), "component"), "rep", "left"
    )
    placed = placed.select("entry", "rep", "n", F.coalesce("component", "rep").alias("component")).distinct()
    # The component that most of an entry's members are in needs no pairs inside: the others meet all members.
    sizes = placed.groupBy("entry", "component").agg(F.count("*").alias("members"))
    major = sizes.groupBy("entry").agg(
        F.max_by("component", F.struct("members", "component")).alias("major"),
        F.sum("members").alias("all"),
        F.count("*").alias("kinds"),
    )
    placed = stage(placed.join(major.filter("kinds > 1"), "entry"), "index-placed")
    rest = stage(across(placed, drawn, threshold), "pairs-across")
    groups = components(maybe.unionByName(rest))
    sized = classes.groupBy(F.col("rep").alias("node")).agg(F.sum("n").alias("n"))
    found = verify_groups(docs, text, doc_id, groups.join(sized, "node"), ngram, threshold)

    # A document with several texts joins the classes of all of them.
    linked = found.unionByName(
        reps.filter("doc_id IS NOT NULL AND doc_id != rep").select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))
    )
    final = components(linked)
    out = prints.join(final, prints["doc_id"] == final["node"], "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "doc_id").alias("component_id"))


def drop_near_copies(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", **options) -> DataFrame:
    """The rows of ``docs`` of which none with a smaller identifier is in the same component; all without one."""
    linked = link(docs, text, doc_id, **options)
    (gone_id,) = unused(docs, "gone_id")
    gone = linked.filter("component_id < doc_id").select(F.col("doc_id").alias(gone_id)).distinct()
    return docs.join(gone, F.col(doc_id).cast("long") == F.col(gone_id), "left_anti")
