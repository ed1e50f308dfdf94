"""N-gram Jaccard join by vertical partitioning.

A text's set is its distinct five-word shingles as 63-bit hashes.  Texts with equal
sets form a class; the join is between classes.  All shingles have one global
order: by hash, but the ``MOST_COMMON`` most frequent ones last, the most
frequent at the very end.  A set's prefix are its first n - ceil(0.75 n) + 1
shingles in that order; two sets with Jaccard similarity of 0.75 or more share
one there.

The order is cut into fragments of equal numbers of prefix shingles, as the sizes of
the sets let expect them, and a task takes up one fragment at a time.  It counts for
every pair of classes how many prefix shingles they share in it; these partial
counts are summed a pair.  All common shingles up to the nearer end of the two
prefixes are then counted, so the pair can link only if
``count + (n - prefix)`` of that side reaches 3/7 of both sizes together.
What passes is verified by the same means on whole sets: cut by hash range,
overlaps counted a fragment, summed a pair.

Pairs are verified in rounds.  The first takes each class's most promising
partner; and a shingle with more than ``GROUP`` classes, which is not expanded to
all pairs, adds its classes' pairs with ``LEADERS`` of them, those with the largest share
of large shingles.  Components are made of the links found.  What is left between
different components follows: other pairs, and for the large
shingles the pairs of their classes, with full counts; again by the most promising
partners while there are more than four pairs a class, then all.  A pair inside a component
could only confirm it.  So no link between components is lost, and a group of
thousands of near copies costs a few links a member.

A shingle that very many texts hold never meets in one task: the rows of a ``HOT``
one are dealt by shingle and class, leaders are found by a partial top-k, and
pairs of a large shingle's classes are compared in cells of ``CELL`` by ``CELL``
classes, which any task can take.  The choice of common and hot shingles, by counts
within blocks of texts, decides the cost and never the result.

Texts without words (also null ones) have an empty set and no link.  Copies and
repeated rows share a class.  The component id is the smallest id reachable;
null ids come last.  An empty table gives no rows; only id and text are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from plumbline.llm._shared import MOST_TASKS, by_key, materialize, parts, release, slices, text_of
from plumbline.llm._words import mix, shingle_sets
from plumbline.llm.components import components

SHINGLE = 5
GROUP = 24
LEADERS = 4
ROUNDS = 4
MOST_COMMON = 100_000
COUNT_BLOCK = 3_000_000
FRAGMENT_ROWS = 500_000
VERIFY_BITS = 2
HELD = 400_000
#: texts with a shingle from which its rows are dealt by class too; classes of a shingle compared in one cell
HOT, CELL = 2_000, 4_096
#: numbers of a matrix of classes and shingles that is held at once
DENSE = 4_000_000
_ROW = np.dtype([("k", "<u8"), ("c", "<i8"), ("n", "<i4")])


def class_key(tokens: np.ndarray) -> int:
    """One key for equal sets."""
    h = mix(tokens + np.uint64(0x51ED270B27D1F1B5)).sum(dtype=np.uint64, keepdims=True) + mix(tokens ^ np.uint64(0xA3C59AC2F1E4D3B7)).max(keepdims=True) * np.uint64(3)
    return int(mix(h + np.uint64(len(tokens))).view(np.int64)[0])


def prefix_length(n: np.ndarray | int) -> np.ndarray | int:
    return n - (3 * n + 3) // 4 + 1


def _sets(b: pd.DataFrame) -> Iterator[tuple[int, np.ndarray]]:
    yield from enumerate(s >> np.uint64(1) for s in _distinct63(shingle_sets([t.encode() for t in b["__text"]], SHINGLE)))


def _distinct63(sets: Iterator[np.ndarray]) -> Iterator[np.ndarray]:
    """Sets whose hashes still differ without the lowest bit."""
    for s in sets:
        if len(s) > 1 and ((s[1:] ^ s[:-1]) <= np.uint64(1)).any():
            s = s[np.concatenate(([True], (s[1:] >> np.uint64(1)) != (s[:-1] >> np.uint64(1))))]
        yield s


def signatures(rows: DataFrame) -> DataFrame:
    """A row a text: __id, row, n, c (class, null for an empty set); and with row null: c a shingle, n its texts in a block."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[np.ndarray] = []
        size = 0

        def common() -> pd.DataFrame:
            t, n = np.unique(np.concatenate(held), return_counts=True)
            own = n >= 3
            return pd.DataFrame({"__id": pd.Series([None] * int(own.sum()), dtype=object), "row": pd.Series([None] * int(own.sum()), dtype="Int64"), "n": n[own].astype(np.int32), "c": pd.Series(t[own].view(np.int64), dtype="Int64")})

        for b in slices(batches):
            n, c = np.zeros(len(b), np.int32), [None] * len(b)
            for i, s in _sets(b):
                n[i] = len(s)
                if len(s):
                    c[i] = class_key(s)
                    held.append(s)
                    size += len(s)
                if size >= COUNT_BLOCK:
                    yield common()
                    held, size = [], 0
            yield pd.DataFrame({"__id": b["__id"].astype(object), "row": b["row"].astype("Int64"), "n": n, "c": pd.Series(c, dtype="Int64")})
        if held:
            yield common()

    # ids travel as text: pandas would make numbers with nulls among them inexact
    out = rows.select(F.col("__id").cast("string").alias("__id"), "__text", "row").mapInPandas(run, "__id string, row long, n int, c long")
    return out.withColumn("__id", F.col("__id").cast(rows.schema["__id"].dataType))


def fragment_edges(sizes: list[tuple[float, int]], fragments: int) -> np.ndarray:
    """The inner edges of fragments, as shares of the hash range; sizes: (n, sets of that size).

    Of n uniform hashes min(Bin(n, x), prefix) are prefix hashes below the share
    x; the binomial is taken as normal.
    """
    x = np.concatenate((np.linspace(0, 0.4, 1601), np.linspace(0.4, 1, 401)[1:]))
    below = np.zeros(len(x))
    erf = np.vectorize(math.erf)
    for n, count in sizes:
        p, mean, spread = prefix_length(int(n)), n * x, np.sqrt(n * x * (1 - x)) + 1e-9
        z = (p - mean) / spread
        under = (p - mean) * (1 + erf(z / math.sqrt(2))) / 2 + spread * np.exp(-z * z / 2) / math.sqrt(2 * math.pi)
        below += count * np.clip(p - under, 0, None)
    below = np.maximum.accumulate(below)
    return np.interp(np.arange(1, fragments) / fragments * below[-1], below, x) if below[-1] > 0 else np.arange(1, fragments) / fragments


def _prefixes(rows: DataFrame, common: list[int], hot: int, edges: np.ndarray) -> DataFrame:
    """part, data: the prefix shingles of every class in a fragment of the order, packed; those of the last hot common ones in parts below 0."""
    sent = rows.sparkSession.sparkContext.broadcast((common, edges))
    fragments = len(edges) + 1

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last, cuts = np.array(sent.value[0], np.uint64), sent.value[1]
        order = np.argsort(last)
        known, rank = last[order], np.uint64(1 << 63) + order.astype(np.uint64)
        first_hot = np.uint64((1 << 63) + len(last) - hot)
        seen: set[int] = set()
        for b in slices(batches):
            out: list[np.ndarray] = []
            for _, s in _sets(b):
                if not len(s) or (c := class_key(s)) in seen:
                    continue
                seen.add(c)
                k = s
                if len(known):
                    at = np.minimum(np.searchsorted(known, s), len(known) - 1)
                    k = np.sort(np.where(known[at] == s, rank[at], s))
                row = np.empty(prefix_length(len(k)), _ROW)
                row["k"], row["c"], row["n"] = k[: len(row)], c, len(k)
                out.append(row)
            if not out:
                continue
            packed = np.concatenate(out)
            frag = np.searchsorted(cuts, packed["k"].astype(np.float64) / 2.0**63, "right").astype(np.int64)
            late, most = packed["k"] >= np.uint64(1 << 63), packed["k"] >= first_hot
            frag[late] = (mix(packed["k"][late]) % np.uint64(fragments)).astype(np.int64)
            frag[most] = -1 - (mix(packed["k"][most] ^ mix(packed["c"][most].view(np.uint64))) % np.uint64(fragments)).astype(np.int64)
            order2 = np.argsort(frag, kind="stable")
            packed, frag = packed[order2], frag[order2]
            cut = [0, *(np.flatnonzero(frag[1:] != frag[:-1]) + 1), len(frag)]
            yield pd.DataFrame([(frag[x], packed[x:y].tobytes()) for x, y in zip(cut, cut[1:], strict=False)], columns=["part", "data"])

    return rows.select("__text").mapInPandas(run, "part int, data binary")


def _size_filter(na: np.ndarray, nb: np.ndarray) -> np.ndarray:
    return 4 * np.minimum(na, nb).astype(np.int64) >= 3 * np.maximum(na, nb).astype(np.int64)


def _all_pairs(group: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (first, second) of rows of a group sorted by n whose sizes allow a link."""
    n = group["n"].astype(np.int64)
    upto = np.searchsorted(n, (4 * n) // 3, "right")
    for i in range(len(group) - 1):
        j = np.arange(i + 1, upto[i])
        if len(j):
            yield np.full(len(j), i), j


_PAIRS = "kind int, a long, b long, na int, nb int, n int"


def _pair_frame(kind: int, a: np.ndarray, b: np.ndarray, na: np.ndarray, nb: np.ndarray, n: np.ndarray | int) -> pd.DataFrame:
    return pd.DataFrame({"kind": np.int32(kind), "a": a, "b": b, "na": na, "nb": nb, "n": n}).astype({"n": np.int32, "kind": np.int32, "na": np.int32, "nb": np.int32})


def _summed(first: list[np.ndarray], second: list[np.ndarray], kind: int) -> Iterator[pd.DataFrame]:
    """Counts of equal pairs of rows."""
    if not first:
        return
    x, y = np.concatenate(first), np.concatenate(second)
    swap = x["c"] > y["c"]
    a, b = np.where(swap, y["c"], x["c"]), np.where(swap, x["c"], y["c"])
    na, nb = np.where(swap, y["n"], x["n"]), np.where(swap, x["n"], y["n"])
    order = np.lexsort((b, a))
    a, b, na, nb = a[order], b[order], na[order], nb[order]
    new = np.flatnonzero(np.concatenate(([True], (a[1:] != a[:-1]) | (b[1:] != b[:-1]))))
    for lo in range(0, len(new), 100_000):
        own = new[lo : lo + 100_000]
        upto = np.concatenate((new[lo + 1 : lo + 1 + len(own)], [len(a)]))[: len(own)]
        yield _pair_frame(kind, a[own], b[own], na[own], nb[own], upto - own)


def _fragment_pairs(prefixes: DataFrame, fragments: int) -> DataFrame:
    """kind 0: a pair's count in a fragment; 2: a row (shingle a, class b) of a large group."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for (f,), blobs in by_key(batches, ["part"]):
            rows = np.frombuffer(b"".join(blobs["data"]), _ROW)
            if f < 0:
                # a class may come from several tasks
                rows = rows[np.unique(rows[["k", "c"]], return_index=True)[1]]
                for lo in range(0, len(rows), HELD):
                    own = rows[lo : lo + HELD]
                    yield _pair_frame(2, own["k"].view(np.int64), own["c"], own["n"], own["n"], 1)
                continue
            rows = rows[np.argsort(rows["k"], kind="stable")]
            edge = np.flatnonzero(np.concatenate(([True], rows["k"][1:] != rows["k"][:-1], [True]))) if len(rows) else np.zeros(1, np.int64)
            size = np.diff(edge)
            first, second, held = [], [], 0
            for at, m in zip(edge[:-1][size > 1], size[size > 1], strict=True):
                group = rows[at : at + m]
                group = group[np.unique(group["c"], return_index=True)[1]]
                if len(group) < 2:
                    continue
                group = group[np.argsort(group["n"], kind="stable")]
                if len(group) <= GROUP:
                    for i, j in _all_pairs(group):
                        first.append(group[i])
                        second.append(group[j])
                        held += len(j)
                    if held > HELD:
                        yield from _summed(first, second, 0)
                        first, second, held = [], [], 0
                    continue
                yield _pair_frame(2, group["k"].view(np.int64), group["c"], group["n"], group["n"], 1)
            yield from _summed(first, second, 0)

    return prefixes.repartition(min(fragments, MOST_TASKS), "part").sortWithinPartitions("part").mapInPandas(run, _PAIRS)


def _fits() -> Column:
    """Whether the sizes na and nb allow a link."""
    return 4 * F.least("na", "nb").cast("long") >= 3 * F.greatest("na", "nb").cast("long")


def _leader_pairs(large: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(pairs of a large group's classes with its most typical ones, a table to release); large: a shingle, b class, na size."""
    typical = large.groupBy("b").agg((F.count(F.lit(1)) / F.first("na")).alias("s"))
    best = W.partitionBy("a").orderBy(F.desc("s"), "b")
    top = large.join(typical, "b").withColumn("at", F.row_number().over(best)).filter(F.col("at") <= LEADERS)
    # written, so that its size is known: a small one is broadcast, and the rows of a large shingle stay where they are
    top = materialize(top.select("a", F.col("b").alias("c"), F.col("na").alias("nb")))
    both = large.join(top, "a").filter(F.col("b") != F.col("c")).filter(_fits())
    swap = F.col("b") > F.col("c")
    ends = [F.when(swap, F.col(y)).otherwise(F.col(x)).alias(name) for x, y, name in (("b", "c", "a"), ("c", "b", "b"), ("na", "nb", "na"), ("nb", "na", "nb"))]
    return both.select(*ends).distinct(), top


def _cross_pairs(known: DataFrame, count: int) -> DataFrame:
    """Pairs of unlike roots within large groups, once each, with their common large shingles.

    known: a shingle, m its classes, main its most frequent root, b class, na size, root, own (all
    large shingles of the class, sorted), other (the most shingles of small groups that
    it has in common with any class of fitting size).  A group's classes are dealt into buckets of about CELL;
    those of other roots than the main one meet all buckets, a pair of buckets being
    one cell.  A pair belongs to its smallest common shingle.  Pairs that can't
    link even if as many others were common are left out.
    """

    def cell_pairs(d: pd.DataFrame, token: int) -> Iterator[pd.DataFrame]:
        d = d.sort_values("b", ignore_index=True)
        c, n, root = d["b"].to_numpy(), d["na"].to_numpy().astype(np.int64), d["root"].to_numpy()
        main, is_left = root == d["main"].to_numpy(), d["side"].to_numpy() == 0
        size = d["own"].map(len).to_numpy()
        tokens, place = np.unique(np.concatenate(d["own"].to_numpy()), return_inverse=True)
        at = int(np.searchsorted(tokens, token))
        row = np.repeat(np.arange(len(d)), size)
        rest, other = n - prefix_length(n), d["other"].to_numpy().astype(np.int64)
        some, all_rows = np.flatnonzero(is_left), np.flatnonzero(~is_left)

        def dense(rows: np.ndarray) -> np.ndarray:
            lookup = np.full(len(d), -1)
            lookup[rows] = np.arange(len(rows))
            own = lookup[row] >= 0
            m = np.zeros((len(rows), len(tokens)), np.float32)
            m[lookup[row[own]], place[own]] = 1
            return m

        wide = max(16, min(1024, DENSE // max(1, len(tokens))))
        for y in range(0, len(all_rows), wide):
            right = all_rows[y : y + wide]
            there = dense(right)
            for x in range(0, len(some), wide):
                left = some[x : x + wide]
                here = dense(left)
                both = here @ there.T
                fits = (root[left][:, None] != root[right]) & (main[right] | (c[left][:, None] < c[right]))
                fits &= 4 * np.minimum(n[left][:, None], n[right]) >= 3 * np.maximum(n[left][:, None], n[right])
                fits &= 7 * (both + np.minimum(other[left][:, None], other[right]) + np.maximum(rest[left][:, None], rest[right])) >= 3 * (n[left][:, None] + n[right])
                fits &= here[:, :at] @ there[:, :at].T == 0
                i, j = np.nonzero(fits)
                if len(i):
                    p, q = left[i], right[j]
                    p, q = np.where(c[p] < c[q], p, q), np.where(c[p] < c[q], q, p)
                    yield pd.DataFrame({"a": c[p], "b": c[q], "na": n[p].astype(np.int32), "nb": n[q].astype(np.int32), "n": both[i, j].astype(np.int64)})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for (token, _, _), d in by_key(batches, ["a", "i", "j"]):
            yield from cell_pairs(d, token)

    buckets = F.ceil(F.col("m") / CELL).cast("int")
    d = known.withColumn("bucket", F.pmod(F.xxhash64("b"), buckets).cast("int")).withColumn("each", F.explode(F.sequence(F.lit(0), buckets - 1)))
    columns = ["a", "b", "na", "root", "main", "own", "other"]
    left = d.filter("root <> main").select(*columns, F.lit(0).alias("side"), F.col("bucket").alias("i"), F.col("each").alias("j"))
    right = d.select(*columns, F.lit(1).alias("side"), F.col("each").alias("i"), F.col("bucket").alias("j"))
    dealt = left.unionByName(right).repartition(max(1, count), "a", "i", "j").sortWithinPartitions("a", "i", "j")
    return dealt.mapInPandas(run, "a long, b long, na int, nb int, n long")


def _can_link() -> Column:
    """Whether the count n of common prefix shingles leaves a link possible."""
    rest = F.greatest(*[F.expr(f"({x} * 3 + 3) div 4 - 1") for x in ("na", "nb")])
    return 7 * (F.col("n") + rest) >= 3 * (F.col("na") + F.col("nb"))


def _token_cuts(rows: DataFrame) -> DataFrame:
    """c, cuts: every class's shingles, cut by hash range."""
    shift = np.uint64(63 - VERIFY_BITS)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in slices(batches):
            out = []
            for _, s in _sets(b):
                if len(s):
                    cut = np.searchsorted(s >> shift, np.arange((1 << VERIFY_BITS) + 1))
                    out.append((class_key(s), [s[x:y].tobytes() for x, y in zip(cut, cut[1:], strict=False)]))
            yield pd.DataFrame(out, columns=["c", "cuts"])

    return rows.select("__text").mapInPandas(run, "c long, cuts array<binary>")


def verified(pairs: DataFrame, cuts: DataFrame) -> DataFrame:
    """The pairs (a, b) whose sets link: overlaps counted a fragment, summed a pair.

    Both joins deal the sets by class, so they are dealt once; and they do so
    whatever the number of pairs is: the plan is the same for any input.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for d in batches:
            n = np.zeros(len(d), np.int64)
            for i, (x, y) in enumerate(zip(d["cuts_a"], d["cuts_b"], strict=True)):
                n[i] = sum(len(np.intersect1d(np.frombuffer(p, "<u8"), np.frombuffer(q, "<u8"), assume_unique=True)) for p, q in zip(x, y, strict=True))
            yield pd.DataFrame({"a": d["a"], "b": d["b"], "na": d["na"], "nb": d["nb"], "n": n})

    sets = cuts.hint("merge")
    both = pairs.select("a", "b", "na", "nb").join(sets.select(F.col("c").alias("a"), F.col("cuts").alias("cuts_a")), "a")
    both = both.join(sets.select(F.col("c").alias("b"), F.col("cuts").alias("cuts_b")), "b")
    total = both.select("a", "b", "na", "nb", "cuts_a", "cuts_b").mapInPandas(run, "a long, b long, na int, nb int, n long")
    return total.filter(100 * F.col("n") >= 75 * (F.col("na") + F.col("nb") - F.col("n"))).select("a", "b")


def _best(pairs: DataFrame) -> DataFrame:
    """For each class the pair with the largest share of common shingles."""
    x = F.struct((F.col("n") / (F.col("na") + F.col("nb"))).alias("s"), "a", "b", "na", "nb").alias("x")
    ends = pairs.select(F.col("a").alias("c"), x).unionByName(pairs.select(F.col("b").alias("c"), x))
    return ends.groupBy("c").agg(F.max("x").alias("x")).select("x.a", "x.b", "x.na", "x.nb").distinct()


def _between(pairs: DataFrame, roots: DataFrame) -> tuple[DataFrame, int]:
    """Pairs of classes in different components, and their number."""
    for x in "ab":
        pairs = pairs.join(roots.select(F.col("node").alias(x), F.col("root").alias(f"r{x}")), x, "left")
    out = materialize(pairs.filter(F.coalesce("ra", "a") != F.coalesce("rb", "b")).select("a", "b", "na", "nb", "n"))
    return out, out.count()


def _grouped(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """(texts: __id, row, n, c of every row; groups: c, root of every class)."""
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("__id"), text_of(text_col).alias("__text")).withColumn("row", F.xxhash64("__id", "__text"))
    found = materialize(signatures(rows))
    texts = found.filter("row is not null")
    common = found.filter("row is null").groupBy("c").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "c").limit(MOST_COMMON).collect()
    # the most frequent at the end of the order
    last, hot = [r["c"] for r in common][::-1], sum(r["n"] >= HOT for r in common)
    classes = texts.filter("c is not null").groupBy("c").agg(F.min("row").alias("row"), F.first("n").alias("n"))
    shingles = texts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    fragments = max(8, parts(shingles // 4, FRAGMENT_ROWS, 1 << 30))
    step = F.when(F.col("n") <= 64, F.col("n")).otherwise(F.floor(F.log2("n") * 8))
    sizes = [(r["n"], r["k"]) for r in classes.groupBy(step.alias("s")).agg(F.avg("n").alias("n"), F.count(F.lit(1)).alias("k")).collect()]

    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    tried = materialize(_fragment_pairs(_prefixes(rows, last, hot, fragment_edges(sizes, fragments)), fragments))
    counted = materialize(tried.filter("kind = 0").groupBy("a", "b", "na", "nb").agg(F.sum("n").alias("n")))
    likely = counted.filter(_can_link())
    large = tried.filter("kind = 2").select("a", "b", "na")
    leaders, top = _leader_pairs(large)
    pairs = materialize(_best(likely).unionByName(leaders).distinct())

    ends = likely.select(F.col("a").alias("c")).union(likely.select("b")).union(large.select("b")).distinct()
    needed = classes.join(ends, "c", "left_semi").select("row")
    # texts are dealt by row whatever the size of the other side: the plan is the same for any input
    cuts = materialize(_token_cuts(rows.join(needed.hint("merge"), "row", "left_semi")))
    links = materialize(verified(pairs, cuts))

    roots = materialize(components(links))
    known = large.join(roots.select(F.col("node").alias("b"), "root"), "b", "left").select("a", "b", "na", F.coalesce("root", "b").alias("root"))
    mixed = known.groupBy("a", "root").agg(F.count(F.lit(1)).alias("n")).groupBy("a").agg(F.sum("n").alias("m"), F.max(F.struct("n", "root"))["root"].alias("main"), F.count(F.lit(1)).alias("roots"))
    mixed = materialize(mixed.filter("roots > 1").drop("roots"))
    known = materialize(known.join(mixed, "a"))
    lists = known.groupBy("b").agg(F.sort_array(F.collect_list("a")).alias("own"))
    others = counted.select(F.col("a").alias("b"), "n").unionAll(counted.select("b", "n")).groupBy("b").agg(F.max("n").alias("other"))
    cross = _cross_pairs(known.join(lists, "b").join(others, "b", "left").fillna(0, ["other"]), tasks)
    more = cross.unionByName(counted).groupBy("a", "b", "na", "nb").agg(F.sum("n").alias("n")).filter(_can_link())
    more, left = _between(more.join(pairs.select("a", "b"), ["a", "b"], "left_anti"), roots)
    done = [tried, counted, top, pairs, cuts, links, roots, mixed, known, more]
    for _ in range(ROUNDS):
        if left <= 4 * ends.count():
            break
        pairs = materialize(_best(more))
        found_links = materialize(verified(pairs, cuts))
        links = links.unionByName(found_links)
        roots = materialize(components(links))
        more, left = _between(more.join(pairs.select("a", "b"), ["a", "b"], "left_anti"), roots)
        done += [pairs, found_links, roots, more]
    if left:
        rest = materialize(verified(more, cuts))
        links = links.unionByName(rest)
        done.append(rest)
    roots = components(links)
    release(*done)
    groups = texts.filter("c is not null").select("c").distinct().join(roots.withColumnRenamed("node", "c"), "c", "left")
    return texts, groups.select("c", F.coalesce("root", "c").alias("root"))


def similar_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_shingles, component_id (the smallest id reachable by links)."""
    texts, groups = _grouped(docs, id_col, text_col)
    least = texts.filter("c is not null").groupBy("c").agg(F.min("__id").alias("__id")).join(groups, "c")
    smallest = least.groupBy("root").agg(F.min("__id").alias("component_id"))
    # written, so that the rows of a class with many copies can be split from each other
    named = materialize(groups.join(smallest, "root").select("c", "component_id"))
    out = texts.join(named, "c", "left")
    return out.select(F.col("__id").alias(id_col), F.col("n").cast("long").alias("n_shingles"), F.when(F.col("c").isNull(), F.col("__id")).otherwise(F.col("component_id")).alias("component_id"))


def without_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with one row of each component: that of the smallest id, null last, and of equal ids that of the smallest hash of id and text.

    Rows are told apart by id and text, so an id that stands on two texts loses
    neither.  Rows equal in both count as one, also those without words;
    of these the smallest by all their columns stays.
    """
    texts, groups = _grouped(docs, id_col, text_col)
    each = texts.groupBy("row").agg(F.first("c").alias("c"), F.first("__id").alias("__id"), F.count(F.lit(1)).alias("k")).join(groups, "c", "left")
    order = F.struct(F.col("__id").isNull(), "__id", "row")
    best = materialize(each.filter("root is not null").groupBy("root").agg(F.min(order).alias("x")).select("root", F.col("x.row").alias("best")))
    each = materialize(each.join(best, "root", "left").select(F.col("row").alias("__row"), (F.col("best").isNotNull() & (F.col("best") != F.col("row"))).alias("later"), (F.col("k") > 1).alias("again")))
    again = materialize(each.filter("again and not later").select("__row"))
    rows = docs.withColumn("__row", F.xxhash64(F.col(id_col), text_of(text_col)))
    out = rows.join(each.filter("again or later").select("__row"), "__row", "left_anti").select(*docs.columns)
    if again.isEmpty():
        return out
    one = rows.join(again, "__row", "left_semi").groupBy("__row").agg(F.min(F.struct(*docs.columns)).alias("x"))
    return out.unionByName(one.select("x.*"))
