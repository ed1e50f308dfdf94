"""Removal of repeated byte strings by distributed suffix ordering.

A byte is removed if a ``LENGTH``-byte string that covers it also starts earlier:
in a text with a smaller id, or earlier in the same text.  Strings are judged on
the input and never cross texts.

Texts that are equal as a whole share one class; all but the one with the
smallest id are repeats from end to end.  In the others, every ``LENGTH``-byte
string has one anchor: of its ``GRAM``-byte substrings the one with the smallest
hash, the leftmost of equals.  Equal strings have equal anchors.  An anchor that occurs
once can't belong to a repeat, which clears most of the corpus after one light
shuffle of hashes.  The strings of each other anchor (a run of starts, and the
bytes they span) go to the part of the anchor's hash.  There, spans with equal
bytes are settled by the earliest; the suffixes of the differing ones are
ordered by the difference-cover algorithm (sorted triples, recursion on names,
merge of the rest) and neighbours with equal ``LENGTH``-byte prefixes form runs
of which the earliest stays.

The number of parts follows the bytes of the corpus, and a task works through
its parts one after the other, so what it holds doesn't grow.  What a block of
texts settles on its own is not dealt out: an anchor that occurs twice in it is shared, and
of equal spans all but the earliest go.  An anchor of very many texts (``HOT``) would still
bring as many differing spans to one task as there are contexts around it; its
spans are cut into their single strings, dealt by the string's hash.

Ordering every suffix of the corpus in one distributed sort needs more disk than
the text many times over; anchors bring equal prefixes together
without it, and their order decides as before.

Null texts are empty.  Rows with equal id and text are the same text and
fare alike; a null id comes after all others.  Of different texts under one id the one with
the smaller hash counts as earlier.  Texts shorter than ``LENGTH`` are kept whole.  An empty table gives no rows.
Only id and text are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm._shared import MOST_TASKS, by_key, materialize, release, slices, text_of
from plumbline.llm._words import BYTE, _power, chunks, mix
from plumbline.llm.suffixes import equal_next, suffix_order

LENGTH, GRAM = 100, 32
SLICE = 1_000_000
#: bytes of texts that are settled together before anything is dealt out
BLOCK = 8 << 20
#: bytes of a part; up to LEAST_PARTS parts are smaller, so that a small corpus keeps all tasks busy
PART, SMALL_PART, LEAST_PARTS = 32 << 20, 2 << 20, 4096
#: occurrences from which an anchor is hot: so many, or as many as leave MOST_HOT hot ones
HOT, MOST_HOT = 4096, 1 << 20
_SAMPLE = np.dtype([("h", "<u8"), ("t", "<i8"), ("p", "<u4"), ("n", "<u4")])
_SPAN = np.dtype([("g", "<u8"), ("c", "<u8"), ("o", "<i8"), ("t", "<i8"), ("a", "<u4"), ("n", "<u4")])


class Anchors:
    """Anchors of the strings of a few texts: ``place`` of the anchor, first and last start ``a`` and ``b``, text ``of``, ``hash``."""

    def __init__(self, texts: list[bytes], length: int = LENGTH, gram: int = GRAM):
        self.data = data = np.frombuffer(b"".join(texts), np.uint8)
        sizes = np.array([len(t) for t in texts], np.int64)
        self.offset = np.concatenate(([0], np.cumsum(sizes)))
        n, width = len(data) - gram + 1, length - gram + 1
        self.place = self.a = self.b = self.of = np.empty(0, np.int64)
        self.hash = np.empty(0, np.uint64)
        if len(data) < length:
            return
        up, down = _power(len(data) + 1)
        self.total = total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(BYTE[data] * up[: len(data)], dtype=np.uint64)))
        self._down = down
        grams = mix((total[gram:] - total[:-gram]) * down[:n])
        low = np.uint64(32)
        key = (grams >> low << low) | np.arange(n, dtype=np.uint64)
        blocks = -(-n // width)
        padded = np.full(blocks * width, np.iinfo(np.uint64).max, np.uint64)
        padded[:n] = key
        square = padded.reshape(blocks, width)
        ahead = np.minimum.accumulate(square, axis=1).ravel()
        back = np.minimum.accumulate(square[:, ::-1], axis=1)[:, ::-1].ravel()
        starts = len(data) - length + 1
        chosen = (np.minimum(back[:starts], ahead[width - 1 : width - 1 + starts]) & np.uint64(0xFFFFFFFF)).astype(np.int64)
        inside = np.zeros(starts + 1, np.int64)
        long = sizes >= length
        np.add.at(inside, self.offset[:-1][long], 1)
        np.add.at(inside, np.minimum(self.offset[1:][long] - length + 1, starts), -1)
        at = np.flatnonzero(np.cumsum(inside[:-1]) > 0)
        if not len(at):
            return
        of = np.searchsorted(self.offset, at, "right") - 1
        new = np.concatenate(([True], (chosen[at][1:] != chosen[at][:-1]) | (of[1:] != of[:-1])))
        first = np.flatnonzero(new)
        last = np.concatenate((first[1:] - 1, [len(at) - 1]))
        self.place, self.a, self.b, self.of = chosen[at[first]], at[first], at[last], of[first]
        self.hash = grams[self.place]

    def hash_of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.total[end] - self.total[start]) * self._down[start] + (end - start).astype(np.uint64))


def text_key(data: bytes) -> int:
    return int.from_bytes(hashlib.sha256(data).digest()[:8], "big", signed=True)


def number_of_parts(size: int) -> int:
    return max(1, min(LEAST_PARTS, size // SMALL_PART), size // PART)


def _blobs(keys: np.ndarray, count: int) -> Iterator[tuple[int, np.ndarray]]:
    """(part, its rows) by the hashes in keys."""
    part = (mix(keys) % np.uint64(count)).astype(np.int64)
    order = np.argsort(part, kind="stable")
    cut = [0, *(np.flatnonzero(np.diff(part[order])) + 1), len(order)]
    for x, y in zip(cut, cut[1:], strict=False):
        if y > x:
            yield int(part[order[x]]), order[x:y]


def _part_of(t: int, count: int) -> int:
    return int(mix(np.array([t], np.int64).view(np.uint64))[0] % np.uint64(count))


def _samples(rows: DataFrame, count: int) -> DataFrame:
    """part, done, t, data.  Not done: hash, text, place and number of anchors, packed; else places of the text t that are shared.

    Copies within a task count once.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: set[int] = set()
        held: list[np.ndarray] = []
        size = 0

        def block() -> pd.DataFrame:
            own = np.concatenate(held)
            own = own[np.argsort(own["h"], kind="stable")]
            edge = np.flatnonzero(np.concatenate(([True], own["h"][1:] != own["h"][:-1])))
            times = np.diff(np.concatenate((edge, [len(own)])))
            many = np.repeat(times > 1, times)
            sent = own[edge]
            sent["n"] = times
            out = [(f, False, 0, sent[i].tobytes()) for f, i in _blobs(sent["h"], count)]
            out += [(_part_of(t, count), True, t, d) for t, d in _by_text(own["t"][many], own["p"][many]).itertuples(index=False)]
            return pd.DataFrame(out, columns=["part", "done", "t", "data"])

        for b in slices(batches):
            texts, keys = [], []
            for t in b["__text"]:
                data = t.encode()
                if len(data) >= LENGTH and (k := text_key(data)) not in seen:
                    seen.add(k)
                    texts.append(data)
                    keys.append(k)
            for lo, hi in chunks(texts):
                x = Anchors(texts[lo:hi])
                rows = np.zeros(len(x.place), _SAMPLE)
                rows["h"], rows["t"], rows["p"] = x.hash, np.array(keys[lo:hi], np.int64)[x.of], x.place - x.offset[x.of]
                held.append(rows)
                size += len(x.data)
                if size >= BLOCK:
                    yield block()
                    held, size = [], 0
        if sum(map(len, held)):
            yield block()

    return rows.select("__text").mapInPandas(run, "part int, done boolean, t long, data binary")


def _by_text(t: np.ndarray, values: np.ndarray) -> pd.DataFrame:
    order = np.argsort(t, kind="stable")
    t, values = t[order], values[order]
    edge = np.flatnonzero(np.concatenate(([True], t[1:] != t[:-1], [True]))) if len(t) else [0]
    return pd.DataFrame([(int(t[x]), values[x:y].tobytes()) for x, y in zip(edge, edge[1:], strict=False)], columns=["t", "data"])


def _shared(samples: DataFrame, count: int, hot: int) -> DataFrame:
    """t, data: places of anchors that occur twice or more, packed; data null: t is the hash of a hot anchor."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for _, d in by_key(batches, ["part"]):
            known = d["done"].to_numpy(bool)
            if known.any():
                yield d.loc[known, ["t", "data"]]
            rows = np.frombuffer(b"".join(d.loc[~known, "data"]), _SAMPLE)
            rows = rows[np.lexsort((rows["p"], rows["t"], rows["h"]))]
            # copies of a text come from several tasks
            twin = (rows["h"][1:] == rows["h"][:-1]) & (rows["t"][1:] == rows["t"][:-1]) & (rows["p"][1:] == rows["p"][:-1]) & (rows["n"][1:] == 1) & (rows["n"][:-1] == 1)
            rows = rows[np.concatenate(([True], ~twin))] if len(rows) else rows
            edge = np.flatnonzero(np.concatenate(([True], rows["h"][1:] != rows["h"][:-1]))) if len(rows) else np.empty(0, np.int64)
            if not len(edge):
                continue
            total = np.add.reduceat(rows["n"].astype(np.int64), edge)
            own = rows[np.repeat(total, np.diff(np.concatenate((edge, [len(rows)])))) > 1]
            own = own[own["n"] == 1]
            yield _by_text(own["t"], own["p"])
            yield pd.DataFrame({"t": rows["h"][edge[total >= hot]].view(np.int64), "data": None})

    return samples.repartition(min(count, MOST_TASKS), "part").sortWithinPartitions("part").mapInPandas(run, "t long, data binary")


def merged(t: np.ndarray, start: np.ndarray, end: np.ndarray) -> pd.DataFrame:
    """t, data: byte ranges by text, those that touch made one, packed as pairs."""
    order = np.lexsort((start, t))
    t, start, end = t[order], start[order], end[order]
    if not len(t):
        return _by_text(t, np.empty((0, 2), np.int64))
    # ends grow within a text once texts are set apart
    base = np.cumsum(np.concatenate(([False], t[1:] != t[:-1]))).astype(np.int64) << 40
    upto = np.maximum.accumulate(end + base)
    new = np.concatenate(([True], (start + base)[1:] > upto[:-1]))
    last = np.concatenate((np.flatnonzero(new)[1:] - 1, [len(t) - 1]))
    return _by_text(t[new], np.stack((start[new], upto[last] - base[last]), axis=1))


def _windows(meta: np.ndarray, content: list[bytes]) -> np.ndarray:
    """The spans' single strings as spans of their own; g and c are the string's hash."""
    data = np.frombuffer(b"".join(content), np.uint8)
    size = meta["n"].astype(np.int64)
    offset = np.concatenate(([0], np.cumsum(size)))[:-1]
    each = size - LENGTH + 1
    of = np.repeat(np.arange(len(meta)), each)
    within = np.arange(int(each.sum())) - np.repeat(np.cumsum(each) - each, each)
    start = offset[of] + within
    up, down = _power(len(data) + 1)
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(BYTE[data] * up[: len(data)], dtype=np.uint64)))
    out = meta[of]
    out["c"] = out["g"] = mix((total[start + LENGTH] - total[start]) * down[start] + np.uint64(LENGTH))
    out["a"], out["n"] = out["a"] + within, LENGTH
    return out


def _earliest(meta: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Indices of the earliest of equal spans, and of the others."""
    order = np.lexsort((meta["a"], meta["t"], meta["o"], meta["c"], meta["g"]))
    m = meta[order]
    lead = np.concatenate(([True], (m["g"][1:] != m["g"][:-1]) | (m["c"][1:] != m["c"][:-1]))) if len(m) else np.zeros(0, bool)
    return order[lead], order[~lead]


def _spans(texts: DataFrame, hot: list[int], count: int) -> DataFrame:
    """part, done, t, meta, data; texts: o (order), t, __text, places.

    Not done: spans of shared anchors and their bytes; in parts below 0 single strings of hot
    anchors, without bytes.  Else data are ranges of the text t that are repeats.
    """
    sent = texts.sparkSession.sparkContext.broadcast(hot)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hot = np.sort(np.array(sent.value, np.int64).view(np.uint64))
        meta: list[np.ndarray] = []
        data: list[bytes] = []
        size = 0

        def block() -> pd.DataFrame:
            rows = np.concatenate(meta)
            lead, rest = _earliest(rows)
            gone = [rows[rest]]
            cut = np.isin(rows["g"][lead], hot)
            single = _windows(rows[lead[cut]], [data[i] for i in lead[cut]])
            first, again = _earliest(single)
            gone.append(single[again])
            single, lead = single[first], lead[~cut]
            out = [(f, False, 0, rows[lead[i]].tobytes(), b"".join(data[k] for k in lead[i])) for f, i in _blobs(rows["g"][lead], count)]
            out += [(-1 - f, False, 0, single[i].tobytes(), b"") for f, i in _blobs(single["g"], count)]
            g = np.concatenate(gone)
            ranges = merged(g["t"], g["a"].astype(np.int64), g["a"].astype(np.int64) + g["n"])
            out += [(_part_of(t, count), True, t, None, d) for t, d in ranges.itertuples(index=False)]
            return pd.DataFrame(out, columns=["part", "done", "t", "meta", "data"])

        for b in slices(batches):
            texts = [t.encode() for t in b["__text"]]
            for lo, hi in chunks(texts):
                x = Anchors(texts[lo:hi])
                own = np.zeros(len(x.place), bool)
                edge = np.searchsorted(x.of, np.arange(hi - lo + 1))
                for i in range(hi - lo):
                    places = np.concatenate([np.frombuffer(p, "<u4") for p in b["places"].iloc[lo + i]])
                    y = slice(edge[i], edge[i + 1])
                    own[y] = np.isin(x.place[y] - x.offset[i], places)
                a, end, of = x.a[own], x.b[own] + LENGTH, x.of[own]
                rows = np.empty(len(a), _SPAN)
                rows["g"], rows["c"], rows["a"], rows["n"] = x.hash[own], x.hash_of(a, end) if len(a) else 0, a - x.offset[of], end - a
                rows["o"], rows["t"] = b["o"].to_numpy()[lo:hi][of], b["t"].to_numpy()[lo:hi][of]
                meta.append(rows)
                raw = x.data.tobytes()
                data += [raw[p:q] for p, q in zip(a.tolist(), end.tolist(), strict=True)]
                size += len(raw)
                if size >= BLOCK:
                    yield block()
                    meta, data, size = [], [], 0
        if sum(map(len, meta)):
            yield block()

    return texts.mapInPandas(run, "part int, done boolean, t long, meta binary, data binary")


def settle(meta: np.ndarray, content: list[bytes]) -> np.ndarray:
    """For spans of one or several anchors: a row (span, first start, last start) for each run of repeated strings.

    content has the bytes of each span; spans with equal g and c are equal.
    """
    kept, rest = _earliest(meta)
    out = [np.stack((rest, np.zeros(len(rest), np.int64), meta["n"][rest].astype(np.int64) - LENGTH), axis=1)]
    # anchors whose spans differ
    g = meta["g"][kept]
    alike = np.concatenate(([False], g[1:] == g[:-1]))
    many = alike | np.concatenate((alike[1:], [False])) if len(g) else alike
    kept, g = kept[many], g[many]
    upto = np.cumsum(meta["n"][kept].astype(np.int64))
    at = 0
    while at < len(kept):
        # whole anchors, of about SLICE bytes
        stop = int(np.searchsorted(upto, (upto[at - 1] if at else 0) + SLICE, "right"))
        stop = max(stop, at + 1)
        stop = int(np.searchsorted(g, g[stop - 1], "right"))
        out.append(_ordered(meta, kept[at:stop], content))
        at = stop
    return np.concatenate(out)


def _ordered(meta: np.ndarray, own: np.ndarray, content: list[bytes]) -> np.ndarray:
    data = np.frombuffer(b"".join(content[i] for i in own), np.uint8)
    size = meta["n"][own].astype(np.int64)
    offset = np.concatenate(([0], np.cumsum(size)))
    start = np.zeros(len(data) + 1, bool)
    span = np.repeat(np.arange(len(own)), size)
    within = np.arange(len(data)) - offset[span]
    start = within <= size[span] - LENGTH
    order = suffix_order(data.astype(np.int64) + 1, LENGTH)
    order = order[start[order]]
    run = np.concatenate(([0], np.cumsum(~equal_next(data, order, LENGTH))))
    s = span[order]
    place = meta["a"][own[s]].astype(np.int64) + within[order]
    by = np.lexsort((place, meta["t"][own[s]], meta["o"][own[s]], run))
    later = np.concatenate(([False], run[by][1:] == run[by][:-1]))
    p = np.sort(order[by][later])
    if not len(p):
        return np.empty((0, 3), np.int64)
    new = np.concatenate(([True], (p[1:] != p[:-1] + 1) | (span[p[1:]] != span[p[:-1]])))
    first = p[new]
    last = p[np.concatenate((np.flatnonzero(new)[1:] - 1, [len(p) - 1]))]
    return np.stack((own[span[first]], within[first], within[last]), axis=1)


def _removed(spans: DataFrame, count: int) -> DataFrame:
    """t, data: byte ranges to remove from a text, packed as pairs."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for (f,), d in by_key(batches, ["part"]):
            known = d["done"].to_numpy(bool)
            if known.any():
                yield d.loc[known, ["t", "data"]]
            d = d[~known]
            if not len(d):
                continue
            rows = np.frombuffer(b"".join(d["meta"]), _SPAN)
            if f < 0:
                rest = rows[_earliest(rows)[1]]
                yield merged(rest["t"], rest["a"].astype(np.int64), rest["a"].astype(np.int64) + LENGTH)
                continue
            raw = b"".join(d["data"])
            end = np.cumsum(rows["n"].astype(np.int64))
            found = settle(rows, _Slices(raw, end - rows["n"], end))
            a = rows["a"][found[:, 0]].astype(np.int64)
            yield merged(rows["t"][found[:, 0]], a + found[:, 1], a + found[:, 2] + LENGTH)

    return spans.repartition(min(count, MOST_TASKS), "part").sortWithinPartitions("part").mapInPandas(run, "t long, data binary")


class _Slices:
    """Pieces of bytes, made when they are asked for."""

    def __init__(self, data: bytes, start: np.ndarray, end: np.ndarray):
        self.data, self.start, self.end = data, start, end

    def __getitem__(self, i: int) -> bytes:
        return self.data[self.start[i] : self.end[i]]


def _cut(texts: DataFrame) -> DataFrame:
    """t, n_removed, n_spans, kept_sha256 of texts with the ranges found in them."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for t, text, ranges in zip(b["t"], b["__text"], b["ranges"], strict=True):
                data = text.encode()
                r = np.concatenate([np.frombuffer(x, "<i8").reshape(-1, 2) for x in ranges])
                cover = np.zeros(len(data) + 1, np.int64)
                np.add.at(cover, r[:, 0], 1)
                np.add.at(cover, r[:, 1], -1)
                gone = np.cumsum(cover)[:-1] > 0
                spans = int(np.count_nonzero(np.diff(np.concatenate(([0], gone.astype(np.int8)))) == 1))
                out.append((t, int(gone.sum()), spans, hashlib.sha256(np.frombuffer(data, np.uint8)[~gone].tobytes()).hexdigest()))
            yield pd.DataFrame(out, columns=["t", "n_removed", "n_spans", "kept_sha256"])

    return texts.select("t", "__text", "ranges").mapInPandas(run, "t long, n_removed long, n_spans long, kept_sha256 string")


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_bytes, n_removed, n_spans, kept_sha256; ids are integers."""
    last = F.lit((1 << 63) - 1)
    rows = docs.select(F.col(id_col).alias("__id"), text_of(text_col).alias("__text")).withColumn("o", F.coalesce(F.col("__id").cast("long"), last))
    rows = rows.withColumn("sha", F.sha2(F.col("__text").cast("binary"), 256))
    # the first 64 bits of the hash, signed
    key = F.expr("cast(conv(substr(sha, 1, 16), 16, -10) as bigint)")
    light = materialize(rows.select("__id", "o", "sha", key.alias("t"), F.octet_length("__text").cast("long").alias("n_bytes")))
    first = materialize(light.groupBy("t").agg(F.min("o").alias("first"), F.first("n_bytes").alias("size")))
    size = first.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    count = number_of_parts(size)
    found = materialize(_shared(_samples(rows, count), count, max(HOT, size // (35 * MOST_HOT))))
    hot = [r["t"] for r in found.filter("data is null").select("t").collect()]
    shared = found.filter("data is not null").groupBy("t").agg(F.collect_list("data").alias("places")).join(first.select("t", F.col("first").alias("o")), "t")
    # equal rows of the smallest id come together by the join, and one of them stays
    texts = materialize(rows.withColumn("t", key).select("o", "t", "__text").join(shared, ["t", "o"]).dropDuplicates(["t", "o"]))
    release(found)
    ranges = _removed(_spans(texts, hot, count), count).groupBy("t").agg(F.collect_list("data").alias("ranges"))
    cut = _cut(texts.select("t", "__text").join(ranges, "t"))
    # written, so that the rows of a text with many copies can be split from each other
    judged = materialize(first.drop("size").join(cut, "t", "left"))
    release(first, texts)
    d = light.join(judged, "t")
    copy = F.col("o") > F.col("first")
    whole = copy & (F.col("n_bytes") >= LENGTH)
    empty = hashlib.sha256(b"").hexdigest()
    return d.select(
        F.col("__id").alias(id_col),
        "n_bytes",
        F.when(whole, F.col("n_bytes")).when(copy, F.lit(0)).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(whole, F.lit(1)).when(copy, F.lit(0)).otherwise(F.coalesce("n_spans", F.lit(0))).cast("long").alias("n_spans"),
        F.when(whole, F.lit(empty)).when(copy, F.col("sha")).otherwise(F.coalesce("kept_sha256", "sha")).alias("kept_sha256"),
    )
