"""Best-fit packing by the sum of squares.

Documents are tokenised, ended by an end token and, only where longer than a
sequence, cut into pieces of exactly the capacity; the first piece takes the
rest.  Full pieces are sequences of their own.  The others are packed by the
sum-of-squares rule: with N(g) open bins of gap g, a piece goes where the sum of
N(g)^2 over all gaps becomes smallest, into an open bin or a new one; full bins
are closed and count no more.  Pieces come longest first.  Bins left more than
``SLACK`` of the capacity open are dissolved and their pieces come again, a few
times over: the pieces that are left fit each other better each time.  All this is done
twice, once opening a new bin wherever the rule says so and once only for pieces
that no open bin has room for; the result with fewer bins counts.

Packing runs in partitions of about ``ROUND_ROWS`` pieces, dealt evenly whatever
their ids are.  State is one counter a gap and the open bins.  What a partition can't
fill is packed again with that of the others in a next, much smaller round,
``ROUNDS`` times at most, so that what is lost doesn't grow with the number of
partitions.

Token ids are those of the vocabulary file read by the tokenizers library; the
same vocabulary as ranks is read by tiktoken, which gives the same ids in a
fifth of the time.  The string of a special token in a text becomes that
token's id, as the library has it unless told otherwise; the list of them is read
from the vocabulary file.

Null and empty texts hold the end token alone.  Repeated rows and rows with
equal or null ids are packed as often as they occur.  An empty table gives no
rows.  Only the id and text columns are read.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm._shared import materialize, parts, release, text_of

ROUND_ROWS = 10_000
ROUNDS = 3
AGAIN = 5
SLACK = 4 / 1024
RANKS, VOCABULARY = "byte_bpe_50k.tiktoken", "byte_bpe_50k.json"


@lru_cache(maxsize=2)
def encoding(name: str = RANKS, vocabulary: str = VOCABULARY):
    """The tokenizer of a rank file of public_tokenizers, or of a path, with the special tokens of a vocabulary file."""
    import json
    import os

    import public_tokenizers
    import tiktoken

    def place(x: str) -> str:
        return x if os.path.isabs(x) else public_tokenizers.path(x)

    with open(place(name), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    with open(place(vocabulary), encoding="utf-8") as f:
        special = {x["content"]: x["id"] for x in json.load(f)["added_tokens"]}
    return tiktoken.Encoding(name, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special)


def token_ids(text: str, tokenizer: str = RANKS) -> list[int]:
    return encoding(tokenizer).encode(text, allowed_special="all")


def token_pieces(docs: DataFrame, capacity: int = 1024, end_id: int = 2, tokenizer: str = RANKS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id_col, piece, start, length, ids (little-endian unsigned 32-bit, as binary)."""
    # ids travel as text: pandas would make numbers with nulls among them inexact
    rows = docs.select(F.col(id_col).cast("string").alias(id_col), text_of(text_col).alias("__text"))
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for lo in range(0, len(b), 256):
                part = b.iloc[lo : lo + 256]
                out: list[tuple] = []
                for doc, text in zip(part[id_col], part["__text"], strict=True):
                    ids = np.asarray([*token_ids(text, tokenizer), end_id], dtype="<u4").tobytes()
                    n = len(ids) // 4
                    first = (n - 1) % capacity + 1
                    cuts = [0, *range(first, n + 1, capacity)]
                    out += [(doc, k, x, y - x, ids[4 * x : 4 * y]) for k, (x, y) in enumerate(zip(cuts, cuts[1:], strict=False))]
                yield pd.DataFrame(out, columns=[id_col, "piece", "start", "length", "ids"])

    return rows.mapInPandas(run, f"`{id_col}` string, piece int, start long, length long, ids binary").withColumn(id_col, F.col(id_col).cast(id_type))


def sum_of_squares(lengths: np.ndarray, capacity: int, eager: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """(bin, offset) of each piece; lengths in the order in which they come.

    eager: a new bin is a choice like any other; else the last one.
    """
    open_bins: list[list[int]] = [[] for _ in range(capacity + 1)]  # by filled length
    n = np.zeros(2 * capacity + 1, dtype=np.int64)  # open bins by filled length; 0 and from capacity on none count
    bins, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    made = 0
    for i, size in enumerate(lengths.tolist()):
        # a bin of level h that gets the piece: N(h) falls, N(h + size) grows unless it is full then
        top = capacity - size
        change = np.full(top + 1, np.iinfo(np.int64).max // 4)
        used = n[1 : top + 1] > 0
        if top >= 1 and used.any():
            grown = 2 * (n[size + 1 : size + top + 1] - n[1 : top + 1] + 1)
            grown[-1] = 1 - 2 * n[top]  # filled up and closed
            change[1:] = np.where(used, grown, change[1:])
        change[0] = np.iinfo(np.int64).max // 8 if not eager else 2 * n[size] + 1 if size < capacity else 0
        best = top - int(np.argmin(change[::-1]))  # of equals the fullest
        if best == 0:
            b, made = made, made + 1
        else:
            b = open_bins[best].pop()
            n[best] -= 1
        bins[i], offsets[i] = b, best
        if best + size < capacity:
            open_bins[best + size].append(b)
            n[best + size] += 1
    return bins, offsets


def pack_lengths(lengths: np.ndarray, capacity: int, again: int = AGAIN) -> tuple[np.ndarray, np.ndarray]:
    """(bin, offset) of each piece: sum of squares, longest first, over and over what isn't filled."""
    return min((_repacked(lengths, capacity, again, eager) for eager in (True, False)), key=lambda x: x[0].max(initial=-1))


def _repacked(lengths: np.ndarray, capacity: int, again: int, eager: bool) -> tuple[np.ndarray, np.ndarray]:
    bins, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    todo, made = np.arange(len(lengths)), 0
    for k in range(again + 1):
        todo = todo[np.argsort(-lengths[todo], kind="stable")]
        own, at = sum_of_squares(lengths[todo], capacity, eager)
        full = (np.bincount(own, lengths[todo]) >= capacity * (1 - SLACK))[own] | (k == again)
        number = np.unique(own[full], return_inverse=True)[1]
        bins[todo[full]], offsets[todo[full]] = number + made, at[full]
        made += int(number.max()) + 1 if len(number) else 0
        todo = todo[~full]
        if not len(todo):
            break
    return bins, offsets


def _round(pieces: DataFrame, rows: int, capacity: int, number: int) -> DataFrame:
    columns = [c for c in pieces.columns if c not in ("sequence_id", "offset", "__filled")]
    kinds = {f.name: f.dataType.simpleString() for f in pieces.schema if f.name in columns}
    whole = [c for c, kind in kinds.items() if kind in ("bigint", "int", "smallint", "tinyint") and c != "length"]
    schema = ", ".join(f"`{c}` {'string' if c in whole else kind}" for c, kind in kinds.items()) + ", sequence_id long, offset long, __filled long"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = [b for b in batches if len(b)]
        if not held:
            return
        all_rows = pd.concat(held, ignore_index=True)
        bins, offsets = pack_lengths(all_rows["length"].to_numpy(), capacity)
        base = (number << 58) + (TaskContext.get().partitionId() << 34)
        yield all_rows.assign(sequence_id=bins + base, offset=offsets, __filled=np.bincount(bins, all_rows["length"].to_numpy()).astype(np.int64)[bins])

    dealt = pieces.select(*[F.col(c).cast("string").alias(c) if c in whole else c for c in columns]).repartition(parts(rows, ROUND_ROWS))
    return dealt.mapInPandas(run, schema).withColumns({c: F.col(c).cast(kinds[c]) for c in whole})


def pack_pieces(pieces: DataFrame, capacity: int = 1024, rounds: int = ROUNDS) -> DataFrame:
    """pieces, and all their columns, with sequence_id and offset; lengths are 1 to capacity.

    Columns sequence_id and offset of the input are replaced.
    """
    todo = materialize(pieces)
    done: DataFrame | None = None
    for number in range(1, rounds + 1):
        rows = todo.count()
        packed = _round(todo, rows, capacity, number)
        if number == rounds or parts(rows, ROUND_ROWS) == 1:
            done = packed if done is None else done.unionByName(packed)
            break
        packed, old = materialize(packed), todo
        release(old)
        closed = F.col("__filled") >= capacity * (1 - SLACK)
        done = packed.filter(closed) if done is None else done.unionByName(packed.filter(closed))
        todo = packed.filter(~closed)
    return done.drop("__filled")


def pack_documents(docs: DataFrame, capacity: int = 1024, end_id: int = 2, tokenizer: str = RANKS, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = True) -> DataFrame:
    """id_col, piece, start, length, ids_crc32, sequence_id, offset, and the token ids unless with_ids is off."""
    pieces = token_pieces(docs, capacity, end_id, tokenizer, id_col, text_col).withColumn("ids_crc32", F.crc32("ids"))
    return pack_pieces(pieces if with_ids else pieces.drop("ids"), capacity)
