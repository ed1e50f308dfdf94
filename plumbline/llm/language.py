"""Language identification by bit-sliced Bloom filters of character n-grams.

Each language's n-grams of its training texts go into one Bloom filter; the
filters are bit-sliced: a slot holds a mask with one bit a language, a word of it for each 64, so that one
probe a hash function answers for all languages at once, and the AND of an
n-gram's probes is the mask of the languages that contain it.  A text's score in
a language is the share of its n-grams whose mask has the language's bit, less
what the filter answers falsely: with fill f and k hashes a foreign n-gram is
found at rate f^k, so (share - f^k) / (1 - f^k) is the share truly contained.
The best language is predicted, ties to the first in name order; the score is
its corrected share.

N-grams are taken over lower-cased letters; everything else becomes one space,
and texts begin and end with one.  An n-gram counts for a language if it occurs
in ``LEAST_TEXTS`` of its training texts at least, which keeps quoted foreign
words out; of fewer than ``LEAST_TEXTS * TEXTS_A_STEP`` texts, in one for each
``TEXTS_A_STEP``.

Training reads up to ``SAMPLE`` distinct texts a language, by hash of the text, whatever their source or id is, of every language.  Prediction covers every row and whole texts, from the text alone.
Null texts and texts without a letter are ``und`` with score 0.  Repeated rows
are predicted alike.  Without training rows everything is ``und``.  An empty
table gives no rows; other columns are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from plumbline.llm._words import mix

SAMPLE = 600
LEAST_TEXTS, TEXTS_A_STEP = 3, 10
GRAMS = (2, 3, 4)
SLOTS = 1 << 20
HASHES = 2
_NOT_LETTERS = re.compile(r"[\W\d_]+")


def letters(text: str) -> str:
    """Lower-cased letters in words, one space around each; empty without a letter."""
    words = _NOT_LETTERS.sub(" ", text.lower()).strip()
    return f" {words} " if any(map(str.isalpha, words)) else ""


def grams(text: str, sizes: tuple[int, ...] = GRAMS) -> np.ndarray:
    """Hashes of the n-grams of letters(text)."""
    points = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.uint64)
    out = []
    for n in sizes:
        m = len(points) - n + 1
        if m > 0:
            h = np.full(m, n, np.uint64)
            for j in range(n):
                h = h * np.uint64(0x100000001B3) + points[j : j + m]
            out.append(mix(h))
    return np.concatenate(out) if out else np.empty(0, np.uint64)


@dataclass
class Filters:
    names: list[str]
    slots: list[np.ndarray]
    false_rate: np.ndarray

    def masks(self, hashes: np.ndarray) -> Iterator[np.ndarray]:
        """The languages of each n-gram, as bits, by words of the mask."""
        for word in self.slots:
            size, out = np.uint64(len(word) - 1), None
            for k in range(HASHES):
                got = word[(hashes >> np.uint64(24 * k)) & size]
                out = got if out is None else out & got
            yield out

    def predict(self, text: str | None) -> tuple[str, float]:
        h = grams(letters(text)) if text else np.empty(0, np.uint64)
        if not len(h) or not self.names:
            return "und", 0.0
        found = np.array([np.count_nonzero(m & m.dtype.type(1 << b)) for w, m in enumerate(self.masks(h)) for b in range(min(64, len(self.names) - 64 * w))]) / len(h)
        true = np.clip((found - self.false_rate) / (1 - self.false_rate), 0, 1)
        best = int(np.argmax(true))
        return self.names[best], float(true[best])


def fit(rows: Iterable[tuple[str, str]], least: int = LEAST_TEXTS, slots: int = SLOTS) -> Filters:
    """Filters from (text, language) rows."""
    seen: dict[str, Counter] = {}
    texts: Counter = Counter()
    for text, lang in rows:
        seen.setdefault(lang, Counter()).update(np.unique(grams(letters(text))).tolist())
        texts[lang] += 1
    names = sorted(seen)
    kind = np.uint8 if len(names) <= 8 else np.uint64
    table = [np.zeros(slots, kind) for _ in range(0, len(names), 64)]
    for b, name in enumerate(names):
        enough = min(least, max(1, texts[name] // TEXTS_A_STEP), max(seen[name].values(), default=1))
        own = np.array([h for h, c in seen[name].items() if c >= enough], np.uint64)
        for k in range(HASHES):
            table[b // 64][(own >> np.uint64(24 * k)) & np.uint64(slots - 1)] |= kind(1 << b % 64)
    fill = np.array([np.count_nonzero(table[b // 64] & kind(1 << b % 64)) / slots for b in range(len(names))])
    return Filters(names, table, fill**HASHES)


def held_out(id_col: str = "doc_id") -> Column:
    """Whether the CRC-32 of the id, as text, leaves 2 when divided by 4."""
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def training_sample(docs: DataFrame, allowed: Column, per_language: int = SAMPLE, text_col: str = "text", lang_col: str = "lang") -> list[tuple[str, str]]:
    """Up to per_language rows of each language, in hash order."""
    rows = docs.filter(allowed & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    # rows below a hash bound that lets about 1.5 times as many through, then the smallest of those
    rows = rows.withColumn("h", F.xxhash64("text"))
    bounds = rows.groupBy("lang").agg((1.5 * (per_language + 50) / F.approx_count_distinct("h", 0.02)).alias("bound"))
    few = rows.join(F.broadcast(bounds), "lang").filter(F.pmod("h", F.lit(1 << 30)) < F.col("bound") * (1 << 30))
    few = few.groupBy("lang", "h").agg(F.first("text").alias("text"))  # copies count once
    few = few.withColumn("n", F.row_number().over(W.partitionBy("lang").orderBy("h", "text"))).filter(F.col("n") <= per_language)
    return sorted((r["text"], r["lang"]) for r in few.select("text", "lang").collect())


def predictor(spark, filters: Filters):
    """A column function from a text to struct<lang_pred, score>."""
    sent = spark.sparkContext.broadcast(filters)

    @F.pandas_udf("lang_pred string, score double")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            yield pd.DataFrame([sent.value.predict(t) for t in texts], columns=["lang_pred", "score"])

    return predict


def identify(docs: DataFrame, allowed: Column, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """docs with lang_pred and score, which replace columns of these names."""
    predict = predictor(docs.sparkSession, fit(training_sample(docs, allowed, text_col=text_col, lang_col=lang_col)))
    keep = [c for c in docs.columns if c not in ("lang_pred", "score")]
    return docs.select(*keep, predict(F.col(text_col)).alias("__lang")).select(*keep, "__lang.*")
