"""Quality rules: counts, repetition, and divergence from the language's own histograms.

Built-in functions only, and no shuffle of texts: counts and histograms are made
in the row.  Two histograms describe a text: its characters that aren't white space by class
(lower case, upper case, digits, symbols, punctuation, other), and its words as
the common words of its language and the rest.  The sums of both over all
documents of a language that pass the base rules are the language's references.
A text is rejected if the Jensen-Shannon distance (base 2, so from 0 to 1) of
either histogram from its reference exceeds a limit.  Short texts vary by chance: a histogram
is compared only with ``MIN_CHARS`` characters or ``MIN_WORDS`` words, and only
against a reference made from ``MIN_REFERENCE`` texts at least.  Common words are
a fixed list for four languages; for any other language they are the ``LISTED`` words
that most of its texts of ten words or more hold, by count and then word.  Documents
without a language are compared by characters alone, as they have no common words.

Words are runs of anything but U+0020 and U+0009 to U+000D.  Repetition counts
words inside five-word windows that occur twice or more in the text, by 64-bit
hash.  Null texts are empty and fail the base rules; a null language is a
language of its own.  Repeated rows and null ids are judged row by row.  An empty
table gives no rows.  Columns other than id, text and language aren't read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from plumbline.llm._shared import materialize, text_of

WHITE = " \t\n\x0b\x0c\r"
WINDOW = 5
MIN_WORDS, MIN_CHARS, MIN_REFERENCE = 60, 200, 30
# a text without a common word is at 0.34 from a reference with 21 % of them, the least of the four languages
MOST_CLASSES, MOST_COMMON = 0.33, 0.3
#: languages whose references are sent to every task; with more they are joined by shuffle
BROADCAST_LANGUAGES = 10_000
LISTED = 16
#: stands in lists of fewer words; no word holds a space
_NONE = " "
# fixed values: frequent function words of each language
COMMON = {
    "de": "der die das und ist nicht ein eine zu den von mit sich auf für im",
    "en": "the of and to in a is that it for on with as was be by",
    "es": "el la de que y en un los del se las por con para una es",
    "fr": "le la de et les des un une que en du est dans pour qui sur",
}
_CLASSES = {"lower": r"\p{Ll}", "upper": r"\p{Lu}", "digit": r"\p{Nd}", "symbol": "[#*$%&|<>]", "mark": r"[.,;:!?'\"()-]"}


def _share_of(counts: Column, total: Column) -> Column:
    return F.transform(counts, lambda x: x / total)


def js_distance(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance, base 2, of two arrays of shares."""

    def part(x: Column, m: Column) -> Column:
        return F.when(x > 0, x * F.log2(x / m)).otherwise(F.lit(0.0))

    terms = F.zip_with(p, q, lambda x, y: part(x, (x + y) / 2) + part(y, (x + y) / 2))
    return F.sqrt(F.greatest(F.lit(0.0), F.aggregate(terms, F.lit(0.0), lambda a, x: a + x) / 2))


def _words(text: Column) -> Column:
    bare = F.btrim(text, F.lit(WHITE))
    return F.when(bare == "", F.expr("cast(array() as array<string>)")).otherwise(F.split(bare, "[\\x20\\x09-\\x0D]+", -1))


def _stripped(words: Column) -> Column:
    """Words in lower case without marks at their end."""
    return F.transform(words, lambda w: F.rtrim(F.lower(w), F.lit(".,;:!?")))


def own_lists(docs: DataFrame, text_col: str, lang_col: str) -> DataFrame | None:
    """language, words: the most common words of every language without a fixed list; None without such a language."""
    other = docs.filter(F.col(lang_col).isNotNull() & ~F.col(lang_col).isin(*COMMON))
    if other.select(lang_col).limit(1).isEmpty():
        return None
    words = other.select(F.col(lang_col).alias("__name"), _words(text_of(text_col)).alias("w")).filter(F.size("w") >= 10)
    seen = words.select("__name", F.explode(F.array_distinct(_stripped(F.col("w")))).alias("w")).groupBy("__name", "w").agg(F.count(F.lit(1)).alias("n"))
    top = seen.withColumn("k", F.row_number().over(W.partitionBy("__name").orderBy(F.desc("n"), "w"))).filter(F.col("k") <= LISTED)
    lists = top.groupBy("__name").agg(F.transform(F.array_sort(F.collect_list(F.struct("k", "w"))), lambda x: x["w"]).alias("__list"))
    lists = materialize(lists.withColumn("__list", F.slice(F.concat("__list", F.array_repeat(F.lit(_NONE), LISTED)), 1, LISTED)))
    return F.broadcast(lists) if lists.count() <= BROADCAST_LANGUAGES else lists


def measures(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """docs without the text, with ``__words`` and so on: counts and histograms."""
    keep = [c for c in docs.columns if c != text_col]
    lists = own_lists(docs, text_col, lang_col)
    d = docs.select(*keep, text_of(text_col).alias("__text"))
    d = d.withColumn("__w", _words(F.col("__text")))
    d = d.withColumn("__list", F.expr("cast(null as array<string>)")) if lists is None else d.join(lists, F.col(lang_col) == F.col("__name"), "left")
    letters = F.array_join("__w", "")
    without = {k: F.length(letters) - F.length(F.regexp_replace(letters, f"(?:{p})+", "")) for k, p in _CLASSES.items()}
    lines = F.filter(F.split("__text", "\n", -1), lambda x: F.rlike(x, F.lit("[^\\x20\\x09-\\x0D]")))
    lang = F.col(lang_col)
    common, found = F.col("__list"), F.when(F.col("__list").isNotNull(), _stripped(F.col("__w")))
    for name, words in COMMON.items():
        common = F.when(lang == name, F.array(*[F.lit(w) for w in words.split()])).otherwise(common)
        pattern = r"(?<![^\s])(?:" + "|".join(words.split()) + r")(?=[.,;:!?]*(?:\s|$))"
        found = F.when(lang == name, F.regexp_extract_all(F.lower("__text"), F.lit(pattern), F.lit(0))).otherwise(found)
    d = d.select(
        *keep,
        F.size("__w").cast("long").alias("__n"),
        F.length(letters).cast("long").alias("__chars"),
        *[without[k].cast("long").alias(f"__{k}") for k in _CLASSES],
        lines.alias("__lines"),
        F.transform("__w", lambda x: F.xxhash64(x)).alias("__h"),
        common.alias("__common"),
        found.alias("__found"),
    )
    # each array stands in a column of its own, so that lambdas read it and don't make it anew
    keys = F.when(F.col("__n") >= WINDOW, F.transform(F.sequence(F.lit(0), F.col("__n").cast("int") - WINDOW), lambda i: F.xxhash64(*[F.get("__h", i + j) for j in range(WINDOW)])))
    d = d.withColumn("__keys", keys)
    d = d.withColumn("__again", F.coalesce(F.size(F.array_distinct("__keys")) < F.size("__keys"), F.lit(False)))
    d = d.withColumn("__sorted", F.when(F.col("__again"), F.array_sort(F.transform("__keys", lambda k, i: F.struct(k.alias("k"), i.alias("i"))))))
    hits = F.filter("__sorted", lambda e, j: F.coalesce(F.get("__sorted", j - 1)["k"] == e["k"], F.lit(False)) | F.coalesce(F.get("__sorted", j + 1)["k"] == e["k"], F.lit(False)))
    places = F.array_sort(F.transform(hits, lambda e: e["i"]))
    covered = F.aggregate(
        places,
        F.struct(F.lit(0).alias("n"), F.lit(-WINDOW).alias("last")),
        lambda a, p: F.struct((a["n"] + F.least(F.lit(WINDOW), p - a["last"])).alias("n"), p.alias("last")),
        lambda a: a["n"],
    )
    marks = F.array(*[F.col(f"__{k}") for k in _CLASSES])
    return d.select(
        *keep,
        F.col("__n").alias("n_words"),
        F.col("__chars").alias("word_chars"),
        F.col("__symbol").alias("n_symbols"),
        (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"),
        F.concat(marks, F.array(F.col("__chars") - sum((F.col(f"__{k}") for k in _CLASSES), F.lit(0)))).alias("__classes"),
        F.transform("__common", lambda w: F.size(F.filter("__found", lambda x: x == w)).cast("long")).alias("__common"),
    ).withColumn("__common", F.concat("__common", F.array(F.greatest(F.lit(0), F.col("n_words") - F.aggregate("__common", F.lit(0).cast("long"), lambda a, x: a + x)))))


def judge_quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """id, the base counts, base_failed, js_classes and js_common (null where not compared), kept."""
    rows = measures(docs.select(F.col(id_col), F.col(text_col), F.col(lang_col).alias("__lang")), text_col, "__lang")
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    rows = materialize(rows.withColumn("base_failed", failed).withColumn("__lang", F.coalesce(F.concat(F.lit("s"), "__lang"), F.lit(""))))
    n_classes, n_common = len(_CLASSES) + 1, len(COMMON["en"].split()) + 1
    sums = [F.sum(F.get("__classes", F.lit(i))).alias(f"c{i}") for i in range(n_classes)] + [F.sum(F.get("__common", F.lit(i))).alias(f"w{i}") for i in range(n_common)]
    means = rows.filter(~F.col("base_failed")).groupBy("__lang").agg(F.count(F.lit(1)).alias("__texts"), *sums)
    classes, words = F.array(*[f"c{i}" for i in range(n_classes)]), F.array(*[f"w{i}" for i in range(n_common)])

    def total(x: Column) -> Column:
        return F.aggregate(x, F.lit(0).cast("long"), lambda a, v: a + F.coalesce(v, F.lit(0).cast("long")))

    means = means.select("__lang", "__texts", classes.alias("__ref_classes"), F.when(F.col("w0").isNotNull(), words).alias("__ref_common"))
    means = means.select("__lang", "__texts", _share_of(F.col("__ref_classes"), total(F.col("__ref_classes"))).alias("__ref_classes"), _share_of(F.col("__ref_common"), total(F.col("__ref_common"))).alias("__ref_common"))
    if means.count() <= BROADCAST_LANGUAGES:
        means = F.broadcast(means)
    d = rows.join(means, "__lang", "left")
    known = F.coalesce(F.col("__texts") >= MIN_REFERENCE, F.lit(False))
    by_class = F.when(known & (F.col("word_chars") >= MIN_CHARS), js_distance(_share_of(F.col("__classes"), F.col("word_chars")), F.col("__ref_classes")))
    by_word = F.when(known & F.col("__common").isNotNull() & (F.col("n_words") >= MIN_WORDS), js_distance(_share_of(F.col("__common"), F.col("n_words")), F.col("__ref_common")))
    d = d.withColumns({"js_classes": by_class, "js_common": by_word})
    fine = F.coalesce(F.col("js_classes") <= MOST_CLASSES, F.lit(True)) & F.coalesce(F.col("js_common") <= MOST_COMMON, F.lit(True))
    return d.select(id_col, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "js_classes", "js_common", (~F.col("base_failed") & fine).alias("kept"))
