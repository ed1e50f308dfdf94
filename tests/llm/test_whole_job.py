"""Cases that a cut in an operator would lose."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from plumbline.llm import decontamination, jaccard, language, quality
from tests_llm_helpers import brute_components


@pytest.mark.parametrize("lang", sorted(quality.COMMON))
def test_texts_without_common_words_are_rejected(spark, lang):
    rng = random.Random(7)
    common = quality.COMMON[lang].split()
    # 21.6 % common words, the least share of a reference over the given documents
    texts = [" ".join(rng.choice(common) if rng.random() < 0.216 else f"zor{rng.randrange(9000)}x" for _ in range(200)) for _ in range(60)]
    bare = " ".join(f"zor{i}x" for i in range(200))
    d = spark.createDataFrame([(i, t, lang) for i, t in enumerate([*texts, bare])], "doc_id long, text string, lang string")
    kept = {r["doc_id"]: r["kept"] for r in quality.judge_quality(d).collect()}
    assert not kept.pop(60) and all(kept.values())


def leaks(spark, items, texts):
    """(text, item, kind) of every leak, by place in the lists."""
    b = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = sorted((r["doc_id"], r["item_id"], r["kind"]) for r in decontamination.find_leaks(d, b).collect())
    kept = {r["doc_id"] for r in decontamination.drop_leaks(d, b).collect()}
    assert kept == set(range(len(texts))) - {x for x, _, _ in found}
    return found


def test_verbatim_items_of_numbers_names_and_few_words(spark):
    items = [
        "What comes next in the series 1, 1, 2, 3, 5, 8, 13, 21, 34, 55, 89, 144?",
        "Name the odd one out: Paris, London, Madrid, Rome, Berlin, Vienna, Boston, Prague, Dublin",
        "11 12 13 14 15 16 17 18 19 20 21 22 23 24",
        "Who painted Guernica?",
    ]
    texts = [f"Some words before. {x} And some after." for x in items]
    assert leaks(spark, items, [*texts, "11 12 13 14 15 16 17 18 19 20 22 22 23 24. Who painted it?"]) == [(i, i, "verbatim") for i in range(4)]


def test_items_in_another_case_or_place_or_renamed_at_a_start(spark):
    items = [
        "Tom has 5 apples. Anna has 3 apples. How many apples do they have together now?",
        "Élise wrote to Berlin and Boston about the river",
        "Where does the old river meet the sea",
    ]
    texts = [
        "Max has 7 apples. Lena has 4 apples. How many apples do they have together now?",
        "ÉLISE WROTE TO BERLIN AND BOSTON ABOUT THE RIVER",
        "élise wrote to berlin and boston about the river",
        "question Where does the old river meet the sea",
        "tom has 9 apples. anna has 4 apples. how many apples do they have together now?",
        "Max has 7 apples. Max has 4 apples. How many apples do they have together now?",
    ]
    want = [(0, 0, "reparameterised"), (1, 1, "verbatim"), (2, 1, "verbatim"), (3, 2, "verbatim"), (4, 0, "reparameterised")]
    assert leaks(spark, items, texts) == want


def test_every_label_is_learned(spark):
    rows = [(100 * k + i, " ".join(chr(0x4E00 + 20 * k + (i + j) % 20) * 3 for j in range(30)), f"l{k:03}") for k in range(140) for i in range(2)]
    d = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert all(r["lang_pred"] == r["lang"] and r["score"] > 0.9 for r in language.identify(d, F.lit(True)).collect())


def test_copies_do_not_thin_the_training_sample(spark):
    text = F.concat(F.lit("some text with number "), F.col("t").cast("string"))
    d = spark.range(20_000).withColumn("t", F.col("id") % 500).select(F.col("id").alias("doc_id"), text.alias("text"), F.lit("en").alias("lang"))
    assert len(language.training_sample(d, F.lit(True))) == 500


@pytest.mark.parametrize("n", [1, 2, 3, 4, 9, 30])
def test_few_training_texts_know_their_language(spark, n):
    rng = random.Random(1)
    words = ["".join(rng.choice("aeioubdklmnrst") for _ in range(rng.randint(2, 5))) for _ in range(60)]
    texts = [" ".join(rng.choice(words) for _ in range(70)) for _ in range(n + 20)]
    filters = language.fit([(t, "x") for t in texts[:n]])
    assert all(filters.predict(t)[1] >= 0.5 for t in texts[n:])


def test_duplicates_go_by_row(spark):
    rng = random.Random(11)
    base = [[f"w{rng.randrange(300)}" for _ in range(rng.randint(1, 60))] for _ in range(6)]
    rows = [(None, "a text without an id stands here"), (None, ""), (9, ""), (9, ""), (1, None)]
    for _ in range(120):
        words = list(rng.choice(base))
        for _ in range(rng.randint(0, 3)):
            words[rng.randrange(len(words))] = f"w{rng.randrange(300)}"
        rows.append((rng.choice([None, *range(20)]), " ".join(words)))
    rows += rows[::7]
    d = spark.createDataFrame([(i, t, k % 3) for k, (i, t) in enumerate(rows)], "doc_id long, text string, row int").repartition(3)
    got = [(r["doc_id"], r["text"]) for r in jaccard.without_duplicates(d).collect()]
    # brute force over distinct rows under numbers of their own
    each = sorted(set((i, t or "") for i, t in rows), key=str)
    groups = brute_components({k: t for k, (_, t) in enumerate(each)})
    of = {r: groups[k][1] for k, r in enumerate(each)}
    kept = [(i, t or "") for i, t in got]
    assert len(kept) == len(set(kept)) and sorted(of[r] for r in kept) == sorted(set(of.values()))
    for i, t in kept:
        ids = [x for x, y in each if of[x, y] == of[i, t]]
        assert i == min((x for x in ids if x is not None), default=None)


def test_duplicates_of_the_verdict(spark):
    a, b, c = (" ".join(f"{x}{i}" for i in range(30)) for x in "abc")
    d = spark.createDataFrame([(3, a), (7, a), (7, b), (9, c), (9, c)], "doc_id long, text string")
    assert sorted(map(tuple, jaccard.without_duplicates(d).collect())) == [(3, a), (7, b), (9, c)]


def test_fragments_hold_equal_shares():
    import numpy as np

    rng = np.random.default_rng(1)
    sizes = rng.choice([1, 2, 3, 6, 12, 40, 300, 5000], 4000)
    edges = jaccard.fragment_edges([(int(n), int(k)) for n, k in zip(*np.unique(sizes, return_counts=True), strict=True)], 200)
    hashes = np.concatenate([np.sort(rng.random(n))[: jaccard.prefix_length(int(n))] for n in sizes])
    rows = np.bincount(np.searchsorted(edges, hashes, "right"), minlength=200)
    assert rows.max() <= 1.6 * rows.mean()


def test_names_beyond_ascii(spark):
    items = ["Gestern gab Émile seinem Freund Örjan genau 14 rote Kugeln und 3 blaue dazu"]
    texts = ["Gestern gab Ängela seinem Freund Ümit genau 20 rote Kugeln und 5 blaue dazu", "Gestern gab Max seinem Freund Max genau 20 rote Kugeln und 5 blaue dazu"]
    assert leaks(spark, items, texts) == [(0, 0, "reparameterised")]


NAMES = "Tom Anna Max Lena Omar Priya Élise Jürgen Óscar Ivan".split()
TEMPLATES = [
    "{a} buys {n} apples for {m} dollars at the local market",
    "A train leaves {a} at {n} and reaches {b} after {m} hours without a stop on the way",
    "If {a} has {n} marbles and gives {m} of them to {b} how many marbles are left",
    "{a} runs {n} km every day while {b} runs {m} km so who runs further in a week",
    "There are {n} boys and {m} girls in the class of teacher {a} on this sunny day",
]


def test_recall_of_reparameterised_items(spark):
    rng = random.Random(3)

    def fill(t, a, b):
        n, m = rng.sample(range(2, 99), 2)
        return t.format(a=a, b=b, n=n, m=m)

    items = [fill(t, "Paula", "Quentin") for t in TEMPLATES]
    cases = [(k, fill(t, *rng.sample(NAMES, 2))) for k, t in enumerate(TEMPLATES) for _ in range(40)]
    before, after = ("Some words stand here first.", "question", ""), ("And more follow.", "")
    texts = [f"{rng.choice(before)} {x} {rng.choice(after)}" for _, x in cases]
    found = {(d, i) for d, i, _ in leaks(spark, items, texts)}
    assert sum((d, k) in found for d, (k, _) in enumerate(cases)) >= 0.9 * len(cases) == 180
    assert all(i == cases[d][0] for d, i in found)


def test_slots_against_brute_force(spark):
    rng = random.Random(5)
    item = "Ann gave {0} pears to Bob and {1} plums to Cid so that Ann had {2} left and Bob had {3} more than Cid in the end"
    values = [(3, 5, 3, 7), (3, 5, 4, 7), (2, 2, 2, 2)]
    items = [item.format(*v) for v in values]
    docs = [tuple(rng.choice([1, 2, 3, 5]) for _ in range(4)) for _ in range(60)]
    found = {(d, i): kind for d, i, kind in leaks(spark, items, [item.format(*v) for v in docs])}
    for i, want in enumerate(values):
        for d, own in enumerate(docs):
            pairs = set(zip(want, own, strict=True))
            one_to_one = len({a for a, _ in pairs}) == len(pairs) == len({b for _, b in pairs})
            assert found.get((d, i)) == (None if not one_to_one and found.get((d, i)) is None else "verbatim" if want == own or not one_to_one else "reparameterised")
            assert not one_to_one or (d, i) in found


def test_predictions_against_brute_force(spark):
    rng = random.Random(9)
    alphabets = ["".join(chr(0x4E00 + 13 * k + j) for j in range(13)) for k in range(130)]

    def text(k):
        return " ".join("".join(rng.choice(alphabets[k]) for _ in range(rng.randint(1, 6))) for _ in range(40))

    train = [(text(k), f"l{k:03}") for k in range(130) for _ in range(3)]
    tests = [text(rng.randrange(130)) + " " + text(rng.randrange(130)) for _ in range(60)]
    filters = language.fit(train, slots=1 << 22)
    known = {}
    for t, lang in train:
        known.setdefault(lang, set()).update(language.grams(language.letters(t)).tolist())
    for t in tests:
        g = language.grams(language.letters(t)).tolist()
        share = {lang: sum(h in own for h in g) / len(g) for lang, own in known.items()}
        lang, score = filters.predict(t)
        assert share[lang] >= max(share.values()) - 0.01 and abs(score - share[lang]) <= 0.01


def test_common_words_of_other_languages(spark, tmp_path):
    import duckdb

    from plumbline.llm import oracles, queries

    rng = random.Random(8)
    common = [f"q{c}" for c in "abcdefghijklmnop"]
    texts = [" ".join(rng.choice(common) if rng.random() < 0.4 else f"zor{rng.randrange(9000)}x" for _ in range(120)) for _ in range(50)]
    bare = " ".join(f"zor{i}x" for i in range(120))
    rows = [(i, t, "tlh") for i, t in enumerate([*texts, bare])] + [(100 + i, t, None) for i, t in enumerate([*texts[:40], bare])] + [(200, "few", "xx"), (201, None, "yy")]
    d = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    kept = {r["doc_id"]: r["kept"] for r in quality.judge_quality(d).collect()}
    assert [i for i, k in kept.items() if not k] == [50, 200, 201]
    d.coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    duck = duckdb.connect()
    duck.sql(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    want = duck.sql(f"SELECT doc_id, kept, js_common FROM ({oracles.quality_sql()}) ORDER BY 1").fetchall()
    assert want == [tuple(r) for r in queries.op2_divergence_rules(spark, str(tmp_path)).select("doc_id", "kept", "js_common").orderBy("doc_id").collect()]


def test_fragment_pairs_has_no_row_for_a_class_without_a_pair(spark):
    """Rows of a class in every fragment grew with the number of fragments, whether or not it had a partner."""
    import numpy as np

    short = " ".join(f"w{i}" for i in range(60))
    rows = spark.createDataFrame([(short,), (short + " " + " ".join(f"x{i}" for i in range(300)),)], "__text string")
    for fragments in (2, 40):
        edges = np.arange(1, fragments) / fragments
        assert jaccard._fragment_pairs(jaccard._prefixes(rows, [], 0, edges), fragments).count() == 0


def test_large_groups_count_what_small_ones_share(spark, monkeypatch):
    """Classes that meet in a large group may link by what they share in small ones."""
    monkeypatch.setattr(jaccard, "GROUP", 2)
    monkeypatch.setattr(jaccard, "LEADERS", 1)
    common = " ".join(f"c{i}" for i in range(12))
    texts = [f"{common} " + " ".join(f"g{g}w{i}" for i in range(40 + 2 * v)) for g in range(6) for v in range(2)]
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.similar_components(d).collect()}
    assert got == brute_components(dict(enumerate(texts)))
    assert {c for _, c in got.values()} == {0, 2, 4, 6, 8, 10}
