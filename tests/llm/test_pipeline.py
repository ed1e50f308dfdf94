"""Every stage of the pipeline against brute force, on what the stage before it kept."""

from __future__ import annotations

import collections

import numpy as np

import corpus_pipeline
from plumbline.llm import language, packing, secrets
from tests_llm_helpers import brute_components, python_spans

SF = "/root/testdata/sf0.001"


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    items = [r["text"] for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    stages = dict(corpus_pipeline.STAGES)
    before = {r["doc_id"]: r for r in docs.collect()}

    d = corpus_pipeline.materialize(stages["language"](spark, docs, SF))
    filters = language.fit(language.training_sample(docs, ~language.held_out()))
    guess = {i: filters.predict(r["text"]) for i, r in before.items()}
    now = {r["doc_id"]: r for r in d.collect()}
    assert set(now) == {i for i, (lang, score) in guess.items() if lang != "und" and score >= corpus_pipeline.LEAST_LANGUAGE}
    assert all(now[i] == before[i] for i in now)

    groups = brute_components({i: r["text"] for i, r in now.items()})
    d = corpus_pipeline.materialize(stages["near duplicates"](spark, d, SF))
    assert {r["doc_id"] for r in d.collect()} == {i for i, (_, root) in groups.items() if root == i}

    whole = {r["doc_id"] for r in d.collect() if any(x in r["text"] for x in items)}
    had = {r["doc_id"] for r in d.collect()}
    d = corpus_pipeline.materialize(stages["benchmark leaks"](spark, d, SF))
    kept = {r["doc_id"]: r for r in d.collect()}
    assert whole <= had - set(kept) and len(had - set(kept)) <= len(whole) + 1

    d = corpus_pipeline.materialize(stages["secrets"](spark, d, SF))
    clean = {r["doc_id"]: r for r in d.collect()}
    assert set(clean) == set(kept)
    for i, r in clean.items():
        out, at = "", 0
        for lo, hi in python_spans(kept[i]["text"]):
            if lo >= at:
                out += kept[i]["text"][at:lo] + "[SECRET]"
            at = max(at, hi)
        out += kept[i]["text"][at:]
        assert r["text"] == out and r["n_chars"] == len(out) and r["source"] == kept[i]["source"]

    rows = corpus_pipeline.packing_stage(spark, d, SF).collect()
    pieces = collections.defaultdict(list)
    for r in rows:
        pieces[r["doc_id"]].append((r["piece"], r["start"], r["length"], bytes(r["ids"])))
    decode = packing.encoding().decode
    for i, r in clean.items():
        own = sorted(pieces[i])
        ids = np.frombuffer(b"".join(p[3] for p in own), "<u4").tolist()
        assert ids[-1] == 2 and decode(ids[:-1]) == r["text"]
        assert [p[1] for p in own] == [0, *np.cumsum([p[2] for p in own])[:-1]]
    assert secrets.RULE_VERSION
