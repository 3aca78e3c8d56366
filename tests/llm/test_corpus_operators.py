"""Joins, models, formats and graphs against brute force."""

import numpy as np
import pytest
from conftest import SF0001

from quire.llm import ngram_join as join_module
from quire.llm.components import connected_components
from quire.llm.lm_score import SIZE, cross_entropy_difference, log_probabilities, with_target
from quire.llm.ngram_join import ngram_join
from quire.llm.preference import neighbours, preference_pairs, turns_of
from quire.llm.quality_classifier import quality_classifier
from quire.llm.url_filter import url_filter

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@pytest.fixture()
def frame(spark):
    """Rows (doc_id, text, ...) with columns whose names clash with outputs."""

    def make(rows, schema="doc_id long, text string, lang string, n_lines string, kept string"):
        return spark.createDataFrame([(*r, *("x",) * (5 - len(r))) for r in rows], schema)

    return make


def brute_components(rows, size, percent):
    import re

    sets = {}
    for i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOWER))
        sets[i] = {tuple(w[k : k + size]) for k in range(len(w) - size + 1)} if len(w) >= size else ({tuple(w)} if w else set())
    label = {i: i for i in sets}
    ids = sorted(sets)
    for a in ids:
        for b in ids:
            k = len(sets[a] & sets[b])
            if a < b and k and 100 * k >= percent * (len(sets[a]) + len(sets[b]) - k) and label[a] != label[b]:
                x, y = sorted((label[a], label[b]))
                label = {i: x if v == y else v for i, v in label.items()}
    return {i: (len(sets[i]), label[i]) for i in ids}


def near_copies(n, seed=5):
    rng = np.random.default_rng(seed)
    base = [f"w{i}" for i in rng.integers(0, 900, 120)]
    rows = []
    for i in range(n):
        words = list(base)
        for at in rng.integers(0, len(words), i % 7):
            words[at] = f"x{rng.integers(0, 10**6)}"
        rows.append((i, " ".join(words)))
    return rows


@pytest.mark.parametrize("tile", [10**6, 700])
def test_ngram_join(frame, monkeypatch, tile):
    monkeypatch.setattr(join_module, "TILE_SHINGLES", tile)
    odd = [None, "", " \n", "one", "ONE", "one two three", "One Two  three", "x " * 2000, "X " * 1500]
    rows = near_copies(40) + [(100 + i, t) for i, t in enumerate(odd)]
    got = ngram_join(frame(rows), size=4, percent=85).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == brute_components(rows, 4, 85)


def test_ngram_join_of_nothing_and_null_ids(frame):
    assert ngram_join(frame([])).count() == 0
    rows = ngram_join(frame([(None, "a b c d e f"), (4, "a b c d e f"), (4, "a b c d e f")])).collect()
    assert sorted((str(r["doc_id"]), str(r["component_id"])) for r in rows) == [("4", "4"), ("4", "4"), ("None", "None")]


def test_tree_prunes_nothing_that_links():
    rng = np.random.default_rng(3)
    base = rng.integers(0, 2**63, 200).astype(np.uint64)
    sets = [np.unique(np.where(rng.random(200) < 0.03, rng.integers(0, 2**63, 200).astype(np.uint64), base)) for _ in range(150)]
    links = join_module.tree_links(sets, np.arange(150), 85)
    label = list(range(150))
    for a, b in links:
        label = [label[a] if x == label[b] else x for x in label]
    for a in range(150):
        for b in range(a):
            k = len(np.intersect1d(sets[a], sets[b]))
            assert label[a] == label[b] or 100 * k < 85 * (len(sets[a]) + len(sets[b]) - k)


def test_connected_components(spark):
    edges = [(i, i + 1) for i in range(50, 90)] + [(5, 3), (3, 9), (9, 9), (2, 5)]
    got = {r["node"]: r["label"] for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 50 for i in range(51, 91)} | {3: 2, 5: 2, 9: 2}


def test_bigram_model_sums_to_one():
    counts = np.zeros((SIZE + 1, SIZE))
    counts[np.random.default_rng(2).integers(0, 50, 4000), np.random.default_rng(3).integers(0, 90, 4000)] += 1
    total = np.exp(log_probabilities(counts).astype(float)).sum(axis=1)
    assert np.allclose(total, 1, atol=1e-3)


def test_score_tells_target_like_texts(spark, frame):
    rows = [(i, ("red green blue " if i % 2 else "tic tac toe ") * 20) for i in range(40)] + [(90, None), (91, "")]
    labels = spark.createDataFrame([(i, i % 2) for i in range(30)] + [(1, None)], "doc_id long, quality int")
    docs = with_target(frame(rows), labels, "quality = 1")
    out = {r["doc_id"]: r for r in cross_entropy_difference(docs, "is_target").collect()}
    assert len(out) == 42 and out[90]["score"] is None and out[91]["n_tokens"] == 0
    assert all((out[i]["score"] < 0) == bool(i % 2) for i in range(40))
    assert cross_entropy_difference(docs.limit(0), "is_target").count() == 0


def test_classifier_on_held_out_labels(spark):
    docs = spark.read.parquet(f"{SF0001}/documents.parquet")
    labels = spark.read.parquet(f"{SF0001}/labels.parquet")
    out = quality_classifier(docs, labels.filter("doc_id % 2 = 0"), "source", "lang")
    held = out.join(labels.filter("doc_id % 2 = 1"), "doc_id").collect()
    assert sum(r["kept"] == bool(r["quality"]) for r in held[:]) >= 0.85 * len(held)
    assert out.count() == docs.count()


def test_sparse_sites_shrink(spark):
    docs = spark.createDataFrame([(i, "good words here " * 30, "a", None) for i in range(30)] + [(99, "!! ## $$ " * 30, None, "p")], "doc_id long, text string, source string, lang string")
    labels = spark.createDataFrame([(i, 1) for i in range(20)] + [(99, 0)], "doc_id long, quality int")
    rows = {r["doc_id"]: r for r in quality_classifier(docs, labels, "source", "lang").collect()}
    assert rows[0]["kept"] and rows[99]["log_odds"] < rows[0]["log_odds"]
    assert rows[99]["log_odds"] < 0 or rows[99]["host_posterior"] <= rows[0]["host_posterior"]
    assert quality_classifier(docs.limit(0), labels, "source", "lang").count() == 0
    assert {r["log_odds"] for r in quality_classifier(docs, labels.limit(0), "source", "lang").collect()} == {0.0}


def test_preference_pairs(spark):
    rows = [(0, 0, "user", "hi"), (0, 1, "assistant", "yes"), (1, 0, "user", "hi"), (1, 1, "assistant", "no"), (1, 2, "user", None)]
    rows += [(2, 0, "user", "same"), (3, 0, "user", "same"), (4, 0, None, "alone"), (None, 0, "user", "lost")]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    out = {r["pair_id"]: r for r in preference_pairs(neighbours(turns_of(table))).collect()}
    assert set(out) == {0, 1, 2}
    assert out[0]["prompt"] == "<|user|>\nhi<|end|>\n" and out[0]["n_prompt_turns"] == 1
    assert [tuple(x) for x in out[0]["chosen"]] == [("<|assistant|>\n", False), ("yes<|end|>\n", True)]
    assert [x["train"] for x in out[0]["rejected"]] == [False, True, False, False]
    assert out[1]["chosen"] == out[1]["rejected"] == [] and out[1]["n_prompt_turns"] == 1
    assert out[2]["prompt"] == "" and out[2]["rejected"] == [] and len(out[2]["chosen"]) == 2
    assert preference_pairs(neighbours(turns_of(table.limit(0)))).count() == 0


def test_url_rules_and_links(spark):
    link = lambda *hosts: "".join(f'<a href="https://{h}/x">' for h in hosts)
    rows = [
        (1, "https://Good.org/a?b", link("friend.net")), (2, "http://example.org/es/1", ""), (3, "http://a.example.org/en/12", None),
        (4, "http://example.org/en/2", ""), (5, "https://spam.com/de/x#y", ""), (6, "https://friend.net/", ""), (7, "https://farm.net/", link("spam.com")),
        (8, None, ""), (9, "no scheme", ""), (10, "http://x.com/fr", ""), (11, "http://x.com/fr/a://b", ""), (7, "https://farm.net/", link("spam.com")),
    ]
    from quire.llm.queries import RULES

    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    out = {r["page_id"]: r for r in url_filter(pages, RULES).collect()}
    assert [out[i]["rule"] for i in range(1, 12)] == ["org/", "example.org/es/", "example.org/en/1", "org/", "com/de/", None, None, None, None, None, "com/fr/"]
    assert out[1]["host"] == "good.org" and out[1]["path"] == "/a" and out[8]["host"] == out[9]["path"] == ""
    assert out[6]["trust"] > 0 and out[6]["verdict"] == "allow" and out[7]["verdict"] == "block" and out[7]["distrust"] > 0
    assert url_filter(pages.limit(0), RULES).count() == 0


def test_pipeline(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF0001}/documents.parquet")
    out = corpus_pipeline.run(spark, SF0001).collect()
    assert 0 < len(out) < docs.count() and all(r["round_trip"] for r in out)
