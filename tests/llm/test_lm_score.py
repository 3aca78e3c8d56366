"""The language models of op9 against one table of all their bigrams."""

import math
import random
import re

import numpy as np
import pytest

from quire.llm import lm_score
from quire.llm.lm_score import cross_entropy_difference, log_probabilities, pack, unpack

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_force(rows):
    texts = [(re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOWER)), bool(mark)) for t, mark in rows]
    ids = {w: i for i, w in enumerate(sorted({w for ws, _ in texts for w in ws}))}
    counts = np.zeros((2, len(ids) + 1, len(ids)))
    codes = [[(ids.get(a, len(ids)), ids[b]) for a, b in zip([None, *ws], ws)] for ws, _ in texts]
    for found, (_, mark) in zip(codes, texts):
        for a, b in found:
            counts[0, a, b] += 1
            counts[1, a, b] += mark
    usual, wanted = map(log_probabilities, counts)
    return [
        (len(c), *(-math.fsum(m[a, b] for a, b in c) / len(c) for m in (wanted, usual))) if c else (0, None, None)
        for c in codes
    ]


def corpus(words, texts, marked):
    """Zipfian texts, with copies, empty texts and odd characters."""
    rng = random.Random(4)
    names = [f"{'Wé'[i % 2]}{i}\x1c\x00"[: 5 + i % 3] for i in range(words)]
    weights = [1 / (i + 1) for i in range(words)]
    rows = []
    for i in range(texts):
        sep = rng.choice([" ", "\n\t", " \x0b"])
        rows.append((sep.join(rng.choices(names, weights, k=rng.randrange(1, 60))), marked(i)))
    return rows + rows[:9] + [(None, True), ("", None), (" \n", False), ("ONE", None), ("one", True)]


@pytest.mark.parametrize("chunk_bytes, group_tokens, hot", [(1 << 23, 1 << 22, 64), (700, 300, 2)])
@pytest.mark.parametrize("marked", [lambda i: [True, False, None][i % 3], lambda i: i == 5])
def test_equals_one_table_of_all_words(spark, monkeypatch, chunk_bytes, group_tokens, hot, marked):
    monkeypatch.setattr(lm_score, "CHUNK_BYTES", chunk_bytes)
    monkeypatch.setattr(lm_score, "GROUP_TOKENS", group_tokens)
    monkeypatch.setattr(lm_score, "HOT", hot)
    rows = corpus(1500, 260, marked)
    docs = spark.createDataFrame([(i, *r, "x") for i, r in enumerate(rows)], "id long, text string, good boolean, _TEXT_sha256 string")
    out = cross_entropy_difference(docs.repartition(3), "good")
    assert out.columns == ["id", "text", "good", "_TEXT_sha256", "n_tokens", "ce_target", "ce_background", "score"]
    found = {r["id"]: r for r in out.collect()}
    assert len(found) == len(rows)
    for i, (n, wanted, usual) in enumerate(brute_force(rows)):
        r = found[i]
        assert r["n_tokens"] == n and r["text"] == rows[i][0]
        if n:
            assert r["ce_target"] == pytest.approx(wanted, abs=1e-9) and r["ce_background"] == pytest.approx(usual, abs=1e-9)
            assert r["score"] == pytest.approx(wanted - usual, abs=1e-9)
        else:
            assert r["ce_target"] is r["ce_background"] is r["score"] is None


def test_rare_words_of_one_ending_have_their_own_figures(spark):
    common = " ".join(f"c{i}" for i in range(1000))
    rows = [(i, common, False) for i in range(3)] + [(10, "x first-end y", True), (11, "x first-end y", False), (12, "x other-end y", False)]
    out = {r["id"]: r for r in cross_entropy_difference(spark.createDataFrame(rows, "id long, text string, good boolean"), "good").collect()}
    assert out[10]["score"] == out[11]["score"] < out[12]["score"]


def test_no_target_and_clashing_columns(spark):
    docs = spark.createDataFrame([(1, "a b a", "y"), (1, "a b a", "y"), (None, "c", None)], "id long, text string, SCORE string").selectExpr("*", "false as good")
    out = cross_entropy_difference(docs, "good")
    assert out.columns == ["id", "text", "good", "n_tokens", "ce_target", "ce_background", "score"]
    rows = out.collect()
    assert len(rows) == 3 and all(r["ce_target"] == pytest.approx(math.log(3)) for r in rows)
    assert cross_entropy_difference(docs.limit(0), "good").collect() == []


@pytest.mark.parametrize("numbers", [[], [0], [255, 0], [256], [1 << 16, 3], [1 << 40, 1 << 62]])
def test_packed_numbers(numbers):
    assert unpack(pack(np.array(numbers, dtype=np.int64))).tolist() == numbers
