"""Preference pairs that share a prompt, and link ranks against brute force."""

import random

import numpy as np
from conftest import SF0001

from quire.llm.preference import other_answers, preference_pairs, turns_of
from quire.llm.queries import op5_preference
from quire.llm.url_filter import host_links, personalised_rank


def brute_pair(chosen, rejected):
    k = 0
    while k < min(len(chosen), len(rejected)) and chosen[k] == rejected[k]:
        k += 1
    prompt = "".join(f"<|{r}|>\n{t}<|end|>\n" for r, t in chosen[:k])
    rest = [[x for r, t in side[k:] for x in ((f"<|{r}|>\n", False), (f"{t}<|end|>\n", r == "assistant"))] for side in (chosen, rejected)]
    return k, prompt, *rest


def test_pairs_equal_brute_force_and_share_a_prompt(spark):
    rows = {}
    table = spark.read.parquet(f"{SF0001}/conversations.parquet")
    for r in table.collect():
        rows.setdefault(r["conv_id"], []).append((r["turn"], r["role"] or "", r["text"] or ""))
    turns = {c: [x[1:] for x in sorted(v)] for c, v in rows.items()}
    out = {r["pair_id"]: r for r in op5_preference(spark, SF0001).collect()}
    assert out.keys() == turns.keys()
    for c, chosen in turns.items():
        answers = [t for r, t in turns.get(c ^ 1, []) if r == "assistant"]
        last = max((i for i, (r, _) in enumerate(chosen) if r == "assistant"), default=None)
        rejected = [] if last is None or not answers else [*chosen[:last], ("assistant", answers[-1]), *chosen[last + 1 :]]
        got = out[c]
        assert (got["n_prompt_turns"], got["prompt"], [tuple(x) for x in got["chosen"]], [tuple(x) for x in got["rejected"]]) == brute_pair(chosen, rejected)
    assert sum(r["n_prompt_turns"] > 0 for r in out.values()) > len(out) / 2


def test_pairs_of_odd_tables(spark):
    schema = "conv_id long, turn long, role string, text string, prompt string, _answer string"
    rows = [(0, 0, "user", "a", "x", "y"), (0, 1, "assistant", None, "x", "y"), (1, 0, "user", "b", "x", "y"), (5, 0, None, "c", "x", "y")]
    pairs = other_answers(turns_of(spark.createDataFrame(rows, schema)))
    got = {r["pair_id"]: (r["n_prompt_turns"], len(r["chosen"]), len(r["rejected"])) for r in preference_pairs(pairs).collect()}
    assert got == {0: (0, 4, 0), 1: (0, 2, 0), 5: (0, 2, 0)}
    assert preference_pairs(other_answers(turns_of(spark.createDataFrame([], schema)))).collect() == []


def test_rank_equals_brute_force(spark):
    r = random.Random(4)
    n = 12
    edges = {(r.randrange(n), r.randrange(n)): r.randrange(1, 4) for _ in range(25)}
    edges = {k: v for k, v in edges.items() if k[0] != k[1]}
    seeds = {0: 3.0, 5: 1.0}
    s = np.zeros(n)
    for i, w in seeds.items():
        s[i] = w / sum(seeds.values())
    move = np.zeros((n, n))
    for (a, b), w in edges.items():
        move[b, a] = w
    out = move.sum(axis=0)
    want = s.copy()
    for _ in range(400):
        got = move @ np.where(out > 0, want / np.where(out > 0, out, 1), 0)
        want = 0.15 * s + 0.85 * (got + (1 - got.sum()) * s)
    frame = spark.createDataFrame([(f"h{a}", f"h{b}", w) for (a, b), w in edges.items()], "src string, dst string, n long")
    start = spark.createDataFrame([(f"h{i}", w) for i, w in seeds.items()], "host string, weight double")
    rank = {x["host"]: x["rank"] for x in personalised_rank(frame, start, tolerance=1e-2).collect()}
    assert all(abs(rank.get(f"h{i}", 0.0) - want[i]) < 0.06 for i in range(n)) and abs(sum(rank.values()) - 1) < 1e-9


def test_links_without_scheme(spark):
    pages = spark.createDataFrame(
        [("a.com", '<a href="//B.org/x">', "z"), ("a.com", "<a href='/own'><a HREF=https://c.net?q><a href=//a.com/y>", "z"), ("", '<a href="//b.org">', "z"), ("d.com", None, "z")],
        "host string, html string, src string",
    )
    assert sorted((r["src"], r["dst"], r["n"]) for r in host_links(pages).collect()) == [("a.com", "b.org", 1), ("a.com", "c.net", 1)]
