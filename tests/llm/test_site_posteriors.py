"""Site posteriors of the quality classifier against brute force."""

import math
from collections import defaultdict

import pytest
from conftest import SF0001

from quire.llm.quality_classifier import quality_classifier


def brute_strength(groups):
    """groups: (n, mean, prior)."""
    many = [g for g in groups if g[0] > 1]
    spread = sum(n * (m - prior) ** 2 for n, m, prior in many)
    noise = sum(prior * (1 - prior) for _, _, prior in many)
    total = sum(n for n, _, _ in many)
    if not total or spread <= noise:
        return 1000.0
    within = sum(n * prior * (1 - prior) for n, _, prior in many) / total
    return min(max(within / ((spread - noise) / total) - 1, 1.0), 1000.0)


def logit(p):
    p = min(max(p, 1e-6), 1 - 1e-6)
    return math.log(p / (1 - p))


def test_posteriors_leave_the_document_out(spark):
    docs = spark.read.parquet(f"{SF0001}/documents.parquet").select("doc_id", "text", "source", "lang")
    alone = spark.createDataFrame([(10**6, "one of its own site " * 20, "alone", None)], docs.schema)
    labels = spark.read.parquet(f"{SF0001}/labels.parquet")
    rows = quality_classifier(docs.unionByName(alone), labels, "source", "lang").collect()
    p = {r["doc_id"]: round(1 / (1 + math.exp(-r["log_odds"])), 9) for r in rows}
    hosts, paths = defaultdict(list), defaultdict(list)
    for r in rows:
        hosts[r["source"]].append(p[r["doc_id"]])
        paths[r["source"], r["lang"]].append(p[r["doc_id"]])
    mean = sum(p.values()) / len(p)
    m_host = brute_strength([(len(v), sum(v) / len(v), mean) for v in hosts.values()])
    prior = {h: (sum(v) + m_host * mean) / (len(v) + m_host) for h, v in hosts.items()}
    m_path = brute_strength([(len(v), sum(v) / len(v), prior[h]) for (h, _), v in paths.items()])
    for r in rows:
        own, host, path = p[r["doc_id"]], hosts[r["source"]], paths[r["source"], r["lang"]]
        of_host = (sum(host) - own + m_host * mean) / (len(host) - 1 + m_host)
        of_path = (sum(path) - own + m_path * of_host) / (len(path) - 1 + m_path)
        assert r["host_posterior"] == pytest.approx(of_host, abs=1e-6) and r["path_posterior"] == pytest.approx(of_path, abs=1e-6)
        z = r["log_odds"] + logit(of_path) - logit(mean)
        assert r["quality"] == pytest.approx(1 / (1 + math.exp(-z)), abs=1e-4)
    single = next(r for r in rows if r["source"] == "alone")
    assert single["quality"] == pytest.approx(1 / (1 + math.exp(-single["log_odds"])), abs=1e-6)
