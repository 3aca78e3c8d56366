"""Quality classifier: document evidence combined with host and path posteriors.

A logistic model over FEATURES of the text, fitted on TRAIN_ROWS labelled rows at most,
gives each document's log-odds. Their probabilities are summed per host and per path by
grouped aggregation; a host's mean is shrunk toward the global mean, a path's toward its
host's, by strengths estimated from the spread between the groups (empirical Bayes). A
document's final log-odds are its own plus those of its path less the global ones.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructField

from quire.operators.skew import join_small

from .common import append_columns, materialize, texts_of

#: Labelled rows that the model is fitted on at most, the first by a hash of their id.
TRAIN_ROWS = 50_000
RIDGE = 1.0
#: No document's own evidence counts for more, either way.
MAX_LOG_ODDS = 8.0
FEATURES = "bias words upper digits symbols other mean_word distinct dup_lines short_lines bars repeats".split()
_UPPER = bytes(range(65, 91))
_DIGITS = b"0123456789"
_SYMBOLS = b"#*$%&|<>{}[]=_~^\\@!+"


def features(text: bytes | None) -> list[float]:
    """Shares and logarithms, all within a few units; of an empty text, those of no word."""
    t = text or b""
    words = t.split()
    size, n = max(len(t), 1), max(len(words), 1)
    lines = [x for x in t.split(b"\n") if x.strip()]
    pairs = list(zip(words, words[1:]))

    def share(letters: bytes) -> float:
        return 10.0 * (len(t) - len(t.translate(None, letters))) / size

    return [
        1.0,
        np.log1p(len(words)) - 5.0,
        min(share(_UPPER), 5.0),
        min(share(_DIGITS), 5.0),
        min(share(_SYMBOLS), 5.0),
        min(share(b".,;:?"), 2.0),
        min(sum(map(len, words)) / n, 20.0) / 5.0 - 1.0,
        len(set(words)) / n,
        1.0 - len(set(lines)) / max(len(lines), 1),
        sum(len(x) < 30 for x in lines) / max(len(lines), 1),
        min(share(b"|"), 3.0),
        1.0 - len(set(pairs)) / max(len(pairs), 1),
    ]


def fit(x: np.ndarray, y: np.ndarray, steps: int = 25) -> np.ndarray:
    """Weights of a ridge logistic regression by Newton's method; zero without rows."""
    w = np.zeros(len(FEATURES))
    if not len(y):
        return w
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (y - p) - RIDGE * w
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + RIDGE * np.eye(len(w)), gradient)
        w += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-6:
            break
    return w


def logit(p: Column) -> Column:
    p = F.greatest(F.lit(1e-6), F.least(F.lit(1 - 1e-6), p))
    return F.log(p / (1 - p))


def strength(groups: DataFrame, prior: str) -> float:
    """Prior strength in documents from the spread of group means (n, mean) around ``prior``:
    what is left of it after the sampling variance is the variance between groups."""
    m, gap = F.col(prior), F.col("mean") - F.col(prior)
    noise = F.sum(m * (1 - m))
    row = groups.filter("n > 1").agg(F.sum(F.col("n") * gap * gap).alias("spread"), noise.alias("noise"), F.sum(F.col("n") * m * (1 - m)).alias("one"), F.sum("n").alias("n")).first()
    if not row["n"] or row["spread"] <= row["noise"]:
        return 1000.0
    between, within = (row["spread"] - row["noise"]) / row["n"], row["one"] / row["n"]
    return float(min(max(within / between - 1, 1.0), 1000.0))


def quality_classifier(docs: DataFrame, labels: DataFrame, host: str, path: str, text: str = "text", doc_id: str = "doc_id", label: str = "quality") -> DataFrame:
    """``docs`` with log_odds (the text's own), host_posterior, path_posterior (of the other
    documents there: the text's own evidence counts once), quality (the final probability)
    and kept (quality of a half or more).

    host and path are columns; null is a group like any other, paths are told apart within
    their host. ``labels`` has doc_id and a 0/1 label; null labels are left out, of several
    the largest counts. A null text is an empty one. Without labels all own evidence is 0.
    Repeated rows count each time; an empty table gives an empty result.
    """
    known = labels.filter(F.col(label).isNotNull()).groupBy(F.col(doc_id).alias("_id")).agg(F.max(label).alias("_y"))
    first = known.orderBy(F.xxhash64("_id"), "_id").limit(TRAIN_ROWS)
    own = docs.select(F.col(doc_id).alias("_id"), F.col(text).alias("_text"))
    rows = join_small(own, first, "_id")
    field = StructField("_x", ArrayType(DoubleType()))
    seen = append_columns(rows, [field], lambda b: [pa.array([features(t) for t in texts_of(b, "_text")], pa.list_(pa.float64()))])
    # TRAIN_ROWS rows of len(FEATURES) numbers at most, unless ids are repeated.
    train = seen.select("_id", "_y", "_x").dropDuplicates(["_id"]).collect()
    train.sort(key=lambda r: r["_id"])
    w = fit(np.array([r["_x"] for r in train]).reshape(-1, len(FEATURES)), np.array([r["_y"] for r in train], dtype=float))

    def evidence(batch: pa.RecordBatch):
        x = np.array([features(t) for t in texts_of(batch, text)]).reshape(-1, len(FEATURES))
        return [pa.array(np.clip((x * w).sum(axis=1), -MAX_LOG_ODDS, MAX_LOG_ODDS))]

    scored = append_columns(docs, [StructField("log_odds", DoubleType())], evidence)
    p = 1 / (1 + F.exp(-F.col("log_odds")))
    narrow = scored.select(F.col(host).alias("_host"), F.col(path).alias("_path"), F.round(p, 9).cast("decimal(20,9)").alias("_p"))
    paths = narrow.groupBy("_host", "_path").agg(F.count("*").alias("n"), F.sum("_p").cast("double").alias("total"))
    paths = materialize(paths, "paths")
    mean = paths.agg(F.sum("total") / F.sum("n")).first()[0]
    mean = 0.5 if mean is None else float(mean)
    hosts = paths.groupBy("_host").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))
    hosts = materialize(hosts.withColumn("mean", F.col("total") / F.col("n")).withColumn("global", F.lit(mean)), "hosts")
    m_host = strength(hosts, "global")
    posterior_of_host = (F.col("total") + m_host * mean) / (F.col("n") + m_host)
    hosts = hosts.select(F.col("_host").alias("_h"), posterior_of_host.alias("host_posterior"), F.col("n").alias("_host_n"), F.col("total").alias("_host_total"))
    paths = paths.join(hosts, F.col("_host").eqNullSafe(F.col("_h"))).drop("_h").withColumn("mean", F.col("total") / F.col("n"))
    paths = materialize(paths, "path-posteriors")
    m_path = strength(paths, "host_posterior")
    key = F.struct(F.coalesce(F.col("_host").cast("string"), F.lit("\0")).alias("h"), F.coalesce(F.col("_path").cast("string"), F.lit("\0")).alias("p"))
    sums = paths.select(F.to_json(key).alias("_site"), "_host_n", "_host_total", F.col("n").alias("_n"), F.col("total").alias("_total"))
    new = ("log_odds", "host_posterior", "path_posterior", "quality", "kept")
    kept = [c for c in docs.columns if c not in new]
    site = F.to_json(F.struct(F.coalesce(F.col(host).cast("string"), F.lit("\0")).alias("h"), F.coalesce(F.col(path).cast("string"), F.lit("\0")).alias("p")))
    found = scored.select(*kept, "log_odds", site.alias("_site"))
    found = join_small(found, sums, "_site", "left", counts=lambda: sums.select("_site", "_n"))
    # Without the document itself, whose evidence is its log_odds.
    mine = F.round(p, 9)
    of_host = (F.col("_host_total") - mine + m_host * mean) / (F.col("_host_n") - 1 + m_host)
    found = found.withColumn("host_posterior", of_host)
    of_path = (F.col("_total") - mine + m_path * F.col("host_posterior")) / (F.col("_n") - 1 + m_path)
    found = found.withColumn("path_posterior", of_path)
    z = F.col("log_odds") + logit(F.col("path_posterior")) - logit(F.lit(mean))
    quality = 1 / (1 + F.exp(-z))
    return found.select(*kept, "log_odds", "host_posterior", "path_posterior", quality.alias("quality"), (z >= 0).alias("kept"))
