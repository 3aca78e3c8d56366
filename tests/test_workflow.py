"""The end-to-end run writes every artifact, and they agree with each other."""

import os

import pytest
from pyspark.sql import functions as F

from conftest import SF0001
from quire.plans.workflow import run
from quire.sources import read_manifest, read_ratings_csv
from quire.sources.artifacts import new_run, publish, read_artifact, run_folder


def test_run_writes_consistent_artifacts(spark, tmp_dir):
    out = os.path.join(tmp_dir, "out")
    stages = []
    manifest = run(spark, SF0001, out, k=3, n_users=20, timer=lambda n, fn: (stages.append(n), fn())[1])
    assert stages[0] == "ingest" and stages[-1] == "package"
    # manifest: UI, two chosen models, per-user RMSE, and train/test paths per fold
    man = read_manifest(spark, os.path.join(out, "manifest"))
    m = {r["artifact"]: r["path"] for r in man.collect()}
    assert m == manifest
    assert {"UI", "R.UB", "R.IB", "V.RMSE"} <= set(m)
    assert sum(1 for k in m if k.startswith("eval_sets.")) == 6
    # clean CSV export equals the kept rows of the tagged table
    csv = read_ratings_csv(spark, m["ratings_csv"])
    tagged = spark.read.parquet(m["tagged"])
    kept = tagged.filter(F.col("dropped_by").isNull()).select("user_id", "isbn", "book_rating")
    assert csv.count() == kept.count() == 3931
    assert csv.exceptAll(kept).count() == 0
    # every fold's train and test are disjoint and together the whole user-item table
    ui = spark.read.parquet(m["UI"]).count()
    for f in (1, 2, 3):
        train = read_artifact(spark, man, f"eval_sets.{f}.train").count()
        test = read_artifact(spark, man, f"eval_sets.{f}.test").count()
        assert train + test == ui and 0 < test < train
    # per-user RMSE for both methods; reports carry all sections
    v = spark.read.parquet(m["V.RMSE"])
    assert {r["method"] for r in v.select("method").distinct().collect()} == {"UBCF", "IBCF"}
    basics = [r["value"] for r in spark.read.text(m["basics"]).collect()]
    assert sum(1 for line in basics if line.startswith("3.a)")) == 2  # before and after
    model_txt = [r["value"] for r in spark.read.text(m["model_report"]).collect()]
    assert any(line.startswith("6.a) RMSE of the full model UB") for line in model_txt)
    lines = spark.read.parquet(m["lines_sampled"])
    assert lines.groupBy("method").count().filter("count = 20").count() == 2


@pytest.mark.parametrize("broken", ["ingest", "package"])
def test_a_broken_run_leaves_the_former_one_readable(spark, tmp_dir, broken):
    """Every stage writes into the run's own folder; only the last step publishes."""
    out = os.path.join(tmp_dir, "out")
    first = {"table": os.path.join(run_folder(out, "r0"), "table")}
    spark.range(3).write.parquet(first["table"])
    publish(spark, first, out, "r0")

    def timer(name, fn):
        value = fn() if name != "package" else None
        if name == broken:
            raise RuntimeError(f"{name} breaks")
        return value

    with pytest.raises(RuntimeError, match="breaks"):
        run(spark, SF0001, out, k=2, n_users=3, timer=timer)
    man = read_manifest(spark, os.path.join(out, "manifest"))
    assert [r["path"] for r in man.collect()] == [first["table"]]
    assert read_artifact(spark, man, "table").count() == 3
    publish(spark, {"other": first["table"]}, out, new_run())
    assert [r["artifact"] for r in read_manifest(spark, os.path.join(out, "manifest")).collect()] == ["other"]
