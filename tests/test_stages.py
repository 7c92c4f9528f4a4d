"""Soft failure, skipped dependents, and runs that go on."""

import pytest
from pyspark.sql import functions as F

from quiremill.operators import quality as Q
from quiremill.stages import Stage, run_stages


def test_failures_are_kept_and_the_run_goes_on(spark, tmp_path):
    calls = []

    def words(s):
        calls.append("words")
        return s.createDataFrame([("a", 90.0), ("a", 70.0), ("b", 50.0)], "page string, conf double")

    def gate(s, w):
        calls.append("gate")
        return Q.quality_gate(w, 75.0).select("page", "decision")

    def broken(s, w):
        calls.append("broken")
        if "mended" not in calls:
            return w.select(F.raise_error(F.lit("no such page")).alias("x"))
        return w.select(F.lit(1).alias("x"))

    def report(s, g, extra):
        calls.append("report")
        return g.withColumn("extra", F.lit(extra is not None))

    stages = [Stage("words", words), Stage("gate", gate, ("words",)), Stage("crops", broken, ("words",)), Stage("figures", lambda s, c: c, ("crops",)), Stage("report", report, ("gate",), ("crops",))]
    status, tables = run_stages(spark, stages, f"file://{tmp_path}/run")
    got = {r.stage: (r.status, r.rows) for r in status.collect()}
    assert got == {"words": ("done", 3), "gate": ("done", 2), "crops": ("failed", None), "figures": ("skipped", None), "report": ("done", 2)}
    errors = {r.stage: r.error for r in status.collect()}
    assert "no such page" in errors["crops"] and errors["figures"] == "without crops" and errors["gate"] is None
    assert {r.extra for r in tables["report"].collect()} == {False} and "crops" not in tables
    # a second run takes what is there; only what failed or was skipped is computed
    calls[:] = ["mended"]
    status, tables = run_stages(spark, stages, f"file://{tmp_path}/run")
    assert {r.stage: r.status for r in status.collect()} == {"words": "kept", "gate": "kept", "crops": "done", "figures": "done", "report": "kept"}
    assert calls == ["mended", "broken"] and tables["figures"].count() == 3


def test_vital_stages_and_names(spark, tmp_path):
    def bad(s):
        raise OSError("disk")

    with pytest.raises(OSError):
        run_stages(spark, [Stage("a", bad, vital=True)], f"{tmp_path}/v")
    status, tables = run_stages(spark, [Stage("a", bad)], f"{tmp_path}/w")
    assert tables == {} and status.first().error == "OSError: disk"
    for stages in ([Stage("a", bad), Stage("a", bad)], [Stage("a", bad, ("b",)), Stage("b", bad)], [Stage("a", bad, wants=("z",))]):
        with pytest.raises(ValueError):
            run_stages(spark, stages, f"{tmp_path}/x")
