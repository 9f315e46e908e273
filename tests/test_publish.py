"""Write, audit, publish: what readers see moves to a run only when it is whole
and its tests pass."""

import os
from urllib.parse import urlparse

import pytest

from forgestat.operators import quality
from forgestat.plans.warehouse import METRIC_MODELS, TABLE_MODELS, audited_run, driver_warehouse

SF = "/root/testdata/sf0.001"


def _files(folder):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(folder) for f in names}


def test_views_move_only_to_audited_runs(spark, scratch, monkeypatch):
    first = audited_run(driver_warehouse(spark, SF), scratch, "audited", warn=("*",))
    assert first["blocked_by"] == {}
    assert sorted(first["published"]) == sorted(f"audited.{m}" for m in TABLE_MODELS + METRIC_MODELS)
    # the driver tables hold merges before their creation: that test has rows, all counted and stored
    negative = spark.table("audited.fct_pull_requests").filter("time_to_merge_hours < 0").count()
    assert negative > 0
    assert first["warnings"]["assert_positive_cycle_time"] == negative
    assert first["tests"]["assert_no_orphan_prs"] == 0
    for model in TABLE_MODELS:
        assert spark.table(f"audited.{model}").count() == first["tables"][model]
    before = _files(first["run"])
    assert before

    # a run with failing rows in a test that does not only warn is stored, not shown
    held = audited_run(driver_warehouse(spark, SF), scratch, "audited",
                       warn=("fct_*", "dim_*", "pr_cycle_time.*", "contributor_engagement.*", "release_velocity.*"))
    assert held["blocked_by"] == {"assert_positive_cycle_time": negative}
    assert held["published"] == [] and held["run"] != first["run"]
    assert _files(f"{held['run']}/test_results/assert_positive_cycle_time")
    # a run that dies after its first tables neither
    monkeypatch.setattr(quality, "store_declared_failures", lambda *a: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        audited_run(driver_warehouse(spark, SF), scratch, "audited", warn=("*",))
    assert _files(first["run"]) == before
    shown = {os.path.dirname(os.path.dirname(urlparse(f).path)) for m in TABLE_MODELS for f in spark.table(f"audited.{m}").inputFiles()}
    assert shown == {first["run"]}

    # the next whole run takes the views over, the folder of the first stays
    monkeypatch.undo()
    wh = driver_warehouse(spark, SF)
    wh._tables["fct_issues"] = wh.fct_issues.limit(0)
    last = audited_run(wh, scratch, "audited", warn=("*",))
    assert spark.table("audited.fct_issues").count() == last["tables"]["fct_issues"] == 0
    assert first["tables"]["fct_issues"] > 0 and _files(first["run"]) == before
