import os
import shutil
import subprocess
import sys

import pytest
from conftest import ROOT
from pyspark.sql import functions as F

from gleaner.operators import curated, funnel, runs
from gleaner.scratch import Scratch
from gleaner.session import BATCH_BYTES, ship


def test_clusters_group_by_category_and_closeness():
    c = lambda i, cat, v, fixed=False: {"id": i, "category": cat, "centroid": v, "size": 2, "fixed": fixed}
    assert sorted(map(sorted, runs.group_clusters([c("a", "x", [1, 0]), c("b", "x", [0.99, 0.05]), c("c", "y", [1, 0]), c("d", "x", [0, 1])], 0.9))) == [["a", "b"], ["c"], ["d"]]
    assert len(runs.group_clusters([c("a", "x", [1, 0], True), c("b", "x", [1, 0], True)], 0.5)) == 2


def test_merge_chains_end():
    assert runs.resolve_merges({"a": "b", "b": "c", "x": "y", "y": "x", "w": "x"}) == {"a": "c", "b": "c", "x": "x", "y": "y", "w": "x"}


def test_clusters_of_one_area_begin_together():
    c = lambda i, cat, v, n, fixed=None: {"id": i, "category": cat, "centroid": v, "size": n, "fixed": fixed}
    own = [c("a", "x", [1, 0], 2, "p"), c("b", "y", [0, 1], 3, "p"), c("c", "y", [0.4, 0.9], 9), c("d", "y", [0, 1], 1, "q")]
    assert runs.group_clusters(own, 0.8) == [["c", "a", "b"], ["d"]]  # cosines with c: 0.986 of a and b together, 0.914 of d
    assert runs.group_clusters(own, 0.99) == [["c"], ["a", "b"], ["d"]]


def test_curated_areas(spark):
    clusters = spark.createDataFrame([("k1", "x", 5, "a"), ("k2", "y", 4, "a"), ("k3", "y", 3, "b"), ("k4", "x", 1, "c"), ("k5", "z", 2, "l")], "cluster_id string, category string, size long, area_id string")
    log = spark.createDataFrame([("b", "merge", "a"), ("l", "merge", "m"), ("m", "merge", "l"), ("c", "status", "archived"), ("a", "name", "One"), ("b", "name", "Two")], "target_id string, field string, value string")
    got = {r["area_id"]: tuple(r)[1:] for r in curated.areas(clusters, log, least=5).collect()}
    assert got == {
        "a": (["k1", "k2", "k3"], "y", 12, "active", "One", ["b"], None, False), "l": (["k5"], "z", 2, "active", None, [], None, True),
        "c": (["k4"], "x", 1, "archived", None, [], None, True), "b": ([], "y", 0, "merged", "Two", [], "a", True),
    }
    assert curated.areas(clusters.limit(0), log, 5).count() == 0 and curated.areas(clusters, log.limit(0), 5).count() == 4
    with pytest.raises(ValueError):
        curated.areas(clusters, spark.range(3).selectExpr("cast(id as string) target_id", "'merge' field", "'x' value"), 5, most=2)


def test_regression_gate():
    assert runs.regressions({"r": 0.9, "p": 0.7}, {"r": 0.903, "p": 0.8}, {}) == ["p 0.700 fell from 0.800"]
    assert runs.regressions({"r": 0.8}, {"q": 1.0}, {"r": 0.9}) == ["r 0.800 misses 0.900", "q is missing"]


def test_robots():
    rules = "User-agent: *\nDisallow: /\nAllow: /open\n\nUser-agent: own\nDisallow: /private*x$\n"
    assert runs.robots_allow(rules, "other", "/open/1") and not runs.robots_allow(rules, "other", "/1")
    assert runs.robots_allow(rules, "Own-Bot", "/1") and not runs.robots_allow(rules, "Own-Bot", "/private/x") and runs.robots_allow("", "a", "/")


def test_csv():
    assert runs.csv_bytes(["a", "b"], [{"a": "=1", "b": None}]) == b"\xef\xbb\xbfa,b\n'=1,\n"
    assert runs.csv_bytes(["a", "b"], []) == b"\xef\xbb\xbfa,b\nno rows,\n"


def test_funnel_pieces(spark):
    row = spark.range(1).select(
        funnel.stage_a(F.lit("where is it"), F.lit(5), ["where is"], ["album"]), funnel.stage_a(F.lit("my album"), F.lit(3), ["where is"], ["album"]), funnel.stage_a(F.lit("my album"), F.lit(None).cast("int"), ["where is"], ["album"]),
        funnel.enforce_scope(F.lit("vague"), F.lit("t"), F.lit(False)), funnel.enforce_scope(F.lit("vague"), F.lit("t"), F.lit(True)), funnel.tidy_list(F.array(F.lit(" a"), F.lit(""), F.lit("a"), F.lit("b"), F.lit("c")), 2),
    ).head()
    assert tuple(row) == (True, True, False, "not", "vague", ["a", "b"])
    ids = spark.range(90).withColumnRenamed("id", "item_id")
    assert funnel.audit_ids(ids, 0.05).count() == 4 and sorted(funnel.audit_ids(ids, 0.05).collect()) == sorted(funnel.audit_ids(ids.repartition(3), 0.05).collect())


def test_the_rest_stands_without_the_training_data_package(tmp_path):
    """Without the llm folders the entry gives the library's own queries, whether or
    not the pipeline module is still there."""
    for keep_pipeline in (True, False):
        home = tmp_path / str(keep_pipeline)
        leave = ["llm", ".git", "__pycache__", *([] if keep_pipeline else ["corpus_pipeline.py"])]
        shutil.copytree(ROOT, home, ignore=shutil.ignore_patterns(*leave))
        code = "import __spark_entry__ as e; q = e.queries(); assert 'op1_divergence' not in q and 'pipeline' not in q and 'opportunity_ranking' in q and set(e.oracle_sql()) <= set(q)"
        subprocess.run([sys.executable, "-c", code], cwd=home, check=True, timeout=120)


def test_ship_reads_any_size_and_scratch_is_released(spark):
    before = spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")
    for size, after in (("64m", str(BATCH_BYTES)), ("1m", "1m"), ("16777216", "16777216")):
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", size)
        assert ship(spark).conf.get("spark.sql.execution.arrow.maxBytesPerBatch") == after
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", before)
    scratch = Scratch(spark, "t")
    scratch.write(spark.range(3), "x")
    at = scratch.path.removeprefix("file:")
    assert os.path.isdir(at)
    scratch.clear()
    assert not os.path.exists(at)
