import json

import pytest
from pyspark.sql import functions as F

from gleaner import __main__ as cli
from gleaner.operators import clusters, model, review, service
from gleaner.operators.filters import Filters
from gleaner.sources import reviews


def test_buckets_and_pacing_wait():
    now, slept = [0.0], []

    def sleep(s):
        slept.append(round(s, 6))
        now[0] += s

    bucket = service.TokenBucket(60, lambda: now[0], sleep)
    for _ in range(61):
        bucket.take(1)
    assert slept == [1.0]
    pacer = service.Pacer(2, lambda: now[0], sleep)
    for host in ("a", "a", "b", "a"):
        pacer.wait(host)
    assert slept[1:] == [2.0, 2.0]


def test_retries_and_lock(tmp_path):
    left = [ValueError(), ValueError()]

    def call():
        if left:
            raise left.pop()
        return "done"

    assert service.retried(call, lambda n, e: 0.0, sleep=lambda s: None) == "done"
    with pytest.raises(KeyError):
        service.retried(lambda: {}["x"], lambda n, e: None)
    path = str(tmp_path / "lock")
    with service.run_lock(path, "me"), service.run_lock(path, "me"):
        with pytest.raises(RuntimeError), service.run_lock(path, "you"):
            pass
    with service.run_lock(path, "you"):
        pass


def test_grids_and_reports(spark, tmp_path):
    df = spark.createDataFrame([(1, "a|b"), (2, None)], "n int, t string").orderBy("n")
    assert service.grid(df, 5) == [["n", "t"], ["1", "a|b"], ["2", ""]]
    with pytest.raises(ValueError):
        service.grid(df, 1)
    chunks, left = service.workbook({"x": [["1"]] * 5, "y": [["1", "2"]] * 4}, 10, chunk=2)
    assert [len(c) for c in chunks["x"]] == [2, 2, 1] and left == ["y"]
    assert service.markdown("T", df).splitlines()[2:] == ["| n | t |", "| --- | --- |", "| 1 | a\\|b |", "| 2 |  |"]
    (tmp_path / "label_v2.md").write_text("hello")
    assert service.load_prompt("label", "v2", str(tmp_path)) == "hello"
    with pytest.raises(FileNotFoundError):
        service.load_prompt("label", "v3", str(tmp_path))


def test_command_line(capsys):
    assert cli.main(["list"]) == 0 and "opportunity_ranking" in capsys.readouterr().out
    assert cli.main(["run", "no such query", "--data", "x", "--out", "y"]) == 2


def test_saved_pages_are_read_along_their_tokens(spark, tmp_path):
    page = lambda c, token, then, own: json.dumps({"country": c, "token": token, "next": then, "reviews": [{"id": i, "at": at, "score": 4, "content": f"{c}{i}"} for i, at in own]})
    (tmp_path / "de.jsonl").write_text("\n".join([page("de", None, "t1", [("a", "2024-03-01"), ("b", "2024-02-01")]), page("de", "t1", "t2", [("c", "2023-01-01")]), page("de", "t2", None, [("d", "2024-05-01")])]))
    (tmp_path / "us.jsonl").write_text(page("us", None, None, [("a", "2024-03-01"), ("e", "2024-04-01")]))
    got = {r["review_id"]: r for r in reviews.fetch(spark, str(tmp_path), "2024-01-01").collect()}
    assert set(got) == {"a", "b", "e"} and got["a"]["countries"] == ["de", "us"] and got["a"]["content"] == "dea"
    assert [r["review_id"] for r in reviews.fetch(spark, str(tmp_path), "2024-01-01", 1).collect()] == ["e"]


def test_answers_keep_their_order_and_halve():
    asked = []

    def client(texts):
        asked.append(len(texts))
        return [(i, t, 1.0) for i, t in enumerate(texts) if t != "lost" or len(texts) > 99][::-1]

    assert model.ask(client, ["a", "b", "lost", "c"]) == [("a", 1.0), ("b", 1.0), (None, None), ("c", 1.0)]
    assert asked == [4, 2, 2, 1, 1]


def test_corrections_clear_and_filters_round_trip(spark):
    items = spark.createDataFrame([(1, "x", 3), (2, "y", 4), (3, None, 5)], "k long, category string, n int")
    log = spark.createDataFrame([(1, 1, "c", "z"), (2, 1, "c", ""), (3, 2, "n", "9"), (4, 9, "c", "q")], "override_id long, target_id long, field string, value string")
    got = [tuple(r) for r in review.decorated(items, "k", {"category": "c", "n": "n"}, log).orderBy("k").select("k", "category", "n", "ai_category", "corrected").collect()]
    assert got == [(1, None, 3, "x", True), (2, "y", 9, "y", True), (3, None, 5, None, False)]
    own = Filters(sources=("a",), ratings=(1,), include_unrated=False)
    assert Filters.from_key(own.key()) == own and own.active_count() == 3


def test_cluster_labels_are_cut_at_words(spark):
    row = spark.range(1).select(clusters.label(F.lit("a  b\nc")).alias("a"), clusters.label(F.lit("word " * 30)).alias("b")).head()
    assert row["a"] == "a b c" and len(row["b"]) <= 70 and row["b"].endswith("word…")
