import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from gleaner.functions.python_text import token_set_ratio
from gleaner.operators import areas, vectors
from gleaner.scratch import Scratch


def test_token_set_ratio():
    assert token_set_ratio("fuzzy was a bear", "fuzzy fuzzy was a bear") == 100.0
    assert token_set_ratio("a b", "") == 0.0 and token_set_ratio("abc", "xyz") == 0.0
    assert token_set_ratio("a b c", "c a") == 100.0
    assert token_set_ratio("abcd", "abce") == pytest.approx(75.0)


def test_quotes_equal_the_sequential_choice(spark):
    rng = random.Random(9)
    words = "red blue old new car tree house lake road bird".split()
    rows = [(rng.choice(["x", "y", None]), i, rng.choice(["s1", "s2", None]), rng.choice([" ", None] + [" ".join(rng.sample(words, 3)) for _ in range(9)]), rng.randrange(1, 6), rng.random()) for i in range(120)]
    df = spark.createDataFrame(rows, "area_id string, item_id long, source string, quote string, strength int, similarity double")
    got = areas.representative_quotes(df, Scratch(spark, "q"), k=6, alike=80.0).collect()
    scored = areas.quote_scores(df).collect()
    for area in ("x", "y", None):
        own = sorted((r for r in scored if r["area_id"] == area), key=lambda r: (-r["score"], r["item_id"]))
        heads = {r["source"]: r["item_id"] for r in reversed(own)}
        picked = []
        for r in sorted(own, key=lambda r: (r["item_id"] not in heads.values(), -r["score"], r["item_id"])):
            if len(picked) < 6 and all(token_set_ratio(r["quote"], p["quote"]) < 80 for p in picked):
                picked.append(r)
        want = [r["item_id"] for r in sorted(picked, key=lambda r: (-r["score"], r["item_id"]))]
        assert [r["item_id"] for r in sorted((g for g in got if g["area_id"] == area), key=lambda g: g["place"])] == want
    assert areas.representative_quotes(df.limit(0), Scratch(spark, "q")).count() == 0


def test_reduction_keeps_the_variance(spark):
    rng = np.random.default_rng(4)
    points = rng.normal(size=(80, 2)) @ rng.normal(size=(2, 6))
    rows = [(i, p.tolist()) for i, p in enumerate(points)] + [(99, None)]
    got = vectors.reduced(spark.createDataFrame(rows, "id long, vector array<double>"), 2).orderBy("id").collect()
    low = np.array([r["reduced"] for r in got[:-1]])
    apart = lambda m: np.linalg.norm(m[:, None] - m[None], axis=2)
    assert got[-1]["reduced"] is None and np.allclose(apart(low), apart(points))


def test_exemplars_are_bounded(spark):
    one = spark.createDataFrame([(1, [1.0, 0.0])], "id long, vector array<double>")
    assert vectors.margins(one, one, one).head()["margin"] == 0
    with pytest.raises(ValueError):
        vectors.margins(one, one.crossJoin(spark.range(1001)).select("vector"), one)
    with pytest.raises(ValueError):
        vectors.margins(one, one.where(F.lit(False)), one)


def test_packing_equals_a_plain_fold(spark):
    rng = random.Random(2)
    rows = [(rng.choice(["a", "b", None]), i, rng.choice([None, 1, 5, 30, 200])) for i in range(200)]
    got = {r["item_id"]: r["batch"] for r in areas.pack(spark.createDataFrame(rows, "g string, item_id long, size long").repartition(7), "size", 4, 60, "g").collect()}
    for group in ("a", "b", None):
        batch, n, total = 0, 0, 0
        for _, i, s in (r for r in rows if r[0] == group):
            if n and (n == 4 or total + (s or 0) > 60):
                batch, n, total = batch + 1, 0, 0
            n, total = n + 1, total + (s or 0)
            assert got[i] == batch
