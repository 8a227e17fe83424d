import os
import tracemalloc
from datetime import datetime

import numpy as np
import pytest
from oracle import assert_same
from pyspark.sql import functions as F

from gleaner.functions import cleaning, python_text, scalars, text
from gleaner.operators import areas, clusters, dedup, filters, scoring, tables, vectors
from gleaner.operators.components import connected_components
from gleaner.plans import registry, texts
from gleaner.scratch import Scratch
from gleaner.sources import pages

registry.load()


def test_quantile_of_ties(spark):
    df = spark.createDataFrame([(i, v) for i, v in enumerate((0.1, 0.4, 0.4, 0.2, 0.9))], "area_id int, v double")
    got = {r["area_id"]: r["q"] for r in scoring.quantile_scores(df, "v", "q").collect()}
    assert got == {0: 1.0, 1: 3.5, 2: 3.5, 3: 2.0, 4: 5.0}
    one = spark.createDataFrame([(1, 0.5)], "area_id int, v double")
    assert scoring.quantile_scores(one, "v", "q").head()["q"] == 3.0


def test_steps_and_bands(spark):
    row = spark.range(1).select(*[scoring.step_score(F.lit(x)).alias(f"s{i}") for i, x in enumerate((0.01, 0.06, 0.3))], *[scoring.band(F.lit(x)).alias(f"b{i}") for i, x in enumerate((3.8, 3.0, 2.99))]).head()
    assert tuple(row) == (1.0, 3.0, 5.0, "High", "Medium", "Low")


def test_day_cap_keeps_the_first_and_the_undated(spark):
    df = spark.sql("select 'a' area_id, cast(id as long) item_id, date'2024-01-01' day from range(10)")
    assert [r["item_id"] for r in scoring.cap_by_day(df).where("kept").collect()] == [0]
    assert scoring.cap_by_day(df.withColumn("day", F.lit(None).cast("date"))).where("kept").count() == 10


def test_weights():
    own = scoring.normalize_weights({"a": 2, "b": 2, "c": -1})
    assert own == {"a": 0.5, "b": 0.5, "c": 0.0}
    with pytest.raises(ValueError):
        scoring.normalize_weights({"a": 0})


DATES = {
    "exact": {"1700000000": "2023-11-14 22:13:20", "1700000000123": "2023-11-14 22:13:20", "2021-02-03T04:05:06+02:00": "2021-02-03 02:05:06"},
    "day": {"2022-12-31": "2022-12-31 00:00:00", "07/08/2019": "2019-08-07 00:00:00", "31.01.2020": "2020-01-31 00:00:00", "01/31/2020": "2020-01-31 00:00:00", "43831": "2020-01-01 00:00:00", "Jul 4, 2018": "2018-07-04 00:00:00", "yesterday": "2024-05-31 00:00:00"},
    "approximate": {"3 days ago": "2024-05-29 00:00:00", "an hour ago": "2024-05-31 23:00:00", "2 weeks ago (edited)": "2024-05-18 00:00:00"},
    None: {" ": None, "never": None, "99/99/2020": None},
}


@pytest.mark.parametrize(("how", "value"), [(how, v) for how, own in DATES.items() for v in own])
def test_loose_dates(spark, how, value):
    at, precision = scalars.loose_date(F.lit(value), F.lit("2024-06-01 00:00:00").cast("timestamp"))
    row = spark.range(1).select(F.date_format(at, "yyyy-MM-dd HH:mm:ss").alias("at"), precision.alias("how")).head()
    assert (row["at"], row["how"]) == (DATES[how][value], how)


def test_small_functions(spark):
    row = spark.range(1).select(
        scalars.rating(F.lit("4.0")), scalars.rating(F.lit("9")), scalars.duration_seconds(F.lit("2m59.5s")), text.normalize_cue(F.lit("My \"the Beach!\" ")), text.spreadsheet_cell(F.lit("=1+1")),
        text.phrase_match(F.lit("éfind it"), ["find"]), text.phrase_match(F.lit("Can’t find it"), ["can't find"]), text.redact_names(F.lit("my mom Priya and Our uncle Raj, my car Bob")), text.redact(F.lit("a@b.co and http://x.y/z"))[0],
        scalars.keep_last(F.array(*[F.lit(i) for i in range(7)])), text.normalize_space(F.lit("a b \n\n\n\n c​")),
    ).head()
    assert tuple(row) == (4, None, 179.5, "beach", "'=1+1", False, True, "my mom [name] and Our uncle [name], my car Bob", "[EMAIL] and [URL]", [2, 3, 4, 5, 6], "a b\n\nc")


def test_python_text():
    assert python_text.strip_markup("<b>Hi</b> &amp; **bold** _em_ `code`\n> quoted\n# [t](u) ![alt](v)") == " Hi  & bold em code\nt alt"
    assert python_text.name_emoji("so 😀\ufe0f!").split() == ["so", "grinning", "face", "!"]
    assert python_text.redact_phones("call +1 (269) 555-3296 v 2024.10.11.12 on 2024-01-01, id 123456789012") == ("call [PHONE] v 2024.10.11.12 on 2024-01-01, id 123456789012", 1)
    assert python_text.indel_ratio("kitten", "sitting") == pytest.approx(200 * 4 / 13)
    body = "I looked for “that photo” of my dog   at the beach for an hour."
    assert python_text.ground_quote('"that photo" of my dog at the beach', body) == "“that photo” of my dog   at the beach"
    assert python_text.ground_quote("that photo of my cat somewhere far away", body) is None
    assert python_text.ground_quote(None, body) is None


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 160)] + [(7, 7), (None, 3)]
    got = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(edges, "a long, b long"), Scratch(spark, "t")).collect()}
    assert got == {**{i: 0 for i in range(61)}, **{i: 100 for i in range(100, 160)}}
    assert connected_components(spark.createDataFrame([], "a long, b long"), Scratch(spark, "t")).count() == 0


def test_star_merge_equals_the_sequential_one(spark):
    rng = np.random.default_rng(3)
    for _ in range(3):
        pairs = sorted({tuple(sorted(map(int, p))) for p in rng.integers(0, 30, (40, 2)) if p[0] != p[1]})
        places = {i: int(p) for i, p in enumerate(rng.permutation(30))}
        near = {i: [] for i in range(30)}
        for a, b in pairs:
            near[a].append(b)
            near[b].append(a)
        expected, done = {}, set()
        for i in sorted(range(30), key=places.get):
            if i in done:
                continue
            done.add(i)
            for j in near[i]:
                if j not in done:
                    expected[j] = i
                    done.add(j)
        df = spark.createDataFrame([(a, b, 1.0) for a, b in pairs], "a long, b long, similarity double")
        order = spark.createDataFrame(list(places.items()), "item_id long, place int")
        assert {r["item_id"]: r["canonical_id"] for r in dedup.star_merge(df, order, Scratch(spark, "t")).collect()} == expected


def test_shingles_of_short_texts(spark):
    row = spark.range(1).select(dedup.shingles(F.split(F.lit("a b c"), " ")), dedup.shingles(F.split(F.lit("a b c d e f"), " "))).head()
    assert tuple(row) == (["a b c"], ["a b c d e", "b c d e f"])


def test_diverse_top_takes_every_source_first(spark):
    df = spark.createDataFrame([("x", "1", 9.0, 1), ("x", "1", 8.0, 2), ("x", "1", 7.0, 3), ("x", "2", 1.0, 4), ("x", "3", 2.0, 5)], "area_id string, source string, score double, item_id long")
    top = lambda k: [r["item_id"] for r in areas.diverse_top(df, k).orderBy("place").collect()]
    assert top(3) == [1, 5, 4] and top(4) == [1, 2, 5, 4]


def test_density_finds_blobs():
    rng = np.random.default_rng(0)
    points = np.concatenate([rng.normal(c, 0.05, (30, 2)) for c in ((0, 0), (3, 3), (0, 4))] + [rng.uniform(-10, 10, (5, 2))])
    labels = vectors.density_labels(points)
    assert len(set(labels[:90]) - {-1}) == 3
    assert all(len(set(labels[i : i + 30]) - {-1}) == 1 for i in (0, 30, 60))
    assert set(vectors.density_labels(points[:5])) == {-1}


def test_filters_and_overrides(spark):
    own = filters.Filters(sources=("a",), include_unrated=False)
    assert own.active_count() == 2 and "sources" in own.summary() and filters.Filters().summary() == "all items"
    log = spark.createDataFrame([(1, 1, "f", "x"), (2, 1, "f", ""), (3, 2, "f", "y")], "override_id long, target_id long, field string, value string")
    df = spark.createDataFrame([(1, "own"), (2, "own"), (3, None)], "k long, c string")
    got = {r["k"]: r["c"] for r in filters.corrected(df, "k", "c", "f", filters.latest_overrides(log)).collect()}
    assert got == {1: "own", 2: "y", 3: None}


def test_publish_gate():
    good = dict.fromkeys(tables.REQUIRED_STAGES, "success")
    assert tables.publish_reasons(good, 3, 3, 3, 100, 120, False) == []
    assert len(tables.publish_reasons(good | {"score": "failed"}, 0, 0, 0, 5, 100, True)) == 4
    assert tables.run_status(True, 0) == "failed" and tables.run_status(False, 2) == "partial" and tables.run_status(False, 2, "success") == "success"


def test_sheet_and_feed(spark, tmp_path):
    (tmp_path / "s.csv").write_text("﻿export,,\nID,Content,Rating\n1,hello,5\n,,\n2,there\n", encoding="utf-8")
    got = pages.read_sheet(spark, str(tmp_path / "s.csv"))
    assert got.columns == ["id", "text", "rating"] and [r["text"] for r in got.where("text is not null").collect()] == ["hello", "there"]
    feeds = spark.createDataFrame([('{"entry":[{"id":"1","rating":"5"},{"id":"2"}]}',), ('{"entry":{"id":"3","rating":"1"}}',)], "f string")
    assert sorted(e["id"] for r in feeds.select(pages.feed_entries(F.col("f")).alias("e")).collect() for e in r["e"]) == ["1", "3"]
    assert pages.read_page("<title>T</title><nav>x</nav><p>a <b>b</b></p><script>z</script>") == ("T", 0, "a b")


def test_dates_are_utc(spark):
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC" and datetime(2024, 1, 1)


def test_clean_records(spark):
    rules = cleaning.Rules(keywords=("can't find",), least_words=4, most_chars=60, head_chars=30, boilerplate=True)
    record = lambda x: dict(zip([f.split()[0] for f in cleaning.FIELDS.split(", ")], cleaning.record(x, rules, cleaning._phrases(rules.keywords)), strict=True))
    page = record("Menu\nSign in\n[home](x) | go\nI could not see where my photo of Rome went, see www.x.y and a@b.co")
    assert page["clean_text"].startswith("I could not see") and page["n_redacted"] == 2 and page["language"] == "en" and page["eligible"] and page["truncated"]
    rules = cleaning.Rules(keywords=("can't find",), least_words=4)
    assert record("😀 😀")["exclude_reason"] == "emoji_only" and record(None)["exclude_reason"] == "emoji_only" and record("hm hm")["exclude_reason"] == "min_words"
    assert record("I can’t find") | {"word_count": 3} == record("I can’t find") and record("I can’t find")["eligible"]
    assert record("mujhe nahi mila yaar photo wala album")["language"] == "code_mixed" and record("Привет как дела друзья")["exclude_reason"] == "language"
    assert record("der Hund und die Katze sind mit von der Partie und das ist gut")["language"] == "de"
    long = cleaning.shortened("First words of it here. " + "Noise. " * 9 + "I can't find it. More noise.", 20, 60, cleaning._phrases(rules.keywords))
    assert long == "First words of it\nI can't find it."
    df = spark.createDataFrame([(None,), ("Call +1 269 555 3296 or passport A1234567 now please",)], "t string")
    got = [r["r"] for r in df.select(cleaning.clean_record(F.col("t"), cleaning.Rules()).alias("r")).collect()]
    assert got[0]["exclude_reason"] == "emoji_only" and got[1]["clean_text"] == "Call [PHONE] or passport [ID] now please" and got[1]["n_redacted"] == 2


def test_whole_deduplication_equals_the_sequential_one(spark):
    rng = np.random.default_rng(8)
    words = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(80):
        base = [words[k] for k in np.random.default_rng(int(rng.integers(0, 12))).integers(0, 60, 30)]
        if rng.random() < 0.5:
            base[int(rng.integers(0, 30))] = f"e{i}"
        own = " ".join(base) if rng.random() < 0.7 else f"short {int(rng.integers(0, 4))}"
        rows.append((i, own, own, own.split(), len(own.split()), int(rng.integers(0, 9)) if rng.random() < 0.8 else None, f"s{int(rng.integers(0, 2))}", int(rng.integers(0, 30)) if rng.random() < 0.2 else None, datetime(2024, 1, 1 + int(rng.integers(0, 28))).date() if rng.random() < 0.9 else None, False))
    df = spark.createDataFrame(rows, "item_id long, text string, folded string, words array<string>, n_words long, author long, source string, external_id long, day date, has_keyword boolean")
    got = {r["item_id"]: r for r in dedup.deduplicate(df, Scratch(spark, "t"), authors=3).collect()}
    by = {r[0]: r for r in rows}
    label = {i: i for i in by}
    keys = {}
    for r in rows:
        own = ([("t", r[2])] if r[4] >= 12 else [("s", r[2], r[5], r[6])] if r[5] is not None else []) + ([("x", r[7])] if r[7] is not None else [])
        for k in own:
            keys.setdefault(k, []).append(r[0])
    for group in keys.values():
        for i in group:
            low, high = sorted((label[i], label[group[0]]))
            label = {k: low if v == high else v for k, v in label.items()}
    drop = {}
    for g in set(label.values()):
        members = sorted((i for i in by if label[i] == g), key=lambda i: (-len(by[i][1]), str(by[i][8] or "9999"), i))
        drop |= {i: members[0] for i in members[1:]}
    sets = {i: {tuple(by[i][3][k : k + 5]) for k in range(len(by[i][3]) - 4)} for i in by if by[i][4] >= 12 and i not in drop}
    near, taken = {}, set()
    ranked = sorted(sets, key=lambda i: (-len(by[i][1]), str(by[i][8] or "9999"), i))
    for n, i in enumerate(ranked):
        if i in taken:
            continue
        for j in ranked[n + 1 :]:
            if j not in taken and len(sets[i] & sets[j]) >= 0.85 * len(sets[i] | sets[j]):
                near[j] = i
                taken.add(j)
    end = {i: near.get(drop.get(i, i), drop.get(i, near.get(i, i))) for i in by}
    assert {i: r["canonical_id"] for i, r in got.items()} == end
    assert {i for i, r in got.items() if r["reason"] is None} == set(by) - set(drop) - set(near)
    first = {c: min((by[i][8] for i in by if end[i] == c and by[i][8]), default=None) for c in set(end.values())}
    assert all(r["earliest"] == first[r["canonical_id"]] for r in got.values())
    stats = dedup.statistics(dedup.deduplicate(df, Scratch(spark, "t"), authors=3)).head()
    assert stats["remaining"] == len(set(end.values())) and stats["near_merged"] == len(near) and stats["exact_merged"] + stats["review_id_merged"] == len(drop)


def test_merge_sample_places_every_merge(spark):
    rng = np.random.default_rng(4)
    rows = [(i, int(rng.integers(0, 500)), ["near", "exact", "review_id", "other"][int(rng.integers(0, 4))]) for i in range(1000, 2600)]
    seen, turns, dealt = {}, {}, []
    for i, c, reason in sorted(rows):
        seen[c] = seen.get(c, 0) + 1
        dealt += [(reason, c, i)] if seen[c] <= 3 else []
    for k, (reason, c, i) in enumerate(sorted(dealt)):
        turns[reason] = turns.get(reason, 0) + 1
        dealt[k] = (turns[reason], {"near": 0, "exact": 1}.get(reason, 2), c, i, reason)
    df = spark.createDataFrame(rows, "item_id long, canonical_id long, reason string")
    got = [(r["place"], r["reason"], r["canonical_id"], r["item_id"]) for r in dedup.merge_sample(df, Scratch(spark, "t")).orderBy("place").collect()]
    assert len(got) > 500 and got == [(k + 1, reason, c, i) for k, (_, _, c, i, reason) in enumerate(sorted(dealt))]


def test_density_keeps_no_matrix():
    points = np.random.default_rng(1).normal(0, 1, (3000, 4))
    tracemalloc.start()
    labels = vectors.density_labels(points)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(labels) == 3000 and peak < 8 * 3000 * 3000


def test_sweep_takes_any_number_of_points(spark):
    df = spark.range(20_001).select(F.col("id").alias("vec_id"), F.array(F.cos(F.col("id") % 3 + F.rand(2) / 9), F.sin(F.col("id") % 3 + F.rand(3) / 9)).alias("vector"))
    row = clusters.sweep(df, [(10, 3)]).head()
    assert (row["least_size"], row["least_near"]) == (10, 3) and row["n_clusters"] > 0


@pytest.fixture
def crowded(spark, sf_dir, tmp_path):
    """Documents with groups of more copies than a candidate's shingle may have, with
    other ends, other openings and openings alike."""
    rng = np.random.default_rng(5)
    prose = lambda n: [f"w{i}" for i in rng.integers(0, 400, n)]
    own, common = [], [prose(60) for _ in range(3)]
    for k, n in enumerate((50, 90, 45)):
        own += [common[k]] * n
        own += [[*common[k][:at], f"x{at}", *common[k][at:]] for at in (0, 3, 56, 58)] + [common[k] + prose(m) for m in (1, 2, 9, 40)]
    for base in (prose(100), prose(30)):
        own += [base, base, base[:20] + ["other"] + base[21:], [*base, "more"], base[:9] + base[11:], ["new", *base], base + prose(30)]
    own += [prose(n) for n in (5, 11, 12, 13, 200)] + [[], prose(12) * 3]
    rows = [(int(i), " ".join(t), "en", "s", len(" ".join(t))) for i, t in zip(rng.permutation(len(own)) + 1, own, strict=True)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").coalesce(2).write.parquet(str(tmp_path / "documents.parquet"))
    for name in os.listdir(sf_dir):
        if name != "documents.parquet":
            os.symlink(f"{sf_dir}/{name}", tmp_path / name)
    return str(tmp_path)


@pytest.mark.parametrize("name", ["shingle_jaccard_pairs", "near_exemplars"])
def test_pairs_of_crowded_texts_equal_sql(spark, crowded, name):
    assert_same(spark, crowded, registry.QUERIES[name], registry.ORACLES[name])


def test_near_pairs_write_less_than_the_texts(spark, sf_dir):
    registry.load()
    items, scratch = texts.items(spark, sf_dir).where("n_words >= 12"), Scratch(spark, "t")
    found = dedup.near_pairs(items.select("item_id", "words"), scratch).count()
    written = sum(os.path.getsize(os.path.join(d, f)) for d, _, names in os.walk(scratch.path.removeprefix("file:")) for f in names)
    assert found and 0 < written < items.agg(F.sum(F.length("text"))).head()[0] / 2


@pytest.fixture
def near_copies(spark, sf_dir, tmp_path):
    """A folder with 150 different near copies of two texts, and the stars among them in
    the order of canonical choice, by brute force."""
    rng = np.random.default_rng(11)
    prose, texts_of = [[f"w{i}" for i in rng.integers(0, 900, 200)] for _ in range(2)], {}
    ids = [i for i in range(1, 400) if i % 17]  # no shared external id
    for k, doc in enumerate(rng.permutation(ids)[:150].tolist()):
        words = list(prose[k % 5 == 0])
        for at in rng.integers(0, 200, int(rng.integers(0, 4))):
            words[at] = f"x{doc}"
        texts_of[doc] = " ".join([*words, f"end{doc}"])
    rows = [(i, t, "en", "s", len(t)) for i, t in texts_of.items()]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").coalesce(2).write.parquet(str(tmp_path / "documents.parquet"))
    for name in os.listdir(sf_dir):
        if name != "documents.parquet":
            os.symlink(f"{sf_dir}/{name}", tmp_path / name)
    sets = {i: {tuple(w[k : k + 5]) for k in range(len(w) - 4)} for i, w in ((i, t.split()) for i, t in texts_of.items())}
    ranked, stars = sorted(sets, key=lambda i: (-len(texts_of[i]), i % 30 if i % 11 else 99, i)), {}
    for n, i in enumerate(ranked):
        if i not in stars:
            stars |= {j: i for j in ranked[n + 1 :] if j not in stars and len(sets[i] & sets[j]) >= 0.85 * len(sets[i] | sets[j])}
    assert 60 < len(stars) < 120
    return str(tmp_path), stars


def test_star_merge_has_no_limit_on_common_shingles(spark, near_copies):
    found = registry.QUERIES["near_dup_star_merge"](spark, near_copies[0]).collect()
    assert len(found) == len(near_copies[1]) and {r["item_id"]: r["canonical_id"] for r in found} == near_copies[1]


def test_star_merge_takes_copies_with_their_class(spark, crowded):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{crowded}/documents.parquet").collect()}
    sets = {i: {tuple(w[k : k + 5]) for k in range(len(w) - 4)} for i, w in ((i, t.split()) for i, t in docs.items()) if len(w) >= 12}
    ranked, stars = sorted(sets, key=lambda i: (-len(docs[i]), i % 30 if i % 11 else 99, i)), {}
    for n, i in enumerate(ranked):
        if i not in stars:
            stars |= {j: i for j in ranked[n + 1 :] if j not in stars and len(sets[i] & sets[j]) >= 0.85 * len(sets[i] | sets[j])}
    found = registry.QUERIES["near_dup_star_merge"](spark, crowded).collect()
    assert len(found) == len(stars) and {r["item_id"]: r["canonical_id"] for r in found} == stars


def test_outcome_has_no_limit_on_common_shingles(spark, near_copies):
    found = registry.QUERIES["dedup_outcome"](spark, near_copies[0]).where("reason is not null").collect()
    assert {r["item_id"]: r["canonical_id"] for r in found} == near_copies[1] and {r["reason"] for r in found} == {"near"}
    assert all(r["similarity"] >= 0.85 for r in found)


def test_statistics_have_no_limit_on_common_shingles(spark, near_copies):
    row = registry.QUERIES["dedup_statistics"](spark, near_copies[0]).head()
    assert row["near_merged"] == len(near_copies[1]) and row["remaining"] == 150 - len(near_copies[1])


def test_sweep_grid_reads_the_whole_table(spark, tmp_path):
    rng, rows = np.random.default_rng(4), []
    for k, label in enumerate((0, 1, 5, None)):
        rows += [(40 * k + i, label, [float(x) for x in np.eye(4)[k] + rng.normal(0, 0.02, 4)]) for i in range(40)]
    spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>").write.parquet(str(tmp_path / "embeddings.parquet"))
    got = registry.QUERIES["sweep_grid"](spark, str(tmp_path)).collect()
    points = np.array([r[2] for r in rows], np.float32).astype(np.float64)
    points /= np.linalg.norm(points, axis=1, keepdims=True)
    assert len(got) == 3
    for r in got:
        labels = vectors.density_labels(points, r["least_size"], r["least_near"])
        sizes = np.bincount(labels[labels >= 0])
        assert (r["n_clusters"], r["noise"], r["largest"]) == (len(sizes), float((labels < 0).mean()), sizes.max() / 160)
    assert next(r["n_clusters"] for r in got if r["least_size"] == 20) == 4
