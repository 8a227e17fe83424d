"""Nulls, empty and long texts, repeated rows, empty tables and clashing columns
through every operator and every stage of the pipeline."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from gleaner.llm import chat, contamination, importance, mixing, passages, quality_rules, simhash, toxicity, urls, warc
from gleaner.scratch import Scratch

DOCS = "doc_id long, text string, lang string, source string, n_chars long, key string, fp string, d int, copy int, size string, rk int, label int"
WORDS = "the of and to a in is that for it was on are as with his they at be this from have or by one had not but what all were when we there can an your which".split()


def prose(seed, n):
    out, state = [], seed * 7919 + 1
    for _ in range(n):
        state = (state * 1103515245 + 12345) % 2**31
        out.append(WORDS[state // 65536 % len(WORDS)] + str(state // 4096 % 50))
    return " ".join(out)


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, prose(i, 60 + i), "en", f"s{i % 3}") for i in range(20)]
    rows += [(None, prose(99, 80), None, None), (None, None, None, None), (31, None, "en", "s1"), (32, "", "en", "s1"), (33, " \n\t ", "en", None), (34, prose(5, 30_000), "en", "s0")]
    rows += [(35, prose(3, 63), "en", "s0"), (3, prose(3, 63), "en", "s0"), (3, prose(3, 63), "en", "s0"), (36, "x", "en", "s2"), (37, "!!! ??? ***", "en", "s2")]
    full = [(*r, len(r[1]) if r[1] is not None else None, "k", "f", 1, 2, "s", 3, 1) for r in rows]
    return spark.createDataFrame(full, DOCS)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(i, 1, 0) for i in range(10)] + [(37, 0, 1), (36, 0, 0), (None, 1, 1), (5, None, None), (1, 1, 0)], "doc_id long, quality int, toxic int")


def operators(labels, items):
    return {
        "op1": quality_rules.judge,
        "op2": mixing.mix,
        "op4": passages.repeated_spans,
        "op5": lambda d: toxicity.severity(d, labels),
        "op6": lambda d: importance.resample(d, labels),
        "op7": simhash.simhash_groups,
        "op9": lambda d: contamination.contained_items(d, items),
    }


@pytest.mark.parametrize("name", ["op1", "op2", "op4", "op5", "op6", "op7", "op9"])
def test_documents(spark, docs, labels, name):
    items = docs.where("doc_id = 3 or doc_id in (31, 32, 36)").select(F.col("doc_id").alias("item_id"), "text")
    run = operators(labels, items)[name]
    got = run(docs).collect()
    if name in ("op1", "op2", "op5", "op6", "op7"):
        assert sorted(str(r["doc_id"]) for r in got) == sorted(str(r["doc_id"]) for r in docs.select("doc_id").collect())
    elif name == "op9":
        assert {(r["doc_id"], r["item_id"]) for r in got} == {(3, 3), (35, 3)} and all(r["containment"] == 1 for r in got)
    else:
        assert {(r["doc_id"], r["first_doc"]) for r in got} >= {(35, 3)}
    assert run(docs.limit(0)).count() == 0


def test_defined_values(docs, labels):
    rules = {(r["doc_id"], r["n_words"]): r for r in quality_rules.judge(docs).collect()}
    for key in ((31, 0), (32, 0), (33, 0), (None, 0)):
        assert rules[key]["base_failed"] and not rules[key]["kept"]
    prints = [(r["doc_id"], r["fingerprint"], r["component_id"]) for r in simhash.simhash_groups(docs).collect()]
    assert {p[1] for p in prints if p[0] in (31, 32, 33)} == {"0" * 16} and {p[2] for p in prints if p[0] in (31, 32, 33)} == {31}
    assert {p[2] for p in prints if p[0] in (3, 35)} == {3}
    assert (None, "0" * 16, 31) in prints
    mixed = mixing.mix(docs).collect()
    assert all(r["taken"] == 0 and r["size"] == 0 for r in mixed if r["doc_id"] in (31, 32, 33))
    assert all(r["taken"] <= 3 * r["size"] for r in mixed)


def test_pipeline_stages(spark, docs, labels, tmp_path):
    items = spark.createDataFrame([(1, prose(7, 67)), (2, None), (None, "too short")], "item_id long, text string")
    for frame, name in ((labels, "labels"), (items, "benchmark"), (docs, "documents")):
        frame.write.parquet(f"{tmp_path}/{name}.parquet")
    now, scratch = docs, Scratch(spark, "t")
    for name, stage in corpus_pipeline.STAGES:
        now = scratch.write(stage(spark, now, str(tmp_path)), name)
        kept = now.columns if name != "mixture" else [c for c in now.columns if c != "copy"]
        assert kept == [c for c in docs.columns if name != "mixture" or c != "copy"], name
        ids = [r["doc_id"] for r in now.select("doc_id").collect()]
        if name == "near_duplicates":
            assert ids.count(3) == 1 and 35 not in ids and len([i for i in ids if i in (31, 32, 33)]) <= 1
        if name == "decontaminate":
            assert 7 not in ids and 8 in ids
    assert corpus_pipeline.run(spark, str(tmp_path)).count() > 0
    assert len(corpus_pipeline.STAGES) == 5 and corpus_pipeline.ORACLE_SQL is None


def test_pipeline_of_nothing(spark, docs, labels, tmp_path):
    for frame, name in ((labels.limit(0), "labels"), (docs.select(F.col("doc_id").alias("item_id"), "text").limit(0), "benchmark"), (docs.limit(0), "documents")):
        frame.write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_conversations(spark):
    schema = "conv_id long, turn long, role string, text string, n int, part string"
    rows = [(1, 0, "user", "Where is it?", 1, "x"), (1, 1, "assistant", "Here.\nAnd there.", 1, "x"), (1, 1, "assistant", "Here.\nAnd there.", 1, "x"), (None, None, None, None, 1, "x"), (None, 0, "user", "alone", 1, "x"), (2, None, "user", None, 1, "x"), (2, 0, "bogus", "", 1, "x")]
    rows += [(3, 0, "user", f"same number {i}", 1, "x") for i in range(300)]
    df = spark.createDataFrame(rows, schema)
    raw = chat.build_transcripts(df)
    model = chat.fit(raw)
    got = chat.parse_transcripts(raw, model, ["conv_id"], truth=F.col("truth")).collect()
    assert sum(r["n_turns"] > 0 for r in got) == len(got) and sum(r["conv_id"] is None for r in got) == 2
    assert max(r["n_lines"] for r in got) < 300
    assert chat.build_transcripts(df.limit(0)).count() == 0
    assert chat.parse(None, model)[0] == [] and chat.render([]) == "" and chat.parse("", model)[0] == []


def test_pages(spark):
    schema = "page_id long, url string, html string, host string, path string, verdict string, original int, payload string"
    rows = [(1, "http://A.example.NET/en/x?q#f", "<p>a</p>" * 200), (2, None, None), (None, "no scheme", ""), (3, "http://casino-win.example.com", "<p>a</p>" * 200), (3, "x://[?/y", "\r\n\r\nWARC/1.1\r\n" * 200), (None, "http://", "<p>a</p>" * 200), (4, "", "é" * 600)]
    df = spark.createDataFrame([(*r, "h", "p", "v", 1, "q") for r in rows], schema)
    judged = urls.judge_urls(df).collect()
    assert len(judged) == 7
    by = {(r["page_id"], r["host"]): r for r in judged}
    assert (by[1, "a.example.net"]["rule"], by[1, "a.example.net"]["path"], by[1, "a.example.net"]["verdict"]) == ("example.net/en/", "/en/x", "allow")
    assert by[2, ""]["verdict"] == "allow" and by[2, ""]["rule"] is None and by[3, "casino-win.example.com"]["verdict"] == "block"
    assert urls.judge_urls(df.limit(0)).count() == 0
    for frame in (df, df.limit(0)):
        scratch = Scratch(spark, "t")
        path = scratch.place("archives")
        warc.write_archives(frame, path, scratch)
        got = sorted(((r["page_id"], r["payload_bytes"], r["record_type"], r["refers_to"]) for r in warc.resolve_revisits(warc.read_archives(spark, path), scratch).collect()), key=str)
        if frame is df:
            assert got == sorted([(1, 1600, "revisit", 3), (2, 0, "response", None), (None, 0, "response", None), (3, 1600, "response", None), (3, 2800, "response", None), (None, 1600, "revisit", 3), (4, 1200, "response", None)], key=str)
        else:
            assert got == []
