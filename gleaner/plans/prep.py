"""Raw rows to items, cleaning, deduplication in one go, and writes that keep tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from gleaner.functions import cleaning, scalars, text
from gleaner.operators import dedup as d
from gleaner.operators import items as it
from gleaner.operators import tables as t
from gleaner.plans.registry import query
from gleaner.plans.texts import _EXACT, items
from gleaner.scratch import Scratch
from gleaner.session import table
from gleaner.sources import pages

_RAW = """raw AS (SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN 'store' WHEN 1 THEN 'feed' WHEN 2 THEN 'sheet' ELSE 'community' END AS source,
  CASE WHEN doc_id % 13 = 0 THEN '' WHEN doc_id % 17 = 0 THEN '[Deleted]' ELSE trim(coalesce(text, ''), ' ') END AS body,
  CASE WHEN doc_id % 19 = 0 THEN DATE '2031-05-06' ELSE DATE '2024-01-01' + (doc_id % 28)::INT END AS day, doc_id % 7 AS score FROM documents)"""


def raw_rows(spark, sf_dir):
    """Documents as the payloads of four sources."""
    key = F.col("doc_id")
    source = F.when(key % 4 == 0, "store").when(key % 4 == 1, "feed").when(key % 4 == 2, "sheet").otherwise("community")
    body = F.when(key % 13 == 0, "").when(key % 17 == 0, "[Deleted]").otherwise(F.coalesce("text", F.lit("")))
    day = F.when(key % 19 == 0, "2031-05-06").otherwise(F.date_format(F.date_add(F.lit("2024-01-01").cast("date"), (key % 28).cast("int")), "yyyy-MM-dd"))
    score, label = (key % 7).cast("string"), lambda c: F.struct(c.alias("label"))
    payload = (
        F.when(key % 4 == 0, F.to_json(F.struct(body.alias("content"), day.alias("at"), score.alias("score"), score.alias("thumbsUpCount"), key.cast("string").alias("reviewId"))))
        .when(key % 4 == 1, F.to_json(F.struct(label(body).alias("content"), label(F.lit("A title")).alias("title"), label(day).alias("updated"), label(score).alias("im:rating"), label(score).alias("im:voteSum"))))
        .when(key % 4 == 2, F.to_json(F.struct(F.struct(body.alias("text"), day.alias("date"), score.alias("rating"), F.lit("1,200").alias("score"), F.lit("#N/A").alias("title")).alias("row"), F.lit("t1").alias("tab"))))
        .otherwise(F.to_json(F.struct(F.lit(" Ask ").alias("title"), body.alias("body"), day.alias("created_at"), score.alias("same_question_count"))))
    )
    return table(spark, sf_dir, "documents").select(
        "doc_id", F.concat(F.lit("r"), key.cast("string")).alias("raw_id"), source.alias("source"), F.when(key % 8 == 2, "ios").otherwise("web").alias("platform"), payload.alias("payload"), F.lit("2024-06-01 00:00:00").cast("timestamp").alias("fetched_at")
    )


def normalized(spark, sf_dir):
    return it.normalize(raw_rows(spark, sf_dir), F.lit("2024-06-01 00:00:00").cast("timestamp"))


_TEXT = "CASE WHEN source = 'community' AND body = '' THEN 'Ask' ELSE body END"
_SKIP = f"CASE WHEN lower({_TEXT}) = '[deleted]' THEN 'deleted' WHEN {_TEXT} = '' THEN 'no_text' END"


@query("normalize_items", f"""WITH {_RAW} SELECT 'r' || doc_id AS raw_id, left(sha256('r' || doc_id), 32) AS item_id, source, CASE source WHEN 'feed' THEN 'A title' WHEN 'community' THEN 'Ask' END AS title,
  CASE WHEN NOT (source = 'sheet' AND body = '') THEN md5({_TEXT}) END AS h, CASE WHEN day < DATE '2030-01-01' THEN strftime(day, '%Y-%m-%d') END AS day, day > DATE '2030-01-01' AS date_flag,
  CASE WHEN source IN ('store', 'feed') OR (source = 'sheet' AND doc_id % 8 = 2) THEN CASE WHEN score BETWEEN 1 AND 5 THEN score::INT END END AS rating,
  CASE source WHEN 'store' THEN 'thumbs_up=' || score WHEN 'feed' THEN 'vote_sum=' || score WHEN 'sheet' THEN 'upvotes=1200' ELSE 'same_question=' || score END AS engagement, {_SKIP} AS skipped FROM raw""")
def normalize_items(spark, sf_dir):
    own = normalized(spark, sf_dir)
    listed = F.array_join(F.transform(F.map_entries("engagement"), lambda e: F.concat_ws("=", e["key"], e["value"].cast("string"))), ",")
    return own.select("raw_id", "item_id", "source", "title", F.md5("text").alias("h"), F.date_format("date", "yyyy-MM-dd").alias("day"), "date_flag", "rating", listed.alias("engagement"), "skipped")


@query("skip_reasons", f"WITH {_RAW} SELECT source, {_SKIP} AS reason, count(*) AS n FROM raw WHERE {_SKIP} IS NOT NULL GROUP BY 1, 2")
def skip_reasons(spark, sf_dir):
    return it.skip_counts(normalized(spark, sf_dir))


@query("metadata_keys", f"""WITH {_RAW} SELECT 'r' || doc_id AS raw_id, CASE source WHEN 'store' THEN 'review_id' WHEN 'feed' THEN '' WHEN 'sheet' THEN 'sheet_tab' ELSE CASE WHEN body = '' THEN 'title_only' ELSE '' END END AS keys FROM raw""")
def metadata_keys(spark, sf_dir):
    """What is left of the metadata without its empty values."""
    return normalized(spark, sf_dir).select("raw_id", F.array_join(F.array_sort(F.map_keys("metadata")), ",").alias("keys"))


@query("raw_of_source", f"WITH {_RAW} SELECT doc_id FROM raw WHERE source = 'sheet' AND doc_id % 3 = 0")
def raw_of_source(spark, sf_dir):
    own = raw_rows(spark, sf_dir)
    return it.raw_by_id(own, "sheet", own.where("doc_id % 3 = 0")).select("doc_id")


@query("eligible_work", "SELECT doc_id AS item_id FROM documents WHERE n_chars >= 400 AND doc_id % 97 <> 0 ORDER BY 1 LIMIT 25")
def eligible_work(spark, sf_dir):
    own = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("item_id"), (F.col("n_chars") >= 400).alias("eligible"), (F.col("doc_id") % 97 == 0).alias("is_spam"))
    return it.work_items(own, 25).select("item_id")


@query("scraped_pages", "SELECT page_id, CASE WHEN page_id % 5 = 0 THEN 'Just a moment' ELSE 'Page ' || page_id END AS title, url, CASE WHEN page_id % 3 = 0 THEN '2024-02-03' END AS published, 'Body ' || page_id AS body, page_id % 5 = 0 AS blocked FROM pages WHERE page_id % 2 = 0 AND url IS NOT NULL AND regexp_full_match(url, '\\S+')")
def scraped_pages(spark, sf_dir):
    p = table(spark, sf_dir, "pages").where(F.col("url").rlike("^\\S+$"))
    key = F.col("page_id").cast("string")
    title = F.when(F.col("page_id") % 5 == 0, "Just a moment").otherwise(F.concat(F.lit("Page "), key))
    head = F.when(F.col("page_id") % 3 == 0, "Published Time: 2024-02-03\n").otherwise("")
    captured = F.when(F.col("page_id") % 2 == 0, F.concat(F.lit("Title: "), title, F.lit("\n\nURL Source: "), "url", F.lit("\n\n"), head, F.lit("Markdown Content:\nBody "), key, F.lit("\n"))).otherwise(F.lit("plain"))
    return p.select("page_id", pages.scraped_page(captured).alias("s")).where("s is not null").select("page_id", "s.*")


RULES = cleaning.Rules(keywords=("idiot", "of that"), least_words=20, most_chars=600, head_chars=400)


@query("clean_records")
def clean_records(spark, sf_dir):
    """The whole record of each document (no SQL twin: Unicode names and entities)."""
    return table(spark, sf_dir, "documents").select("doc_id", cleaning.clean_record(F.col("text"), RULES).alias("r")).select("doc_id", "r.*")


@query("prep_report")
def prep_report(spark, sf_dir):
    """Documents by language and by reason of exclusion, and how much was redacted."""
    own = clean_records(spark, sf_dir)
    return own.groupBy("language", F.coalesce("exclude_reason", F.lit("eligible")).alias("outcome")).agg(F.count("*").alias("n"), F.sum("n_redacted").alias("n_redacted"))


@query("username_scrub", """SELECT event_id, '{"keep":{"n":' || (event_id % 5) || '},"list":[{},5]}' AS metadata, 'u' || user_id || ',x' AS removed FROM events""")
def username_scrub(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    raw = F.concat(F.lit('{"User":"u'), F.col("user_id").cast("string"), F.lit('","keep":{"author":" x ","n":'), (F.col("event_id") % 5).cast("string"), F.lit('},"list":[{"handle":7},5]}'))
    return e.select("event_id", cleaning.scrubbed(raw).alias("s")).select("event_id", "s.metadata", F.array_join("s.removed", ",").alias("removed"))


_CELL = "CASE WHEN regexp_matches(v, '^[=+@-]') THEN '''' || v ELSE v END"


@query("export_cells", f"""WITH c AS (SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN '=1+' || doc_id WHEN 1 THEN '-x' WHEN 2 THEN '' ELSE lang || '_' || 'near-by' END AS v, coalesce(text, '') AS text FROM documents)
  SELECT doc_id, {_CELL} AS cell, greatest(1, floor(length(text) / 4))::BIGINT AS tokens, CASE WHEN doc_id % 4 = 3 THEN upper(left(v, 1)) || substr(v, 2, 2) || 'Near By' END AS title FROM c""")
def export_cells(spark, sf_dir):
    key = F.col("doc_id") % 4
    named = F.concat("lang", F.lit("_near-by"))
    value = F.when(key == 0, F.concat(F.lit("=1+"), F.col("doc_id").cast("string"))).when(key == 1, "-x").when(key == 2, None).otherwise(named)
    title = F.regexp_replace(F.when(key == 3, text.titleize(named)), "^(..) ", "$1_")
    return table(spark, sf_dir, "documents").select("doc_id", text.spreadsheet_cell(value).alias("cell"), text.estimate_tokens(F.coalesce("text", F.lit(""))).alias("tokens"), F.regexp_replace(title, "_", "_").alias("title"))


@query("normalized_cues", r"""WITH c AS (SELECT conv_id, turn, regexp_replace(lower('My the "' || coalesce(text, '') || '"!! '), '\s+', ' ', 'g') AS v FROM conversations)
  SELECT conv_id, turn, md5(regexp_replace(regexp_replace(v, '[\s"''.,;:!?()\[\]]+$', ''), '^(?:[\s"''.,;:!?()\[\]]+|(?:my|the|a|an|some|that|this)\s+)+', '')) AS cue FROM c""")
def normalized_cues(spark, sf_dir):
    raw = F.concat(F.lit('My the "'), F.coalesce("text", F.lit("")), F.lit('"!! '))
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", F.md5(text.normalize_cue(raw)).alias("cue"))


@query("redacted_names", "SELECT doc_id, 'my ' || CASE doc_id % 3 WHEN 0 THEN 'mom [name]' WHEN 1 THEN 'car Priya' ELSE 'colleague [name]' END || ' and Our uncle [name] ' || lang AS text FROM documents")
def redacted_names(spark, sf_dir):
    who = F.when(F.col("doc_id") % 3 == 0, "mom Priya").when(F.col("doc_id") % 3 == 1, "car Priya").otherwise("colleague Raj")
    return table(spark, sf_dir, "documents").select("doc_id", text.redact_names(F.concat(F.lit("my "), who, F.lit(" and Our uncle Sam "), "lang")).alias("text"))


@query("merge_reasons", f"""WITH RECURSIVE {_EXACT}, m AS (SELECT c.item_id, c.canonical_id, a.folded = b.folded AS same, a.external_id = b.external_id AS shared FROM can c JOIN it a ON a.item_id = c.item_id JOIN it b ON b.item_id = c.canonical_id WHERE c.item_id <> c.canonical_id)
  SELECT item_id, canonical_id, CASE WHEN shared THEN 'review_id' WHEN same THEN 'exact' ELSE 'review_id' END AS reason FROM m""")
def merge_reasons(spark, sf_dir):
    own = items(spark, sf_dir)
    return d.merge_reasons(own, d.canonical(own, d.exact_groups(own, Scratch(spark, "exact"))))


@query("earliest_dates", f"WITH RECURSIVE {_EXACT} SELECT canonical_id, strftime(min(day), '%Y-%m-%d') AS earliest FROM can JOIN it USING (item_id) GROUP BY 1")
def earliest_dates(spark, sf_dir):
    """The first day of each group of exact copies, for the one that stays."""
    own = items(spark, sf_dir)
    merged = d.canonical(own, d.exact_groups(own, Scratch(spark, "exact")))
    return own.select("item_id", "day").join(merged, "item_id").groupBy("canonical_id").agg(F.date_format(F.min("day"), "yyyy-MM-dd").alias("earliest"))


def _outcome(spark, sf_dir):
    own = items(spark, sf_dir).withColumn("has_keyword", text.phrase_match(F.col("text"), ["idiot"]))
    return d.deduplicate(own, Scratch(spark, "dedup"), authors=2)


@query("dedup_outcome")
def dedup_outcome(spark, sf_dir):
    """All merges, dates, spam and counts in one (no SQL twin: stars are sequential)."""
    return _outcome(spark, sf_dir)


@query("dedup_statistics")
def dedup_statistics(spark, sf_dir):
    return d.statistics(_outcome(spark, sf_dir))


_STORED = "s AS (SELECT doc_id, md5(text) AS h, lang FROM documents WHERE doc_id % 3 <> 0), b AS (SELECT doc_id, md5(CASE WHEN doc_id % 5 = 0 THEN text || '!' ELSE text END) AS h FROM documents WHERE doc_id % 4 <> 1)"


@query("upserted_items", f"""WITH {_STORED}, m AS (SELECT coalesce(s.doc_id, b.doc_id) AS doc_id, s.h AS old, b.h AS new, lang, s.doc_id IS NULL AS is_new, b.doc_id IS NULL AS kept FROM s FULL JOIN b ON s.doc_id = b.doc_id)
  SELECT doc_id, coalesce(new, old) AS h, CASE WHEN is_new OR (NOT kept AND old <> new) THEN NULL ELSE lang END AS lang, CASE WHEN is_new THEN 'new' WHEN kept THEN 'kept' WHEN old IS NOT DISTINCT FROM new THEN 'unchanged' ELSE 'updated' END AS change,
  CASE WHEN is_new THEN 0 WHEN kept OR old IS NOT DISTINCT FROM new THEN 5 ELSE 5 END::INT AS n_history, CASE WHEN NOT is_new AND NOT kept AND old <> new THEN '{{"h":"' || old || '"}}' WHEN NOT is_new THEN '5' END AS last FROM m""")
def upserted_items(spark, sf_dir):
    """The table after a batch, written and read back; five entries of history before it."""
    docs = table(spark, sf_dir, "documents")
    five = F.transform(F.sequence(F.lit(1), F.lit(5)), lambda i: i.cast("string"))
    stored = docs.where("doc_id % 3 != 0").select("doc_id", F.md5("text").alias("h"), "lang", five.alias("history"))
    batch = docs.where("doc_id % 4 != 1").select("doc_id", F.md5(F.when(F.col("doc_id") % 5 == 0, F.concat("text", F.lit("!"))).otherwise(F.col("text"))).alias("h"), F.lit(1).alias("seq"))
    after = Scratch(spark, "upsert").write(t.upsert_items(stored, batch, "doc_id", ["h"], "seq", ["lang"]), "items")
    return after.select("doc_id", "h", "lang", "change", F.size("history").alias("n_history"), F.try_element_at("history", F.lit(-1)).alias("last"))


@query("replaced_rows", "SELECT doc_id, CASE WHEN doc_id % 5 = 0 THEN 'new' ELSE 'old' END AS v FROM documents WHERE doc_id % 2 = 0 OR doc_id % 5 = 0")
def replaced_rows(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id")
    return t.replace_rows(docs.where("doc_id % 2 = 0").withColumn("v", F.lit("old")), docs.where("doc_id % 5 = 0").withColumn("v", F.lit("new")), "doc_id")


@query("in_scope_only", "SELECT doc_id FROM documents WHERE doc_id IN (SELECT doc_id FROM labels WHERE quality = 1)")
def in_scope_only(spark, sf_dir):
    return t.only_in_scope(table(spark, sf_dir, "documents").select("doc_id"), table(spark, sf_dir, "labels").where("quality = 1"), "doc_id")


@query("prep_update", "SELECT d.doc_id, lang, coalesce(quality, -1) AS quality, l.doc_id IS NOT NULL AS updated FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id")
def prep_update(spark, sf_dir):
    """Outputs of preparation set on all items by one join."""
    out = table(spark, sf_dir, "labels").select("doc_id", "quality", F.lit(True).alias("_hit"))
    return table(spark, sf_dir, "documents").join(out, "doc_id", "left").select("doc_id", "lang", F.coalesce("quality", F.lit(-1)).alias("quality"), F.coalesce("_hit", F.lit(False)).alias("updated"))


@query("replaced_run", "SELECT 'r1' AS run_id, source, count(*) AS n FROM documents GROUP BY 2 UNION ALL SELECT 'r2', lang, count(*) FROM documents WHERE doc_id % 2 = 0 GROUP BY 2")
def replaced_run(spark, sf_dir):
    """Two runs are written, the second one twice: its rows are replaced, the first's stay."""
    path = Scratch(spark, "runs").place("scores")
    counts = lambda df, by: df.groupBy(F.col(by).alias("source")).agg(F.count("*").alias("n"))
    docs = table(spark, sf_dir, "documents")
    for run, rows in (("r1", counts(docs, "source")), ("r2", counts(docs, "source")), ("r2", counts(docs.where("doc_id % 2 = 0"), "lang"))):
        t.write_run(rows, path, run)
    return spark.read.schema("source string, n long, run_id string").parquet(path).select("run_id", "source", "n")


@query("snapshot_lines", "SELECT source, 'r' || (doc_id % 2) AS run_id, count(*) AS n FROM documents GROUP BY 1, 2")
def snapshot_lines(spark, sf_dir):
    path, docs = Scratch(spark, "snapshot").place("raw"), table(spark, sf_dir, "documents").select("doc_id", "text", F.col("source").alias("of"))
    for run in (0, 1):
        t.append_snapshot(docs.where(F.col("doc_id") % 2 == run).select("doc_id", "text", "of"), path, "docs", f"r{run}")
    lines = spark.read.schema("doc_id long, text string, of string, source string, run_id string").json(path)
    return lines.groupBy(F.col("of").alias("source"), "run_id").agg(F.count("*").alias("n"))


@query("inserted_vectors", "SELECT vec_id, CASE WHEN vec_id % 2 = 0 THEN 'old' ELSE 'new' END AS model FROM embeddings WHERE vec_id % 2 = 0 OR vec_id % 3 = 0")
def inserted_vectors(spark, sf_dir):
    own = table(spark, sf_dir, "embeddings").select("vec_id")
    fresh = own.where("vec_id % 3 = 0").union(own.where("vec_id % 9 = 0")).withColumn("model", F.lit("new"))
    return t.insert_absent(own.where("vec_id % 2 = 0").withColumn("model", F.lit("old")), fresh, ["vec_id"])


@query("repointed_sources", "SELECT conv_id, turn, CASE WHEN conv_id % 5 = 1 THEN conv_id - 1 ELSE conv_id END AS item_id FROM conversations")
def repointed_sources(spark, sf_dir):
    """Bridge rows of merged items follow them to the one that stays."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", F.col("conv_id").alias("item_id"))
    gone = turns.where("item_id % 5 = 1").select("item_id", (F.col("item_id") - 1).alias("canonical_id")).distinct()
    return t.repoint(turns, gone)


@query("children_of_survivors", "SELECT conv_id, turn FROM conversations WHERE conv_id % 5 <> 1")
def children_of_survivors(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn")
    return t.without_parents(turns, turns.where("conv_id % 5 = 1"), "conv_id")


@query("purged_raw", "SELECT event_type, count_if(ts < (SELECT max(ts) FROM events) - INTERVAL 10 DAY)::BIGINT AS purged, count_if(ts >= (SELECT max(ts) FROM events) - INTERVAL 10 DAY)::BIGINT AS kept FROM events GROUP BY 1")
def purged_raw(spark, sf_dir):
    """A dry run of the purge of raw rows by age."""
    e = table(spark, sf_dir, "events")
    cutoff = e.agg(F.max("ts").alias("m")).select((F.col("m") - F.expr("interval 10 days")).alias("cutoff"))
    old = F.col("ts") < F.col("cutoff")
    return e.join(cutoff).groupBy("event_type").agg(F.count_if(old).alias("purged"), F.count_if(~old).alias("kept"))


@query("published_pointer", "SELECT 'run-1' AS run_id, '2024-02-01' AS day")
def published_pointer(spark, sf_dir):
    """Moved twice and restored: the last move counts."""
    path = Scratch(spark, "pointer").place("published")
    for run, day in (("run-1", "2024-01-01"), ("run-2", "2024-01-15"), ("run-1", "2024-02-01")):
        t.publish(spark, path, run, f"{day} 00:00:00")
    return t.published(spark, path).select("run_id", F.date_format("published_at", "yyyy-MM-dd").alias("day"))


@query("content_change", "SELECT doc_id, sha256(regexp_replace(trim(lower(text)), '\\s+', ' ', 'g')) <> sha256(regexp_replace(trim(lower(text || CASE WHEN doc_id % 5 = 0 THEN ' x' ELSE '  ' END)), '\\s+', ' ', 'g')) AS changed FROM documents WHERE text IS NOT NULL")
def content_change(spark, sf_dir):
    """Whether a text changed but for case and spaces."""
    now = F.concat("text", F.when(F.col("doc_id") % 5 == 0, " x").otherwise("  "))
    return table(spark, sf_dir, "documents").where("text is not null").select("doc_id", (scalars.content_hash(F.col("text")) != scalars.content_hash(now)).alias("changed"))
