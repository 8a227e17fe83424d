"""Cleaning, redaction, language, eligibility, hashes, dates and deduplication."""

from __future__ import annotations

from pyspark.sql import functions as F

from gleaner.functions import python_text, scalars, text
from gleaner.operators import dedup as d
from gleaner.plans.registry import query
from gleaner.scratch import Scratch
from gleaner.session import table

_FOLD = r"trim(regexp_replace(regexp_replace(translate(lower(text), '’‘`', ''''''''), '[^\p{L}\p{Mn}\p{Nd}\p{Pc}\s'']', ' ', 'g'), '\s+', ' ', 'g'))"
_ITEMS = rf"""it0 AS (SELECT doc_id AS item_id, coalesce(text, '') AS text, source, {_FOLD} AS folded,
  CASE WHEN doc_id % 7 <> 0 THEN doc_id % 40 END AS author, CASE WHEN doc_id % 11 <> 0 THEN DATE '2024-01-01' + (doc_id % 30)::INT END AS day,
  CASE WHEN doc_id % 17 = 0 THEN doc_id // 34 END AS external_id FROM documents),
it AS (SELECT *, CASE WHEN folded = '' THEN 0 ELSE len(string_split(folded, ' ')) END AS n_words FROM it0)"""


def items(spark, sf_dir):
    key = F.col("doc_id")
    own = table(spark, sf_dir, "documents").select(
        key.alias("item_id"), F.coalesce("text", F.lit("")).alias("text"), "source", F.when(key % 7 != 0, key % 40).alias("author"),
        F.when(key % 11 != 0, F.date_add(F.lit("2024-01-01").cast("date"), (key % 30).cast("int"))).alias("day"), F.when(key % 17 == 0, F.floor(key / 34)).alias("external_id"),
    )
    own = own.withColumn("folded", d.folded(F.col("text"))).withColumn("words", F.split("folded", " "))
    return own.withColumn("n_words", F.when(F.col("folded") == "", 0).otherwise(F.size("words")).cast("long"))


@query("normalize_dedup", f"SELECT doc_id, md5({_FOLD}) AS h, CASE WHEN {_FOLD} = '' THEN 0 ELSE len(string_split({_FOLD}, ' ')) END AS n FROM documents")
def normalize_dedup(spark, sf_dir):
    folded = d.folded(F.col("text"))
    n = F.when(folded == "", 0).otherwise(F.size(F.split(folded, " "))).cast("long")
    return table(spark, sf_dir, "documents").select("doc_id", F.md5(folded).alias("h"), n.alias("n"))


@query("pii_counts", r"""SELECT doc_id, len(regexp_extract_all(text, '[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}')) AS n_emails, len(regexp_extract_all(text, '(?i)(?:https?://|www\.)\S+')) AS n_urls,
  len(regexp_extract_all(text, '\b\d{4}[\s-]\d{4}[\s-]\d{4}\b')) + len(regexp_extract_all(regexp_replace(text, '\d{13,}', ' ', 'g'), '\d{12}')) + len(regexp_extract_all(text, '\b[A-Z][0-9]{7}\b')) AS n_ids FROM documents""")
def pii_counts(spark, sf_dir):
    count = lambda p: F.regexp_count("text", F.lit(p)).cast("long")
    return table(spark, sf_dir, "documents").select("doc_id", count(text.EMAIL).alias("n_emails"), count(text.URL).alias("n_urls"), (count(text.GROUPED_ID) + count(text.BARE_ID) + count(text.PASSPORT)).alias("n_ids"))


_PHRASES = ["the", "of that", "idiot", "worthless"]


@query("phrase_match", r"SELECT doc_id, regexp_matches(lower(text), '(^|[^\p{L}\p{Mn}\p{Nd}\p{Pc}])(of that|worthless|idiot|the)($|[^\p{L}\p{Mn}\p{Nd}\p{Pc}])') AS hit FROM documents WHERE text IS NOT NULL")
def phrase_match(spark, sf_dir):
    return table(spark, sf_dir, "documents").where("text is not null").select("doc_id", text.phrase_match(F.col("text"), _PHRASES).alias("hit"))


def _lang_sql() -> str:
    hits = ", ".join("(SELECT count(*) FROM unnest(w) u(x) WHERE x IN (" + ", ".join(repr(x) for x in known) + f")) AS {lang}" for lang, known in text.FUNCTION_WORDS.items())
    return rf"""w AS (SELECT doc_id, text, string_split(trim(regexp_replace(lower(coalesce(text, '')), '[^\p{{L}}\p{{N}}]+', ' ', 'g')), ' ') AS w FROM documents),
  h AS (SELECT doc_id, text, w, {hits} FROM w),
  g AS (SELECT doc_id, text, (SELECT count(*) FROM unnest(w) u(x) WHERE x <> '') AS n, CASE WHEN greatest(de, en, es, fr) = 0 THEN NULL WHEN de = greatest(de, en, es, fr) THEN 'de' WHEN en = greatest(de, en, es, fr) THEN 'en' WHEN es = greatest(de, en, es, fr) THEN 'es' ELSE 'fr' END AS guess FROM h)"""


@query("language_guess", f"WITH {_lang_sql()} SELECT doc_id, guess FROM g")
def language_guess(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", text.language_guess(F.col("text")).alias("guess"))


@query("eligibility", rf"""WITH {_lang_sql()} SELECT doc_id, CASE WHEN NOT regexp_matches(coalesce(text, ''), '[\p{{L}}\p{{N}}]') THEN 'emoji_only' WHEN guess IS NULL OR guess <> 'en' THEN 'language'
  WHEN n < 40 AND NOT regexp_matches(lower(text), '(^|[^\p{{L}}\p{{Mn}}\p{{Nd}}\p{{Pc}}])(idiot)($|[^\p{{L}}\p{{Mn}}\p{{Nd}}\p{{Pc}}])') THEN 'min_words' END AS reason FROM g""")
def eligibility(spark, sf_dir):
    own = table(spark, sf_dir, "documents").withColumn("guess", text.language_guess(F.col("text")))
    reason = text.eligibility(F.col("text"), F.col("guess"), 40, text.phrase_match(F.col("text"), ["idiot"]))
    return own.select("doc_id", reason.alias("reason"))


@query("clean_text")
def clean_text(spark, sf_dir):
    """Markup, emoji and phones in one Arrow pass, the fixed patterns natively."""
    own = table(spark, sf_dir, "pages").select("page_id", python_text.clean_text("html").alias("c"))
    redacted, n = text.redact(F.col("c.clean"))
    return own.select("page_id", text.normalize_space(redacted).alias("clean"), (n + F.col("c.n_phones")).alias("n_redacted"))


@query("item_hashes", "SELECT doc_id, left(sha256('src:' || doc_id), 32) AS item_id, 'oa-' || left(sha256('area' || doc_id), 8) AS area_id, left(sha256('salt:user' || (doc_id % 9)), 16) AS author FROM documents")
def item_hashes(spark, sf_dir):
    key = F.col("doc_id").cast("string")
    return table(spark, sf_dir, "documents").select(
        "doc_id", scalars.item_id(F.concat(F.lit("src:"), key)).alias("item_id"), scalars.area_id(F.concat(F.lit("area"), key)).alias("area_id"),
        scalars.author_hash(F.concat(F.lit(" User"), (F.col("doc_id") % 9).cast("string"), F.lit(" ")), "salt").alias("author"),
    )


@query("content_hash", r"SELECT doc_id, sha256(regexp_replace(trim(lower(text)), '\s+', ' ', 'g')) AS h FROM documents")
def content_hash(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", scalars.content_hash(F.col("text")).alias("h"))


@query("rating_coerce", "SELECT o_orderkey, CASE WHEN try_cast(left(o_orderpriority, 1) AS INT) * (1 + o_orderkey % 3) BETWEEN 1 AND 5 THEN (try_cast(left(o_orderpriority, 1) AS INT) * (1 + o_orderkey % 3))::INT END AS rating FROM orders")
def rating_coerce(spark, sf_dir):
    raw = F.concat((F.substring("o_orderpriority", 1, 1).cast("int") * (1 + F.col("o_orderkey") % 3)).cast("string"), F.lit(".0"))
    return table(spark, sf_dir, "orders").select("o_orderkey", scalars.rating(raw).alias("rating"))


@query("json_props", "SELECT event_type, count(*) AS n, sum(json_extract_string(props, '$.k')::BIGINT)::BIGINT AS k FROM events GROUP BY 1")
def json_props(spark, sf_dir):
    k = F.from_json("props", "k long")["k"]
    return table(spark, sf_dir, "events").groupBy("event_type").agg(F.count("*").alias("n"), F.sum(k).alias("k"))


@query("parse_dates", """SELECT event_id, strftime(ts, '%Y-%m-%d') AS day, CASE event_id % 4 WHEN 0 THEN 'exact' ELSE 'day' END AS how FROM events""")
def parse_dates(spark, sf_dir):
    """Dates written in four ways, read back by one parser."""
    e = table(spark, sf_dir, "events")
    kind = F.col("event_id") % 4
    written = F.when(kind == 0, F.unix_seconds(F.date_trunc("second", "ts")).cast("string")).when(kind == 1, F.date_format("ts", "dd/MM/yyyy")).when(kind == 2, F.date_format("ts", "MMM d, yyyy")).otherwise(F.date_format("ts", "yyyy-MM-dd"))
    at, how = scalars.loose_date(written, F.lit("2024-06-01 00:00:00").cast("timestamp"))
    return e.select("event_id", F.date_format(at, "yyyy-MM-dd").alias("day"), how.alias("how"))


_EXACT = f"""{_ITEMS}, keyed AS (
  SELECT item_id, 't:' || folded AS k FROM it WHERE n_words >= 12
  UNION ALL SELECT item_id, 's:' || folded || ':' || author || ':' || source FROM it WHERE n_words < 12 AND author IS NOT NULL AND folded <> ''
  UNION ALL SELECT item_id, 'x:' || external_id FROM it WHERE external_id IS NOT NULL),
e AS (SELECT a.item_id AS x, b.item_id AS y FROM keyed a JOIN keyed b ON a.k = b.k),
reach AS (SELECT item_id AS a, item_id AS b FROM it UNION SELECT r.a, e.y FROM reach r JOIN e ON r.b = e.x),
grp AS (SELECT a AS item_id, min(b) AS grp FROM reach GROUP BY 1),
can AS (SELECT g.item_id, grp, first_value(g.item_id) OVER (PARTITION BY grp ORDER BY length(text) DESC, day NULLS LAST, g.item_id) AS canonical_id FROM grp g JOIN it USING (item_id))"""


@query("exact_dup_groups", f"WITH RECURSIVE {_EXACT} SELECT grp, count(*) AS n FROM grp GROUP BY 1 HAVING count(*) > 1")
def exact_dup_groups(spark, sf_dir):
    groups = d.exact_groups(items(spark, sf_dir), Scratch(spark, "exact"))
    return groups.groupBy("grp").agg(F.count("*").alias("n")).where("n > 1")


@query("connected_components", f"WITH RECURSIVE {_EXACT} SELECT item_id, grp FROM grp")
def connected_components(spark, sf_dir):
    return d.exact_groups(items(spark, sf_dir), Scratch(spark, "exact"))


@query("canonical_pick", f"WITH RECURSIVE {_EXACT} SELECT item_id, canonical_id FROM can")
def canonical_pick(spark, sf_dir):
    own = items(spark, sf_dir)
    return d.canonical(own, d.exact_groups(own, Scratch(spark, "exact"))).select("item_id", "canonical_id")


@query("dropped_to_canonical", f"WITH RECURSIVE {_EXACT} SELECT item_id, canonical_id FROM can WHERE item_id <> canonical_id")
def dropped_to_canonical(spark, sf_dir):
    own = items(spark, sf_dir)
    return d.canonical(own, d.exact_groups(own, Scratch(spark, "exact"))).where("not is_canonical").select("item_id", "canonical_id")


@query("spam_texts", f"WITH {_ITEMS} SELECT md5(folded) AS h, count(DISTINCT coalesce(author::VARCHAR, '#' || item_id)) AS n_authors FROM it WHERE folded <> '' GROUP BY folded HAVING count(DISTINCT coalesce(author::VARCHAR, '#' || item_id)) >= 2")
def spam_texts(spark, sf_dir):
    return d.spam_texts(items(spark, sf_dir), 2).select(F.md5("folded").alias("h"), "n_authors")


@query("short_text_similar_count", f"WITH {_ITEMS} SELECT item_id, count(*) OVER (PARTITION BY folded) - 1 AS similar_count FROM it WHERE n_words < 12 AND folded <> ''")
def short_text_similar_count(spark, sf_dir):
    return d.similar_counts(items(spark, sf_dir))


_PAIRS = f"""{_ITEMS}, lg AS (SELECT item_id, string_split(folded, ' ') AS w FROM it WHERE n_words >= 12),
sx AS (SELECT item_id, w, unnest(range(1, greatest(2, len(w) - 3))) AS i FROM lg),
sh AS (SELECT DISTINCT item_id, array_to_string(w[i:i+4], ' ') AS s FROM sx),
sn AS (SELECT item_id, count(*) AS n FROM sh GROUP BY 1),
kk AS (SELECT item_id, s AS k, 40 AS lim FROM sh UNION ALL SELECT item_id, '^' || array_to_string(w[1:6], ' '), 80 FROM lg),
ok AS (SELECT k FROM kk GROUP BY k HAVING count(*) BETWEEN 2 AND max(lim)),
rk AS (SELECT item_id, row_number() OVER (ORDER BY array_to_string(w, ' '), item_id) AS pos FROM lg),
cand AS (SELECT a.item_id AS a, b.item_id AS b FROM kk a JOIN ok ON a.k = ok.k JOIN kk b ON b.k = a.k AND a.item_id < b.item_id
  UNION SELECT least(x.item_id, y.item_id), greatest(x.item_id, y.item_id) FROM rk x JOIN rk y ON y.pos BETWEEN x.pos + 1 AND x.pos + 8),
both_ AS (SELECT c.a, c.b, count(*) AS n FROM cand c JOIN sh x ON x.item_id = c.a JOIN sh y ON y.item_id = c.b AND x.s = y.s GROUP BY 1, 2),
prs AS (SELECT a, b, both_.n / (p.n + q.n - both_.n) AS similarity FROM both_ JOIN sn p ON p.item_id = a JOIN sn q ON q.item_id = b WHERE both_.n / (p.n + q.n - both_.n) >= 0.85)"""


def _long(spark, sf_dir):
    return items(spark, sf_dir).where(F.col("n_words") >= d.LONG)


@query("shingle_jaccard_pairs", f"WITH {_PAIRS} SELECT a, b, round(similarity, 9) AS similarity FROM prs")
def shingle_jaccard_pairs(spark, sf_dir):
    return d.near_pairs(_long(spark, sf_dir), Scratch(spark, "pairs")).select("a", "b", F.round("similarity", 9).alias("similarity"))


@query("sort_neighbours", f"WITH {_ITEMS}, rk AS (SELECT item_id, row_number() OVER (ORDER BY folded, item_id) AS pos FROM it) SELECT x.item_id AS a, y.item_id AS b FROM rk x JOIN rk y ON y.pos BETWEEN x.pos + 1 AND x.pos + 8")
def sort_neighbours(spark, sf_dir):
    return d.sort_neighbours(items(spark, sf_dir), Scratch(spark, "neighbours"), "folded")


@query("near_dup_star_merge")
def near_dup_star_merge(spark, sf_dir):
    """Greedy star merge in canonical order (no SQL twin: it is sequential)."""
    scratch = Scratch(spark, "stars")
    own = _long(spark, sf_dir)
    far = F.coalesce(F.col("day"), F.lit("9999-12-31").cast("date"))
    order = own.select("item_id", F.struct((-F.length("text")).alias("l"), far.alias("d"), F.col("item_id").alias("i")).alias("place"))
    return d.near_stars(own.select("item_id", "words"), order, scratch).select("item_id", "canonical_id")


@query("merge_sample_round_robin", f"""WITH RECURSIVE {_EXACT}, m AS (SELECT item_id, canonical_id, CASE WHEN item_id % 2 = 0 THEN 'near' ELSE 'exact' END AS reason FROM can WHERE item_id <> canonical_id),
  p AS (SELECT *, row_number() OVER (PARTITION BY canonical_id ORDER BY item_id) AS n FROM m), q AS (SELECT *, row_number() OVER (PARTITION BY reason ORDER BY canonical_id, item_id) AS turn FROM p WHERE n <= 3)
  SELECT row_number() OVER (ORDER BY turn, CASE reason WHEN 'near' THEN 0 ELSE 1 END, canonical_id, item_id)::INT AS place, reason, canonical_id, item_id FROM q""")
def merge_sample_round_robin(spark, sf_dir):
    own = items(spark, sf_dir)
    scratch = Scratch(spark, "exact")
    merges = d.canonical(own, d.exact_groups(own, scratch)).where("not is_canonical")
    return d.merge_sample(merges.select("item_id", "canonical_id", F.when(F.col("item_id") % 2 == 0, "near").otherwise("exact").alias("reason")), scratch)
