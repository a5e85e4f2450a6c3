"""Queries over texts, markup and semi-structured answers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import payload
from ..functions import text as rules
from ..operators import chunking, html_spans, profile
from .registry import query, table

PATTERNS = {"mean": r"\bthe\b", "number": r"[0-9]{3}", "time": r"(?i)\b(?:time|year|day)s?\b"}
PATTERNS = {k: rules.ascii_bounds(p) for k, p in PATTERNS.items()}
_HITS = """h AS (SELECT doc_id, text, list_filter([CASE WHEN regexp_matches(text, '\\bthe\\b') THEN 'mean' END, CASE WHEN regexp_matches(text, '[0-9]{3}') THEN 'number' END,
 CASE WHEN regexp_matches(text, '(?i)\\b(?:time|year|day)s?\\b') THEN 'time' END], lambda x: x IS NOT NULL) AS hits FROM documents)"""


def _docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents", "doc_id", "text")


@query(f"WITH {_HITS} SELECT doc_id, array_to_string(hits, ',') AS keywords FROM h WHERE len(hits) > 0")
def keyword_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _docs(spark, sf_dir).withColumn("hits", rules.keywords_hit(F.col("text"), PATTERNS))
    return rows.where(F.size("hits") > 0).select("doc_id", F.array_join("hits", ",").alias("keywords"))


@query("""SELECT doc_id, keyword, CAST(n AS INTEGER) AS n FROM (SELECT doc_id, 'mean' AS keyword, len(regexp_extract_all(text, '\\bthe\\b')) AS n FROM documents UNION ALL
 SELECT doc_id, 'number', len(regexp_extract_all(text, '[0-9]{3}')) FROM documents UNION ALL SELECT doc_id, 'time', len(regexp_extract_all(text, '(?i)\\b(?:time|year|day)s?\\b')) FROM documents) WHERE n > 0""")
def keyword_counts_by_doc(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = F.array(*[F.struct(F.lit(k).alias("keyword"), F.regexp_count("text", F.lit(p)).alias("n")) for k, p in sorted(PATTERNS.items())])
    return _docs(spark, sf_dir).select("doc_id", F.inline(counts)).where("n > 0")


@query("""SELECT doc_id, CAST(len(regexp_extract_all(text, '[^ \\t\\r\\n\\f]+')) AS INTEGER) AS words, len(text) - len(replace(text, chr(10), '')) <= 1 OR length(text) >= 20000 AS malformed,
 lower(regexp_replace(text, '[^A-Za-z0-9]+', '', 'g')) AS signature, regexp_replace(text, '[^0-9]+', '', 'g') AS digits FROM documents""")
def text_measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.col("text")
    ends = F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit("")))
    return _docs(spark, sf_dir).select(
        "doc_id", rules.word_count(text).alias("words"), ((ends <= 1) | (F.length(text) >= 20000)).alias("malformed"),
        rules.content_signature(text).alias("signature"), rules.digits_only(text).alias("digits"),
    )


@query("""WITH m AS (SELECT doc_id, greatest(length(text), 1) AS n, len(regexp_extract_all(text, '[A-Za-z]')) AS a, len(regexp_extract_all(text, ' ')) AS s, len(regexp_extract_all(text, '[^ \\t\\r\\n\\f]+')) AS t,
 len(list_filter(regexp_extract_all(text, '[^ \\t\\r\\n\\f]+'), lambda x: regexp_full_match(x, '[A-Za-z]'))) AS one, len(list_filter(regexp_extract_all(text, '[^ \\t\\r\\n\\f]+'), lambda x: length(x) > 18)) AS big FROM documents),
 r AS (SELECT doc_id, a / n AS alpha_ratio, one / greatest(t, 1) AS single_letter_rate, big / greatest(t, 1) AS long_token_rate, s / n AS space_ratio FROM m)
SELECT doc_id, round(alpha_ratio, 4) AS alpha_ratio, round(single_letter_rate, 4) AS single_letter_rate, round(long_token_rate, 4) AS long_token_rate, round(space_ratio, 4) AS space_ratio,
 CASE WHEN single_letter_rate > 0.25 THEN 3 WHEN single_letter_rate > 0.12 THEN 1 WHEN long_token_rate > 0.08 THEN 2 WHEN space_ratio < 0.12 THEN 2 ELSE 0 END AS route FROM r""")
def quality_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _docs(spark, sf_dir).select("doc_id", rules.quality_metrics(F.col("text")).alias("m"))
    names = ("alpha_ratio", "single_letter_rate", "long_token_rate", "space_ratio")
    return rows.select("doc_id", *(F.round(F.col("m")[c], 4).alias(c) for c in names), rules.repair_route(F.col("m")).alias("route"))


_CLEAN = "regexp_replace(regexp_replace(lower(t), '[0-9]+', '', 'g'), '[^\\p{L}]+', ' ', 'g')"


@query(f"""WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS t, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS line FROM documents),
 f AS (SELECT *, CASE WHEN length(t) BETWEEN 10 AND 120 THEN trim({_CLEAN}, ' ') END AS form FROM l), o AS (SELECT doc_id, form FROM f WHERE form IS NOT NULL GROUP BY ALL HAVING count(*) >= 4)
SELECT f.doc_id, CAST(count(*) AS BIGINT) AS lines, CAST(sum(length(t)) AS BIGINT) AS chars FROM f LEFT JOIN o ON o.doc_id = f.doc_id AND o.form = f.form WHERE o.form IS NULL GROUP BY f.doc_id""")
def repeated_line_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = chunking.repeated_lines(_docs(spark, sf_dir), least=4)
    return kept.groupBy("doc_id").agg(F.count("*").alias("lines"), F.sum(F.length("t")).alias("chars"))


@query("""WITH m AS (SELECT doc_id, length(text) AS n, len(regexp_extract_all(text, '[\\x00-\\x08\\x0e-\\x1f]')) AS c, len(text) - len(replace(text, chr(65533), '')) AS r, len(regexp_extract_all(text, '[^ \\t\\r\\n\\f]+')) AS w FROM documents),
 q AS (SELECT doc_id, list_filter([CASE WHEN n < 200 THEN 'short' END, CASE WHEN n > 50000 THEN 'long' END, CASE WHEN c > 0 THEN 'control' END, CASE WHEN r > 0 THEN 'replacement' END, CASE WHEN w > 0 AND n / w > 12 THEN 'dense' END], lambda x: x IS NOT NULL) AS i FROM m)
SELECT doc_id, array_to_string(i, ',') AS issues, CAST(len(i) AS INTEGER) AS n_issues FROM q""")
def doc_qa_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    text, n, words = F.col("text"), F.length("text"), F.regexp_count("text", F.lit(r"\S+"))
    checks = [
        ("short", n < 200),
        ("long", n > 50000),
        ("control", F.regexp_count("text", F.lit("[\\x00-\\x08\\x0e-\\x1f]")) > 0),
        ("replacement", F.contains(text, F.lit("�"))),
        ("dense", (words > 0) & (n / words > 12)),
    ]
    return profile.issues(_docs(spark, sf_dir), checks).select("doc_id", "issues", "n_issues")


@query("""SELECT c_custkey AS k, trim(regexp_replace(regexp_replace(replace(lower(c_name), '&', ' and '), '[^a-z0-9 ]+', ' ', 'g'), ' +', ' ', 'g')) AS name_key,
 trim(regexp_replace(lower(trim(c_name)), '[^a-z0-9]+', '-', 'g'), '-') AS slug, regexp_replace(lower(trim(c_name)), '[^a-z0-9]', '-', 'g') AS slug_plain,
 nullif(regexp_replace(upper(c_name), '[^A-Z0-9]+', '', 'g'), '') AS ticker FROM customer""")
def name_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.col("c_name")
    return table(spark, sf_dir, "customer", "c_custkey", "c_name").select(
        F.col("c_custkey").alias("k"), rules.name_key(name).alias("name_key"), rules.slug(name).alias("slug"), rules.slug(name, collapse=False).alias("slug_plain"), rules.ticker_key(name).alias("ticker")
    )


@query("""SELECT doc_id, 'doc-chunk-' || substr(sha1(doc_id || ':0:' || length(text)), 1, 12) AS chunk_id, substr(sha256(coalesce(text, '')), 1, 16) AS excerpt_hash,
 CASE WHEN doc_id % 3 = 0 THEN CAST(doc_id AS VARCHAR) WHEN doc_id % 3 = 1 THEN 'lei' || doc_id ELSE trim(regexp_replace(lower(source), '[^a-z0-9]+', '-', 'g'), '-') END AS company_id,
 CASE WHEN length(text) > 300 THEN left(text, 100) || chr(10) || '...' || chr(10) || right(text, 100) ELSE text END AS cut FROM documents WHERE source IS NOT NULL AND text IS NOT NULL""")
def stable_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents", "doc_id", "text", "source").where("source is not null and text is not null")
    number = F.when(F.col("doc_id") % 3 == 0, F.col("doc_id").cast("string")).otherwise(" ")
    lei = F.when(F.col("doc_id") % 3 == 1, F.concat(F.lit("lei"), F.col("doc_id").cast("string")))
    return rows.select(
        "doc_id", rules.chunk_id(F.col("doc_id").cast("string"), F.lit(0), F.length("text")).alias("chunk_id"), rules.excerpt_hash(F.coalesce("text", F.lit(""))).alias("excerpt_hash"),
        rules.company_id(number, lei, F.col("source")).alias("company_id"), rules.truncate_middle(F.col("text"), 300, 100).alias("cut"),
    )


@query("""SELECT p_type AS label, count(*) AS parts, CASE p_type WHEN 'PROMO' THEN 'Promotional' ELSE array_to_string(list_transform(string_split(replace(lower(p_type), '_', ' '), ' '), lambda w: upper(left(w, 1)) || substr(w, 2)), ' ') END AS pretty FROM part GROUP BY p_type""")
def pretty_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = table(spark, sf_dir, "part", "p_type").groupBy(F.col("p_type").alias("label")).agg(F.count("*").alias("parts"))
    return counts.select("label", "parts", rules.pretty_label(F.lower("label"), {"promo": "Promotional"}).alias("pretty"))


# answers: an order's lines as the JSON text a labelling service would give, some of it damaged
def _answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem", "l_orderkey", "l_returnflag", "l_discount")
    best = lines.groupBy("l_orderkey", "l_returnflag").agg(F.max("l_discount").alias("c"))
    entry = F.struct(F.concat(F.lit("Label."), F.lower("l_returnflag")).alias("type"), (F.col("c") * 10).alias("signal"))
    rows = best.groupBy(F.col("l_orderkey").alias("id")).agg(F.array_sort(F.collect_list(entry)).alias("signals"))
    json = F.to_json(F.struct(F.transform("signals", lambda s: s["type"]).alias("labels"), F.col("signals")))
    form = F.col("id") % 4
    raw = F.when(form == 0, json).when(form == 1, F.concat(F.lit("```json\n"), json, F.lit("\n```"))).when(form == 2, F.concat(F.lit("So: "), F.regexp_replace(json, r"\]\}$", ",]}"), F.lit(" Done."))).otherwise(F.left(json, F.length(json) - 3))
    return rows.select("id", raw.alias("raw"))


_LABELS = "a AS (SELECT l_orderkey AS id, lower(l_returnflag) AS label, max(l_discount) * 10 AS signal FROM lineitem GROUP BY 1, 2)"


@query(f"WITH {_LABELS} SELECT id, array_to_string(list_sort(list(label)), ',') AS labels, round(max(signal), 4) AS top_signal FROM a WHERE id % 4 <> 3 GROUP BY id")
def json_signals_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answers in three forms (plain, fenced, with a trailing comma in prose) give the same labels and signals."""
    value = payload.parse_json(F.col("raw"))
    # a filter on what a generator gives isn't pushed down with the whole reading spelt out in it, so answers are made and read once
    rows = _answers(spark, sf_dir).select("id", value.alias("read")).select("id", F.explode_outer(F.array("read")).alias("v")).where("v is not null")
    labels = F.try_variant_get("v", "$.labels", "array<string>")
    signals = F.try_variant_get("v", "$.signals", "array<struct<type string, signal double>>")
    rows = rows.select("id", payload.label_list(labels, ["Label"]).alias("labels"), payload.signal_map(signals).alias("signals"))
    return rows.select("id", F.array_join("labels", ",").alias("labels"), F.round(F.array_max(F.map_values("signals")), 4).alias("top_signal"))


@query(f"WITH {_LABELS} SELECT id, array_to_string(list_sort(list(label)), ',') AS labels FROM a WHERE id % 4 = 3 GROUP BY id")
def salvaged_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answers that are cut off: the labels are read from what is left."""
    rows = _answers(spark, sf_dir).where(payload.parse_json(F.col("raw")).isNull())
    plain = F.regexp_replace("raw", r"Label\.", "")
    return rows.select("id", F.array_join(payload.label_list(payload.salvage_labels(plain, "labels", ["a", "n", "r"])), ",").alias("labels"))


@query(f"""WITH {_LABELS}, g AS (SELECT id, count(*) AS n, max(signal) AS hi, min(signal) AS lo, bool_or(label = 'n') AS nothing FROM a GROUP BY id)
SELECT id, array_to_string(list_filter([CASE WHEN nothing AND n > 1 THEN 'none with others' END, CASE WHEN hi > 0.9 THEN 'signal too high' END, CASE WHEN lo < 0.05 THEN 'signal missing' END], lambda x: x IS NOT NULL), '; ') AS messages FROM g""")
def payload_validate(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem", "l_orderkey", "l_returnflag", "l_discount")
    best = lines.groupBy("l_orderkey", "l_returnflag").agg((F.max("l_discount") * 10).alias("s"))
    rows = best.groupBy(F.col("l_orderkey").alias("id")).agg(F.count("*").alias("n"), F.max("s").alias("hi"), F.min("s").alias("lo"), F.bool_or(F.col("l_returnflag") == "N").alias("nothing"))
    checks = [(F.col("nothing") & (F.col("n") > 1), "none with others"), (F.col("hi") > 0.9, "signal too high"), (F.col("lo") < 0.05, "signal missing")]
    return rows.select("id", F.array_join(payload.messages(checks), "; ").alias("messages"))


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events WHERE CAST(json_extract_string(props, '$.k') AS BIGINT) > 50")
def json_field_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events", "event_id", "props").select("event_id", F.get_json_object("props", "$.k").cast("long").alias("k"))
    return rows.where("k > 50")


@query()
def chunk_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with a blank line after each line, cut into keyword-gated chunks of at most 120 words."""
    docs = _docs(spark, sf_dir).withColumn("text", F.replace(F.col("text"), F.lit("\n"), F.lit("\n\n")))
    return chunking.split_words(chunking.keyword_chunks(docs, PATTERNS), 120).drop("sections")


@query()
def html_text_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_spans.spans(table(spark, sf_dir, "pages", "page_id", "html"))


@query("""WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS t FROM documents), h AS (SELECT doc_id, trim(t) AS t FROM l WHERE starts_with(trim(t), '#'))
SELECT doc_id, count(*) AS headings FROM h GROUP BY doc_id""")
def heading_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = F.filter(F.split("text", "\n"), lambda t: F.trim(t).startswith("#"))
    return _docs(spark, sf_dir).select("doc_id", F.size(lines).cast("long").alias("headings")).where("headings > 0")


@query("""WITH s AS (SELECT item_id, list_filter(string_split_regex(text, '[.!?][ \\n\\t]+'), lambda x: x <> '') AS s FROM benchmark)
SELECT item_id, CAST(len(s) AS INTEGER) AS sentences, CAST(list_max(list_transform(s, lambda x: len(regexp_extract_all(x, '[^ \\t\\r\\n]+')))) AS INTEGER) AS longest FROM s""")
def sentence_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = F.filter(rules.sentences(F.col("text")), lambda x: x != "")
    longest = F.array_max(F.transform(parts, lambda x: F.regexp_count(x, F.lit(r"\S+"))))
    return table(spark, sf_dir, "benchmark").select("item_id", F.size(parts).alias("sentences"), longest.alias("longest"))


@query("""WITH d AS (SELECT doc_id, list_distinct(list_filter(string_split_regex(lower(text), '[^a-z0-9]+'), lambda w: w <> '')) AS ws FROM documents), p AS (SELECT *, unnest(ws) AS w FROM d)
SELECT w AS token, count(*) AS documents FROM p WHERE length(w) > 3 GROUP BY w ORDER BY documents DESC, w LIMIT 50""")
def frequent_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A report of the 50 words that most documents hold."""
    words = _docs(spark, sf_dir).select(F.explode(rules.tokens(F.col("text"))).alias("token")).where(F.length("token") > 3)
    return words.groupBy("token").agg(F.count("*").alias("documents")).orderBy(F.desc("documents"), "token").limit(50)
