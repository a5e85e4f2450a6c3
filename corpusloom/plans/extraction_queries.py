"""Queries over extracted text: rewrites, headings, listings, tables of constituents, names and words broken by extraction."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import names
from ..functions import text as rules
from ..operators import fragments, html_tables, passages
from .registry import query, table


def _forms(key: str, *forms: str) -> str:
    """One of the forms for each row, by its key; the expression means the same to both engines."""
    return f"CASE {key} % {len(forms)} " + " ".join(f"WHEN {i} THEN {x}" for i, x in enumerate(forms)) + " END"


_DUCK = lambda x: x.replace("AS STRING", "AS VARCHAR")

# listings

_LINE = _forms(
    "o_orderkey",
    "'| ' || repeat('Alpha Holdings Limited | 1 High Street, Floor 2, London, SW1A 1AA, United Kingdom | ', CAST(1 + o_orderkey % 7 AS INT)) || '100 |'", "'|---|:--:|---|'", "'| Revenue 2023 | 2024 | 7.5% |'",
    "'| Principal risk | Beta Group plc | ' || repeat('x, ', 300)", "'Plain words about a trust and its partners, no table'", "'| ' || repeat('a | ', CAST(6 + o_orderkey % 11 AS INT))", "''", "'   '",
    "'| ' || repeat('Nominee fund, ltd, | ', CAST(8 + o_orderkey % 8 AS INT)) || 'York |'", "'| 2021 | 2022 | Delta Limited company | 3 Park Road |'",
    "'| 100% | Unit 4, Warrington, WA1 1AA | ' || repeat('spv, | ', CAST(o_orderkey % 50 AS INT))", "'  | on the keyword | ' || repeat('Omega LLP | 9 Court Drive, Cardiff, CF10 1BH | ', 6)", "'| Omega LLP, 9 Court Drive | ' || repeat('y', CAST(o_orderkey % 1000 AS INT)) || ' |'",
)
_LISTED = rf"""l AS (SELECT o_orderkey AS pk, o_custkey AS owner, {_DUCK(_LINE)} AS t FROM orders), c AS (SELECT *, trim(t) AS s, lower(trim(t)) AS low FROM l),
h AS (SELECT *, len(list_filter(['limited', 'ltd', 'llp', 'plc', 'holdco', 'holdings', 'nominee', 'ordinary', 'spv', 'fund', 'oeic', 'sicav', 'company', 'group', 'partners', 'partnership', 'trust'], lambda w: contains(low, w))) AS ent,
 len(list_filter(['road', 'street', 'st ', 'avenue', 'drive', 'house', 'court', 'park', 'building', 'floor', 'unit', 'united kingdom', 'london', 'glasgow', 'edinburgh', 'reading', 'cardiff', 'plymouth', 'warrington', 'york'], lambda w: contains(low, w))) AS adr,
 regexp_matches(s, '(?i)\b[a-z]{{1,2}}\d[a-z\d]?\s?\d[a-z]{{2}}\b') AS post, regexp_matches(s, '^\|?\s*:?-{{2,}}.*\|.*$') AS ruled, length(s) - length(replace(s, '|', '')) AS pipes, length(s) - length(replace(s, ',', '')) AS commas,
 len(regexp_extract_all(s, '\b20\d{{2}}\b')) >= 2 OR regexp_matches(s, '\d+(\.\d+)?%') AS fig, regexp_matches(s, '(?i)\b(ai|artificial intelligence|machine learning|ml|gen(erative)?\s*ai|llm|algorithm|risk|principal risk|mitigation|control|governance|opportunit(y|ies)|threat|compliance|regulat(ion|ory))\b') AS keep FROM c),
k AS (SELECT *, CASE WHEN NOT regexp_matches(s, '\|.*\|') OR ruled OR keep OR (fig AND ent < 2 AND adr = 0 AND NOT post) THEN 0 ELSE CASE WHEN pipes >= 14 THEN 2 WHEN pipes >= 10 THEN 1 ELSE 0 END
 + CASE WHEN length(s) >= 900 THEN 3 WHEN length(s) >= 500 THEN 2 WHEN length(s) >= 300 THEN 1 ELSE 0 END + CASE WHEN ent >= 4 THEN 3 WHEN ent >= 2 THEN 2 WHEN ent >= 1 THEN 1 ELSE 0 END
 + CASE WHEN adr >= 2 THEN 2 WHEN adr >= 1 THEN 1 ELSE 0 END + CASE WHEN post THEN 2 ELSE 0 END + CASE WHEN commas >= 12 THEN 2 WHEN commas >= 8 THEN 1 ELSE 0 END END AS score FROM h)"""


@query(f"WITH {_LISTED} SELECT pk, CAST(score AS INTEGER) AS score, score >= 6 AS noise FROM k")
def listing_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How much table lines look like listings of entities, by entities, addresses, length, pipes, commas and post codes."""
    lines = table(spark, sf_dir, "orders", "o_orderkey").select(F.col("o_orderkey").alias("pk"), F.trim(F.expr(_LINE)).alias("t"))
    return lines.select("pk", rules.listing_score(F.col("t")).alias("score")).withColumn("noise", F.col("score") >= rules.LISTING_DROP)


@query(rf"""WITH {_LISTED}, m AS (SELECT *, CASE WHEN s = '' THEN 'blank' WHEN regexp_matches(s, '\bthe\b') THEN 'kept' WHEN ruled THEN 'rule' WHEN score >= 6 THEN 'listing' ELSE 'kept' END AS kind FROM k)
SELECT owner, md5(trim(coalesce(string_agg(t, chr(10) ORDER BY pk) FILTER (WHERE kind = 'kept'), ''))) AS cleaned, CAST(count(*) FILTER (WHERE kind = 'rule') AS INTEGER) AS rules, CAST(count(*) FILTER (WHERE kind = 'listing') AS INTEGER) AS listings FROM m GROUP BY owner""")
def cleaned_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each owner's lines without table rules and listings, unless a keyword hits them, and how many of both went."""
    lines = table(spark, sf_dir, "orders", "o_orderkey", "o_custkey").select(F.col("o_custkey").alias("owner"), F.struct("o_orderkey", F.expr(_LINE).alias("t")).alias("line"))
    texts = lines.groupBy("owner").agg(F.array_join(F.transform(F.array_sort(F.collect_list("line")), lambda x: x["t"]), "\n").alias("text"))
    # what a generator gives isn't worked out again for each of its fields
    return texts.select("owner", F.explode(F.array(rules.cleaned_lines(F.col("text"), [r"\bthe\b"]))).alias("c")).select("owner", F.md5("c.text").alias("cleaned"), "c.rules", "c.listings")


# rewrites and headings

_RAW = _forms(
    "o_orderkey",
    "'LEI 5493001KJTIIGC8Y1R12 2020-01-0' || CAST(1 + o_orderkey % 9 AS STRING) || ' 2020-12-31 Annual report'", "'issued 2021-03-04 by iso4217:GBP and xbrli:shares as ifrs-full:Revenue here'", "'A n n u a l   r e p o r t of g r o u p ' || CAST(o_orderkey AS STRING)",
    "'Contents ..... 12 and more .... 7 or .. 3'", "'Total 1 234 567 , 8 . 5 % of ' || CAST(o_orderkey AS STRING)", "'cost $ 12, £ 5 or € 7 and 3 %'", "'trans- formation of long- term plans - not this'", "'endOfLine and camelCase Words ABCd'", "'  spaced   out  ' || CAST(o_orderkey AS STRING)",
    "'a b c is spelled, x y is not, a&nbsp;b c'", "'1 , 2 . 3 4'", "'broken�char and ABCDEFGHIJKLMNOPQRS1 code'", "''",
)
_REWRITES = [
    (r"\b[A-Z0-9]{18,20}\b(?:\s+\d{4}-\d{2}-\d{2}(?:\s+\d{4}-\d{2}-\d{2})?)*", ""), (r"\b\d{4}-\d{2}-\d{2}\b", ""), (r"\b(?:iso4217|xbrli):[A-Za-z]+\b", ""), None, (r"\b[a-z0-9]{2,}(?:-[a-z0-9]{2,})?:[A-Za-z][A-Za-z0-9_-]*\b", ""),
    (r"\s*\.{3,}\s*\d+\b", ""), (r"(\d)\s+(\d)", r"\1\2"), (r"(\d)\s+,\s+(\d)", r"\1,\2"), (r"(\d)\s+\.\s+(\d)", r"\1.\2"), (r"(\d)\s+%", r"\1%"), (r"([£$€])\s+(\d)", r"\1\2"), (r"([A-Za-z])-\s+([A-Za-z])", r"\1\2"), ("([a-z])([A-Z])", r"\1 \2"), ("�", ""), (r"\s+", " "),
]
_SPELLED = r"(?:\b[A-Za-z]\b(?:\s+|&nbsp;)+){2,}\b[A-Za-z]\b"


def _rewritten() -> str:
    steps, at = [f"r0 AS (SELECT o_orderkey AS pk, trim(regexp_replace({_DUCK(_RAW)}, '\\s+', ' ', 'g')) AS t FROM orders)"], 0
    for rule in _REWRITES:
        if rule:
            made = f"regexp_replace(t, '{rule[0]}', '{rule[1]}', 'g')"
        else:
            words = f"list_transform(regexp_extract_all(t, '{_SPELLED}'), lambda m: regexp_replace(m, '[^A-Za-z]', '', 'g'))"
            made = f"array_to_string(list_transform(list_zip(string_split_regex(t, '{_SPELLED}'), {words}), lambda z: z[1] || coalesce(z[2], '')), '')"
        steps.append(f"r{at + 1} AS (SELECT pk, {made} AS t FROM r{at})")
        at += 1
    return "WITH " + ", ".join(steps) + f" SELECT pk, trim(t) AS normalised FROM r{at}"


@query(_rewritten())
def normalised_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The conservative rewrites of extracted markup on texts that hit each of them."""
    return table(spark, sf_dir, "orders", "o_orderkey").select(F.col("o_orderkey").alias("pk"), passages.normalise(F.expr(_RAW)).alias("normalised"))


@query(r"""WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS t, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS line FROM documents),
 m AS (SELECT *, list_filter(string_split_regex(t, '[\s\x0b\x{85}\p{Z}]+'), lambda w: w <> '') AS ws, len(regexp_extract_all(t, '\p{Lu}')) AS up, len(regexp_extract_all(t, '\p{L}')) AS a FROM l),
 h AS (SELECT doc_id, line, length(t) <= 60 AND len(ws) > 0 AND ((up > greatest(a, 1) * 0.6 AND len(ws) <= 8) OR (len(ws) <= 6 AND len(list_filter(ws, lambda w: regexp_matches(w, '^\p{L}') AND NOT regexp_matches(w, '^\p{Lu}'))) = 0)) AS looks,
  10 + line % 5 > 11 * 1.2 OR (up > 0 AND NOT regexp_matches(t, '\p{Ll}') AND len(ws) <= 8) OR regexp_matches(t, '^\d+\.(\d+\.?)?\s+[A-Z]') AS heading FROM m)
SELECT doc_id, line, looks, heading FROM h WHERE looks OR heading""")
def heading_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines that look like headings by their text, and those that are by text or size (every fifth line is set in larger letters)."""
    lines = table(spark, sf_dir, "documents", "doc_id", "text").select("doc_id", F.posexplode(F.split("text", "\n")).alias("line", "t"))
    found = lines.select("doc_id", F.col("line").cast("long").alias("line"), passages.looks_like_heading(F.col("t")).alias("looks"), passages.is_heading(F.col("t"), 10 + F.col("line") % 5, F.lit(11)).alias("heading"))
    return found.where("looks or heading")


# tables and names

PAGE_ROWS = 50


@query(f"""WITH p AS (SELECT c_custkey // {PAGE_ROWS} AS page, row_number() OVER (PARTITION BY c_custkey // {PAGE_ROWS} ORDER BY c_custkey) AS row, c_name AS name, 'T' || c_custkey AS t FROM customer)
SELECT page, CAST(row AS INTEGER) AS row, name, CASE WHEN page % 3 = 2 THEN '' ELSE t END AS ticker FROM p""")
def table_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names and tickers from the best table of each page: with other heads, or none at all and a column of numbers; each page also has a table without rows and a small one."""
    page = F.expr(f"c_custkey div {PAGE_ROWS}")
    kind, key = page % 3, F.col("c_custkey").cast("string")
    cells = F.when(kind == 0, F.concat(F.col("c_name"), F.lit("<td>x<td>T"), key)).when(kind == 1, F.concat(F.lit("n<td> "), F.col("c_name"), F.lit(" <td>T"), key)).otherwise(F.concat(key, F.lit("<td>"), F.col("c_name"), F.lit("<td>U"), key))
    rows = table(spark, sf_dir, "customer", "c_custkey", "c_name").groupBy(page.alias("page")).agg(F.array_sort(F.collect_list(F.struct("c_custkey", cells.alias("cells")))).alias("rows"))
    head = F.when(F.col("page") % 3 == 0, "<tr><th>Issuer name<th>Note<th>EPIC").when(F.col("page") % 3 == 1, "<tr><th>No.<th>Constituent<th>Mnemonic").otherwise("")
    body = F.array_join(F.transform("rows", lambda r: F.concat(F.lit("<tr><td>"), r["cells"], F.lit("</tr>"))), "\n")
    html = F.concat(F.lit("<table><tr><td>a<td>b</table><table>"), head, body, F.lit("</table><table><tr><td>Company<td>x<tr><td>Y<td>1</table>"))
    found = html_tables.tables(rows.select("page", html.alias("html")), "page", "html")
    return html_tables.records(found, "page", F.lit(100)).drop("place")


_NAME = _forms(
    "c_custkey",
    "c_name || ' Holdings plc'", "'The ' || c_name || ' & Sons Ltd.'", "c_name || ' Inv Tst Ord 25p'", "c_name || '  (Class A)'", "'ABRDN ' || c_name || ' Cap and Inc Tst'", "c_name || ' Public Limited Company'", "c_name || ' Group N.V. ordinary shares of 5p'", "c_name || ' P.L.C.'",
    "'’' || c_name || '’ – “Intl” Pharma'", "c_name || ' Co''s Glbl Util Inf Res'", "'Auto Trader ' || c_name || ' Inc Corp NPV SA'", "'British Land Co ' || c_name || ' LD nonvoting'", "'  '", "CAST(NULL AS STRING)",
)


def _nested(start: str, steps: list[tuple[str, str, bool]]) -> str:
    for old, new, regex in steps:
        old, new = old.replace("'", "''"), new.replace("'", "''")
        start = f"regexp_replace({start}, '{old}', '{new}', 'g')" if regex else f"replace({start}, '{old}', '{new}')"
    return start


_LISTED_NAME = _nested("lower(" + _nested("translate(trim(regexp_replace(n, '\\s+', ' ', 'g')), '’“”–—', '''\"\"--')", [(r"\s+\([^)]*\)$", "", True), (r"(?i)\bordinary shares?\b.*$", "", True), (r"(?i)\b(ord|ords)\b.*$", "", True), ("[^A-Za-z0-9&+'/-]+", " ", True)]) + ")", [(r"\b(public limited company|plc)\b", "", True), (r"\s+", " ", True)])
_CANON_NAME = _nested("' ' || upper(n) || ' '", [*((a, b, False) for a, b in names.ABBREVIATIONS.items()), (r"\bPUBLIC LIMITED COMPANY\b", " ", True), (r"\bP\.?L\.?C\.?\b", " ", True), (r"\bLIMITED\b", " ", True), (r"\bLTD\.?\b", " ", True), (r"\bTHE\b", " ", True), ("[^A-Z0-9]+", " ", True)])


@query(rf"""WITH t AS (SELECT c_custkey AS k, {_DUCK(_NAME)} AS n FROM customer) SELECT k, trim({_LISTED_NAME}) AS listed, trim({_CANON_NAME}) AS canonical,
 regexp_replace(regexp_replace(lower(n), '\b(plc|ltd|limited|group|holdings|inc|corp|ord|npv|sa|nv)\b', '', 'g'), '[^a-z0-9]', '', 'g') AS reconciled,
 regexp_replace(regexp_replace(replace(lower(n), '&', ' and '), '\b(plc|limited|ltd|holdings|group)\b', ' ', 'g'), '[^a-z0-9]+', '', 'g') AS audited,
 regexp_replace(regexp_replace(replace(upper(n), '&', ' AND '), '\b(PLC|LIMITED|LTD|GROUP|HOLDINGS|ORD|LD|N\.V\.|NV|INC|SHARES|NONVOTING|THE)\b', ' ', 'g'), '[^A-Z0-9]+', '', 'g') AS staged, trim(regexp_replace(upper(n), '\s+', ' ', 'g')) AS plain FROM t""")
def name_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names in the six forms of their sources."""
    rows = table(spark, sf_dir, "customer", "c_custkey", "c_name").select(F.col("c_custkey").alias("k"), F.expr(_NAME).alias("n"))
    return rows.select("k", *(f(F.col("n")).alias(f.__name__) for f in (names.listed, names.canonical, names.reconciled, names.audited, names.staged, names.plain)))


# words broken by extraction

LEAST_TEXTS = 3
_WORDS = f"""w AS (SELECT doc_id, unnest(list_distinct(regexp_extract_all(lower(text), '\\p{{L}}+'))) AS word FROM documents),
dict AS (SELECT word FROM w WHERE length(word) > 2 OR word IN ({', '.join(f"'{x}'" for x in fragments.SHORT_WORDS)}) GROUP BY word HAVING count(*) >= {LEAST_TEXTS})"""


@query(rf"""WITH {_WORDS}, t AS (SELECT doc_id, text, unnest(list_filter(string_split_regex(lower(text), '[\s\x0b\x{{85}}\p{{Z}}]+'), lambda x: regexp_matches(x, '^\p{{L}}+$'))) AS tok FROM documents),
 u AS (SELECT doc_id, count(*) FILTER (WHERE tok NOT IN (SELECT word FROM dict)) AS unknown, count(*) FILTER (WHERE length(tok) = 1 AND tok NOT IN ('a', 'i')) AS suspicious FROM t GROUP BY doc_id),
 l AS (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z]{{3,}}')) AS tok FROM documents), v AS (SELECT doc_id, count(*) AS n, count(*) FILTER (WHERE lower(tok) IN (SELECT word FROM dict)) AS good, count(*) FILTER (WHERE length(tok) >= 12) AS long FROM l GROUP BY doc_id)
SELECT d.doc_id, CAST(coalesce(unknown, 0) AS BIGINT) AS unknown, CAST(coalesce(suspicious, 0) AS BIGINT) AS suspicious,
 coalesce(length(text) >= 80 AND n > 0 AND (good < n * 0.6 OR long > n * 0.15 OR regexp_matches(text, '[a-z]{{6,}}(and|the|of|to)[a-z]{{4,}}')), FALSE) AS needs_repair FROM documents d LEFT JOIN u ON u.doc_id = d.doc_id LEFT JOIN v ON v.doc_id = d.doc_id""")
def word_validity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unknown tokens and stray letters of texts, and whether they need repair, by words that stand in at least three texts."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return fragments.validity(docs, "doc_id", "text", fragments.learn(docs, "text", LEAST_TEXTS))


@query()
def repaired_fragments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts in which some words were broken after four letters and others run together, put together by the words that the whole ones teach."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    broken = F.regexp_replace(F.regexp_replace("text", r"\b([a-z]{4})([a-z]{2}[aeiou][a-z]*)\b", "$1 $2"), r"\b([a-z]{5,}) (and|the|for)\b", "$1$2")
    found = fragments.repair(docs.select("doc_id", broken.alias("text")), "doc_id", "text", fragments.learn(docs, "text", LEAST_TEXTS))
    return found.select("doc_id", F.md5("repaired").alias("repaired"), "unknown_before", "unknown_after", "kept")
