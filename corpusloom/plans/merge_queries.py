"""Queries that combine tables by key: precedence, overlays, patches, lookups and matches."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import name_key
from ..operators import lookup, merge
from .base import FILINGS_SQL, filings
from .registry import query, table


def _three(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """Three overlapping lists of filings of one owner and year: finished ones, large ones, all."""
    rows = filings(spark, sf_dir).select("pk", "owner", "year", "size", "kind")
    return [rows.where("kind = 'F'"), rows.where("size > 150000"), rows]


_THREE = f"""WITH {FILINGS_SQL}, parts AS (SELECT pk, owner, year, 0 AS source FROM filings WHERE kind = 'F' UNION ALL SELECT pk, owner, year, 1 FROM filings WHERE size > 150000
 UNION ALL SELECT pk, owner, year, 2 FROM filings)"""


@query(f"{_THREE}, r AS (SELECT *, row_number() OVER (PARTITION BY owner, year ORDER BY source, pk) AS n FROM parts) SELECT owner, year, pk, source FROM r WHERE n = 1")
def precedence_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge.precedence_union(_three(spark, sf_dir), ["owner", "year"], [F.col("pk")]).select("owner", "year", "pk", "source")


_FILL = """parts AS (SELECT c_custkey AS k, 0 AS s, CASE WHEN c_acctbal > 5000 THEN c_name ELSE '' END AS name, CASE WHEN c_nationkey > 12 THEN c_mktsegment END AS sector FROM customer
 UNION ALL SELECT c_custkey, 1, CASE WHEN c_acctbal > 0 THEN upper(c_name) END, lower(c_mktsegment) FROM customer WHERE c_custkey % 3 = 0)"""


@query(f"""WITH {_FILL} SELECT k, arg_min(name, CASE WHEN trim(name) <> '' THEN s END) AS name, arg_min(sector, CASE WHEN trim(sector) <> '' THEN s END) AS sector,
 list_sort(list(DISTINCT s)) AS sources FROM parts GROUP BY k""")
def null_fill_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "customer")
    name, balance = F.col("c_name"), F.col("c_acctbal")
    first = rows.select(F.col("c_custkey").alias("k"), F.when(balance > 5000, name).otherwise("").alias("name"), F.when(F.col("c_nationkey") > 12, F.col("c_mktsegment")).alias("sector"))
    second = rows.where("c_custkey % 3 = 0").select(F.col("c_custkey").alias("k"), F.when(balance > 0, F.upper(name)).alias("name"), F.lower("c_mktsegment").alias("sector"))
    return merge.fill_merge([first, second], ["k"], ["name", "sector"])


def _base(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filings(spark, sf_dir).select("pk", "kind", "priority", "size")


def _patch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A newer reading of every fourth filing, and some that the base lacks."""
    rows = filings(spark, sf_dir).where("pk % 4 = 0")
    kind = F.when(F.col("pk") % 8 == 0, "F").otherwise("P")
    own = rows.select("pk", kind.alias("kind"), F.when(F.col("size") > 100000, F.lit("9-LATE")).alias("priority"), F.round(F.col("size") * 2, 2).alias("size"))
    return own.union(own.where("pk % 16 = 0").withColumn("pk", -F.col("pk")))


_PATCH = f"""WITH {FILINGS_SQL}, base AS (SELECT pk, kind, priority, size FROM filings),
 own AS (SELECT pk, CASE WHEN pk % 8 = 0 THEN 'F' ELSE 'P' END AS kind, CASE WHEN size > 100000 THEN '9-LATE' END AS priority, round(size * 2, 2) AS size FROM filings WHERE pk % 4 = 0),
 patch AS (SELECT * FROM own UNION ALL SELECT -pk, kind, priority, size FROM own WHERE pk % 16 = 0)"""


@query(f"""{_PATCH} SELECT b.pk, CASE WHEN p.pk IS NULL THEN b.kind ELSE p.kind END AS kind, b.priority, CASE WHEN p.pk IS NULL THEN b.size ELSE p.size END AS size, p.pk IS NOT NULL AS replaced
FROM base b LEFT JOIN patch p ON p.pk = b.pk UNION ALL SELECT pk, kind, priority, size, false FROM patch WHERE pk NOT IN (SELECT pk FROM base)""")
def overlay_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge.overlay(_base(spark, sf_dir), _patch(spark, sf_dir), "pk", ["kind", "size"], append=True)


@query(f"""{_PATCH}, j AS (SELECT b.*, p.kind AS nk, coalesce(b.kind = 'P' AND p.kind <> 'P', false) AS u FROM base b LEFT JOIN patch p ON p.pk = b.pk)
SELECT pk, CASE WHEN u THEN nk ELSE kind END AS kind, priority, size, u AS replaced FROM j""")
def retry_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A repeated answer replaces one that failed (P), if it didn't fail itself."""
    better = (F.col("kind") == "P") & (F.col("new_kind") != "P")
    return merge.overlay(_base(spark, sf_dir), _patch(spark, sf_dir), "pk", ["kind"], when=better)


@query(f"""{_PATCH} SELECT b.pk, b.kind, coalesce(p.priority, b.priority) AS priority, coalesce(p.size, b.size) AS size,
 CASE WHEN p.priority IS NOT NULL AND p.priority IS DISTINCT FROM b.priority THEN 1 ELSE 0 END + CASE WHEN p.size IS NOT NULL AND p.size IS DISTINCT FROM b.size THEN 1 ELSE 0 END AS changed
FROM base b LEFT JOIN patch p ON p.pk = b.pk""")
def field_patch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge.patch_fields(_base(spark, sf_dir), _patch(spark, sf_dir), "pk", ["priority", "size"])


_SETS = """WITH a AS (SELECT l_orderkey AS k, list_sort(list(DISTINCT l_returnflag)) AS labels FROM lineitem GROUP BY 1),
 v AS (SELECT l_orderkey AS k, list_sort(list(DISTINCT l_linestatus)) AS vendor FROM lineitem WHERE l_quantity > 25 GROUP BY 1)"""


@query(f"""{_SETS} SELECT a.k, array_to_string(coalesce(v.vendor, ['-']), ',') AS vendor,
 array_to_string(list_sort(CASE WHEN list_contains(v.vendor, 'O') THEN list_distinct(list_append(a.labels, 'O')) WHEN v.vendor IS NULL THEN a.labels ELSE list_filter(a.labels, lambda x: x <> 'O') END), ',') AS labels
FROM a LEFT JOIN v ON v.k = a.k""")
def set_patch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The vendor labels are overwritten, and one of them is carried over to the general label set."""
    lines = table(spark, sf_dir, "lineitem", "l_orderkey", "l_returnflag", "l_linestatus", "l_quantity")
    both = lines.groupBy(F.col("l_orderkey").alias("k")).agg(
        F.collect_set("l_returnflag").alias("labels"), F.collect_set(F.when(F.col("l_quantity") > 25, F.col("l_linestatus"))).alias("vendor")
    )  # one shuffle for both sides
    one = F.array(F.lit("O"))
    labels = F.when(F.size("vendor") == 0, F.col("labels")).when(F.array_contains("vendor", "O"), F.array_union("labels", one)).otherwise(F.array_except("labels", one))
    vendor = F.when(F.size("vendor") == 0, F.array(F.lit("-"))).otherwise(F.array_sort("vendor"))
    return both.select("k", F.array_join(vendor, ",").alias("vendor"), F.array_join(F.array_sort(labels), ",").alias("labels"))


@query(f"""{_PATCH} SELECT coalesce(b.pk, p.pk) AS pk, CASE WHEN p.pk IS NULL THEN b.kind ELSE p.kind END AS kind, coalesce(b.priority, p.priority) AS priority,
 CASE WHEN p.pk IS NULL THEN b.size ELSE p.size END AS size FROM base b FULL JOIN patch p ON p.pk = b.pk""")
def upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge.upsert(_base(spark, sf_dir), _patch(spark, sf_dir), ["pk"], keep=["priority"])


@query(f"{_PATCH} SELECT * FROM base WHERE pk NOT IN (SELECT pk FROM patch) UNION ALL SELECT * FROM patch")
def replace_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge.replace_by_key(_base(spark, sf_dir), _patch(spark, sf_dir), ["pk"])


@query(f"{_PATCH} SELECT * FROM base UNION ALL SELECT * FROM patch WHERE pk NOT IN (SELECT pk FROM base)")
def insert_absent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge.insert_absent(_base(spark, sf_dir), _patch(spark, sf_dir), ["pk"])


@query(f"{_THREE} SELECT owner, year, pk, count(*) AS rows FROM parts GROUP BY ALL HAVING count(*) > 1")
def repeated_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge.repeated_keys([p.select("owner", "year", "pk") for p in _three(spark, sf_dir)], ["owner", "year", "pk"])


@query("""WITH a AS (SELECT DISTINCT o_custkey AS k FROM orders), b AS (SELECT c_custkey AS k FROM customer WHERE c_acctbal > 0)
SELECT k, 'b' AS missing_in FROM a WHERE k NOT IN (SELECT k FROM b) UNION ALL SELECT k, 'a' FROM b WHERE k NOT IN (SELECT k FROM a)""")
def anti_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = table(spark, sf_dir, "orders", "o_custkey").select(F.col("o_custkey").alias("k"))
    return merge.missing_keys(a, table(spark, sf_dir, "customer").where("c_acctbal > 0").select(F.col("c_custkey").alias("k")), "k")


@query("""WITH a AS (SELECT DISTINCT o_custkey AS k FROM orders), b AS (SELECT DISTINCT c_custkey AS k FROM customer WHERE c_acctbal > 0), j AS (SELECT a.k AS x, b.k AS y FROM a FULL JOIN b ON a.k = b.k)
SELECT count(*) FILTER (WHERE y IS NULL) AS only_a, count(*) FILTER (WHERE x IS NULL) AS only_b, count(*) FILTER (WHERE x IS NOT NULL AND y IS NOT NULL) AS "both" FROM j""")
def key_overlap_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = table(spark, sf_dir, "orders", "o_custkey").select(F.col("o_custkey").alias("k"))
    return merge.key_overlap(a, table(spark, sf_dir, "customer").where("c_acctbal > 0").select(F.col("c_custkey").alias("k")), "k")


@query("SELECT o_orderkey AS pk, o_custkey AS owner FROM orders WHERE o_orderstatus IN ('F', 'O') AND year(o_orderdate) IN (1996, 1997) AND o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')")
def semi_eligible(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate")
    universe = table(spark, sf_dir, "customer", "c_custkey", "c_mktsegment").where("c_mktsegment = 'BUILDING'")
    rows = rows.where(F.col("o_orderstatus").isin("F", "O") & F.year("o_orderdate").isin(1996, 1997))
    return rows.join(universe, F.col("o_custkey") == F.col("c_custkey"), "left_semi").select(F.col("o_orderkey").alias("pk"), F.col("o_custkey").alias("owner"))


@query("""SELECT o_orderkey AS pk, c_mktsegment AS sector, coalesce(n_name, 'Unknown') AS nation, coalesce(r_name, 'Unknown') AS region
FROM orders LEFT JOIN customer ON c_custkey = o_custkey LEFT JOIN nation ON n_nationkey = c_nationkey LEFT JOIN region ON r_regionkey = n_regionkey""")
def star_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, owners = table(spark, sf_dir, "orders", "o_orderkey", "o_custkey"), table(spark, sf_dir, "customer", "c_custkey", "c_mktsegment", "c_nationkey")
    places = lookup.checked_broadcast(table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"), "left"))
    rows = orders.join(owners, F.col("o_custkey") == F.col("c_custkey"), "left").join(places, F.col("c_nationkey") == F.col("n_nationkey"), "left")
    unknown = lambda c: F.coalesce(c, F.lit("Unknown"))
    return rows.select(F.col("o_orderkey").alias("pk"), F.col("c_mktsegment").alias("sector"), unknown("n_name").alias("nation"), unknown("r_name").alias("region"))


@query("""WITH a AS (SELECT c_custkey AS k, c_mktsegment AS v FROM customer WHERE c_acctbal > 6000), b AS (SELECT c_custkey AS k, 'rich' AS v FROM customer WHERE c_acctbal > 3000)
SELECT o.o_orderkey AS pk, coalesce(a.v, b.v, 'Other') AS value, CASE WHEN a.v IS NOT NULL THEN 0 WHEN b.v IS NOT NULL THEN 1 END AS hit FROM orders o LEFT JOIN a ON a.k = o_custkey LEFT JOIN b ON b.k = o_custkey""")
def fallback_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    owners = table(spark, sf_dir, "customer", "c_custkey", "c_mktsegment", "c_acctbal")
    rows = table(spark, sf_dir, "orders", "o_orderkey", "o_custkey").select(F.col("o_orderkey").alias("pk"), F.col("o_custkey").alias("owner"))
    sources = [(owners.where("c_acctbal > 6000"), "c_custkey", "c_mktsegment"), (owners.where("c_acctbal > 3000").withColumn("v", F.lit("rich")), "c_custkey", "v")]
    return lookup.fallback(rows, sources, "owner", "Other").select("pk", "value", "hit")


@query("""WITH c AS (SELECT p_partkey AS part, lpad(CAST(p_size * 37 AS VARCHAR), 4, '0') AS code FROM part),
 t AS (SELECT DISTINCT substr(lpad(CAST(p_size * 37 AS VARCHAR), 4, '0'), 1, 2) AS prefix, 'two' AS value FROM part WHERE p_size % 2 = 0
  UNION SELECT DISTINCT substr(lpad(CAST(p_size * 37 AS VARCHAR), 4, '0'), 1, 3), 'three' FROM part WHERE p_size % 3 = 0 UNION SELECT DISTINCT lpad(CAST(p_size * 37 AS VARCHAR), 4, '0'), 'four' FROM part WHERE p_size % 5 = 0)
SELECT part, code, coalesce((SELECT value FROM t WHERE prefix = code), (SELECT value FROM t WHERE prefix = substr(code, 1, 3)), (SELECT value FROM t WHERE prefix = substr(code, 1, 2)), 'Other') AS value FROM c""")
def prefix_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part", "p_partkey", "p_size").withColumn("code", F.lpad((F.col("p_size") * 37).cast("string"), 4, "0"))
    sizes = parts.select("p_size", "code").distinct()
    rule = lambda d, n, v: sizes.where(F.col("p_size") % d == 0).select(F.substring("code", 1, n).alias("prefix"), F.lit(v).alias("value")).distinct()
    known = rule(2, 2, "two").union(rule(3, 3, "three")).union(rule(5, 4, "four"))
    return lookup.longest_prefix(parts, known, "code", (2, 3, 4), "Other").select(F.col("p_partkey").alias("part"), "code", "value")


@query("SELECT p_partkey AS part, CASE WHEN p_size BETWEEN 1 AND 9 THEN 'small' WHEN p_size BETWEEN 10 AND 33 THEN 'middle' WHEN p_size BETWEEN 35 AND 47 THEN 'large' ELSE 'Other' END AS bucket FROM part")
def range_bucket(spark: SparkSession, sf_dir: str) -> DataFrame:
    bucket = lookup.range_bucket(F.col("p_size"), [(1, 9, "small"), (10, 33, "middle"), (35, 47, "large")], "Other")
    return table(spark, sf_dir, "part", "p_partkey", "p_size").select(F.col("p_partkey").alias("part"), bucket.alias("bucket"))


@query("""WITH t AS (SELECT DISTINCT p_type AS term FROM part), n AS (SELECT DISTINCT p_name AS name FROM part)
SELECT name, min(term) AS term FROM n JOIN t ON length(name) >= 4 AND length(term) >= 4 AND (contains(lower(name), lower(term)) OR contains(lower(term), lower(substr(name, 1, 4)))) GROUP BY name""")
def substring_match_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part", "p_name", "p_type")
    terms = parts.select(F.col("p_type").alias("term")).distinct()
    names = parts.select(F.col("p_name").alias("name")).distinct().withColumn("low", F.lower("name")).withColumn("head", F.substring("low", 1, 4))
    return lookup.substring_match(names, terms.withColumn("low_term", F.lower("term")), "low", "low_term", [F.col("term")], held="head").select("name", "term")


@query("""WITH h AS (SELECT trim(regexp_replace(regexp_replace(lower(c_name), '[^a-z0-9 ]+', ' ', 'g'), ' +', ' ', 'g')) AS k, count(*) AS n FROM customer WHERE c_acctbal > 1000 GROUP BY 1),
 l AS (SELECT trim(regexp_replace(regexp_replace(lower(c_name), '[^a-z0-9 ]+', ' ', 'g'), ' +', ' ', 'g')) AS k, count(*) AS n FROM customer WHERE c_acctbal < 4000 GROUP BY 1)
SELECT coalesce(h.k, l.k) AS name_key, CASE WHEN h.k IS NULL THEN 'local' WHEN l.k IS NULL THEN 'history' ELSE 'both' END AS found_in, CAST(coalesce(h.n, 0) + coalesce(l.n, 0) AS BIGINT) AS rows FROM h FULL JOIN l ON h.k = l.k""")
def entity_resolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two lists joined on normalised names, by tagged union: each row is shuffled once, after partial sums."""
    owners = table(spark, sf_dir, "customer", "c_name", "c_acctbal").withColumn("name_key", name_key(F.col("c_name")))
    tagged = owners.where("c_acctbal > 1000").select("name_key", F.lit(1).alias("t")).union(owners.where("c_acctbal < 4000").select("name_key", F.lit(2)))
    sides = tagged.groupBy("name_key").agg(F.bit_or("t").alias("t"), F.count("*").alias("rows"))
    return sides.select("name_key", F.when(F.col("t") == 1, "history").when(F.col("t") == 2, "local").otherwise("both").alias("found_in"), "rows")


@query("""WITH y AS (SELECT unnest([1996, 1997, 1998]) AS year), c AS (SELECT c_custkey AS owner FROM customer WHERE c_mktsegment = 'MACHINERY')
SELECT owner, year FROM c CROSS JOIN y WHERE (owner, year) NOT IN (SELECT o_custkey, CAST(year(o_orderdate) AS INTEGER) FROM orders)""")
def expected_minus_actual(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected years are exploded beside each owner, so no cross join is needed."""
    owners = table(spark, sf_dir, "customer", "c_custkey", "c_mktsegment").where("c_mktsegment = 'MACHINERY'").select(F.col("c_custkey").alias("owner"))
    expected = owners.withColumn("year", F.explode(F.array(*[F.lit(y) for y in (1996, 1997, 1998)])))
    actual = table(spark, sf_dir, "orders", "o_custkey", "o_orderdate").select(F.col("o_custkey").alias("owner"), F.year("o_orderdate").alias("year"))
    return expected.join(actual, ["owner", "year"], "left_anti")


def _windows(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    rows = filings(spark, sf_dir)
    ends = rows.where("kind = 'O'").select("owner", F.col("pk").alias("period"), F.col("filed").alias("ended"))
    return ends, rows.where("kind = 'F'").select("owner", F.col("pk").alias("filing"), "filed", "priority")


_WINDOWS = f"""WITH {FILINGS_SQL}, p AS (SELECT a.owner, a.pk AS period, a.filed AS ended, b.pk AS filing, b.filed, b.priority, date_diff('day', a.filed, b.filed) AS days
 FROM filings a JOIN filings b ON a.owner = b.owner AND a.kind = 'O' AND b.kind = 'F' AND date_diff('day', a.filed, b.filed) BETWEEN 0 AND 300)"""


@query(f"{_WINDOWS}, r AS (SELECT *, row_number() OVER (PARTITION BY period ORDER BY priority, days, filing) AS n FROM p) SELECT period, filing, days FROM r WHERE n = 1")
def date_window_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    ends, found = _windows(spark, sf_dir)
    order = [F.col("priority"), F.col("days"), F.col("filing")]
    return lookup.window_match(ends, found, "owner", "ended", "filed", 300, order).select("period", "filing", "days")


@query()
def date_window_greedy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As above, but each filing is used once and periods choose in date order."""
    ends, found = _windows(spark, sf_dir)
    pairs = lookup.window_pairs(ends, found, "owner", "ended", "filed", 300)
    return lookup.greedy_assign(pairs, "owner", ["ended"], ["priority", "days"], "period", "filing")


@query("""WITH t AS (SELECT item_id, list_distinct(list_filter(string_split_regex(lower(text), '[^a-z0-9]+'), lambda x: x <> '')) AS ws FROM benchmark),
 p AS (SELECT a.item_id AS a, b.item_id AS b, len(list_intersect(a.ws, b.ws)) AS n, len(a.ws) + len(b.ws) AS m FROM t a JOIN t b ON a.item_id % 2 = 0 AND b.item_id % 2 = 1),
 s AS (SELECT a, b, 2.0 * n / m AS score FROM p WHERE m > 0 AND 2.0 * n / m >= 0.2), r AS (SELECT *, row_number() OVER (PARTITION BY a ORDER BY score DESC, b) AS k FROM s)
SELECT a, b, round(score, 6) AS score FROM r WHERE k = 1""")
def token_dice_best_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "benchmark")
    a = items.where("item_id % 2 = 0").select(F.col("item_id").alias("a"), "text")
    b = items.where("item_id % 2 = 1").select(F.col("item_id").alias("b"), "text")
    return lookup.best_token_match(a, b, 0.2).select("a", "b", F.round("score", 6).alias("score"))


@query("""SELECT o_orderkey AS report, CASE WHEN o_orderstatus = 'F' THEN 'doc:' || o_orderkey ELSE o_custkey || '|||' || year(o_orderdate) END AS key FROM orders""")
def report_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A report's own id, else its owner and year."""
    rows = filings(spark, sf_dir)
    own = F.when(F.col("kind") == "F", F.concat(F.lit("doc:"), F.col("pk").cast("string")))
    return rows.select(F.col("pk").alias("report"), F.coalesce(own, F.concat_ws("|||", "owner", "year")).alias("key"))


@query("""WITH u AS (SELECT o_custkey AS owner, o_orderkey AS report FROM orders WHERE o_orderstatus = 'F'), f AS (SELECT l_orderkey AS report, count(*) AS facts FROM lineitem WHERE l_quantity > 40 GROUP BY 1)
SELECT coalesce(u.report, f.report) AS report, coalesce(facts, 0) AS facts, u.report IS NOT NULL AS seeded FROM u FULL JOIN f ON u.report = f.report""")
def universe_with_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seeded reports with their facts, and facts of reports that weren't seeded."""
    seeds = table(spark, sf_dir, "orders", "o_orderkey", "o_orderstatus").where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("report"), F.lit(True).alias("seeded"))
    facts = table(spark, sf_dir, "lineitem", "l_orderkey", "l_quantity").where("l_quantity > 40").groupBy(F.col("l_orderkey").alias("report")).agg(F.count("*").alias("facts"))
    return seeds.join(facts, "report", "full").select("report", F.coalesce("facts", F.lit(0)).cast("long").alias("facts"), F.coalesce("seeded", F.lit(False)).alias("seeded"))


@query("""WITH d AS (SELECT doc_id, text, left(text, 100) AS p FROM documents WHERE text IS NOT NULL), u AS (SELECT p, min(doc_id) AS lo, count(*) AS n FROM d WHERE length(p) >= 100 GROUP BY p),
 h AS (SELECT u.p, d.doc_id AS t FROM u JOIN d ON contains(d.text, u.p)), x AS (SELECT d.doc_id AS a, h.t AS b FROM h JOIN d ON d.p = h.p WHERE d.doc_id <> h.t)
SELECT doc_id, min(other) AS first_id FROM (SELECT a AS doc_id, b AS other FROM x UNION ALL SELECT b, a FROM x) GROUP BY doc_id""")
def prefix_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts one of which holds the other's first 100 characters (the measure's own prefix) anywhere, with the smallest such partner of each."""
    return lookup.prefix_contained(table(spark, sf_dir, "documents", "doc_id", "text"), "doc_id", "text")


@query("SELECT l_orderkey AS report, l_linenumber AS chunk, max(l_quantity) AS answer FROM lineitem GROUP BY ALL")
def keyed_or_positional(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answers meet their chunks by key; where a report's answers have no key at all, by position."""
    lines = table(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", "l_quantity").groupBy("l_orderkey", "l_linenumber").agg(F.max("l_quantity").alias("answer"))
    rows = lines.select(F.col("l_orderkey").alias("report"), F.col("l_linenumber").alias("chunk"), (F.col("l_linenumber") - 1).alias("place"), "answer")
    answers = rows.select("report", F.when(F.col("report") % 3 != 0, F.col("chunk")).alias("key"), "place", "answer")
    return lookup.by_key_or_place(rows.drop("answer"), answers, "report", "chunk", "key", "place").select("report", "chunk", "answer")
