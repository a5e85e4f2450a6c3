"""Queries that write whole tables in each form to the shared folder and read them back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import work_folder
from ..sources import publish, readers, store, writers
from .registry import query, table

_ORDERS = "SELECT o_orderkey AS pk, o_custkey AS owner, o_orderpriority AS priority, o_totalprice AS size FROM orders"


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("pk"), F.col("o_custkey").alias("owner"), F.col("o_orderpriority").alias("priority"), F.col("o_totalprice").alias("size"))


def _typed(df: DataFrame) -> DataFrame:
    return df.select(F.col("pk").cast("long").alias("pk"), F.col("owner").cast("long").alias("owner"), "priority", F.col("size").cast("double").alias("size"))


@query("SELECT doc_id, text, source FROM documents WHERE text IS NOT NULL")
def csv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole texts through CSV: quotes are doubled, line ends stay in their cells, columns that aren't named stay out."""
    path = work_folder(spark, "csv")
    writers.csv(table(spark, sf_dir, "documents").where("text is not null"), path, ["doc_id", "text", "source"])
    return readers.csv(spark, path, lines=True).select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"), "source")


@query("SELECT o_orderkey AS pk, o_custkey AS owner, CASE WHEN o_orderkey % 2 = 0 THEN o_orderpriority END AS priority, CASE WHEN o_orderkey % 2 = 1 THEN o_totalprice END AS size FROM orders")
def csv_union_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two sets of rows with different columns in one CSV with the columns of both."""
    path, rows = work_folder(spark, "csv"), _orders(spark, sf_dir)
    writers.csv_union([rows.where("pk % 2 = 0").drop("size"), rows.where("pk % 2 = 1").drop("priority")], path)
    return _typed(readers.csv(spark, path))


@query("SELECT o_orderkey AS pk, o_custkey AS owner, o_orderpriority AS priority FROM orders")
def preamble_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV files with lines of prose before the header row, which its first two cells tell."""
    path = work_folder(spark, "preamble")
    line = F.concat_ws(",", F.col("pk").cast("string"), F.col("owner").cast("string"), "priority")
    body = _orders(spark, sf_dir).groupBy("owner").agg(F.array_join(F.collect_list(line), "\n").alias("rows"))
    body.select(F.concat(F.lit("Exported list\n\nKey,Owner,Priority\n"), "rows").alias("value"), (F.col("owner") % 4).alias("part")).write.partitionBy("part").text(path, lineSep="\n\nKey,Owner,Priority\n")
    rows = readers.csv_after_preamble(spark, path, ("Key", "Owner"), ["pk", "owner", "priority"]).where("pk <> 'Key'")
    return rows.where("pk rlike '^[0-9]+$'").select(F.col("pk").cast("long").alias("pk"), F.col("owner").cast("long").alias("owner"), "priority")


@query(_ORDERS)
def json_lines_by_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON lines in a folder for each group, read strictly."""
    path = work_folder(spark, "json")
    writers.json_lines(_orders(spark, sf_dir), path, by="priority")
    return readers.json_lines(spark, path, "pk long, owner long, size double, priority string").select("pk", "owner", "priority", "size")


@query("SELECT o_orderkey AS pk, o_totalprice AS size FROM orders WHERE o_orderkey % 10 <> 0")
def lenient_json_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON lines of which every tenth is broken: those are dropped."""
    path = work_folder(spark, "json")
    whole = F.to_json(F.struct("pk", "size"))
    _orders(spark, sf_dir).select(F.when(F.col("pk") % 10 == 0, F.concat(F.lit("{broken "), F.col("pk").cast("string"))).otherwise(whole).alias("value")).write.text(path)
    return readers.json_lines(spark, path, "pk long, size double", "lenient").where("pk is not null")


@query("SELECT count(*) AS good, (SELECT count(*) FROM orders WHERE o_orderkey % 10 = 0) AS bad FROM orders WHERE o_orderkey % 10 <> 0")
def recorded_bad_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Broken lines kept beside the good ones, and counted."""
    path = work_folder(spark, "json")
    whole = F.to_json(F.struct("pk", "size"))
    _orders(spark, sf_dir).select(F.when(F.col("pk") % 10 == 0, F.lit("{broken")).otherwise(whole).alias("value")).write.text(path)
    rows = readers.json_lines(spark, path, "pk long, size double", "recording")
    return rows.agg(F.count_if(F.col("pk").isNotNull()).alias("good"), F.count_if(F.col("_corrupt_record").isNotNull()).alias("bad"))


@query(_ORDERS)
def by_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows by a path's suffix: the JSON lines that are asked for aren't there, the Parquet beside them is."""
    path = work_folder(spark, "rows")
    _orders(spark, sf_dir).write.parquet(f"{path}.parquet")
    return readers.by_suffix(spark, f"{path}.jsonl", "pk long, owner long, priority string, size double")


@query("SELECT n_nationkey AS k, n_name AS name, n_regionkey AS region FROM nation")
def manifest_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One JSON document with an array of rows (a table of 25 rows, whatever the scale), read as rows."""
    path = work_folder(spark, "manifest")
    rows = table(spark, sf_dir, "nation").agg(F.collect_list(F.struct(F.col("n_nationkey").alias("k"), F.col("n_name").alias("name"), F.col("n_regionkey").alias("region"))).alias("documents"))
    writers.json_summary(rows, path)
    return readers.manifest(spark, path).select(F.col("k").cast("int").alias("k"), "name", F.col("region").cast("int").alias("region"))


@query("SELECT n_name AS key, CAST(n_nationkey AS VARCHAR) AS value FROM nation")
def json_map_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One JSON object as a lookup table."""
    path = work_folder(spark, "map")
    entries = table(spark, sf_dir, "nation").agg(F.map_from_entries(F.collect_list(F.struct("n_name", F.col("n_nationkey").cast("string")))).alias("m"))
    entries.select(F.to_json("m").alias("value")).coalesce(1).write.text(path)
    return readers.json_map(spark, path)


@query("SELECT count(*) AS documents, CAST(sum(length(text)) AS BIGINT) AS chars, count(DISTINCT md5(text)) AS texts FROM documents WHERE doc_id IS NOT NULL AND text IS NOT NULL AND text <> ''")
def front_matter_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with front matter, a mark after each, read record by record and parted from their front matter again."""
    path = work_folder(spark, "md")
    docs = table(spark, sf_dir, "documents", "doc_id", "text").where("doc_id is not null and text <> ''")
    writers.front_matter(docs, "text", ["doc_id"]).select(F.col("document").alias("value")).write.text(path, lineSep="\x1e")
    found = readers.texts(spark, path, "\x1e").select(F.regexp_extract("text", r"(?s)^---\ndoc_id: \d+\n---\n\n(.*)\z", 1).alias("t"))
    return found.agg(F.count("*").alias("documents"), F.sum(F.length("t")).alias("chars"), F.count_distinct(F.md5("t")).alias("texts"))


@query("""SELECT c_custkey AS id, CASE WHEN c_custkey % 4 = 0 THEN 'Unknown' ELSE c_name END AS name, CASE WHEN c_custkey % 3 = 0 THEN 'Other' ELSE c_mktsegment END AS sector, CAST(2018 + c_custkey % 6 AS INTEGER) AS year FROM customer WHERE 2018 + c_custkey % 6 >= 2020""")
def report_universe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A universe of reports from CSV files whose headers differ, with defaults for blanks, from 2020 on."""
    path = work_folder(spark, "universe")
    k = F.col("c_custkey")
    rows = table(spark, sf_dir, "customer").select(k.alias("id"), F.when(k % 4 == 0, F.lit(" ")).otherwise(F.col("c_name")).alias("name"), F.when(k % 3 == 0, F.lit(None).cast("string")).otherwise(F.col("c_mktsegment")).alias("sector"), (2018 + k % 6).alias("year"))
    even = rows.where("id % 2 = 0").select(F.col("id").alias("company_id"), F.col("name").alias("company_name"), F.col("sector").alias("cni_sector"), F.col("year").alias("report_year"))
    odd = rows.where("id % 2 = 1").select(F.col("id").alias("lei"), F.col("name").alias("Company"), F.col("sector").alias("Sector"), F.col("year").alias("Year"))
    writers.csv(even, f"{path}/a")
    writers.csv(odd, f"{path}/b")
    parts = [readers.universe(readers.csv(spark, f"{path}/{x}")) for x in "ab"]
    return parts[0].union(parts[1]).select(F.col("id").cast("long").alias("id"), "name", "sector", "year")


@query("""SELECT c_name AS name, CASE WHEN c_custkey % 3 = 0 THEN 'SC' || c_custkey ELSE lpad(CAST(c_custkey AS VARCHAR), 8, '0') END AS number FROM customer""")
def companies_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Companies with their numbers padded to eight digits where they are all digits."""
    path = work_folder(spark, "companies")
    k = F.col("c_custkey").cast("string")
    writers.csv(table(spark, sf_dir, "customer").select(F.concat(F.lit(" "), "c_name").alias("Company Name"), F.when(F.col("c_custkey") % 3 == 0, F.concat(F.lit("SC"), k)).otherwise(k).alias("CompanyNumber")), path)
    return readers.companies(readers.csv(spark, path, trim=True))


@query("""SELECT o_orderkey AS pk, c_name AS name, CAST(o_orderdate AS DATE) AS released, o_totalprice AS size FROM orders JOIN customer ON c_custkey = o_custkey""")
def nested_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested answers of a service (a company with its filings) as one row for each filing."""
    path = work_folder(spark, "nested")
    orders = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.collect_list(F.struct(F.col("o_orderkey").alias("id"), F.struct(F.to_date("o_orderdate").alias("date"), F.col("o_totalprice").alias("size")).alias("meta"))).alias("filings"))
    rows = table(spark, sf_dir, "customer", "c_custkey", "c_name").join(orders, F.col("c_custkey") == F.col("o_custkey"))
    writers.json_lines(rows.select(F.struct(F.col("c_name").alias("name")).alias("company"), "filings"), path)
    read = readers.json_lines(spark, path, "company struct<name string>, filings array<struct<id long, meta struct<date date, size double>>>")
    return read.select(F.col("company.name").alias("name"), F.explode("filings").alias("f")).select(F.col("f.id").alias("pk"), "name", F.col("f.meta.date").alias("released"), F.col("f.meta.size").alias("size"))


@query("SELECT conv_id, turn, coalesce(text, '') AS text FROM conversations WHERE turn IS NOT NULL")
def batch_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batch responses unwrapped: of the first candidate that has text its parts, joined by line ends."""
    path = work_folder(spark, "responses")
    half = F.expr("cast(length(text) div 2 as int)")
    parts = F.array(F.struct(F.left("text", half).alias("text")), F.struct(F.substr("text", half + 1, F.length("text")).alias("text")))
    empty = F.struct(F.struct(F.array().cast("array<struct<text string>>").alias("parts")).alias("content"))
    rows = table(spark, sf_dir, "conversations").where("turn is not null").withColumn("text", F.coalesce("text", F.lit("")))
    writers.json_lines(rows.select("conv_id", "turn", F.struct(F.array(empty, F.struct(F.struct(parts.alias("parts")).alias("content"))).alias("candidates")).alias("response")), path)
    read = readers.json_lines(spark, path, "conv_id long, turn long, response struct<candidates array<struct<content struct<parts array<struct<text string>>>>>>")
    return read.select("conv_id", "turn", readers.first_answer(F.col("response.candidates"), "").alias("text"))


@query("""SELECT doc_id, '"' || replace(left(text, 50), '"', '""') || '"' AS cell FROM documents WHERE regexp_matches(left(text, 50), '[",\\n]')""")
def quoted_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Title cells of a CSV export (a title is 50 characters) that need quoting, as the export writes them."""
    cell = writers.csv_cell(F.left("text", F.lit(50)))
    return table(spark, sf_dir, "documents", "doc_id", "text").select("doc_id", cell.alias("cell")).where(F.startswith("cell", F.lit('"')) & F.regexp_like(F.left("text", F.lit(50)), F.lit('[",\n]')))


@query("SELECT page_id, length(html) AS chars, md5(html) AS digest FROM pages WHERE html IS NOT NULL AND page_id IS NOT NULL")
def decoded_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as records of files, a mark after each, decoded by what each record is."""
    path = work_folder(spark, "files")
    rows = table(spark, sf_dir, "pages", "page_id", "html").where("html is not null and page_id is not null")
    rows.select(F.concat(F.col("page_id").cast("string"), F.lit("\x1f"), "html").alias("value")).write.text(path, lineSep="\x1e")
    found = readers.decoded(spark, path, "\x1e")
    page = F.substring_index("text", "\x1f", 1)
    html = F.substr("text", F.length(page) + 2, F.length("text"))
    return found.select(page.cast("long").alias("page_id"), F.length(html).cast("long").alias("chars"), F.md5(html).alias("digest"))


@query("SELECT lpad(CAST(n_nationkey AS VARCHAR), 8, '0') AS stem, CASE WHEN n_nationkey % 3 = 0 THEN '.html' ELSE '.md' END AS suffix FROM nation")
def first_file_by_stem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of the files of one number (of eight digits) that whose format comes first, listed and not read."""
    path = work_folder(spark, "stems")
    suffixes = F.when(F.col("n_nationkey") % 3 == 0, F.array(F.lit(".html"), F.lit(".pdf"))).otherwise(F.array(F.lit(".pdf"), F.lit(".md"), F.lit(".html")))
    rows = table(spark, sf_dir, "nation", "n_nationkey", "n_name").select(F.lpad(F.col("n_nationkey").cast("string"), 8, "0").alias("number"), "n_name", F.explode(suffixes).alias("suffix"))
    rows.select(F.concat("number", "suffix").alias("file"), "n_name").write.partitionBy("file").text(path)
    found = readers.first_by_stem(spark, path, [".md", ".html", ".pdf"], "/file=([^/]+)/")
    return found.select("stem", F.regexp_extract("name", r"(\.[^.]+)$", 1).alias("suffix"))


@query("SELECT event_id, user_id FROM events WHERE event_id % 3 <> 0")
def checkpointed_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A status table of finished keys in the shared folder, and what is left to do by it."""
    path = work_folder(spark, "status")
    rows = table(spark, sf_dir, "events", "event_id", "user_id")
    writers.json_lines(rows.where("event_id % 3 = 0").select("event_id", F.lit("done").alias("status")), path)
    done = readers.json_lines(spark, path, "event_id long, status string").where("status = 'done'")
    return rows.join(done, "event_id", "left_anti")


@query("SELECT part, n FROM (SELECT CAST(o_orderkey % 4 AS INTEGER) AS part, count(*) AS n FROM orders GROUP BY 1)")
def shards_in_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shards' outputs in folders by number, read together and in the order of the shards."""
    path = work_folder(spark, "shards")
    _orders(spark, sf_dir).withColumn("part", (F.col("pk") % 4).cast("int")).write.partitionBy("part").json(path)
    read = spark.read.schema("pk long, part int").json(path)
    return read.groupBy("part").agg(F.count("*").alias("n")).orderBy("part")


@query("""SELECT page_id, CASE WHEN octet_length(encode(html)) >= 50000 THEN FALSE WHEN octet_length(encode(html)) < 5000 THEN TRUE ELSE contains(left(html, 500), 'noscript') OR contains(left(html, 500), 'redirect') END AS stub FROM pages WHERE html IS NOT NULL""")
def stub_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages that are stubs by size, or by a marker near their start (the rule's own 500 characters)."""
    rows = table(spark, sf_dir, "pages", "page_id", "html").where("html is not null").withColumn("size", F.octet_length("html"))
    return readers.stubs(rows, "size", "html", ["noscript", "redirect"]).select("page_id", "stub")


@query("""SELECT c_nationkey AS nation, '## ' || c_nationkey || chr(10) || chr(10) || '| c_custkey | c_name | c_mktsegment |' || chr(10) || '| --- | --- | --- |' || chr(10) || string_agg('| ' || c_custkey || ' | ' || c_name || ' | ' || c_mktsegment || ' |', chr(10) ORDER BY c_custkey) AS report FROM customer GROUP BY c_nationkey""")
def markdown_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A report with a table of customers for each nation."""
    rows = table(spark, sf_dir, "customer", "c_nationkey", "c_custkey", "c_name", "c_mktsegment")
    return writers.markdown_reports(rows, "c_nationkey", "c_custkey", ["c_custkey", "c_name", "c_mktsegment"]).withColumnRenamed("c_nationkey", "nation")


@query("SELECT c_custkey, c_name, c_acctbal FROM customer WHERE c_acctbal >= 0")
def published_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table published twice, then replaced by a third version that is rolled back, read as what is current."""
    rows = table(spark, sf_dir, "customer", "c_custkey", "c_name", "c_acctbal")
    store = publish.Published(spark, work_folder(spark, "published"))
    store.publish(rows)
    store.publish(rows.where("c_acctbal >= 0"))
    store.publish(rows.where("c_acctbal < 0"))
    store.roll_back()
    return store.read()


_FILTERS = (
    ("none", {}, {}), ("status", {"status": "F"}, {}), ("statuses", {"status": ["F", "P"], "priority": None}, {}), ("years", {}, {"year": (1996, 1998)}), ("all", {"status": "O", "priority": "1-URGENT"}, {"year": (1997, None), "total": (None, 200000.0)}),
    ("nothing", {"status": []}, {}), ("quotes", {"priority": "1' OR '1'='1"}, {}),
)
_FILTERS_SQL = {"none": "TRUE", "status": "status = 'F'", "statuses": "status IN ('F', 'P')", "years": "year BETWEEN 1996 AND 1998", "all": "status = 'O' AND priority = '1-URGENT' AND year >= 1997 AND total <= 200000", "nothing": "FALSE", "quotes": "FALSE"}


@query("WITH o AS (SELECT o_orderkey AS pk, o_orderstatus AS status, o_orderpriority AS priority, o_totalprice AS total, CAST(year(o_orderdate) AS INTEGER) AS year FROM orders) " + " UNION ALL ".join(f"SELECT '{k}' AS filters, pk, status, year FROM o WHERE {w}" for k, w in _FILTERS_SQL.items()))
def filtered_reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table stored by year and status, read by every set of optional filters."""
    orders = table(spark, sf_dir, "orders", "o_orderkey", "o_orderstatus", "o_orderpriority", "o_totalprice", "o_orderdate")
    rows = orders.select(F.col("o_orderkey").alias("pk"), F.col("o_orderstatus").alias("status"), F.col("o_orderpriority").alias("priority"), F.col("o_totalprice").alias("total"), F.year("o_orderdate").alias("year"))
    path = work_folder(spark, "stored")
    store.save(rows, path, ["year", "status"])
    out = None
    for name, filters, ranges in _FILTERS:
        found = store.read(spark, path, filters, ranges).select(F.lit(name).alias("filters"), "pk", "status", "year")
        out = found if out is None else out.union(found)
    return out
