"""Readers: CSV variants, JSON lines in strict, lenient and recording modes, documents and files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def csv(spark: SparkSession, path: str, trim: bool = False, lines: bool = False) -> DataFrame:
    """CSV with a header, all columns strings; with `lines`, cells may hold line ends."""
    return spark.read.csv(path, header=True, encoding="UTF-8", multiLine=lines, lineSep="\n" if lines else None, ignoreLeadingWhiteSpace=trim, ignoreTrailingWhiteSpace=trim, escape='"')


def csv_after_preamble(spark: SparkSession, path: str, first_cells: tuple[str, str], columns: list[str]) -> DataFrame:
    """CSV files with text before the header: rows after the line that starts with these two cells; blank and short rows go."""
    lines = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("file"), F.posexplode(F.split("value", r"\r?\n")).alias("line", "t"))
    cells = F.transform(F.split("t", ","), lambda x: F.trim(x))
    rows = lines.withColumn("cells", cells)
    head = F.when((F.get("cells", F.lit(0)) == first_cells[0]) & (F.get("cells", F.lit(1)) == first_cells[1]), F.col("line"))
    rows = rows.withColumn("_head", F.min(head).over(Window.partitionBy("file"))).where("line > _head").where(F.size("cells") >= len(columns)).where(F.trim("t") != "")
    return rows.select("file", "line", *(F.get("cells", F.lit(i)).alias(c) for i, c in enumerate(columns)))


def json_lines(spark: SparkSession, path: str, schema: StructType | str, mode: str = "strict") -> DataFrame:
    """JSON lines: `strict` fails at a bad line, `lenient` drops it, `recording` keeps it in _corrupt_record."""
    if mode == "recording":
        text = schema if isinstance(schema, str) else schema.simpleString()[7:-1].replace(":", " ", 1)
        return spark.read.json(path, schema=f"{text}, _corrupt_record string", mode="PERMISSIVE", columnNameOfCorruptRecord="_corrupt_record")
    return spark.read.json(path, schema=schema, mode={"strict": "FAILFAST", "lenient": "DROPMALFORMED"}[mode])


def manifest(spark: SparkSession, path: str, field: str = "documents") -> DataFrame:
    """The rows of an array field of one JSON object."""
    return spark.read.json(path, multiLine=True).select(F.inline(field))


def json_map(spark: SparkSession, path: str) -> DataFrame:
    """A JSON object as (key, value) rows."""
    return spark.read.text(path, wholetext=True).select(F.explode(F.from_json("value", "map<string,string>")).alias("key", "value"))


def texts(spark: SparkSession, path: str, mark: str | None = None) -> DataFrame:
    """(file, text) of whole small files, or with a mark that ends each, of the records of files of any size (such files are split among tasks)."""
    rows = spark.read.text(path, wholetext=True) if mark is None else spark.read.text(path, lineSep=mark)
    return rows.select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("text"))


def decoded(spark: SparkSession, path: str, mark: str | None = None) -> DataFrame:
    """(file, size, text) of files, or of records that a mark ends, in UTF-8, or in Latin-1 where they aren't valid UTF-8; size counts bytes."""
    rows = texts(spark, path, mark)
    text = F.when(F.is_valid_utf8("text"), F.col("text")).otherwise(F.decode(F.col("text").cast("binary"), "ISO-8859-1"))
    return rows.select("file", F.octet_length("text").cast("long").alias("size"), text.alias("text"))


def first_by_stem(spark: SparkSession, path: str, suffixes: list[str], name: str = "([^/]+)$") -> DataFrame:
    """For each stem the file whose suffix comes first in the list; contents aren't read. `name` finds a file's name in its path (such as a folder's, where a writer names the files)."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "length").withColumn("name", F.regexp_extract("path", name, 1))
    place = F.array_position(F.array(*[F.lit(s) for s in suffixes]), F.regexp_extract("name", r"(\.[^.]+)$", 1))
    rows = files.withColumn("stem", F.regexp_replace("name", r"\.[^.]+$", "")).withColumn("_place", place).where("_place > 0")
    best = Window.partitionBy("stem").orderBy("_place", "path")
    return rows.withColumn("_n", F.row_number().over(best)).where("_n = 1").drop("_n", "_place")


def stubs(files: DataFrame, size: str, head: str, markers: list[str]) -> DataFrame:
    """Adds `stub`: under 5,000 bytes, or under 50,000 with a marker in the first 500."""
    marked = F.exists(F.array(*[F.lit(m) for m in markers]), lambda m: F.contains(F.substring(F.col(head), 1, 500), m))
    return files.withColumn("stub", F.when(F.col(size) >= 50_000, False).when(F.col(size) < 5_000, True).otherwise(F.coalesce(marked, F.lit(True))))


def by_suffix(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Parquet or JSON lines by the path's suffix; where nothing is there, the other form beside it."""
    stem, suffix = path.rsplit(".", 1)
    reads = {"parquet": lambda p: spark.read.schema(schema).parquet(p), "jsonl": lambda p: json_lines(spark, p, schema)}
    other = {"parquet": "jsonl", "jsonl": "parquet"}[suffix]
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    there = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(root)
    return reads[suffix](path) if there else reads[other](f"{stem}.{other}")


def _either(df: DataFrame, names: tuple[str, ...], default: str | None = None) -> Column:
    """The first of these columns that isn't blank, whatever the case of its name."""
    known = {c.lower(): c for c in df.columns}
    found = [F.nullif(F.trim(F.col(f"`{known[n]}`")), F.lit("")) for n in names if n in known]
    return F.coalesce(*found, F.lit(default).cast("string"))


def universe(df: DataFrame) -> DataFrame:
    """id, name, sector and year of a report list, by any of the known headers, from 2020 on and with an id."""
    year = _either(df, ("report_year", "year", "fiscal_year")).try_cast("int")
    rows = df.select(_either(df, ("company_id", "lei", "company_number", "id")).alias("id"), _either(df, ("company_name", "company", "name"), "Unknown").alias("name"), _either(df, ("cni_sector", "sector"), "Other").alias("sector"), year.alias("year"))
    return rows.where("id is not null and year >= 2020")


def companies(df: DataFrame) -> DataFrame:
    """name and number of a list of companies; numbers of digits alone are padded to eight."""
    number = _either(df, ("company_number", "companynumber", "number"))
    return df.select(_either(df, ("company_name", "company name", "company", "name")).alias("name"), F.when(F.regexp_like(number, F.lit(r"^\d+$")), F.lpad(number, 8, "0")).otherwise(number).alias("number"))


def first_answer(candidates: Column, between: str = "\n") -> Column:
    """The joined text parts of the first candidate that has any."""
    texts = F.transform(candidates, lambda c: F.transform(c["content"]["parts"], lambda p: p["text"]))
    first = F.get(F.filter(texts, lambda t: F.size(t) > 0), F.lit(0))
    return F.array_join(first, between)
