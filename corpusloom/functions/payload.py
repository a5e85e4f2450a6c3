"""Semi-structured answers: tolerant JSON, label lists, signal maps and validation, on VARIANT and array functions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def parse_json(text: Column) -> Column:
    """The first reading that is a JSON object: as it is, without code fences, or from the first to the last brace; then each again without trailing commas."""
    bare = F.regexp_replace(F.regexp_replace(text, r"^\s*```(?:json)?\s*", ""), r"\s*```\s*$", "")
    inner = F.regexp_extract(text, r"(?s)(\{.*\})", 1)
    forms = [text, bare, inner]
    forms += [F.regexp_replace(x, r",\s*([}\]])", "$1") for x in forms]
    found = [F.try_parse_json(F.nullif(x, F.lit(""))) for x in forms]
    return F.coalesce(*[F.when(F.schema_of_variant(v).startswith("OBJECT"), v) for v in found])


def salvage_labels(text: Column, field: str, vocabulary: Sequence[str]) -> Column:
    """Labels of the vocabulary that stand quoted after the field's name, also in a text that is cut off."""
    tail = F.regexp_extract(text, rf'(?s)"{field}"\s*:\s*\[?([^\]]*)', 1)
    named = F.regexp_extract_all(tail, F.lit(r'"([A-Za-z_ ]+)"'), F.lit(1))
    return F.filter(named, lambda x: x.isin(*vocabulary))


def label_list(labels: Column, prefixes: Sequence[str] = ()) -> Column:
    """Distinct labels in order, without enum prefixes; `none` only if it stands alone or nothing is left."""
    bare = labels
    if prefixes:
        bare = F.transform(bare, lambda x: F.regexp_replace(x, rf"^(?:{'|'.join(prefixes)})\.", ""))
    kept = F.array_sort(F.array_distinct(F.filter(F.transform(bare, F.lower), lambda x: x.isNotNull() & (F.trim(x) != ""))))
    others = F.array_remove(kept, "none")
    return F.when(F.size(others) > 0, others).otherwise(F.array(F.lit("none")))


def signal_map(signals: Column) -> Column:
    """Entries (type, signal) as a map; of repeated types the largest signal counts."""
    types = F.array_distinct(F.transform(signals, lambda s: s["type"]))
    best = F.transform(types, lambda t: F.array_max(F.transform(F.filter(signals, lambda s: s["type"] == t), lambda s: s["signal"])))
    return F.map_from_arrays(types, best)


def confidence_map(labels: Column, confidences: Column, scalar: Column) -> Column:
    """A label's confidence from the map, or the scalar for all labels, or an empty map."""
    spread = F.map_from_arrays(labels, F.transform(labels, lambda _: scalar))
    return F.coalesce(confidences, F.when(scalar.isNotNull(), spread), F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<double>")))


def at_least(labels: Column, confidences: Column, threshold: float) -> Column:
    """Labels with at least this confidence (missing: 0); a threshold of 0 or less keeps all."""
    return labels if threshold <= 0 else F.filter(labels, lambda x: F.coalesce(F.try_element_at(confidences, x), F.lit(0.0)) >= threshold)


def messages(rules: Sequence[tuple[Column, str]]) -> Column:
    """The messages of the rules that are broken (whose column is true)."""
    return F.array_compact(F.array(*[F.when(broken, F.lit(text)) for broken, text in rules]))


def salvage_number(text: Column, name: str) -> Column:
    """The number that stands after a quoted name, also in a text that is cut off behind it."""
    return F.nullif(F.regexp_extract(text, rf'"{name}"\s*:\s*(-?\d+(?:\.\d+)?)', 1), F.lit("")).try_cast("double")


def evidence(rows: DataFrame, v: str) -> DataFrame:
    """Rows of a VARIANT that holds lists by label, or one list, as a row for each excerpt, with its label (null in the second form)."""
    by_label = F.try_variant_get(v, "$", "map<string,array<string>>")
    plain = F.try_variant_get(v, "$", "array<string>")
    kept = [c for c in rows.columns if c != v]
    one = rows.where(F.schema_of_variant(v).startswith("OBJECT")).select(*kept, F.explode(by_label).alias("label", "es")).select(*kept, "label", F.explode("es").alias("excerpt"))
    return one.union(rows.where(F.schema_of_variant(v).startswith("ARRAY")).select(*kept, F.lit(None).cast("string").alias("label"), F.explode(plain).alias("excerpt")))


def _kind(value: Column) -> Column:
    return F.coalesce(F.schema_of_variant(value), F.lit("VOID"))


def number_messages(kind: Column, x: Column, name: str, low: int, high: int, whole: bool) -> Column:
    """What is wrong with a VARIANT (its kind and its value as a double) that should be a number from low to high, or null; a missing value is no number."""
    text = F.when(~F.left(kind, F.lit(3)).isin("BIG", "DOU", "FLO", "DEC"), f"{name} must be numeric")
    if whole:
        text = text.when(x != F.floor(x), f"{name} must be an integer")
    return text.when(~x.between(low, high), f"{name} must be between {low} and {high}")


def risk_messages(rows: DataFrame, v: str, vocabulary: Sequence[str], levels: Sequence[str]) -> DataFrame:
    """Adds `messages`, all rules that a risk answer (VARIANT object in column v) breaks: missing fields, wrong kinds, unknown and repeated labels, scores, `none` beside
    others, labels and scores that don't match, an unknown level and a confidence out of bounds. Rules on labels need both lists; a label's message stands once for each time it breaks the rule."""
    get, col, none = F.try_variant_get, F.col, F.array().cast("array<string>")
    kept = rows.columns
    # read once, in steps: the rules name these columns many times. Whether a value is a list is told by its cast, since the schema of a list costs a walk through it
    fields = {"_risk_types": "risk_types", "_risk_signals": "risk_signals", "_level": "substantiveness", "_confidence": "confidence"}
    rows = rows.withColumns({c: get(v, f"$.{n}", "variant") for c, n in fields.items()})
    rows = rows.withColumns({"_list": get("_risk_types", "$", "array<string>"), "_entries": get("_risk_signals", "$", "array<struct<type string, signal variant>>"), "_named": F.lower(F.trim(get("_level", "$", "string")))})
    rows = rows.withColumns({
        "_types": F.coalesce("_list", none), "_typed": col("_list").isNotNull(), "_scored": col("_entries").isNotNull(), "_seen": F.coalesce(col("_entries")["type"], none),
        "_values": F.transform("_entries", lambda e: F.struct(_kind(e["signal"]).alias("kind"), get(e["signal"], "$", "double").alias("x"))),
    })
    rows = rows.withColumn("_names", F.array_distinct(F.array_compact("_seen")))
    rows = rows.withColumns({"_less": F.array_except("_types", "_names"), "_more": F.array_except("_names", "_types")})
    types, seen, names, both = col("_types"), col("_seen"), col("_names"), col("_typed") & col("_scored")
    strange = lambda labels, field: F.transform(F.filter(labels, lambda x: x.isNull() | ~x.isin(*vocabulary)), lambda x: F.concat(F.lit(f"unknown label in {field}: "), F.coalesce(x, F.lit("null"))))
    unknown = lambda labels, field: F.when(F.size(F.array_except(labels, F.array(*map(F.lit, vocabulary)))) > 0, strange(labels, field)).otherwise(none)
    twice = F.filter(names, lambda n: n.isin(*vocabulary) & (F.size(F.filter(seen, lambda x: x == n)) > 1))
    repeated = F.when(F.size(seen) > F.size(names), F.transform(twice, lambda n: F.concat(F.lit("repeated label: "), n))).otherwise(none)
    uneven = lambda labels, text: F.when(both & (F.size(labels) > 0), F.concat(F.lit(text), F.array_join(F.array_sort(labels), ", ")))
    zero = lambda e: F.when(F.floor(e["x"]) == 0, "selected labels need a signal of 1 to 3")
    scores = F.flatten(F.transform("_values", lambda e: F.array(number_messages(e["kind"], e["x"], "signal", 0, 3, True), zero(e))))
    alone = [
        *[F.when(col(c).isNull(), f"missing field: {fields[c]}").when(~listed, f"{fields[c]} must be a list") for c, listed in (("_risk_types", col("_typed")), ("_risk_signals", col("_scored")))],
        F.when(both & F.array_contains(types, "none") & (F.size(F.array_distinct(types)) > 1), "none with other labels"),
        uneven(col("_less"), "labels without signal: "),
        uneven(col("_more"), "signals without label: "),
        F.when(col("_level").isNull(), "missing field: substantiveness").when(col("_named").isNull() | ~col("_named").isin(*levels), "unknown level"),
        F.when(col("_confidence").isNotNull(), number_messages(_kind(col("_confidence")), get("_confidence", "$", "double"), "confidence", 0, 1, False)),
    ]
    found = F.array_compact(F.concat(F.array(*alone), F.coalesce(scores, none), unknown(types, "risk_types"), unknown(seen, "risk_signals"), repeated))
    return rows.select(*kept, found.alias("messages"))
