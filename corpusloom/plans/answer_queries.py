"""Queries over answers of all kinds: each form of answer with what it breaks, told beside it by hand."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import answer_rules
from ..operators import passages
from .registry import query, table

#: (kind, answer, messages); # stands for the row's number.
_ANSWERS = [
    ("harms", '{"harms_mentioned":true,"confidence":0.5,"evidence":["a"],"id":#}', ""), ("harms", '{"confidence":2,"evidence":"a","id":#}', "confidence must be between 0 and 1; evidence must be a list; missing field: harms_mentioned"),
    ("harms", '{"harms_mentioned":"yes","evidence":["a",#]}', "evidence entry must be a string; harms_mentioned must be a bool"),
    ("adoption_type", '{"adoption_signals":[{"type":"llm","signal":1},{"type":"agentic","signal":0},{"type":"non_llm","signal":3}],"id":#}', ""),
    ("adoption", '{"adoption_signals":[{"type":"llm","signal":1.5},{"type":"llm","signal":7},{"type":"x#","signal":"1"},3]}', "adoption_signals entry must be a dict; adoption_signals lacks: agentic, non_llm; repeated label in adoption_signals: llm; signal must be a whole number from 0 to 3; signal must be between 0 and 3; signal must be numeric; unknown label in adoption_signals"),
    ("substantiveness", '{"substantiveness":" Contextual ","id":#}', ""), ("substantiveness", '{"substantiveness":#,"confidence":"high"}', "confidence must be numeric; unknown level in substantiveness"),
    ("mention_type_v2", '{"mention_types":["risk"],"confidence_scores":{"risk":0.7},"id":#}', ""), ("mention_type", '{"mention_types":"risk","confidence_scores":{"a":-1,"b":null},"id":#}', "confidence must be between 0 and 1; confidence must be numeric; mention_types must be a list"),
    ("vendor", '{"vendors":[{"vendor":"v#","signal":2}]}', ""), ("vendor", '{"vendors":[{"vendor":"v#"},{"signal":4},"v"]}', "vendors entry lacks signal; vendors entry must be a dict; vendors signal must be one of 1, 2, 3"),
    ("risk", '{"risk_types":["cybersecurity"],"risk_signals":[{"type":"cybersecurity","signal":2}],"substantiveness":"moderate","id":#}', ""),
    ("risk", '{"risk_types":["none","cybersecurity"],"risk_signals":[{"type":"cybersecurity","signal":0},{"type":"national_security","signal":1}],"id":#}',
     "missing field: substantiveness; none with other labels in risk_types; risk_signals has labels beside risk_types: national_security; risk_signals lacks labels of risk_types: none; selected labels need a signal of 1 to 3"),
    ("risk", '{"risk_types":["floods"],"confidence_scores":{"floods":1,"cybersecurity":9},"id":#}', "signal must be between 0 and 3; unknown label in confidence_scores: floods; unknown label in risk_types: floods"), ("risk", '{"risk_types":[],"risk_signals":[],"substantiveness_score":5,"id":#}', "signal must be between 0 and 3"),
    ("risk_open", '{"anything":#}', ""), ("risk_open", "[#]", "answer must be a dict"), ("mood", '{"id":#}', "unknown kind: mood"), ("harms", '{"harms_mentioned":#', "answer must be a dict"),
]
#: (text, the same with stray letters put back); # stands for the row's number.
_STRAY = [
    ("management uses a number # of alternative measures", "management uses a number # of alternative measures"), ("principal risk s and uncertainties #", "principal risks and uncertainties #"), ("the c ustomer base #", "the customer base #"),
    ("a company overview #", "a company overview #"), ("value s, price s.", "values, prices."), ("see b and c for # i n detail", "seeb andc for # i ndetail"),
]


def _quoted(text: str, key: str) -> str:
    return f" || CAST({key} AS STRING) || ".join("'" + part.replace("'", "''") + "'" for part in text.split("#"))


def _case(key: str, forms: list[str]) -> str:
    return f"CASE {key} % {len(forms)} " + " ".join(f"WHEN {i} THEN {_quoted(x, key)}" for i, x in enumerate(forms)) + " END"


@query(f"SELECT o_orderkey AS pk, {_case('o_orderkey', [a[0] for a in _ANSWERS])} AS kind, {_case('o_orderkey', [a[2] for a in _ANSWERS])} AS messages FROM orders".replace("AS STRING", "AS VARCHAR"))
def answer_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All rules that answers of all kinds break, read in one scan."""
    rows = table(spark, sf_dir, "orders", "o_orderkey").select(F.col("o_orderkey").alias("pk"), F.expr(_case("o_orderkey", [a[0] for a in _ANSWERS])).alias("kind"), F.expr(_case("o_orderkey", [a[1] for a in _ANSWERS])).alias("raw"))
    return answer_rules.checked(rows, "raw", "kind").select("pk", "kind", F.array_join(F.array_sort("messages"), "; ").alias("messages"))


@query(f"SELECT o_orderkey AS pk, {_case('o_orderkey', [a[1] for a in _STRAY])} AS text FROM orders".replace("AS STRING", "AS VARCHAR"))
def stray_letters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Single letters put back to the words that they broke off from."""
    return table(spark, sf_dir, "orders", "o_orderkey").select(F.col("o_orderkey").alias("pk"), passages.merged_letters(F.expr(_case("o_orderkey", [a[0] for a in _STRAY]))).alias("text"))
