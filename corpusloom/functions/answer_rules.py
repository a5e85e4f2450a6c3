"""Rules on classifiers' answers as a table, compiled to one expression over VARIANT values.

A rule is (test, field, arguments) with an optional guard; the rules of all kinds of answers become one array of messages for each
row, so a table of answers is read once whatever the kinds, and `checked` counts violations in the same pass
by an observation. Values that JSON can't parse, and answers that aren't objects, break one rule: they must be objects.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

# Kinds of answers and their old names, the vocabularies, and the numbers that count.
ALIASES = {"adoption_type": "adoption", "mention_type_v2": "mention_type"}
ADOPTION = ("agentic", "llm", "non_llm")
RISKS = (
    "strategic_competitive", "operational_technical", "cybersecurity", "workforce_impacts", "regulatory_compliance", "information_integrity", "reputational_ethical", "third_party_supply_chain", "environmental_impact", "national_security", "none",
)
LEVELS, LEVEL_ALIASES = ("boilerplate", "moderate", "substantive"), {"contextual": "moderate"}
GENERIC = ("risk_open", "generic")

Messages = Callable[[Column], Column]  # from an answer to its array of messages
NO_MESSAGE = "array<string>"


def _none() -> Column:
    return F.array().cast(NO_MESSAGE)


def _say(test: Column, message: str | Column) -> Column:
    return F.when(test, F.array(F.lit(message) if isinstance(message, str) else message)).otherwise(_none())


def _at(v: Column, field: str, kind: str = "variant") -> Column:
    return F.try_variant_get(v, f"$.{field}", kind)


def _type(v: Column) -> Column:
    """list, dict, bool, number, string or null of a value that is there."""
    found = F.schema_of_variant(v)
    starts = lambda *names: F.regexp_like(found, F.lit("^(" + "|".join(names) + ")"))
    return F.when(starts("ARRAY"), "list").when(starts("OBJECT"), "dict").when(starts("BOOLEAN"), "bool").when(starts("STRING"), "string").when(starts("VOID"), "null").when(found.isNotNull(), "number")


def _is(v: Column, kind: str) -> Column:
    return F.coalesce(_type(v) == kind, F.lit(False))


def _entries(v: Column, field: str) -> Column:
    return F.coalesce(_at(v, field, "array<variant>"), F.array().cast("array<variant>"))


def _each(v: Column, field: str, of: Messages) -> Column:
    """The messages of all entries of a list, none if it is no list."""
    return F.flatten(F.transform(_entries(v, field), of))


def _dicts(v: Column, field: str, of: Messages) -> Column:
    return _each(v, field, lambda e: F.when(_is(e, "dict"), of(e)).otherwise(_none()))


def _signal(x: Column) -> Column:
    """A signal is a whole number from 0 to 3."""
    n = F.try_variant_get(x, "$", "double")
    return (
        F.when(~_is(x, "number"), F.array(F.lit("signal must be numeric")))
        .when(n != F.floor(n), F.array(F.lit("signal must be a whole number from 0 to 3")))
        .when((n < 0) | (n > 3), F.array(F.lit("signal must be between 0 and 3")))
        .otherwise(_none())
    )


def _confidence(x: Column) -> Column:
    """A confidence is a number from 0 to 1; true and false count as 1 and 0."""
    n = F.try_variant_get(x, "$", "double")
    return F.when(_is(x, "bool"), _none()).when(~_is(x, "number"), F.array(F.lit("confidence must be numeric"))).when((n < 0) | (n > 1), F.array(F.lit("confidence must be between 0 and 1"))).otherwise(_none())


def _level(x: Column) -> Column:
    text = F.lower(F.trim(F.try_variant_get(x, "$", "string")))
    for old, new in LEVEL_ALIASES.items():
        text = F.when(text == old, new).otherwise(text)
    return _is(x, "string") & F.coalesce(text.isin(*LEVELS), F.lit(False))


def _names(v: Column, field: str, allowed: Sequence[str], key: str = "type") -> Column:
    """The allowed names of a list's entries, in order, with repeats."""
    names = F.transform(_entries(v, field), lambda e: F.when(_is(e, "dict") & _is(_at(e, key), "string"), _at(e, key, "string")))
    return F.filter(names, lambda n: F.coalesce(n.isin(*allowed), F.lit(False)))


def _repeats(names: Column) -> Column:
    return F.filter(F.transform(names, lambda n, i: F.when(F.array_position(names, n) <= i, n)), lambda n: n.isNotNull())


def _listed(names: Column, message: str) -> Column:
    return _say(F.size(names) > 0, F.concat(F.lit(message), F.array_join(F.array_sort(names), ", ")))


def _labels(v: Column, field: str) -> Column:
    """A plain list's values as text; values of other types in their JSON form."""
    return F.transform(_entries(v, field), lambda e: F.when(_is(e, "string"), F.try_variant_get(e, "$", "string")).otherwise(F.to_json(e)))


TESTS: dict[str, Callable[..., Column]] = {
    "required": lambda v, f: _say(_at(v, f).isNull(), f"missing field: {f}"),
    "typed": lambda v, f, kind: _say(_at(v, f).isNotNull() & ~_is(_at(v, f), kind), f"{f} must be a {kind}"),
    "dicts": lambda v, f: _each(v, f, lambda e: _say(~_is(e, "dict"), f"{f} entry must be a dict")),
    "strings": lambda v, f: _each(v, f, lambda e: _say(~_is(e, "string"), f"{f} entry must be a string")),
    "known": lambda v, f, allowed: _dicts(v, f, lambda e: _say(~F.coalesce(_is(_at(e, "type"), "string") & _at(e, "type", "string").isin(*allowed), F.lit(False)), f"unknown label in {f}")),
    "once": lambda v, f, allowed: F.transform(_repeats(_names(v, f, allowed)), lambda n: F.concat(F.lit(f"repeated label in {f}: "), n)),
    "complete": lambda v, f, allowed: F.when(_is(_at(v, f), "list"), _listed(F.array_except(F.array(*map(F.lit, allowed)), _names(v, f, allowed)), f"{f} lacks: ")).otherwise(_none()),
    "signals": lambda v, f: _dicts(v, f, lambda e: _signal(_at(e, "signal"))),
    "not_zero": lambda v, f: _dicts(v, f, lambda e: _say(_is(_at(e, "signal"), "number") & F.coalesce(F.abs(_at(e, "signal", "double")) < 1, F.lit(False)) | F.coalesce(_at(e, "signal", "boolean") == F.lit(False), F.lit(False)) & _is(_at(e, "signal"), "bool"), "selected labels need a signal of 1 to 3")),
    "has": lambda v, f, key: _dicts(v, f, lambda e: _say(_at(e, key).isNull(), f"{f} entry lacks {key}")),
    "one_of": lambda v, f, key, values: _dicts(v, f, lambda e: _say(_at(e, key).isNotNull() & ~F.coalesce((_is(_at(e, key), "number") & _at(e, key, "double").isin(*values)) | (_is(_at(e, key), "bool") & _at(e, key, "boolean") & F.lit(1 in values)), F.lit(False)), f"{f} {key} must be one of {', '.join(map(str, values))}")),
    "confidence": lambda v, f: F.when(_at(v, f).isNotNull(), _confidence(_at(v, f))).otherwise(_none()),
    "confidences": lambda v, f: F.flatten(F.transform(F.map_values(F.coalesce(_at(v, f, "map<string,variant>"), F.create_map().cast("map<string,variant>"))), _confidence)),
    "level": lambda v, f: _say(_at(v, f).isNotNull() & ~_level(_at(v, f)), f"unknown level in {f}"),
    "signal": lambda v, f: _signal(_at(v, f)),
    "labels": lambda v, f, allowed: F.transform(F.filter(_labels(v, f), lambda x: ~x.isin(*allowed)), lambda x: F.concat(F.lit(f"unknown label in {f}: "), x)),
    "keys": lambda v, f, allowed: F.transform(F.filter(F.array_sort(F.map_keys(F.coalesce(_at(v, f, "map<string,variant>"), F.create_map().cast("map<string,variant>")))), lambda k: ~k.isin(*allowed)), lambda k: F.concat(F.lit(f"unknown label in {f}: "), k)),
    "key_signals": lambda v, f: F.flatten(F.transform(F.map_values(F.coalesce(_at(v, f, "map<string,variant>"), F.create_map().cast("map<string,variant>"))), _signal)),
    "alone": lambda v, f: _say(F.array_contains(_labels(v, f), "none") & (F.size(F.array_distinct(_labels(v, f))) > 1), f"none with other labels in {f}"),
    "covered": lambda v, f, by, allowed: F.when(_is(_at(v, by), "list"), _listed(F.array_except(_labels(v, f), _names(v, by, allowed)), f"{by} lacks labels of {f}: ")).otherwise(_none()),
    "only": lambda v, f, by, allowed: F.when(_is(_at(v, by), "list"), _listed(F.array_except(_names(v, by, allowed), _labels(v, f)), f"{by} has labels beside {f}: ")).otherwise(_none()),
}
#: Guards: rules that hold only if a field is there, or isn't.
THERE, ABSENT = "there", "absent"
_OLD = [(THERE, "confidence_scores"), (ABSENT, "risk_signals")]
_NEW = [(ABSENT, "confidence_scores"), (ABSENT, "risk_signals")]
_SIGNALS = [(THERE, "risk_signals")]
#: kind -> rules (test, field, arguments..., guards as a list at the end).
RULES: dict[str, list[tuple]] = {
    "harms": [("required", "harms_mentioned"), ("typed", "harms_mentioned", "bool"), ("confidence", "confidence"), ("typed", "evidence", "list"), ("strings", "evidence")],
    "adoption": [
        ("required", "adoption_signals"), ("typed", "adoption_signals", "list"), ("dicts", "adoption_signals"), ("known", "adoption_signals", ADOPTION), ("once", "adoption_signals", ADOPTION), ("signals", "adoption_signals"),
        ("complete", "adoption_signals", ADOPTION),
    ],
    "substantiveness": [("required", "substantiveness"), ("level", "substantiveness"), ("confidence", "confidence")],
    "mention_type": [("required", "mention_types"), ("typed", "mention_types", "list"), ("required", "confidence_scores"), ("typed", "confidence_scores", "dict"), ("confidences", "confidence_scores")],
    "vendor": [("required", "vendors"), ("typed", "vendors", "list"), ("dicts", "vendors"), ("has", "vendors", "signal"), ("one_of", "vendors", "signal", (1, 2, 3))],
    "risk": [
        ("required", "risk_types"), ("typed", "risk_types", "list"), ("labels", "risk_types", RISKS),
        ("typed", "confidence_scores", "dict", _OLD), ("keys", "confidence_scores", RISKS, _OLD), ("key_signals", "confidence_scores", _OLD), ("required", "risk_signals", _NEW),
        ("typed", "risk_signals", "list"), ("dicts", "risk_signals"), ("known", "risk_signals", RISKS), ("once", "risk_signals", RISKS), ("signals", "risk_signals"), ("not_zero", "risk_signals"), ("alone", "risk_types", [(THERE, "risk_signals")]),
        ("covered", "risk_types", "risk_signals", RISKS, _SIGNALS), ("only", "risk_types", "risk_signals", RISKS, _SIGNALS),
        # old answers with confidence scores say nothing of substantiveness
        *((test, field, [*guards, either]) for either in ((THERE, "risk_signals"), ) for test, field, guards in (
            ("level", "substantiveness", []), ("signal", "substantiveness_score", [(ABSENT, "substantiveness"), (THERE, "substantiveness_score")]), ("required", "substantiveness", [(ABSENT, "substantiveness_score")]))),
        *((test, field, [*guards, *_NEW]) for test, field, guards in (
            ("level", "substantiveness", []), ("signal", "substantiveness_score", [(ABSENT, "substantiveness"), (THERE, "substantiveness_score")]), ("required", "substantiveness", [(ABSENT, "substantiveness_score")]))),
    ],
}


def _compiled(v: Column, rule: tuple) -> Column:
    guards = rule[-1] if isinstance(rule[-1], list) else []
    test, field, *arguments = rule[: len(rule) - isinstance(rule[-1], list)]
    found = TESTS[test](v, field, *arguments)
    for how, name in guards:
        there = _at(v, name).isNotNull()
        found = F.when(there if how == THERE else ~there, found).otherwise(_none())
    return found


def answer_messages(v: Column, kind: Column) -> Column:
    """All rules that an answer (VARIANT) of a kind breaks, in the rules' order; kinds without rules must only be objects."""
    out = None
    for old, new in ALIASES.items():
        kind = F.when(kind == old, new).otherwise(kind)
    for name, rules in RULES.items():
        found = F.concat(*(_compiled(v, r) for r in rules))
        out = F.when(kind == name, found) if out is None else out.when(kind == name, found)
    unknown = _say(F.coalesce(~kind.isin(*RULES, *GENERIC), F.lit(True)), F.concat(F.lit("unknown kind: "), F.coalesce(kind, F.lit("null"))))
    return F.when(_is(v, "dict"), F.concat(out.otherwise(_none()), unknown)).otherwise(F.concat(F.array(F.lit("answer must be a dict")), unknown))


def checked(answers: DataFrame, raw: str, kind: str, counts: Observation | None = None) -> DataFrame:
    """answers with `messages`; counts, if given, gets `answers`, `faulty` and `messages` when the result is written."""
    rows = answers.withColumn("messages", answer_messages(F.try_parse_json(F.col(raw)), F.col(kind)))
    if counts is None:
        return rows
    return rows.observe(counts, F.count(F.lit(1)).alias("answers"), F.count_if(F.size("messages") > 0).alias("faulty"), F.coalesce(F.sum(F.size("messages")), F.lit(0)).alias("messages"))
