"""Rules on answers against a plain reading of them."""

from __future__ import annotations

import json
import random

from pyspark.sql import Observation, SparkSession

from corpusloom.functions import answer_rules as rules


def _signal(x: object) -> list[str]:
    if isinstance(x, bool) or not isinstance(x, (int, float)):
        return ["signal must be numeric"]
    if x != int(x):
        return ["signal must be a whole number from 0 to 3"]
    return [] if 0 <= x <= 3 else ["signal must be between 0 and 3"]


def _confidence(x: object) -> list[str]:
    if not isinstance(x, (int, float)):
        return ["confidence must be numeric"]
    return [] if 0 <= x <= 1 else ["confidence must be between 0 and 1"]


def _level(x: object) -> bool:
    return isinstance(x, str) and {"contextual": "moderate"}.get(x.strip().lower(), x.strip().lower()) in rules.LEVELS


def _text(x: object) -> str:
    return x if isinstance(x, str) else json.dumps(x, separators=(",", ":"))


def _plain(raw: str, kind: str) -> list[str]:
    kind = rules.ALIASES.get(kind, kind)
    unknown = [] if kind in rules.RULES or kind in rules.GENERIC else [f"unknown kind: {kind}"]
    try:
        a = json.loads(raw)
    except ValueError:
        return ["answer must be a dict", *unknown]
    if not isinstance(a, dict):
        return ["answer must be a dict", *unknown]
    out: list[str] = []

    def need(field: str, kind_of: type, name: str) -> bool:
        if field not in a:
            out.append(f"missing field: {field}")
        elif not isinstance(a[field], kind_of):
            out.append(f"{field} must be a {name}")
        else:
            return True
        return False

    def level() -> None:
        if "substantiveness" in a:
            if not _level(a["substantiveness"]):
                out.append("unknown level in substantiveness")
        elif "substantiveness_score" in a:
            out.extend(_signal(a["substantiveness_score"]))
        else:
            out.append("missing field: substantiveness")

    if kind == "harms":
        need("harms_mentioned", bool, "bool")
        out += _confidence(a["confidence"]) if "confidence" in a else []
        if "evidence" in a and need("evidence", list, "list"):
            out += ["evidence entry must be a string" for e in a["evidence"] if not isinstance(e, str)]
    elif kind == "adoption" and need("adoption_signals", list, "list"):
        seen: set = set()
        for e in a["adoption_signals"]:
            if not isinstance(e, dict):
                out.append("adoption_signals entry must be a dict")
                continue
            t = e.get("type")
            if t not in rules.ADOPTION:
                out.append("unknown label in adoption_signals")
            elif t in seen:
                out.append(f"repeated label in adoption_signals: {t}")
            seen.add(str(t))
            out += _signal(e.get("signal"))
        lacks = sorted(set(rules.ADOPTION) - seen)
        out += [f"adoption_signals lacks: {', '.join(lacks)}"] if lacks else []
    elif kind == "substantiveness":
        if "substantiveness" not in a:
            out.append("missing field: substantiveness")
        elif not _level(a["substantiveness"]):
            out.append("unknown level in substantiveness")
        out += _confidence(a["confidence"]) if "confidence" in a else []
    elif kind == "mention_type":
        need("mention_types", list, "list")
        if need("confidence_scores", dict, "dict"):
            for x in a["confidence_scores"].values():
                out += _confidence(x)
    elif kind == "vendor" and need("vendors", list, "list"):
        for e in a["vendors"]:
            if not isinstance(e, dict):
                out.append("vendors entry must be a dict")
            elif "signal" not in e:
                out.append("vendors entry lacks signal")
            elif e["signal"] not in (1, 2, 3):
                out.append("vendors signal must be one of 1, 2, 3")
    elif kind == "risk":
        if need("risk_types", list, "list"):
            out += [f"unknown label in risk_types: {_text(t)}" for t in a["risk_types"] if t not in rules.RISKS]
        if "risk_signals" not in a and "confidence_scores" in a:
            if need("confidence_scores", dict, "dict"):
                for k, x in a["confidence_scores"].items():
                    out += [] if k in rules.RISKS else [f"unknown label in confidence_scores: {k}"]
                    out += _signal(x)
            return sorted(out)
        if need("risk_signals", list, "list"):
            seen = set()
            for e in a["risk_signals"]:
                if not isinstance(e, dict):
                    out.append("risk_signals entry must be a dict")
                    continue
                t, x = e.get("type"), e.get("signal")
                if t not in rules.RISKS:
                    out.append("unknown label in risk_signals")
                elif t in seen:
                    out.append(f"repeated label in risk_signals: {t}")
                else:
                    seen.add(t)
                out += _signal(x)
                out += ["selected labels need a signal of 1 to 3"] if isinstance(x, (int, float)) and int(x) == 0 else []
            types = {_text(t) for t in a["risk_types"]} if isinstance(a.get("risk_types"), list) else set()
            out += ["none with other labels in risk_types"] if "none" in types and len(types) > 1 else []
            for left, right, text in ((types, seen, "risk_signals lacks labels of risk_types: "), (seen, types, "risk_signals has labels beside risk_types: ")):
                out += [text + ", ".join(sorted(left - right))] if left - right else []
        elif "risk_signals" in a and isinstance(a.get("risk_types"), list) and len(set(map(_text, a["risk_types"]))) > 1 and "none" in a["risk_types"]:
            out.append("none with other labels in risk_types")
        level()
    return sorted([*out, *unknown])


def _value(rng: random.Random) -> object:
    return rng.choice([0, 1, 2, 3, 4, -1, 0.5, 2.0, True, False, None, "x", [], {}, 1.5])


def _answer(rng: random.Random) -> tuple[str, str]:
    kind = rng.choice([*rules.RULES, *rules.ALIASES, "risk_open", "other"])
    label = lambda some: rng.choice([*some, *some, "zzz", 7, None])
    signals = lambda some: rng.choice([[{k: v for k, v in (("type", label(some)), ("signal", _value(rng))) if rng.random() < 0.9} if rng.random() < 0.9 else rng.choice([1, "a", None]) for _ in range(rng.randrange(4))], _value(rng)])
    fields = {
        "harms_mentioned": _value(rng), "confidence": _value(rng), "evidence": rng.choice([["a", "b"], ["a", 1, None], _value(rng)]), "adoption_signals": signals(rules.ADOPTION),
        "substantiveness": rng.choice(["Contextual ", "substantive", "vague", _value(rng)]), "substantiveness_score": _value(rng), "mention_types": rng.choice([["risk"], _value(rng)]),
        "confidence_scores": rng.choice([{"cybersecurity": _value(rng), "b": _value(rng)}, _value(rng)]), "vendors": signals(("v",)), "risk_types": rng.choice([[label(rules.RISKS[-3:]) for _ in range(rng.randrange(4))], _value(rng)]), "risk_signals": signals(rules.RISKS[-3:]),
    }
    raw = json.dumps({k: v for k, v in fields.items() if rng.random() < 0.8})
    return (rng.choice(["", "[1]", "null", "{", '"a"']) if rng.random() < 0.05 else raw), kind


def test_against_plain_rules(spark: SparkSession) -> None:
    rng = random.Random(7)
    rows = [(i, *_answer(rng)) for i in range(1500)]
    counts = Observation("answers")
    found = rules.checked(spark.createDataFrame(rows, "i int, raw string, kind string"), "raw", "kind", counts).collect()
    faulty = 0
    for r in found:
        want = sorted(_plain(r["raw"], r["kind"]))
        assert sorted(r["messages"]) == want, (r["kind"], r["raw"])
        faulty += bool(want)
    assert counts.get == {"answers": len(rows), "faulty": faulty, "messages": sum(len(r["messages"]) for r in found)}
    assert {k for _, _, k in rows} >= set(rules.RULES)


def test_null_answers(spark: SparkSession) -> None:
    rows = [(None, "risk"), (None, None), ("{}", None)]
    found = rules.checked(spark.createDataFrame(rows, "raw string, kind string"), "raw", "kind").collect()
    assert [r["messages"] for r in found] == [["answer must be a dict"], ["answer must be a dict", "unknown kind: null"], ["unknown kind: null"]]
