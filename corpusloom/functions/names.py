"""Six ways to bring company names to one form, each for its own source, as Column functions. A null name stays null."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the rules below.
STRAIGHT = {"’": "'", "“": '"', "”": '"', "–": "-", "—": "-"}
ABBREVIATIONS = {
    "&": " AND ", "ABRDN": "ABERDEEN", " CO ": " COMPANY ", " CO'S ": " COMPANIES ", " INV TST ": " INVESTMENT TRUST ", " INV TRUST ": " INVESTMENT TRUST ", " INV ": " INVESTMENT ", " TST ": " TRUST ",
    " GLBL ": " GLOBAL ", " UTIL ": " UTILITIES ", " INF ": " INFRASTRUCTURE ", " RES ": " RESOURCES ", " CAP AND INC ": " CAPITAL AND INCOME ", " CAP ": " CAPITAL ", " INC ": " INCOME ", " INTL ": " INTERNATIONAL ",
    " PHARMA ": " PHARMACEUTICALS ", " AUTO TRADER ": " AUTOTRADER ", " BRITISH LAND CO ": " BRITISH LAND COMPANY ",
}
CANON_DROPS = (r"\bPUBLIC LIMITED COMPANY\b", r"\bP\.?L\.?C\.?\b", r"\bLIMITED\b", r"\bLTD\.?\b", r"\bTHE\b")
RECONCILED = r"\b(plc|ltd|limited|group|holdings|inc|corp|ord|npv|sa|nv)\b"
AUDITED = r"\b(plc|limited|ltd|holdings|group)\b"
STAGED = r"\b(PLC|LIMITED|LTD|GROUP|HOLDINGS|ORD|LD|N\.V\.|NV|INC|SHARES|NONVOTING|THE)\b"


def _collapsed(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, r"(?U)\s+", " "))


def listed(name: Column) -> Column:
    """Names of index lists: straight marks, no share class or note in brackets, letters, digits and &+'/- only, lower case, no company form."""
    text = F.translate(_collapsed(name), "".join(STRAIGHT), "".join(STRAIGHT.values()))
    for pattern in (r"\s+\([^)]*\)$", r"(?i)\bordinary shares?\b.*$", r"(?i)\b(ord|ords)\b.*$"):
        text = F.regexp_replace(text, pattern, "")
    text = F.lower(F.regexp_replace(text, "[^A-Za-z0-9&+'/-]+", " "))
    return _collapsed(F.regexp_replace(text, r"\b(public limited company|plc)\b", ""))


def canonical(name: Column) -> Column:
    """Names of segment lists: upper case, abbreviations written out in their order, no company form or article, letters and digits only."""
    text = F.concat(F.lit(" "), F.upper(name), F.lit(" "))
    for old, new in ABBREVIATIONS.items():
        text = F.replace(text, F.lit(old), F.lit(new))
    for pattern in CANON_DROPS:
        text = F.regexp_replace(text, pattern, " ")
    return _collapsed(F.regexp_replace(text, "[^A-Z0-9]+", " "))


def reconciled(name: Column) -> Column:
    """Names to reconcile: lower case, without forms and share classes, letters and digits run together."""
    return F.regexp_replace(F.regexp_replace(F.lower(name), RECONCILED, ""), "[^a-z0-9]", "")


def audited(name: Column) -> Column:
    """Names to audit: like those to reconcile, with `&` as `and` and fewer forms."""
    return F.regexp_replace(F.regexp_replace(F.replace(F.lower(name), F.lit("&"), F.lit(" and ")), AUDITED, " "), "[^a-z0-9]+", "")


def staged(name: Column) -> Column:
    """Names of the stages' sources: upper case with a longer list of dropped words."""
    return F.regexp_replace(F.regexp_replace(F.replace(F.upper(name), F.lit("&"), F.lit(" AND ")), STAGED, " "), "[^A-Z0-9]+", "")


def plain(name: Column) -> Column:
    """Names of exported metadata: upper case, single spaces."""
    return _collapsed(F.upper(name))
