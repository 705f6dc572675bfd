"""Text renderings of rule hits and results, all as JVM-side expressions.

Number and time formats follow Python's formatting of the same values:
``{:.2f}`` is ``format_number(x, '0.00')`` (both round the exact binary value
half-to-even; ``format_string('%.2f')`` would round half-up), ``${:,.2f}`` is
``'$' || format_number(x, '#,##0.00')`` and ``str(None)`` is ``'None'``.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


# Texts of the sequential scorer, in Python format syntax.
NO_FLAGGED_TEXT = "No flagged transactions to summarize."
EXPLANATION_FALLBACK = "Explanation unavailable (LLM error)."
NO_RULES_TEXT = "None"
DETAIL_TEMPLATES = {
    "HighAmount": "Amount {amount:.2f} >= {threshold}",
    "CountryMismatch": "Card country {card} != IP country {ip}",
    "BlacklistedMCC": "MCC {mcc} is blacklisted",
    "HighVelocity": "{count} txns in last {minutes} minutes for user {user}",
    "NightTime": "Transaction at {hour:02d}:00",
    "NewDevice": "New device {device} for user {user}",
}
HIT_SHORT = "{name} (+{points})"
HIT_DETAILED = "{name} (+{points}) [{details}]"
HIT_BULLET = "- {name} (+{points}): {details}"
HITS_SEPARATOR = "; "
BULLETS_SEPARATOR = "\n"

_FIELD = re.compile(r"\{(\w+)(?::([^}]*))?\}")


def fmt_number(col: Column, pattern: str) -> Column:
    return F.call_function("format_number", col, F.lit(pattern))


def _finite(col: Column, text: Column) -> Column:
    """``text`` for finite numbers, else Python's ``nan``, ``inf`` and ``-inf``."""
    x = col.cast("double")
    return (F.when(F.isnan(x), F.lit("nan")).when(x == float("inf"), F.lit("inf"))
            .when(x == float("-inf"), F.lit("-inf")).otherwise(text))


def fixed2(col: Column) -> Column:
    """Python ``f"{x:.2f}"``."""
    return _finite(col, fmt_number(col, "0.00"))


def money(col: Column) -> Column:
    """Python ``"${:,.2f}".format(x)``."""
    return F.concat(F.lit("$"), _finite(col, fmt_number(col, "#,##0.00")))


def py_str(col: Column) -> Column:
    """Python ``str(x)`` for strings / ints, with ``None`` for NULL."""
    return F.coalesce(col.cast("string"), F.lit("None"))


def _field(value, spec: str | None) -> Column:
    if not isinstance(value, Column):          # a driver-side constant, formatted by Python itself
        return F.lit(format(value, spec or ""))
    if spec is None:
        return py_str(value)
    if spec == ".2f":
        return fixed2(value)
    if spec == "02d":
        return F.lpad(value.cast("string"), 2, "0")
    raise ValueError(f"unsupported format spec {spec!r}")


def render(template: str, **values) -> Column:
    """A Python format string as a Spark expression: literals stay text, fields become columns."""
    parts, pos = [], 0
    for m in _FIELD.finditer(template):
        if m.start() > pos:
            parts.append(F.lit(template[pos:m.start()]))
        parts.append(_field(values[m.group(1)], m.group(2)))
        pos = m.end()
    if pos < len(template):
        parts.append(F.lit(template[pos:]))
    return F.concat(*parts)


# --- rule details (R11) ----------------------------------------------------

def detail_high_amount(amount: Column, threshold: float) -> Column:
    return render(DETAIL_TEMPLATES["HighAmount"], amount=amount, threshold=float(threshold))


def detail_country_mismatch(card: Column, ip: Column) -> Column:
    return render(DETAIL_TEMPLATES["CountryMismatch"], card=card, ip=ip)


def detail_blacklisted_mcc(mcc: Column) -> Column:
    return render(DETAIL_TEMPLATES["BlacklistedMCC"], mcc=mcc)


def detail_high_velocity(count: Column, window_minutes: int, user: Column) -> Column:
    return render(DETAIL_TEMPLATES["HighVelocity"], count=count, minutes=int(window_minutes), user=user)


def detail_night_time(ts: Column) -> Column:
    return render(DETAIL_TEMPLATES["NightTime"], hour=F.hour(ts))


def detail_new_device(device: Column, user: Column) -> Column:
    return render(DETAIL_TEMPLATES["NewDevice"], device=device, user=user)


# --- rule-hit list renderings (F8-F10) ------------------------------------

def _join_hits(hits: Column, template: str, sep: str) -> Column:
    return F.array_join(F.transform(hits, lambda h: render(template, name=h["name"], points=h["points"],
                                                               details=h["details"])), sep)


def hits_short_text(hits: Column) -> Column:
    """``"Name (+pts)"`` joined by ``"; "``."""
    return _join_hits(hits, HIT_SHORT, HITS_SEPARATOR)


def hits_detailed_text(hits: Column) -> Column:
    """``"Name (+pts) [details]"`` joined by ``"; "``."""
    return _join_hits(hits, HIT_DETAILED, HITS_SEPARATOR)


def hits_bullets(hits: Column) -> Column:
    """``"- Name (+pts): details"`` lines, or ``None`` when nothing fired."""
    return F.when(F.size(hits) == 0, F.lit(NO_RULES_TEXT)).otherwise(
        _join_hits(hits, HIT_BULLET, BULLETS_SEPARATOR))


def hits_names(hits: Column, sep: str = ", ") -> Column:
    return F.array_join(F.transform(hits, lambda h: h["name"]), sep)


# --- JSON rendering of a small record (F11) ---------------------------------

# The short escapes of Python's json.dumps.
JSON_SHORT_ESCAPES = {'"': '\\"', "\\": "\\\\", "\n": "\\n", "\r": "\\r", "\t": "\\t",
                      "\b": "\\b", "\f": "\\f"}


def json_string(col: Column) -> Column:
    """``json.dumps(s)`` of a string (``ensure_ascii``): Python's escaping, character by character.

    Printable ASCII stays; the short escapes apply; every other character
    becomes lowercase ``\\uXXXX`` of its UTF-16 code units (a surrogate pair
    above U+FFFF).  NULL gives ``null``.
    """
    def one(c: Column) -> Column:
        out = F.when(c == F.lit('"'), F.lit(JSON_SHORT_ESCAPES['"']))
        for ch, esc in JSON_SHORT_ESCAPES.items():
            if ch != '"':
                out = out.when(c == F.lit(ch), F.lit(esc))
        printable = (c >= F.lit(" ")) & (c <= F.lit("~"))
        utf16 = F.lower(F.hex(F.encode(c, "UTF-16BE")))
        return out.when(printable, c).otherwise(F.regexp_replace(utf16, "(.{4})", r"\\u$1"))

    # plain printable text needs no escape: only other strings are split into characters
    body = F.when(col.rlike(r'^[ !#-\[\]-~]*$'), col).otherwise(
        F.array_join(F.transform(F.split(col, ""), one), ""))
    return F.when(col.isNull(), F.lit("null")).otherwise(F.concat(F.lit('"'), body, F.lit('"')))


def json_double(col: Column) -> Column:
    """``json.dumps(x)`` of a double: positional from 1e-4 to 1e16, else ``1.5e+16``; ``NaN``, ``Infinity``."""
    x = col.cast("double")
    java = x.cast("string")
    size = F.abs(x)
    digits = F.regexp_replace(java.try_cast("decimal(38,21)").cast("string"), "0+$", "")
    positional = F.when(digits.endswith("."), F.concat(digits, F.lit("0"))).otherwise(digits)
    power = F.substring_index(java, "E", -1).try_cast("int")
    mantissa = F.regexp_replace(F.substring_index(java, "E", 1), r"\.0$", "")
    scientific = F.concat(mantissa, F.when(power < 0, F.lit("e-")).otherwise(F.lit("e+")),
                          F.when(F.abs(power) < 10, F.lit("0")).otherwise(F.lit("")), F.abs(power).cast("string"))
    return (F.when(x.isNull(), F.lit("null")).when(F.isnan(x), F.lit("NaN"))
            .when(x == float("inf"), F.lit("Infinity")).when(x == float("-inf"), F.lit("-Infinity"))
            .when((size != 0) & ((size >= 1e16) | (size < 1e-4)), scientific)
            .when((size != 0) & ((size >= 1e7) | (size < 1e-3)), positional).otherwise(java))


def indented_json(fields: list[tuple[str, Column, bool]]) -> Column:
    """``json.dumps(record, indent=2)`` layout for a flat record of (name, column, is_text) fields."""
    parts: list[Column] = [F.lit("{\n")]
    for i, (name, col, is_text) in enumerate(fields):
        sep = ",\n" if i < len(fields) - 1 else "\n"
        parts += [F.lit(f'  "{name}": '), json_string(col) if is_text else json_double(col), F.lit(sep)]
    parts.append(F.lit("}"))
    return F.concat(*parts)
