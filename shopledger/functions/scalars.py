"""Column helpers: ratios, text clean-up, small parsers. All of them stay inside the JVM."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

NO_REASON = "Sin razón especificada"  # fixed value: label of a missing cancellation reason


def safe_ratio(numerator: Column, denominator: Column) -> Column:
    """``numerator / denominator``, 0 where the denominator is 0 or missing."""
    return F.coalesce(F.try_divide(numerator.cast("double"), denominator.cast("double")), F.lit(0.0))


def percent(numerator: Column, denominator: Column) -> Column:
    return safe_ratio(numerator, denominator) * F.lit(100.0)


def percent_text(value: Column) -> Column:
    """``12.30%``; an empty string where there is no value."""
    return F.when(value.isNull(), F.lit("")).otherwise(F.format_string("%.2f%%", value.cast("double")))


def percent_number(text: Column) -> Column:
    """``"12,3%"`` as 12.3; NULL if it is not a number."""
    return F.trim(F.translate(text.cast("string"), ",%", ".")).try_cast("double")


def lenient_amount(text: Column) -> Column:
    """A number, or else the part before the first dot of a badly formatted one. For callers' own inputs; no report needs it."""
    raw = text.cast("string")
    return F.coalesce(raw.try_cast("double"), F.substring_index(raw, ".", 1).try_cast("double"))


# --- delivery frequency -------------------------------------------------------
# The words and patterns of frequency texts ("Every 4 weeks", "28 days").


def every_n(text: Column) -> Column:
    """``"Every 4 weeks"`` as 4; the unit is not looked at."""
    token = F.try_element_at(F.split(text, r"\s+"), F.lit(2))
    return F.when(text.startswith("Every"), token.try_cast("int"))


def every_n_weeks(text: Column) -> Column:
    """The N of ``Every N weeks`` anywhere in the text, NULL for any other unit."""
    return F.nullif(F.regexp_extract(text, r"Every\s+(\d+)\s+weeks", 1), F.lit("")).try_cast("int")


def days_as_weeks(text: Column) -> Column:
    """``"28 days"`` as 4.0."""
    return F.try_element_at(F.split(F.trim(text), r"\s+"), F.lit(1)).try_cast("int") / F.lit(7.0)


def in_parentheses(text: Column) -> Column:
    """What stands between the last ``(`` and the ``)`` after it."""
    return F.substring_index(F.substring_index(text, "(", -1), ")", 1)


# --- text ---------------------------------------------------------------------


def reason_root(reason: Column, separator: str = "->", blank_is_missing: bool = False) -> Column:
    """The first level of ``"a -> b -> c"``; a missing reason gets the fixed label."""
    root = F.trim(F.substring_index(F.trim(reason), separator, 1))
    if blank_is_missing:
        return F.when(reason.isNull() | (F.trim(reason) == ""), F.lit(NO_REASON)).otherwise(root)
    return F.coalesce(root, F.lit(NO_REASON))


def first_word(text: Column) -> Column:
    return F.try_element_at(F.split(F.trim(text), r"\s+"), F.lit(1))


def word_after(text: Column, marker: str) -> Column:
    """The word following the last ``marker``, NULL if the marker is absent."""
    return F.when(text.contains(marker), first_word(F.substring_index(text, marker, -1)))


def normalized_status(status: Column) -> Column:
    return F.upper(F.trim(F.coalesce(status.cast("string"), F.lit(""))))


def is_truthy(flag: Column) -> Column:
    return F.coalesce(F.lower(F.trim(flag.cast("string"))).isin("true", "1", "yes", "y", "t"), F.lit(False))


def blank_to_null(text: Column) -> Column:
    return F.nullif(F.trim(text.cast("string")), F.lit(""))


def lookup_key(name: Column) -> Column:
    """Names compared without case, spaces and hyphens, but as a whole."""
    return F.lower(F.regexp_replace(F.trim(name), "[ -]", ""))


def step_number(step: Column) -> Column:
    return F.nullif(F.regexp_extract(step, r"^(\d+)\.", 1), F.lit("")).try_cast("int")


def step_name(step: Column) -> Column:
    return F.regexp_replace(step, r"^\d+\.\s*", "")


# --- JSON ---------------------------------------------------------------------


def decline_code(metadata: Column, path: str = "$.stripeError.error.decline_code") -> Column:
    return F.when(F.try_parse_json(metadata).isNull(), F.lit("invalid_metadata")).otherwise(
        F.coalesce(F.get_json_object(metadata, path), F.lit("unknown_error"))
    )


# --- rules --------------------------------------------------------------------


def classify(code: Column, rules: Sequence[dict], default: int) -> Column:
    """First matching rule wins.

    A rule is ``{"type": id}`` plus any of ``"prefixes"``, ``"codes"`` and
    ``"between"`` (two numbers, for codes made of digits); one hit is enough.
    """
    key = F.upper(F.trim(code.cast("string")))
    result = None
    for rule in rules:
        hit = F.lit(False)
        for prefix in rule.get("prefixes", ()):
            hit = hit | key.startswith(prefix)
        if rule.get("codes"):
            hit = hit | key.isin(list(rule["codes"]))
        if rule.get("between"):
            low, high = rule["between"]
            hit = hit | F.coalesce(
                F.when(key.rlike(r"^\d+$"), key.try_cast("bigint")).between(low, high), F.lit(False)
            )
        result = F.when(hit, F.lit(rule["type"])) if result is None else result.when(hit, F.lit(rule["type"]))
    return F.lit(default) if result is None else result.otherwise(F.lit(default))


def padded_id(prefix: str, number: Column, width: int) -> Column:
    """``prefix`` and ``number`` filled with zeros to ``width`` characters in all."""
    return F.concat(F.lit(prefix), F.lpad(number.cast("string"), width - len(prefix), "0"))


def stable_id(prefix: str, width: int, *parts: Column) -> Column:
    """An id drawn from the row itself, so loading twice gives the same ids."""
    text = F.concat_ws("\u0001", *[F.coalesce(p.cast("string"), F.lit("\u0002")) for p in parts])
    return F.concat(F.lit(prefix), F.upper(F.substring(F.sha2(text, 256), 1, width - len(prefix))))


def deviation(share: Column, historic: Column) -> Column:
    """How far a share is off its historic value, as a part of that; NULL without a history."""
    return F.when(historic > 0, (share - historic) / historic)


def deviation_flag(deviation: Column, tolerance: float = 0.4) -> Column:
    """``high`` / ``low`` where a deviation exceeds ``tolerance``."""
    return F.when(deviation > tolerance, F.lit("high")).when(deviation < -tolerance, F.lit("low"))
