"""Row contract for running events as a list of (rule code, failing-condition) expressions.

Validation builds one array column of the codes of failed rules; a row is accepted when the
array is empty. Everything stays inside whole-stage codegen: no UDF, one pass.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from delaylens.functions.expressions import (
    DELAY_MAX_MINUTES,
    DELAY_MIN_MINUTES,
    ID_MAX_LENGTH,
    ISO_DATE_PATTERN,
    SOURCE_NAME_MAX_LENGTH,
    strip,
)

# Rule codes in the order they are reported.
RULE_CODES = [
    "train_number_length",
    "journey_date_invalid",
    "station_code_length",
    "station_sequence_not_positive",
    "source_name_length",
    "arrival_delay_out_of_range",
    "departure_delay_out_of_range",
]


def _length_fails(c: Column, max_len: int) -> Column:
    # Only a text that is too long as it stands is stripped for its length.
    text = strip(c)
    return c.isNull() | (text == "") | ((F.length(c) > max_len) & (F.length(text) > max_len))


def _delay_fails(c: Column) -> Column:
    # NOT BETWEEN also rejects NaN (NaN compares greater than every number in Spark).
    return c.isNotNull() & ~c.between(DELAY_MIN_MINUTES, DELAY_MAX_MINUTES)


def _date_fails(c: Column, is_text: bool) -> Column:
    if not is_text:
        return c.isNull()
    text = strip(c)
    return c.isNull() | ~text.rlike(ISO_DATE_PATTERN) | text.try_cast("date").isNull()


def running_event_rules(date_is_text: bool = False) -> list[tuple[str, Column]]:
    """(code, condition that is true when the rule fails) for the running-event contract."""
    return [
        ("train_number_length", _length_fails(F.col("train_number"), ID_MAX_LENGTH)),
        ("journey_date_invalid",
         _date_fails(F.col("journey_date_text" if date_is_text else "journey_date"), date_is_text)),
        ("station_code_length", _length_fails(F.col("station_code"), ID_MAX_LENGTH)),
        ("station_sequence_not_positive",
         F.col("station_sequence").isNull() | (F.col("station_sequence") <= 0)),
        ("source_name_length", _length_fails(F.col("source_name"), SOURCE_NAME_MAX_LENGTH)),
        ("arrival_delay_out_of_range", _delay_fails(F.col("arrival_delay_minutes"))),
        ("departure_delay_out_of_range", _delay_fails(F.col("departure_delay_minutes"))),
    ]


def rules_pass(rules: list[tuple[str, Column]]) -> Column:
    """True when no rule fails: one boolean expression, fully inside generated code."""
    fails = None
    for _code, cond in rules:
        c = F.coalesce(cond, F.lit(False))
        fails = c if fails is None else (fails | c)
    return ~fails


def failed_rules(rules: list[tuple[str, Column]]) -> Column:
    """Array of the codes of failed rules (empty array = valid row).

    The array is built only for rows that fail (the lambda-based ``filter`` is evaluated
    row by row, so valid rows skip it).
    """
    flagged = F.array(*[F.when(cond, F.lit(code)) for code, cond in rules])
    return F.when(rules_pass(rules), F.array().cast("array<string>")) \
            .otherwise(F.filter(flagged, lambda x: x.isNotNull()))
