"""Column expressions shared by the operators. All are JVM built-ins (no Python UDFs)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference's for equal results:
# valid delay range (minutes), identifier and source-name lengths, delay-band edges and labels,
# the on-time threshold and the major-delay threshold.
DELAY_MIN_MINUTES = -1440
DELAY_MAX_MINUTES = 10080
ID_MAX_LENGTH = 16
SOURCE_NAME_MAX_LENGTH = 100
ON_TIME_MAX_MINUTES = 0
MAJOR_DELAY_MINUTES = 60
DELAY_BANDS = [
    (0, "On time / early"),
    (15, "1–15 min"),
    (30, "16–30 min"),
    (60, "31–60 min"),
    (None, "60+ min"),
]
# What counts as white space at the ends of a value: the Unicode property and U+001C to U+001F.
WHITE_SPACE = "".join(map(chr, [*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
                                0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))
NULL_MARKER = "-"
NUMBER_PATTERN = r"(?i)^[+-]?(([0-9]+\.?[0-9]*|\.[0-9]+)(e[+-]?[0-9]+)?|inf|infinity|nan)$"
ISO_DATE_PATTERN = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"
FIVE_DIGIT_TRAIN_PATTERN = r"^[0-9]{5}$"


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: str | Column) -> Column:
    """Text without white space at both ends: tabs, line ends and no-break spaces too.

    The text is named once: rules are pushed below the projection that makes a column, and every
    mention of it there is that column's expression anew.
    """
    return F.trim(col(c), F.lit(WHITE_SPACE))


def blank_to_null(c: str | Column) -> Column:
    """Stripped text, or null when nothing is left."""
    return F.nullif(strip(c), F.lit(""))


def normalize_id(c: str | Column) -> Column:
    """Identifier as the contract stores it: stripped and upper-cased."""
    return F.upper(strip(c))


def normalize_key(c: str | Column) -> Column:
    """Join key clean-up for CSV identifiers: strip, upper-case, drop one trailing '.0'."""
    key = F.upper(strip(F.coalesce(col(c), F.lit(""))))
    return F.when(F.endswith(key, F.lit(".0")), F.substring(key, F.lit(1), F.length(key) - 2)).otherwise(key)


def _number(text: Column) -> Column:
    """The number, or null: a cast alone would take suffixes such as ``5d`` too."""
    return F.when(text.rlike(NUMBER_PATTERN), text.try_cast("double"))


def optional_number(c: str | Column) -> Column:
    """Blank -> null, otherwise the number; unparsable text -> null (flag with ``not_a_number``)."""
    return _number(strip(c))


def not_a_number(c: str | Column) -> Column:
    """True where the text is present but does not parse as a number."""
    text = strip(c)
    return text.isNotNull() & (text != "") & _number(text).isNull()


def sequence_from_text(c: str | Column) -> Column:
    """``int(float(text))``: parse as double, truncate toward zero; bad text, NaN or an
    out-of-range value -> null (the row is then skipped or quarantined, never a failed job)."""
    return _number(strip(c)).try_cast("int")


def record_hash(*columns: str | Column) -> Column:
    """SHA-256 (hex) of the columns in the given order, each as ``length:text``, nulls as ``-``.

    The lengths make the joined text readable in one way only, so different records differ.

    Callers pass the canonical column list sorted by name, so equal content gives an equal
    hash whatever the source column order.
    """
    texts = [col(c).cast("string") for c in columns]
    parts = [F.coalesce(F.concat(F.length(t).cast("string"), F.lit(":"), t), F.lit(NULL_MARKER)) for t in texts]
    return F.sha2(F.concat(*parts), 256)


def minutes_between(start: str | Column, end: str | Column) -> Column:
    """Minute boundaries crossed from ``start`` to ``end`` (warehouse ``datediff('minute')``)."""
    return F.timestamp_diff("MINUTE", F.date_trunc("minute", col(start)), F.date_trunc("minute", col(end)))


def day_of_week_sunday_zero(c: str | Column) -> Column:
    """Day of week with Sunday = 0 .. Saturday = 6."""
    return F.dayofweek(col(c)) - 1


def delay_band_label(c: str | Column) -> Column:
    d = col(c)
    expr = None
    for edge, label in DELAY_BANDS:
        if edge is None:
            expr = expr.otherwise(F.lit(label))
        elif expr is None:
            expr = F.when(d <= edge, F.lit(label))
        else:
            expr = expr.when(d <= edge, F.lit(label))
    return expr


def delay_band_order(c: str | Column) -> Column:
    d = col(c)
    expr = None
    for i, (edge, _label) in enumerate(DELAY_BANDS, start=1):
        if edge is None:
            expr = expr.otherwise(F.lit(i))
        elif expr is None:
            expr = F.when(d <= edge, F.lit(i))
        else:
            expr = expr.when(d <= edge, F.lit(i))
    return expr


def percent_where(cond: Column) -> Column:
    """Share of rows (in %) where ``cond`` holds; the aggregate of ``iff(cond, 1, 0)``."""
    return F.avg(F.when(cond, F.lit(1.0)).otherwise(F.lit(0.0))) * 100.0


def round6(c: Column) -> Column:
    return F.round(c.cast("double"), 6)


def guard(value: str | Column, ok: Column, message: str) -> Column:
    """``value``, but fail the task with ``message`` where ``ok`` is false.

    The check is folded into a column that is kept: a separate ``assert_true`` column that
    is dropped later would be pruned by the optimizer and never run.
    """
    return F.coalesce(F.assert_true(ok, F.lit(message)), col(value))
