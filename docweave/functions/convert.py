"""Column conversions: typed rows, change values, dates, keys. All stay inside code generation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DataType, IntegralType, StringType, StructType, TimestampType

# Shapes of a date field (fixed values): a date of one to three parts, ISO times from the hour on with any
# fraction and zone, a date and time with a blank, and dates with slashes.
_DASHED = r"^\d{4}(-\d{2}(-\d{2}(T\d{2}(:\d{2}(:\d{2}([.,]\d{1,9})?)?)?(Z|[+-]\d{2}(:?\d{2})?)?)?)?)?$"
_BLANK = r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}$"
_SLASHED = r"^\d{4}/\d{2}(/\d{2})?$"
# epoch milliseconds; four digits are a year
_EPOCH_MILLIS = r"^(-\d{1,18}|\d{1,3}|\d{5,18})$"
_WHOLE = r"^[+-]?[0-9]+$"
_DECIMAL = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
_DATETIME = ("yyyy-MM-dd HH:mm:ss", r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}$")
_DATE = ("yyyy-MM-dd", r"^\d{4}-\d{2}-\d{2}$")


def int_or_zero(value: Column) -> Column:
    """Whole number of a text, 0 where it is none."""
    return F.coalesce(number_value(value), F.lit(0).cast("long"))


def number_value(value: Column) -> Column:
    """Text to long; NULL where it is not a whole number: no blanks, no decimals, no suffix."""
    return whole_value(value, "long")


def whole_value(value: Column, kind: str | DataType) -> Column:
    """Text to a whole number type; NULL where it is none or out of range."""
    return F.when(value.cast("string").rlike(_WHOLE), value.try_cast(kind))


def decimal_value(value: Column) -> Column:
    """Text to double; NULL where it is not a decimal number or beyond the range of doubles."""
    number = F.when(value.cast("string").rlike(_DECIMAL), value.try_cast("double"))
    return F.when(F.abs(number) <= F.lit(1.7976931348623157e308), number)


def safe_score(value: Column) -> Column:
    """Text to double, 0 where it is not a number."""
    return F.coalesce(decimal_value(value), F.lit(0.0))


def coerce(value: Column, target: DataType) -> Column:
    """Text to the target type; unparsable or out of range gives the zero value."""
    if isinstance(target, StringType):
        return F.coalesce(value.cast("string"), F.lit(""))
    if isinstance(target, TimestampType):
        return _parse(value, *_DATETIME)
    if isinstance(target, IntegralType):
        parsed = whole_value(value, target)
    else:
        parsed = F.when(decimal_value(value).isNotNull(), value.try_cast(target))
    return F.coalesce(parsed, F.lit(0).cast(target))


def coerce_rows(df: DataFrame, schema: StructType) -> DataFrame:
    """Rows of text columns as typed rows; columns missing from ``df`` get the zero value."""
    columns = []
    for field in schema.fields:
        source = F.col(field.name) if field.name in df.columns else F.lit(None).cast("string")
        columns.append(coerce(source, field.dataType).alias(field.name))
    return df.select(*columns)


def project_columns(
    df: DataFrame, include: list[str] | None = None, exclude: list[str] | None = None, keys: list[str] = ()
) -> DataFrame:
    """Listed columns, or all but the excluded ones; key columns always stay. Names ignore case."""
    by_lower = {c.lower(): c for c in df.columns}
    if include:
        unknown = [c for c in include if c.lower() not in by_lower]
        if unknown:
            raise ValueError(f"not a table column: {', '.join(unknown)}")
        wanted = {c.lower() for c in include}
    else:
        wanted = set(by_lower) - {c.lower() for c in exclude or []}
    wanted |= {k.lower() for k in keys}
    return df.select(*[c for c in df.columns if c.lower() in wanted])


def null_fallback(new: Column, old: Column, action: Column | None = None) -> Column:
    """The new value, or the old one where an update left it NULL."""
    if action is None:
        return F.coalesce(new, old)
    return F.coalesce(new, F.when(action == "update", old))


def enum_label(index: Column, labels: list[str]) -> Column:
    """Label of a 1-based index; empty text where the index is out of range."""
    known = F.array(*[F.lit(label) for label in labels])
    label = F.coalesce(F.get(known, index.cast("int") - 1), F.lit(""))
    return F.when(index.isNotNull(), label)


def set_labels(mask: Column, labels: list[str]) -> Column:
    """Labels whose bit is set, joined by commas in declaration order."""
    picked = [
        F.when(mask.cast("long").bitwiseAND(F.lit(1 << bit)) != 0, F.lit(label)) for bit, label in enumerate(labels)
    ]
    return F.when(mask.isNotNull(), F.concat_ws(",", *picked))


def bit_to_int(value: Column) -> Column:
    """1 for the one-byte text 0x01, else 0."""
    return F.when(value.isNotNull(), F.when(value == "\x01", 1).otherwise(0).cast("long"))


def _parse(value: Column, pattern: str, shape: str) -> Column:
    # the shape test keeps bad texts away from the parser, whose failures are slow
    return F.when(value.rlike(shape), F.try_to_timestamp(value, F.lit(pattern)))


def reformat_datetime(value: Column, pattern: str | None) -> Column:
    """Datetime text in another pattern; bad or zero dates give NULL, no pattern leaves the text."""
    return _reformat(value, pattern, _DATETIME)


def reformat_date(value: Column, pattern: str | None) -> Column:
    """Date text in another pattern, with the same rules."""
    return _reformat(value, pattern, _DATE)


def _reformat(value: Column, pattern: str | None, source: tuple[str, str]) -> Column:
    if not pattern:
        return value
    zero = value.startswith("0001-01-01") | value.startswith("0000")
    return F.when(~zero, F.date_format(_parse(value, *source), pattern))


def multi_format_date(value: Column) -> Column:
    """Timestamp of a date text in any of the accepted shapes, epoch milliseconds among them.

    The shape is tested first, then one cast reads the text; hours without minutes and minutes without seconds are completed for it.
    """
    with_minutes = F.regexp_replace(value, r"(T\d{2})(Z|[+-].*)?$", "$1:00$2")
    completed = F.regexp_replace(with_minutes, r"(T\d{2}:\d{2})(Z|[+-].*)?$", "$1:00$2")
    iso = F.when(value.contains("T"), F.regexp_replace(completed, ",", ".")).otherwise(value)
    return (
        F.when(value.rlike(_DASHED) | value.rlike(_BLANK), iso.try_cast("timestamp"))
        .when(value.rlike(_SLASHED), F.translate(value, "/", "-").try_cast("timestamp"))
        .when(value.rlike(_EPOCH_MILLIS), F.timestamp_millis(value.try_cast("long")))
    )


def epoch_to_timestamp(value: Column, unit: str) -> Column:
    """Timestamp of an epoch number whose unit is stated: ``s`` or ``ms``."""
    if unit == "s":
        return F.timestamp_seconds(value)
    if unit == "ms":
        return F.timestamp_millis(value)
    raise ValueError(f"unknown unit: {unit}")


def plain_double(value: Column) -> Column:
    """Shortest text of a double without an exponent, which only very large and small ones have."""
    text = value.cast("string")
    short = F.when(text.endswith(".0"), F.substring_index(text, ".", 1)).otherwise(text)
    return F.when(text.contains("E"), _without_exponent(text)).otherwise(short)


def _without_exponent(text: Column) -> Column:
    sign = F.when(text.startswith("-"), F.lit("-")).otherwise(F.lit(""))
    body = F.regexp_replace(text, "^-", "")
    digits = F.regexp_replace(F.regexp_replace(F.substring_index(body, "E", 1), r"\.0$", ""), r"\.", "")
    exponent = F.regexp_extract(body, r"E(-?\d+)$", 1).try_cast("int")
    large = F.when(
        F.length(digits) <= exponent + 1, F.rpad(digits, exponent + 1, F.lit("0"))
    ).otherwise(
        F.concat_ws(".", F.substring(digits, F.lit(1), exponent + 1), F.substring(digits, exponent + 2, F.length(digits)))
    )
    small = F.concat(F.lit("0."), F.repeat(F.lit("0"), -exponent - 1), digits)
    return F.concat(sign, F.when(exponent >= 0, large).otherwise(small))


def text_key(value: Column, dtype: str) -> Column:
    """Any value as key text: floats without exponent, NULL as empty text, nested values as JSON."""
    if dtype in ("double", "float"):
        text = plain_double(value)
    elif dtype.startswith(("struct", "array", "map")):
        text = F.to_json(value)
    else:
        text = value.cast("string")
    return F.coalesce(text, F.lit(""))


def language_disable(ref_id: Column, own_id: Column) -> Column:
    """1 where the row refers to another row of the same work, else 0."""
    return F.when((ref_id != 0) & (ref_id != own_id), 1).otherwise(0)


def effective_create(create_time: Column) -> Column:
    """Creation time, 0 where it is not positive."""
    return F.when(create_time > 0, create_time).otherwise(F.lit(0).cast("long"))


def effective_update(own: Column, newest_child: Column) -> Column:
    """The later of the own and the newest child's update time; NULLs are passed over."""
    return F.greatest(own, newest_child)


def nested_override(value: Column, replacements: dict[str, Column]) -> Column:
    """A struct with the values at the dotted paths replaced."""
    for path, replacement in replacements.items():
        value = value.withField(path, replacement)
    return value
