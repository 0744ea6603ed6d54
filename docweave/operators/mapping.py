"""Rows checked against the declared types of a target."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from docweave.functions.convert import decimal_value, epoch_to_timestamp, multi_format_date, whole_value

# Declared field type -> Spark type (fixed values).
FIELD_TYPES = {
    "byte": "tinyint",
    "short": "smallint",
    "integer": "int",
    "long": "bigint",
    "float": "float",
    "keyword": "string",
    "text": "string",
    "date": "timestamp",
}
_FLOAT_LIMIT = 3.4028234663852886e38


def _fit(value: Column, field_type: str, dtype: str, epoch_unit: str) -> Column:
    if field_type == "float":
        number = decimal_value(value) if dtype == "string" else value.try_cast("double")
        return F.when(F.abs(number) <= _FLOAT_LIMIT, number.cast("float"))
    if field_type == "date" and dtype == "string":
        return multi_format_date(value)
    if field_type == "date" and dtype in ("int", "bigint"):
        return epoch_to_timestamp(value, epoch_unit)
    target = FIELD_TYPES[field_type]
    if dtype == "string" and target.endswith("int"):
        return whole_value(value, target)
    return value.try_cast(target)


def _fit_field(name: str, field_type: str, dtype: str, epoch_unit: str) -> tuple[Column, Column]:
    """(fitted value, whether something in it does not fit); a field may hold a list."""
    value = F.col(name)
    if not dtype.startswith("array<"):
        fitted = _fit(value, field_type, dtype, epoch_unit)
        return fitted, value.isNotNull() & fitted.isNull()
    element = dtype[len("array<") : -1]
    fitted = F.transform(value, lambda item: _fit(item, field_type, element, epoch_unit))
    misfit = F.exists(value, lambda item: item.isNotNull() & _fit(item, field_type, element, epoch_unit).isNull())
    return fitted, F.coalesce(misfit, F.lit(False))


def conform_to_mapping(
    df: DataFrame, mapping: dict[str, str], reject: str = "reject_reason", epoch_unit: str = "ms"
) -> DataFrame:
    """Declared columns in their target type and a reject reason naming the first field that does not fit.

    Columns without a declaration are kept as they are. Lists are checked item by item. Dates may be
    texts in any accepted shape or epoch numbers of the stated unit. Filter on the reason to separate
    the rows.
    """
    dtypes = dict(df.dtypes)
    fitted = {c: _fit_field(c, mapping[c], dtypes[c], epoch_unit) for c in df.columns if c in mapping}
    failing = [F.when(misfit, F.lit(c)) for c, (_, misfit) in fitted.items()]
    reason = F.coalesce(*failing) if failing else F.lit(None).cast("string")
    columns = [fitted[c][0].alias(c) if c in fitted else F.col(c) for c in df.columns]
    return df.select(*columns, reason.alias(reject))
