"""Cell conversions as built-in Column expressions.

Every function takes a string column and gives the same answer whatever the
session's ANSI flag and time zone are. Nothing here leaves code generation.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerline.contract import LENIENT, POINT_TYPE, ColumnSpec, check_policy

# The characters a text-to-number conversion trims, and the epoch
# seconds of years 0001 to 9999.
_BLANK = r"[\x00-\x20\x7f]*"
_WHOLE = rf"^{_BLANK}([+-]?\d+)(?:\.\d*)?{_BLANK}$"
_PLAIN_INT, _PLAIN_BIGINT = "^[0-9]{1,9}$", "^[0-9]{1,18}$"
_FRACTION_ONLY = rf"^{_BLANK}[+-]?\.\d*{_BLANK}$"
_FLOAT = r"[+-]?(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?"
_NUMBER = rf"^{_BLANK}{_FLOAT}{_BLANK}$"
_NO_NUMBER = rf"[A-DF-Za-df-z/]|^{_BLANK}$"
_POINT = rf"(?i)^\s*POINT\s*\(\s*({_FLOAT})\s+({_FLOAT})\s*\)\s*$"
_FIRST_SECOND, _LAST_SECOND = -62135596800, 253402300799


def lenient_int(text: Column, data_type: str = "int") -> Column:
    """Text to a whole number, cut toward zero; NULL when impossible or too large.

    ``try_cast`` on text it must refuse costs an exception per cell, so it is given only
    digits: text that is nothing else and surely fits at once, other text by its match.
    Only numbers too large for the type pay for an exception.
    """
    plain = text.rlike(_PLAIN_INT if data_type == "int" else _PLAIN_BIGINT)
    digits = F.try_element_at(F.regexp_extract_all(text, F.lit(_WHOLE), 1), F.lit(1))
    none_before_point = F.when(text.rlike(_FRACTION_ONLY), F.lit(0).cast(data_type))
    return F.when(plain, text.try_cast(data_type)).otherwise(
        F.coalesce(digits.try_cast(data_type), none_before_point)
    )


def lenient_decimal(text: Column, precision: int, scale: int) -> Column:
    """Text to a decimal, rounded half up; NULL when impossible or too large.

    Blank text and text with a letter other than an exponent's is not tried at all.
    """
    return F.when(~text.rlike(_NO_NUMBER), text.try_cast(f"decimal({precision},{scale})"))


def _utc_wall_clock(seconds: Column) -> Column:
    # Seconds out of range are drawn to a mark beyond either end and the marks nulled,
    # so the seconds are computed once.
    below, above = F.lit(_FIRST_SECOND - 1), F.lit(_LAST_SECOND + 1)
    held = F.greatest(F.least(seconds, above), below)
    within = F.nullif(F.nullif(held, above), below)
    interval = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), within.cast("decimal(18,6)"))
    return F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'") + interval


def lenient_epoch(text: Column) -> Column:
    """Epoch seconds to a UTC timestamp without zone; NULL outside years 0001-9999."""
    return _utc_wall_clock(lenient_int(text, "bigint"))


def _or_raise(value: Column, text: Column, data_type: str, what: str, label: str) -> Column:
    message = F.concat(F.lit(f"{label}: not {what}: "), text)
    return F.coalesce(value, F.when(text.isNotNull(), F.raise_error(message).cast(data_type)))


def strict_number(text: Column, precision: int = 38, scale: int = 0, label: str = "value") -> Column:
    """Text to decimal(p,s), rounded half away from zero; an error when it does not fit."""
    data_type = f"decimal({precision},{scale})"
    return _or_raise(text.try_cast(data_type), text, data_type, f"a number({precision},{scale})", label)


def strict_epoch(text: Column, label: str = "value") -> Column:
    """Epoch seconds to a UTC timestamp without zone; an error when impossible."""
    seconds = text.try_cast("decimal(38,0)").try_cast("bigint")
    return _or_raise(_utc_wall_clock(seconds), text, "timestamp_ntz", "epoch seconds", label)


def strict_text(text: Column, length: int | None, label: str = "value") -> Column:
    """The text itself; an error when it is longer than its limit."""
    if length is None:
        return text
    message = F.concat(F.lit(f"{label}: longer than {length}: "), text)
    return F.when(F.length(text) > length, F.raise_error(message).cast("string")).otherwise(text)


def _coordinates(text: Column) -> tuple[Column, Column]:
    return tuple(F.regexp_extract(text, _POINT, i).try_cast("double") for i in (1, 2))


def _on_earth(text: Column) -> Column:
    lon, lat = _coordinates(text)
    return lon.between(-180, 180) & lat.between(-90, 90)


def point(text: Column) -> Column:
    """``POINT (lon lat)`` to struct<lon,lat,text>; NULL when the text is no point on earth.

    Longitudes reach from -180 to 180 and latitudes from -90 to 90 degrees.
    """
    lon, lat = _coordinates(text)
    return F.when(
        text.rlike(_POINT) & _on_earth(text),
        F.struct(lon.alias("lon"), lat.alias("lat"), text.alias("text")),
    )


def strict_point(text: Column, label: str = "value") -> Column:
    """As :func:`point`, with an error for text that is no point."""
    return _or_raise(point(text), text, POINT_TYPE.simpleString(), "a point", label)


def cell(text: Column, spec: ColumnSpec, policy: str) -> Column:
    """One contract cell under a policy, without its alias."""
    lenient = check_policy(policy) == LENIENT
    if spec.kind == "int":
        return lenient_int(text) if lenient else strict_number(text, spec.precision or 38, 0, spec.target)
    if spec.kind == "decimal":
        if lenient:
            return lenient_decimal(text, spec.precision, spec.scale)
        return strict_number(text, spec.precision, spec.scale, spec.target)
    if spec.kind == "epoch":
        return lenient_epoch(text) if lenient else strict_epoch(text, spec.target)
    if spec.kind == "point" and not lenient:
        return strict_point(text, spec.target)
    return text if lenient else strict_text(text, spec.length, spec.target)


def number_cell(value: Column, spec: ColumnSpec, policy: str) -> Column:
    """As :func:`cell`, for a numeric column: no detour through its text.

    The text of a large double has an exponent, which the lenient text rules refuse.
    """
    lenient = check_policy(policy) == LENIENT
    text = value.cast("string")
    if spec.kind == "epoch":
        if lenient:
            return _utc_wall_clock(value.try_cast("bigint"))
        seconds = value.try_cast("decimal(38,0)").try_cast("bigint")
        return _or_raise(_utc_wall_clock(seconds), text, "timestamp_ntz", "epoch seconds", spec.target)
    if spec.kind == "int" and lenient:
        return value.try_cast("int")
    if spec.kind in ("int", "decimal"):
        precision, scale = spec.precision or 38, 0 if spec.kind == "int" else spec.scale
        number = value.try_cast(f"decimal({precision},{scale})")
        if lenient:
            return number
        what = f"a number({precision},{scale})"
        return _or_raise(number, text, f"decimal({precision},{scale})", what, spec.target)
    return cell(text, spec, policy)


def violation(text: Column, spec: ColumnSpec) -> Column:
    """What keeps a cell out of a strict load: a short code, or NULL when it fits."""
    if spec.kind in ("int", "decimal", "epoch"):
        if spec.kind == "epoch":
            value = _utc_wall_clock(text.try_cast("decimal(38,0)").try_cast("bigint"))
        else:
            value = text.try_cast(f"decimal({spec.precision or 38},{spec.scale})")
        return (
            F.when(text.isNull(), None)
            .when(text.rlike(_NO_NUMBER), "not_a_number")
            .when(value.isNotNull(), None)
            .when(text.rlike(_NUMBER), "out_of_range")
            .otherwise("not_a_number")
        )
    if spec.kind == "point":
        return F.when(text.isNotNull() & ~text.rlike(_POINT), "not_a_point").when(
            text.isNotNull() & ~_on_earth(text), "out_of_range"
        )
    if spec.length is not None:
        return F.when(F.length(text) > spec.length, "too_long")
    return F.lit(None).cast("string")
