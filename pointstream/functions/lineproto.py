"""Points as text lines: ``measurement[,tag=value]* field=value[,field=value]* timestamp``."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..model import BOOLEAN, FLOAT, INTEGER, STRING, UNSIGNED
from . import keys

#: A float has an exponent if its first digit's decimal exponent is below the one or from the other on.
LOW_EXPONENT, HIGH_EXPONENT = -4, 6


def _escape(text: Column, characters: str) -> Column:
    for c in characters:
        text = F.replace(text, F.lit(c), F.lit("\\" + c))
    return text


def escape_measurement(text: Column) -> Column:
    return _escape(text, ", ")


def escape_tag(text: Column) -> Column:
    """For tag keys, tag values and field names."""
    return _escape(text, ", =")


def escape_string(text: Column) -> Column:
    """For string values: backslash first, then the quote."""
    return _escape(text, '\\"')


def shortest(value: float) -> str:
    """The fewest digits that give the same double, without a trailing ".0"."""
    if value != value:
        return "NaN"
    if value in (float("inf"), float("-inf")):
        return "+Inf" if value > 0 else "-Inf"
    sign, text = ("-", repr(value)[1:]) if repr(value).startswith("-") else ("", repr(value))
    mantissa, _, power = text.partition("e")
    whole, _, fraction = mantissa.partition(".")
    digits = (whole + fraction).lstrip("0")
    exponent = int(power or 0) + (len(whole) - 1 if whole != "0" else -1 - (len(fraction) - len(fraction.lstrip("0"))))
    digits = digits.rstrip("0")
    if not digits:
        return sign + "0"
    if LOW_EXPONENT <= exponent < HIGH_EXPONENT:
        if exponent < 0:
            return f"{sign}0.{'0' * (-exponent - 1)}{digits}"
        digits = digits.ljust(exponent + 1, "0")
        return sign + digits[: exponent + 1] + ("." + digits[exponent + 1 :] if len(digits) > exponent + 1 else "")
    return f"{sign}{digits[0]}{'.' + digits[1:] if len(digits) > 1 else ''}e{'-' if exponent < 0 else '+'}{abs(exponent):02d}"


@F.pandas_udf(T.StringType())
def format_float(values: pd.Series) -> pd.Series:
    """Any double, by Python's shortest digits (the JVM's aren't always the shortest)."""
    return values.map(lambda v: None if v is None else shortest(float(v)))


@F.arrow_udf(T.ArrayType(T.StringType()))
def format_floats(values: pa.Array) -> pa.Array:
    """The same for arrays of doubles; no array gives none."""
    texts = pa.array([None if v is None else shortest(v) for v in values.flatten().to_pylist()], pa.string())
    ends = np.cumsum(pc.fill_null(pc.list_value_length(values), 0).to_numpy(), dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(np.concatenate([np.zeros(1, np.int32), ends])), texts, mask=values.is_null())


def format_short_decimal(value: Column) -> Column:
    """In the JVM, for doubles below a million that have at most six decimals; null for others."""
    plain = F.rtrim(F.rtrim(value.cast("decimal(14,6)").cast("string"), F.lit("0")), F.lit("."))
    zero = F.when(value.cast("string") == "-0.0", "-0").otherwise("0")
    short = (F.abs(value) < 10**HIGH_EXPONENT) & (F.round(value, 6) == value) & ((F.abs(value) >= 1e-4) | (value == 0))
    return F.when(short, F.when(value == 0, zero).otherwise(plain))


def format_value(field: Column, float_text: Column) -> Column:
    """A field's value by its type; ``float_text`` is the text for floats."""
    return (
        F.when(field["vtype"] == FLOAT, float_text)
        .when(field["vtype"] == INTEGER, F.concat(field["v_int"].cast("string"), F.lit("i")))
        .when(field["vtype"] == UNSIGNED, F.concat(field["v_uint"].cast("string"), F.lit("u")))
        .when(field["vtype"] == BOOLEAN, field["v_bool"].cast("string"))
        .when(field["vtype"] == STRING, F.concat(F.lit('"'), escape_string(field["v_str"]), F.lit('"')))
    )


#: A series key whose escaped parts are the parts themselves: no backslash, no blank, and one "=" in each tag.
PLAIN_KEY = r"[^,\\ ]*+(?:,[^,=\\ ]*+=[^,=\\ ]*+)*+"


def head(measurement: Column, tags: Column) -> Column:
    """What stands before the fields: the measurement and its tags."""
    pairs = F.transform(tags, lambda t: F.concat(F.lit(","), escape_tag(t["k"]), F.lit("="), escape_tag(t["v"])))
    return F.concat(escape_measurement(measurement), F.array_join(pairs, ""))


def head_of(series: Column) -> Column:
    """The same from a series key, which is taken apart only if that changes anything."""
    return F.when(series.rlike(rf"\A{PLAIN_KEY}\z"), series).otherwise(head(keys.measurement(series), keys.tags(series)))


def line(head_: Column, fields: Column, ts_ns: Column) -> Column:
    """The line with its line feed.  ``fields`` have name and text."""
    values = F.transform(fields, lambda f: F.concat(escape_tag(f["name"]), F.lit("="), f["text"]))
    return F.concat(head_, F.lit(" "), F.array_join(values, ","), F.lit(" "), ts_ns.cast("string"), F.lit("\n"))


def encode(measurement: Column, tags: Column, fields: Column, ts_ns: Column) -> Column:
    return line(head(measurement, tags), fields, ts_ns)
