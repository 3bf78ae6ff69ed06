"""Series keys: ``measurement[,tag=value]*`` with backslash escapes, a separator and the field behind."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..model import FIELD_SEPARATOR


def series_key(raw: Column) -> Column:
    """What stands before the first separator; null without one."""
    at = F.locate(FIELD_SEPARATOR, raw)
    return F.when(at > 0, F.substring(raw, F.lit(1), at - 1))


def field_name(raw: Column) -> Column:
    """All that stands behind the first separator, further separators included; null without one."""
    at = F.locate(FIELD_SEPARATOR, raw)
    return F.when(at > 0, F.substring(raw, at + len(FIELD_SEPARATOR), F.length(raw)))


def split_unescaped(text: Column, separator: str) -> Column:
    """Parts between separators that no backslash escapes; backslashes stay, empty parts too.

    A backslash takes the next character with it, whatever that is; a last one stands for itself."""
    # a separator in front makes each match begin with one
    pattern = rf"(?s){separator}((?:\\.|[^\\{separator}])*+\\?)"
    return F.regexp_extract_all(F.concat(F.lit(separator), text), F.lit(pattern), F.lit(1))


def unescape_measurement(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\,"), F.lit(",")), F.lit("\\ "), F.lit(" "))


def unescape_tag(text: Column) -> Column:
    """Other backslashes are literal."""
    return F.replace(unescape_measurement(text), F.lit("\\="), F.lit("="))


def measurement(series: Column) -> Column:
    return unescape_measurement(F.get(split_unescaped(series, ","), F.lit(0)))


def tags(series: Column) -> Column:
    """Ordered (k, v) pairs, an array as keys may repeat; a token without exactly one "=" is a key with an empty value."""

    def pair(token: Column) -> Column:
        sides = split_unescaped(token, "=")
        two = F.size(sides) == 2
        return F.struct(
            F.when(two, unescape_tag(F.get(sides, F.lit(0)))).otherwise(unescape_tag(token)).alias("k"),
            F.when(two, unescape_tag(F.get(sides, F.lit(1)))).otherwise("").alias("v"),
        )

    tokens = split_unescaped(series, ",")
    return F.transform(F.slice(tokens, F.lit(2), F.greatest(F.size(tokens) - 1, F.lit(0))), pair)
