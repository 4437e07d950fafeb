"""Raw feed text to typed columns. A bad value becomes NULL; nothing here raises."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .clock import midnight_s

# white space as text tools strip it, not only the space character
_BLANKS = (
    " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005"
    "\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
_DECIMAL = r"(?i)^[+-]?((nan|inf|infinity)|([0-9]+\.?[0-9]*|\.[0-9]+)(e[+-]?[0-9]+)?)$"
_WHOLE = r"^[+-]?[0-9]+$"


def stripped(text: Column) -> Column:
    return F.btrim(text, F.lit(_BLANKS))


def text_or_null(text: Column) -> Column:
    """Trimmed text, blank to NULL."""
    return F.nullif(stripped(text), F.lit(""))


def clipped(text: Column, length: int) -> Column:
    """The first ``length`` characters, empty to NULL; not trimmed."""
    return F.nullif(F.substring(text, 1, length), F.lit(""))


def decimal(clean: Column) -> Column:
    """DOUBLE or NULL from stripped text. The pattern keeps out forms only the JVM reads, such as
    '1.0d'."""
    return F.when(clean.rlike(_DECIMAL), clean.try_cast("double"))


def whole(clean: Column, kind: str = "int") -> Column:
    """Integer of the given type or NULL from stripped text; '2.0' is not an integer."""
    return F.when(clean.rlike(_WHOLE), clean.try_cast(kind))


def unreadable(clean: Column, parsed: Column) -> Column:
    """1 where there was text but no value could be read from it."""
    return (parsed.isNull() & (clean != "")).cast("int")


def day(text: Column) -> Column:
    """Calendar DATE from yyyy-MM-dd (one-digit month and day allowed) or NULL.

    The pattern keeps out what a plain cast also takes, such as a year alone.
    """
    return F.when(text.rlike(r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}$"), text.try_cast("date"))


def moment(day_text: Column, hhmm: Column) -> Column:
    """UTC instant from a date and an unpadded HHMM; blank time is midnight.

    Longer texts are left as they are: lpad would cut them to a valid-looking time.
    """
    padded = F.when(F.length(hhmm) < 4, F.lpad(hhmm, 4, "0")).otherwise(hhmm)
    clock = F.when(padded.rlike("^([01][0-9]|2[0-3])[0-5][0-9]$"), padded)
    seconds = (F.substring(clock, 1, 2).cast("int") * 3600
               + F.substring(clock, 3, 2).cast("int") * 60)
    return F.timestamp_seconds(midnight_s(day(day_text)) + seconds)


def source_names(text: Column) -> Column:
    """';'-separated names, trimmed, blanks dropped; an empty array for NULL."""
    parts = F.transform(F.split(F.coalesce(text, F.lit("")), ";"), stripped)
    return F.filter(parts, lambda part: part != "")


def source_count(text: Column) -> Column:
    """Number of named sources, at least 1."""
    return F.greatest(F.size(source_names(text)), F.lit(1))


def key_hash(*keys: Column) -> Column:
    """Stable signed 64-bit id of a natural key. Carries no order in time."""
    return F.xxhash64(*keys)


def settled(parsed: DataFrame) -> DataFrame:
    """The same rows behind a boundary that later filters cannot be pushed through.

    A filter on parsed values would otherwise be rewritten over the raw text, and parse a
    coordinate again for each of the box edges it is compared with. A one-row generator is a
    boundary to that rewriting and stays inside generated code.
    """
    return parsed.select(F.inline(F.array(F.struct(*parsed.columns))))
