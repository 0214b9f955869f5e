"""Text -> value expressions for the station files.  All JVM-side, no UDF."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import MEASURE_NULLS, METADATA_NULLS

# White space that may surround a metadata key or value, the Latin-1 no-break space included.
_BLANKS = " \t\r\n\u000b\u000c\u00a0"
# The only characters of a plain number.  Within them a cast to double accepts exactly the usual
# spellings; without the test it would also take "NaN", "Infinity", "1d" and hexadecimal.
_NUMBER_CHARS = "^[0-9+.,eE-]+$"
# A ";" outside double quotes.
_UNQUOTED_SEPARATOR = ';(?=(?:[^"]*"[^"]*")*[^"]*$)'


def _strip(text: Column) -> Column:
    return F.btrim(text, F.lit(_BLANKS))


def is_blank(line: Column) -> Column:
    """Nothing but white space."""
    return _strip(line) == ""


def split_cells(line: Column) -> Column:
    """The ``;``-separated cells of one line; the rarer quoted lines take the slower branch.

    With an odd number of double quotes there is no telling what they enclose: they are ordinary characters then,
    so that the cell that holds the stray one fails to parse, and not its neighbours.
    """
    quoted = F.transform(
        F.split(line, _UNQUOTED_SEPARATOR),
        lambda cell: F.when(
            cell.rlike('^".*"$'),
            F.replace(cell.substr(F.lit(2), F.length(cell) - 2), F.lit('""'), F.lit('"')),
        ).otherwise(cell),
    )
    count = F.length(line) - F.length(F.replace(line, F.lit('"'), F.lit("")))
    return F.when((count > 0) & (count % 2 == 0), quoted).otherwise(F.split(line, ";"))


def split_key_value(line: Column) -> Column:
    """``KEY:;value`` -> struct(key, value): cut at the first ``;``, colons dropped from the key."""
    text = _strip(line)
    head = F.substring_index(text, ";", 1)
    value = text.substr(F.length(head) + 2, F.length(text))
    return F.struct(
        _strip(F.replace(head, F.lit(":"), F.lit(""))).alias("key"),
        _strip(value).alias("value"),
    )


def parse_decimal(text: Column) -> Column:
    """A decimal-comma (or decimal-point) number as double; anything else is NULL."""
    trimmed = F.trim(text)
    return F.when(
        trimmed.rlike(_NUMBER_CHARS), F.replace(trimmed, F.lit(","), F.lit(".")).try_cast("double")
    )


def without_sentinels(value: Column, sentinels: Iterable[float] = ()) -> Column:
    """NULL in place of the codes that mean "missing"; by default there are none."""
    codes = list(sentinels)
    return F.when(~value.isin(codes), value) if codes else value


def parse_measure(text: Column, sentinels: Iterable[float] = ()) -> Column:
    """A measure's text as double."""
    return without_sentinels(parse_decimal(text), sentinels)


def invalid_number(text: Column, value: Column, nulls: Iterable[str] = MEASURE_NULLS) -> Column:
    """True where ``text`` neither means "missing" nor gave a ``value``."""
    accepted = sorted({token.upper() for token in (*nulls, *METADATA_NULLS)})
    return text.isNotNull() & value.isNull() & ~F.upper(F.trim(text)).isin(accepted)


def parse_utc_timestamp(date: Column, hour: Column, strict: bool = True) -> Column:
    """``2023/01/31`` and ``2300 UTC`` as a zone-free UTC wall time.

    A missing date or hour gives NULL.  A text that is no time fails the job when ``strict``, else is
    NULL.  The value never passes through a zoned type, so the session zone cannot move it.
    """
    clock = F.replace(hour, F.lit(" UTC"), F.lit(""))
    text = F.concat(date, F.lit(" "), clock)
    well_formed = text.rlike("^[0-9]{4}/[0-9]{1,2}/[0-9]{1,2} [0-9]{4}$")
    iso = F.concat(
        F.replace(date, F.lit("/"), F.lit("-")),
        F.lit(" "), F.substring(clock, 1, 2), F.lit(":"), F.substring(clock, 3, 2),
    )
    value = F.when(well_formed, iso.try_cast("timestamp_ntz"))
    if not strict:
        return value
    # Raised explicitly, so that it does not depend on the session's ANSI mode.
    failure = F.raise_error(F.concat(F.lit("not a UTC date and hour: "), text))
    return F.coalesce(value, F.when(text.isNotNull(), failure.cast("timestamp_ntz")))
