"""Value rules: bands, whole numbers, equality with nulls, and the text form used by exports."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F, types as T

NULL_MARK, SEPARATOR = "\0", "\x1f"
RESERVED = (NULL_MARK, SEPARATOR)

SPARK_TYPES = {
    "string": T.StringType(), "date32": T.DateType(), "bool": T.BooleanType(),
    "int8": T.ByteType(), "int16": T.ShortType(), "rank": T.DoubleType(),
}


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def folded(terms: list[Column], join: Callable[[Column, Column], Column]) -> Column:
    """Many terms joined in pairs, then the pairs in pairs. A chain of hundreds is as deep as it is long, and Spark walks it on the stack."""
    terms = list(terms)
    while len(terms) > 1:
        terms = [join(*terms[i:i + 2]) if i + 1 < len(terms) else terms[i] for i in range(0, len(terms), 2)]
    return terms[0]


def total(terms: list[Column]) -> Column:
    return folded([F.lit(0).cast("long"), *terms], lambda a, b: a + b)


def same(a, b) -> Column:
    """Null equals null and nothing else; a blank is a value."""
    return _col(a).eqNullSafe(_col(b))


def turned(band, width: int, invert: bool = True) -> Column:
    """Band with 1 as most deprived."""
    return F.lit(width + 1) - _col(band) if invert else _col(band)


def whole(c) -> Column:
    """A present value without a fraction."""
    v = _col(c).cast("double")
    return F.coalesce(F.pmod(v, F.lit(1.0)) == 0, F.lit(False))


def half_unit(c) -> Column:
    v = _col(c).cast("double")
    return F.coalesce(F.pmod(v * 2, F.lit(1.0)) == 0, F.lit(False))


def missing_point(easting, northing) -> Column:
    return _col(easting).try_cast("double").isNull() | _col(northing).try_cast("double").isNull()


def rendered(c, kind: str, null_mark: str = NULL_MARK) -> Column:
    """A value as exported text: ISO day, 0/1, one decimal for a rank, plain integers, text as is."""
    v = _col(c)
    if kind == "date32":
        text = F.date_format(v, "yyyy-MM-dd")
    elif kind == "bool":
        # A flag has two texts only; a missing one reads as not set.
        return F.when(v, F.lit("1")).otherwise(F.lit("0"))
    elif kind == "rank":
        text = F.when(v.isNotNull(), F.format_string("%.1f", v.cast("double")))
    elif kind == "string":
        text = v
    else:
        text = v.cast("long").cast("string")
    return F.coalesce(text, F.lit(null_mark))


def reserved_in(c) -> Column:
    """Whether text holds a character the digest framing needs."""
    v = _col(c)
    return F.coalesce(v.contains(RESERVED[0]) | v.contains(RESERVED[1]), F.lit(False))


def signature(columns: list[str]) -> Column:
    """Several values as one comparable text, nulls marked rather than skipped."""
    return F.concat_ws(SEPARATOR, *[F.coalesce(F.col(c).cast("string"), F.lit(NULL_MARK)) for c in columns])


def row_number64(text: Column) -> Column:
    """First eight bytes of a text's SHA-256, big-endian two's complement, as an exact decimal."""
    unsigned = F.conv(F.substring(F.sha2(text, 256), 1, 16), 16, 10).cast("decimal(38,0)")
    wrap, half = (F.lit(str(2 ** n)).cast("decimal(38,0)") for n in (64, 63))
    return F.when(unsigned >= half, unsigned - wrap).otherwise(unsigned)


def stored(c, kind: str, *, role=None, null_for_role: str | None = None, blank_is_null: bool = False) -> Column:
    """A CSV cell back to its declared type. Text blanks return as blanks unless the column never
    holds one, or does not exist for the record's role; a rank returns only if its text round-trips. A cell that is no value of its
    type is null: `refused` tells which were."""
    v = _col(c)
    filled = F.nullif(v, F.lit(""))
    if kind == "date32":
        return F.try_to_date(filled, "yyyy-MM-dd")
    if kind == "bool":
        return F.when(v == "1", F.lit(True)).when(v == "0", F.lit(False))
    if kind == "rank":
        exact = filled.try_cast("decimal(6,1)")
        return F.when(exact.cast("string") == v, exact)
    if kind in ("int8", "int16"):
        return filled.try_cast(SPARK_TYPES[kind])
    if blank_is_null:
        return filled
    text = F.coalesce(v, F.lit(""))
    if null_for_role is not None:
        return F.when(~F.col(role).eqNullSafe(F.lit(null_for_role)), text)
    return text


def refused(text, value, kind: str) -> Column:
    """Whether a cell held something that is no value of its type."""
    return F.lit(False) if kind == "string" else (_col(text) != "") & _col(value).isNull()
