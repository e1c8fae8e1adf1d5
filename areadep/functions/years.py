"""Which edition and which classification version a year uses, and what is wrong with the year."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from ..registry import FIRST_YEAR, LAST_YEAR, REGISTRY, Registry


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def by_window(year, windows, value=2, cast: str | None = None) -> Column:
    """The value of the window a year falls in, null outside every window. Windows come from the
    registry, so the chain is a handful of comparisons and no join."""
    y, out = _col(year), None
    for w in windows:
        test = y.between(w[0], w[1])
        out = F.when(test, F.lit(w[value])) if out is None else out.when(test, F.lit(w[value]))
    out = F.lit(None).cast("string") if out is None else out
    return out.cast(cast) if cast else out


def edition_for(year, registry: Registry = REGISTRY) -> Column:
    return by_window(year, registry.edition_windows())


def vintage_for(year, registry: Registry = REGISTRY) -> Column:
    return by_window(year, registry.edition_windows(), 3)


def version_for(year, registry: Registry = REGISTRY) -> Column:
    return by_window(year, registry.rurality_windows())


def vintage_of(edition, registry: Registry = REGISTRY) -> Column:
    e, out = _col(edition), None
    for ed in registry.editions:
        out = F.when(e == ed.key, F.lit(ed.vintage)) if out is None else out.when(e == ed.key, F.lit(ed.vintage))
    return out


def analysis_year(override, address_date) -> Column:
    return F.coalesce(_col(override), F.year(_col(address_date)))


def year_out_of_range(year) -> Column:
    return (_col(year) < FIRST_YEAR) | (_col(year) > LAST_YEAR)


def edition_status(year, edition) -> Column:
    return (F.when(_col(year).isNull(), F.lit("missing_year"))
            .when(year_out_of_range(year), F.lit("invalid_year"))
            .when(_col(edition).isNull(), F.lit("no_edition"))
            .otherwise(F.lit("ok")))
