"""The declared output tables: column order, type, nullability and where each column comes from."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F, types as T

from .functions.values import SPARK_TYPES
from .operators.checks import static_check, union_checks
from .operators.digest import HISTORY_EXCLUDED, HISTORY_NULL_FOR_ROLE, MAIN_EXCLUDED, ExportContract
from .registry import (GEOGRAPHIES, LARGE_USER_HEADER, LOOKUP_HEADER, PUBLISHED_BANDS, PUBLISHED_FLAGS, REGISTRY, SMALL_USER_HEADER, UNWEIGHTED,
                       Registry)

DERIVED = {"pc_norm": "string", "pc_base": "string", "spd_user_type": "string", "spd_release": "string", "sspl_release": "string",
           "introduced_on": "date32", "deleted_on": "date32", "is_current": "bool"}
HISTORY_DERIVED = ("pc_norm", "pc_base", "spd_user_type", "spd_release", "introduced_on", "deleted_on", "is_current")
LOOKUP_DERIVED = ("pc_norm", "spd_user_type", "sspl_release", "introduced_on", "deleted_on", "is_current")


@dataclass(frozen=True)
class Field:
    name: str
    kind: str
    nullable: bool
    source: str
    edition: str = ""
    basis: str = ""      # pw, uw or computed, for a band


def _index_fields(names, nullable, source) -> list[Field]:
    return [Field(n, "string", n in nullable, source) for n in names]


def _edition_fields(registry: Registry) -> list[Field]:
    eds = registry.editions
    out = [Field(f"phs_dz{v}_{g}", "string", False, "phs") for v in registry.vintages() for g in GEOGRAPHIES]
    for e in eds:
        out.append(Field(e.column("rank"), "int16", False, "phs", e.key))
        out += [Field(e.column(m), "int8", False, "phs", e.key, "pw") for m in (*PUBLISHED_BANDS.values(), *PUBLISHED_FLAGS.values())]
        out += [Field(e.column(m), "int8", False, "govscot", e.key, "uw") for m in UNWEIGHTED]
    return out


def _domain_fields(registry: Registry) -> list[Field]:
    eds = registry.editions
    out = [Field(e.column(m), "rank", False, "govscot", e.key, "uw") for e in eds for m in e.domain_ranks()]
    for e in eds:
        out += [Field(e.column(m), "int8", False, "govscot_bands", e.key, "uw") for m in e.domain_bands()]
        out += [Field(e.column(m), "string", True, "govscot_bands", e.key) for m in e.domain_statuses()]
    out += [Field(e.column(m), "int8", False, "computed", e.key, "computed") for e in eds for m in e.weighted_bands()]
    return out + [Field(e.column("population"), "int16", False, "govscot", e.key) for e in eds]


def history_fields(registry: Registry = REGISTRY, small=SMALL_USER_HEADER, large=LARGE_USER_HEADER) -> list[Field]:
    source = [*small, *[c for c in large if c not in small]]
    only_one = {c for c in source if (c in small) != (c in large)}
    out = _index_fields(source, only_one, "directory")
    out += [Field(n, DERIVED[n], n == "deleted_on", "derived") for n in HISTORY_DERIVED]
    out += _edition_fields(registry)
    for v in registry.rurality_versions:
        out += [Field(f"{v.stem}_6fold", "int8", True, "rurality"), Field(f"{v.stem}_8fold", "int8", True, "rurality"), Field(f"{v.stem}_status", "string", True, "rurality")]
    return out + _domain_fields(registry)


def main_fields(registry: Registry = REGISTRY, header=LOOKUP_HEADER) -> list[Field]:
    out = _index_fields(header, set(), "lookup") + [Field(n, DERIVED[n], n == "deleted_on", "derived") for n in LOOKUP_DERIVED]
    return out + _edition_fields(registry) + _domain_fields(registry)


def export_contract(fields: list[Field], key: tuple, history: bool) -> ExportContract:
    """What of a table is exported: every column but coordinates."""
    names = {f.name for f in fields}
    excluded = tuple(c for c in (HISTORY_EXCLUDED if history else MAIN_EXCLUDED) if c in names)
    never_blank = tuple(f.name for f in fields if f.name.endswith("_status"))
    nulls = {k: v for k, v in HISTORY_NULL_FOR_ROLE.items() if k in names} if history else {}
    return ExportContract(tuple((f.name, f.kind, f.nullable) for f in fields), key, excluded, "spd_user_type", nulls, never_blank)


CONVENTION = ("Bands count from 1 for the most deprived in every edition: those of the two earliest were published the other way round and are turned. "
              "Ranks and flags stand as published. Population-weighted and unweighted bands are different measures and are never mixed; twentieths exist unweighted only.")
SCHEMA_VERSION = 1


def provenance(key, index_source: str, release: str, allocation: str, decisions: str = "", sources=()) -> dict:
    """What a table says of itself, given by the build and never read from a file: convention, version, product and release, how places are
    allocated, key, hash of the decisions and hashes of the sources (path, sha256)."""
    return {"band_convention": CONVENTION, "schema_version": SCHEMA_VERSION, "index_source": index_source, "index_release": release, "allocation": allocation,
            "key": list(key), "decisions_sha256": decisions, "sources": [{"path": p, "sha256": h} for p, h in sorted(sources)]}


def field_metadata(fields: list[Field], index_source: str, table: dict | None = None) -> dict[str, dict]:
    """The metadata of each field; the first one has the table's beside its own."""
    out = {f.name: {k: v for k, v in {"source": f.source, "edition": f.edition, "basis": f.basis, "index_source": index_source}.items() if v} for f in fields}
    if table is not None:
        out[fields[0].name]["table"] = table
    return out


def typed(df: DataFrame, fields: list[Field], index_source: str, table: dict | None = None) -> DataFrame:
    """Declared order and types; a value that does not fit its type stops the job. Provenance travels as
    field metadata, which Parquet keeps."""
    meta = field_metadata(fields, index_source, table)
    return df.select(*[F.col(f.name).cast(SPARK_TYPES[f.kind]).alias(f.name, metadata=meta[f.name]) for f in fields])


def metadata_checks(saved: DataFrame, expected: dict[str, dict], label: str) -> DataFrame:
    """Check rows: every field's metadata is what is expected, all of it, and so is each entry of the table's."""
    found = {f.name: dict(f.metadata or {}) for f in saved.schema.fields}
    spark = saved.sparkSession
    first = next(iter(expected))
    of_table = lambda meta: meta.get(first, {}).get("table", {})
    bare = lambda meta: {k: v for k, v in meta.items() if k != "table"}
    differ = sorted(n for n in expected.keys() | found.keys() if bare(expected.get(n, {})) != bare(found.get(n, {})))
    names = sorted(of_table(expected).keys() | of_table(found).keys())
    return union_checks(static_check(spark, f"{label}.metadata", differ, []),
                        *[static_check(spark, f"{label}.metadata.{n}", of_table(found).get(n), of_table(expected).get(n)) for n in names])


def declared_types(fields: list[Field]) -> list[tuple[str, str]]:
    return [(f.name, SPARK_TYPES[f.kind].simpleString()) for f in fields]


def struct_type(fields: list[Field]) -> T.StructType:
    return T.StructType([T.StructField(f.name, SPARK_TYPES[f.kind], f.nullable) for f in fields])
