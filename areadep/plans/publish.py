"""From sources to published tables: build, check, write aside, read back, and only then publish.

A run writes under runs/<run id>. Publishing appends one line to publications, after every check has
passed; readers take the newest line. A failed run leaves what was published untouched.
"""

from __future__ import annotations

import datetime as dt
import json
import re
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.keys import Lives
from ..operators import bands as b
from ..operators import digest as g
from ..operators import enrich as en
from ..operators import rings as rg
from ..operators import spatial as sp
from ..operators.checks import Checks, require, settle, summary, typed_columns, union_checks, unique_key
from ..operators.snapshot import compare_with_previous
from ..operators.weighted import reproduces_published, share_deviation, with_domain_bands
from ..registry import REGISTRY, WEIGHTED_WIDTH, Registry
from ..schema import Field, declared_types, export_contract, field_metadata, metadata_checks, provenance, typed
from ..session import ensure_checkpoint_dir
from ..sources.binary import read_dbf, read_layer
from ..sources.text import band_cube, directory_file, history_index, latest_lookup, pinned_files, pinned_list, service_edition



@dataclass(frozen=True)
class Paths:
    """Where each source lies. Editions and versions are keyed by their registry key."""

    small_user: str
    large_user: str
    lookup: str | None = None
    service: dict = field(default_factory=dict)
    attributes: dict = field(default_factory=dict)
    cubes: dict = field(default_factory=dict)
    pinned: dict = field(default_factory=dict)       # (edition, domain) -> list of pinned rank disagreements
    layers: dict = field(default_factory=dict)


# ---- edition tables ----

def scratch_folder(spark: SparkSession) -> str:
    """A new folder under the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark)}/areadep-{uuid.uuid4().hex[:12]}"


def written(df: DataFrame, path: str) -> DataFrame:
    """The table written and read again: a finished step, whatever is lost later."""
    df.write.mode("errorifexists").option("compression", "zstd").parquet(path)
    return df.sparkSession.read.parquet(path)


def service_tables(spark: SparkSession, paths: Paths, registry: Registry = REGISTRY, scratch: str | None = None) -> tuple[DataFrame, DataFrame]:
    """All canonical edition tables stacked, and their check rows."""
    scratch = scratch or scratch_folder(spark)
    tables, reports = [], []
    for e in registry.editions:
        source, report = service_edition(spark, paths.service[e.key], e)
        reports.append(settle(report))
        require(reports[-1])
        table = written(b.canonical(source, e), f"{scratch}/service_{e.key}")
        tables.append(table)
        reports.append(settle(b.canonical_checks(table, e)))
    stacked = written(en.stacked(tables), f"{scratch}/service")
    return stacked, union_checks(*reports, settle(b.shared_geography(stacked)))


def government_tables(spark: SparkSession, paths: Paths, registry: Registry = REGISTRY, years: dict | None = None,
                      scratch: str | None = None) -> tuple[DataFrame, DataFrame]:
    """All government edition tables stacked, published bands admitted and weighted bands computed."""
    scratch = scratch or scratch_folder(spark)
    tables, reports = [], []
    for e in registry.editions:
        attributes = read_dbf(spark, paths.attributes[e.key])
        reports.append(settle(b.government_source_checks(attributes, e)))
        require(reports[-1])
        table = written(b.government(attributes, e), f"{scratch}/attributes_{e.key}")
        reports.append(settle(b.government_checks(table, e)))
        if e.cube_year is not None:
            cube = band_cube(spark, paths.cubes[e.key])
            pins = [pinned_list(spark, path, "dz_code string, shapefile_rank double, published_rank double").withColumn("domain", F.lit(d))
                    for (key, d), path in paths.pinned.items() if key == e.key]
            reports.append(settle(b.cube_checks(cube, e, (years or {}).get(e.key))))
            table, admitted = b.admit_bands(table, cube, e, en.stacked(pins) if pins else None)
            reports.append(settle(admitted))
        table = written(with_domain_bands(table, e), f"{scratch}/government_{e.key}")
        reports.append(settle(share_observations(table, e)))
        tables.append(table)
    return written(en.stacked(tables), f"{scratch}/government"), union_checks(*reports)


def share_observations(table: DataFrame, e) -> DataFrame:
    """The largest distance from an equal share of every computed band, all in one job a width."""
    reports = []
    for band, k in WEIGHTED_WIDTH.items():
        long = table.select("population", F.inline(F.array(*[
            F.struct(F.lit(d).alias("domain"), F.col(f"{d}_domain_pw_scotland_{band}").alias("band")) for d in e.domains])))
        shares = share_deviation(long, ["domain"], "band", "population", k)
        c = Checks(f"weighted.{e.key}.")
        for d in e.domains:
            c.observe(f"{d}.{band}.max_share_deviation_pp", F.max(F.when(F.col("domain") == d, F.col("max_share_deviation_pp"))))
        reports.append(c.run(shares))
    return union_checks(*reports)


def cross_checks(service: DataFrame, gov: DataFrame, registry: Registry = REGISTRY) -> DataFrame:
    """Both publishers agree, and the weighting rule reproduces the published overall bands."""
    rule = [settle(reproduces_published(service.where(F.col("edition") == e.key), gov.where(F.col("edition") == e.key), e.key)) for e in registry.editions]
    return union_checks(settle(b.cross_publisher(service, gov)), *rule)


# ---- writing and reading back ----

def required_gate(df: DataFrame, fields: list[Field], label: str) -> DataFrame:
    return Checks(f"{label}.").required([f.name for f in fields if not f.nullable]).run(df)


def write_table(df: DataFrame, path: str) -> None:
    df.write.mode("errorifexists").option("compression", "zstd").parquet(path)


def readback(spark: SparkSession, path: str, fields: list[Field], key: list[str], index: DataFrame, service: DataFrame, gov: DataFrame,
             registry: Registry = REGISTRY, edges: DataFrame | None = None, label: str = "readback", *, metadata: dict[str, dict]) -> DataFrame:
    """The saved file against the sources, not against memory: shape, key, required values, index columns,
    every attached value looked up again, and every point placed again."""
    saved = spark.read.parquet(path)
    shape = typed_columns(saved, declared_types(fields), f"{label}.columns")
    require(shape)
    kept = metadata_checks(saved, metadata, label)
    reports = [settle(r) for r in (shape, kept, required_gate(saved, fields, label), unique_key(saved, key, f"{label}.primary_key_unique"),
                                   en.source_equal_checks(saved, index, key, label), en.relookup_checks(saved, service, gov, key, registry, label))]
    if edges is not None:
        bare = saved.drop(*[c for c in saved.columns if c.startswith("urbanrural")])
        again = sp.withhold_po_boxes(sp.classify(bare, edges, registry.rurality_versions), registry.rurality_versions)
        rural = [f.name for f in fields if f.source == "rurality"]
        reports.append(settle(g.cells_equal(saved.select(*key, *rural), again.select(*key, *rural), key, f"{label}.rurality")))
    return union_checks(*reports)


def export(spark: SparkSession, df: DataFrame, fields: list[Field], key: tuple, history: bool, path: str, label: str) -> tuple[DataFrame, DataFrame]:
    """CSV beside the table, read back cell by cell, with the digest of the accepted table."""
    contract = export_contract(fields, key, history)
    require(g.reserved_characters(df, contract, label))
    g.write_csv(df, contract, path)
    report = settle(g.cells_equal(g.read_csv(spark, contract, path), g.render(df, contract, ""), list(key), label))
    return g.row_digest(g.render(df, contract)), report


@dataclass
class Table:
    """One table on its way to publication."""

    name: str
    df: DataFrame
    fields: list
    key: tuple
    index: DataFrame
    index_source: str
    release: str = ""
    edges: DataFrame | None = None
    allocation: str = ""

    def metadata(self, decisions: str, sources: list[tuple[str, str]]) -> dict[str, dict]:
        about = provenance(self.key, self.index_source, self.release, self.allocation, decisions, sources)
        return field_metadata(self.fields, self.index_source, about)


def pins_of(sources: DataFrame | None) -> list[tuple[str, str]]:
    """Paths and hashes of the sources; they are declared one by one, so they are few."""
    return [] if sources is None else [(r["path"], r["sha256"]) for r in sources.select("path", "sha256").collect()]


def publish(spark: SparkSession, root: str, tables: list[Table], service: DataFrame, gov: DataFrame, report: DataFrame,
            registry: Registry = REGISTRY, csv: bool = True, sources: DataFrame | None = None, decisions: str = "") -> str:
    """Write, read back and publish. Nothing is published unless every check of the run passes, nor if another run was published
    meanwhile. `sources` (path, sha256 of what was read) and the hash of the `decisions` taken are kept with the run and in its tables."""
    run = f"{dt.datetime.now(dt.timezone.utc):%Y%m%dT%H%M%S}-{uuid.uuid4().hex[:8]}"
    base = f"{root}/runs/{run}"
    require(report)
    version, expected = latest_version(spark, root)
    reports, facts, pins = [report], [], pins_of(sources)
    for t in tables:
        path = f"{base}/{t.name}"
        metadata = t.metadata(decisions, pins)
        out = typed(t.df, t.fields, t.index_source, metadata[t.fields[0].name]["table"])
        write_table(out, path)
        saved = spark.read.parquet(path)
        require(required_gate(saved, t.fields, t.name))
        reports.append(readback(spark, path, t.fields, list(t.key), t.index, service, gov, registry, t.edges, f"readback.{t.name}", metadata=metadata))
        digest = g.table_fingerprint(saved)
        prints = digest.select(F.col("total").alias("fingerprint")).first()[0]
        if csv:
            digest, cells = export(spark, saved, t.fields, t.key, t.index_source == "spd", f"{base}/{t.name}_csv", f"csv.{t.name}")
            reports.append(cells)
        before = published(spark, root, expected, t.name)
        diff = compare_with_previous(before, saved, list(t.key), before is None or still_as_published(spark, root, expected, t.name, before))
        facts.append(digest.select(F.lit(t.name).alias("table"), F.lit(t.index_source).alias("index_source"), F.lit(t.release).alias("index_release"),
                                   F.lit(",".join(t.key)).alias("key"), "n_rows", F.col("total").alias("digest"), F.lit(prints).alias("fingerprint"), F.lit(expected).alias("previous_run")))
        diff.write.mode("errorifexists").json(f"{base}/{t.name}_changes")
    whole = union_checks(*reports)
    whole.write.mode("errorifexists").json(f"{base}/checks")
    checks = spark.read.schema(whole.schema).json(f"{base}/checks")
    require(checks)
    facts = en.stacked(facts)
    facts.write.mode("errorifexists").json(f"{base}/manifest")
    summary(checks).write.mode("errorifexists").json(f"{base}/summary")
    if sources is not None:
        sources.write.mode("errorifexists").json(f"{base}/sources")
    commit(spark, root, version + 1, run)
    return run


HISTORY_ALLOCATION, LOOKUP_ALLOCATION = "postcode_grid_reference", "oa2022_centroid"


class PublishedMeanwhile(RuntimeError):
    """Another run was published since this one began; this one is not."""


def _files(spark: SparkSession, path: str):
    """A path with its file system, wherever that is."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark._jsc.hadoopConfiguration())


def latest_version(spark: SparkSession, root: str) -> tuple[int, str | None]:
    """The number of the last publication and the run it published; (0, None) before the first. A number whose file was begun and not written stands for no run."""
    folder, fs = _files(spark, f"{root}/publications")
    names = sorted((f.getPath().getName() for f in fs.listStatus(folder)), reverse=True) if fs.exists(folder) else []
    numbered = [n for n in names if re.fullmatch(r"[0-9]{12}\.json", n)]
    for name in numbered:
        path, _ = _files(spark, f"{root}/publications/{name}")
        stream = fs.open(path)
        text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        stream.close()
        if text.strip():
            return int(numbered[0][:12]), json.loads(text)["run_id"]
    return (int(numbered[0][:12]) if numbered else 0), None


def commit(spark: SparkSession, root: str, version: int, run: str) -> None:
    """Publish a run under a number. Of runs that began at the same number one gets the next: its file is created only where there is none."""
    path, fs = _files(spark, f"{root}/publications/{version:012d}.json")
    try:
        out = fs.create(path, False)
    except Exception as e:
        if fs.exists(path):
            raise PublishedMeanwhile(f"publication {version} is taken; {run} began before it") from e
        raise
    out.writeBytes(json.dumps({"published_at": dt.datetime.now(dt.timezone.utc).isoformat(), "run_id": run}))
    out.close()


def latest_run(spark: SparkSession, root: str) -> str | None:
    return latest_version(spark, root)[1]


def published(spark: SparkSession, root: str, run: str | None, table: str) -> DataFrame | None:
    return spark.read.parquet(f"{root}/runs/{run}/{table}") if run else None


def still_as_published(spark: SparkSession, root: str, run: str, table: str, df: DataFrame) -> bool:
    """Whether a published table still has the rows whose fingerprint its manifest keeps."""
    manifest = spark.read.json(f"{root}/runs/{run}/manifest")
    if "fingerprint" not in manifest.columns:
        return False
    kept = manifest.where(F.col("table") == table).select(F.col("fingerprint").cast("string")).first()
    return kept is not None and kept[0] == g.table_fingerprint(df).first()["total"]


def current(spark: SparkSession, root: str, table: str) -> DataFrame | None:
    """The published table, or None before the first publication."""
    return published(spark, root, latest_run(spark, root), table)


def audit(spark: SparkSession, root: str, tables: list[Table], service: DataFrame, gov: DataFrame, registry: Registry = REGISTRY,
          sources: DataFrame | None = None, decisions: str = "") -> DataFrame:
    """The published tables checked against the sources again, digest and metadata included; nothing is written."""
    run = latest_run(spark, root)
    if run is None:
        raise ValueError(f"nothing is published under {root}")
    manifest = spark.read.json(f"{root}/runs/{run}/manifest")
    reports = []
    for t in tables:
        path = f"{root}/runs/{run}/{t.name}"
        reports.append(readback(spark, path, t.fields, list(t.key), t.index, service, gov, registry, t.edges, f"audit.{t.name}",
                                metadata=t.metadata(decisions, pins_of(sources))))
        contract = export_contract(t.fields, t.key, t.index_source == "spd")
        now = g.row_digest(g.render(spark.read.parquet(path), contract)).select(F.lit(t.name).alias("table"), F.col("total").alias("_now"))
        both = manifest.where(F.col("table") == t.name).join(now, "table", "full_outer")
        reports.append(Checks(f"audit.{t.name}.").zero("digest", ~F.col("digest").cast("string").eqNullSafe(F.col("_now"))).run(both))
    return union_checks(*reports)


def build(spark: SparkSession, paths: Paths, root: str, history_columns: list[Field], main_columns: list[Field] | None = None, registry: Registry = REGISTRY,
          headers: dict | None = None, years: dict | None = None, lives: Lives = Lives(), pins: tuple[str, DataFrame] | None = None,
          declared: dict | None = None, decisions: str = "") -> tuple[str, list[Table]]:
    """The whole run: sources, edition tables, one join per vintage, classes, checks, publication.

    `pins` is a folder and what it must hold (path, sha256), verified before anything is read; `declared` has the rows and live records that the
    sources are said to have, by `small_user`, `large_user` and `lookup`, and the totals of `history`."""
    headers, declared = headers or {}, declared or {}
    scratch = scratch_folder(spark)
    sources = None
    if pins is not None:
        sources = written(pinned_files(spark, *pins), f"{scratch}/sources")
        require(Checks("sources.").zero("present", ~F.col("present")).zero("verified", ~F.col("verified")).run(sources))
    counts = lambda name: dict(zip(("rows", "live"), declared.get(name, ())))
    small, r1 = directory_file(spark, paths.small_user, "small_user", registry, headers.get("small_user"), **counts("small_user"))
    large, r2 = directory_file(spark, paths.large_user, "large_user", registry, headers.get("large_user"), **counts("large_user"))
    r1, r2 = settle(r1), settle(r2)
    require(union_checks(r1, r2))
    index, r3 = history_index(small, large, registry, *([declared["history"]] if "history" in declared else []))
    r3 = settle(r3)
    require(r3)
    index = written(index, f"{scratch}/index")
    service, r4 = service_tables(spark, paths, registry, scratch)
    gov, r5 = government_tables(spark, paths, registry, years, scratch)
    reports = [r1, r2, r3, r4, r5, cross_checks(service, gov, registry)]
    require(union_checks(*reports))
    wide, edges = written(en.enrich(index, service, gov, registry), f"{scratch}/enriched"), None
    if registry.rurality_versions:
        layers = []
        for v in registry.rurality_versions:
            layer, columns, epsg = read_layer(spark, paths.layers[v.key], v)
            reports.append(settle(sp.layer_checks(sp.polygon_table(layer), v, columns, epsg)))
            layers.append(layer)
        edges = written(en.stacked(layers), f"{scratch}/edges")
        reports += [settle(sp.points_present(index)), settle(sp.area_checks(edges)), settle(rg.observed(edges))]
        placed = written(sp.classify(wide, edges, registry.rurality_versions), f"{scratch}/placed")
        gated = sp.agreement(placed, registry.gate, lives)
        principal = F.max(F.when(F.col("cohort") == "current_small_user", F.col("lives")))
        reports.append(settle(Checks("rurality.agreement.").zero("cohorts", ~F.col("passed")).holds("current_small_users_present", principal > 0).run(gated)))
        wide = sp.withhold_po_boxes(placed, registry.rurality_versions, lives)
    reports.append(settle(en.enriched_checks(wide, index, ["pc_norm", "introduced_on"], registry, "join.history")))
    tables = [Table("postcode_simd_history", wide, history_columns, ("pc_norm", "introduced_on"), index, "spd", registry.history_release, edges, HISTORY_ALLOCATION)]
    if paths.lookup and main_columns:
        main, r6 = latest_lookup(spark, paths.lookup, registry, headers.get("lookup"), **counts("lookup"))
        r6 = settle(r6)
        require(r6)
        main = written(main, f"{scratch}/lookup")
        main_wide = written(en.enrich(main, service, gov, registry), f"{scratch}/lookup_enriched")
        reports += [r6, settle(en.enriched_checks(main_wide, main, ["pc_norm"], registry, "join.main"))]
        tables.append(Table("postcode_simd", main_wide, main_columns, ("pc_norm",), main, "sspl", registry.lookup_release, None, LOOKUP_ALLOCATION))
    run = publish(spark, root, tables, service, gov, union_checks(*reports), registry, sources=sources, decisions=decisions)
    return run, tables
