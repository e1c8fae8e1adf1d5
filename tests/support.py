"""Writers of small source files: a directory, edition files, attribute tables, band cubes and a layer."""

import csv
import os
import struct
from dataclasses import replace

from areadep.plans.publish import Paths
from areadep.registry import (CUBE_COLUMNS, CUBE_DOMAINS, EDITIONS, EIGHT_TO_SIX, PUBLISHED_BANDS, PUBLISHED_FLAGS, AgreementGate, Registry,
                              RuralityVersion)

HEADER = ["Postcode", "SplitIndicator", "DateOfIntroduction", "DateOfDeletion", "GridReferenceEasting", "GridReferenceNorthing", "DataZone2001Code",
          "DataZone2011Code", "DataZone2022Code", "UrbanRural6Fold2022Code", "UrbanRural8Fold2022Code", "GridLinkPositionalAccuracy",
          "ScottishIndexOfMultipleDeprivation2020Rank"]
LARGE_HEADER = HEADER + ["LinkedSmallUserPostcode"]
LOOKUP_HEADER = ["Postcode", "SplitIndicator", "LinkedSmallUserPostcode", "DateOfIntroduction", "DateOfDeletion", "PostcodeType", "DataZone2001Code",
                 "DataZone2011Code", "DataZone2022Code", "ScottishIndexOfMultipleDeprivation2020Rank"]
VERSION = RuralityVersion("2022", 2022, sixfold="UR6Class", eightfold="UR8Class")
BNG = 'PROJCS["British_National_Grid",GEOGCS["GCS_OSGB_1936"]]'


def write_csv(path, header, rows, bom=False):
    with open(path, "w", newline="", encoding="utf-8-sig" if bom else "utf-8") as f:
        w = csv.writer(f, lineterminator="\n")
        w.writerow(header)
        w.writerows(rows)


def write_dbf(path, fields, rows):
    """fields: (name, type, width, decimals)."""
    record = 1 + sum(w for _, _, w, _ in fields)
    with open(path, "wb") as f:
        f.write(struct.pack("<B3BIHH20x", 3, 126, 1, 1, len(rows), 33 + 32 * len(fields), record))
        for name, kind, width, decimals in fields:
            f.write(name.upper().encode()[:11].ljust(11, b"\0") + kind.encode() + b"\0" * 4 + bytes([width, decimals]) + b"\0" * 14)
        f.write(b"\r")
        for row in rows:
            f.write(b" ")
            for (_, kind, width, decimals), v in zip(fields, row):
                text = "" if v is None else (f"{v:.{decimals}f}" if kind == "N" else str(v))
                f.write((text.rjust(width) if kind == "N" else text.ljust(width)).encode("latin-1"))
        f.write(b"\x1a")


def write_shape(stem, polygons, prj=BNG):
    """polygons: lists of rings, a ring a closed list of points. Writes .shp, .shx and .prj."""
    shp, shx, at = b"", b"", 50
    for i, rings in enumerate(polygons, 1):
        points = [p for r in rings for p in r]
        xs, ys = [p[0] for p in points], [p[1] for p in points]
        starts, n = [], 0
        for r in rings:
            starts.append(n)
            n += len(r)
        body = struct.pack("<i4d2i", 5, min(xs), min(ys), max(xs), max(ys), len(rings), n) + struct.pack(f"<{len(starts)}i", *starts)
        body += b"".join(struct.pack("<2d", *p) for p in points)
        shp += struct.pack(">2i", i, len(body) // 2) + body
        shx += struct.pack(">2i", at, len(body) // 2)
        at += 4 + len(body) // 2
    for end, body in ((".shp", shp), (".shx", shx)):
        with open(stem + end, "wb") as f:
            f.write(struct.pack(">7i", 9994, 0, 0, 0, 0, 0, 50 + len(body) // 2) + struct.pack("<2i8d", 1000, 5, *[0.0] * 8) + body)
    with open(stem + ".prj", "w") as f:
        f.write(prj)


def square(i):
    x = i * 20000.0
    return [[(x, 0.0), (x, 20000.0), (x + 20000.0, 20000.0), (x + 20000.0, 0.0), (x, 0.0)]]


def registry(release="r1"):
    """An edition of each vintage over two zones, and one classification version."""
    eds = tuple(replace(e, rows=2) for e in EDITIONS if e.key in ("2004", "2020v2"))
    return Registry(editions=eds, rurality_versions=(VERSION,), history_release=release, lookup_release=release + "-lookup",
                    gate=AgreementGate(min_cohort=1000))


def record(postcode, zone=1, deleted="", split="N"):
    letter, x = "AB"[zone - 1], 5000 + 40000 * (zone - 1)      # squares 1 and 3
    cls = 1 if zone == 1 else 3
    return [postcode, split, "1/1/2020 00:00:00", deleted, str(x), "5000", f"D2001{letter}", f"D2011{letter}", f"D2022{letter}", str(EIGHT_TO_SIX[cls]), str(cls), "1", str(zone)]


def lookup_record(postcode, zone=1, deleted="", split="N", kind="S", link=""):
    letter = "AB"[zone - 1]
    return [postcode, split, link, "01/01/2020", deleted, kind, f"D2001{letter}", f"D2011{letter}", f"D2022{letter}", str(zone)]


def write_project(root, small=None, large=None, lookup=None, fault=None):
    """Every source file of a small project; returns its Paths."""
    os.makedirs(root, exist_ok=True)
    p = lambda n: os.path.join(root, n)
    small = small or [record("AB10 1AA"), record("AB10 1AB", 2), record("AB10 1AC")]
    large = large or [record("AB10 1AD", 2) + ["AB10 1AA"]]
    lookup = lookup or [lookup_record("AB10 1AA"), lookup_record("AB10 1AB", 2), lookup_record("AB10 1AC", 2), lookup_record("AB10 1AD", 2, kind="L", link="AB10 1AA")]
    write_csv(p("small.csv"), HEADER, small, bom=True)
    write_csv(p("large.csv"), LARGE_HEADER, large)
    write_csv(p("lookup.csv"), LOOKUP_HEADER, lookup)
    service, attributes, cubes, pinned = {}, {}, {}, {}
    words = {v: k for k, v in CUBE_DOMAINS.items()}
    for e in registry().editions:
        widths = {n: 10 if n.endswith("decile") else 5 for n in PUBLISHED_BANDS.values()}
        values = {n: {"pw_scotland_quintile": (1, 3), "pw_scotland_decile": (1, 6)}.get(n, (1, w)) for n, w in widths.items()}
        rows = []
        for i, letter in enumerate("AB"):
            zone = {"DataZone": f"D{e.vintage}{letter}", "IntZone": "IZ", "HB": "HB", "HSCP": "HSCP", "CA": "CA"}
            bands = [(w + 1 - values[n][i] if e.invert_bands else values[n][i]) for n, w in widths.items()]
            rows.append([zone[c] for c in e.zone_columns] + [i + 1, *bands, 1 - i, i])
        if fault == ("service", e.key):
            rows[1][5] = 7
        service[e.key] = p(f"service_{e.key}.csv")
        write_csv(service[e.key], [*e.zone_columns, *[e.prefix + s for s in ("Rank", *PUBLISHED_BANDS, *PUBLISHED_FLAGS)]], rows)

        fields = [(e.columns["datazone"], "C", 12, 0)] + [(e.columns[c], "N", 10, 0) for c in ("rank", "quintile", "decile", "vigintile", "population")]
        fields += [(e.domain_columns[d], "N", 10, 1) for d in e.domains]
        attributes[e.key] = p(f"attributes_{e.key}.dbf")
        write_dbf(attributes[e.key], fields, [
            [f"D{e.vintage}{l}", i + 1, (1, 5)[i], (1, 10)[i], (1, 20)[i], (10, 190)[i], *[1.5 if d == "income" else float(i + 1) for d in e.domains]] for i, l in enumerate("AB")])
        long = []
        for i, letter in enumerate("AB"):
            for d in ("overall", *e.domains):
                rank = 1.5 if d == "income" else float(i + 1)
                rank += 0.5 if rank % 1 and e.half_ranks == "rounded_up" else 0
                rank -= 0.5 if d in e.status_domains and i == 1 else 0
                cut = (5, 10, 20) if i == 1 and d != "income" else (1, 1, 1)
                for m, v in zip(("Rank", "Quintile", "Decile", "Vigintile"), (rank, *cut)):
                    long.append([f"D{e.vintage}{letter}", "name", f"{e.vintage} Data Zone", e.cube_year, m, m, v, words[d]])
        cubes[e.key] = p(f"cube_{e.key}.csv")
        write_csv(cubes[e.key], CUBE_COLUMNS, long)
        for d in e.status_domains:
            pinned[(e.key, d)] = p(f"pinned_{e.key}_{d}.csv")
            with open(pinned[(e.key, d)], "w") as f:
                f.write(f"# declared\ndata_zone,shapefile_rank,published_rank\nD{e.vintage}B,2.0,1.5\n")
    write_shape(p("layer"), [square(i) for i in range(8)])
    write_dbf(p("layer.dbf"), [("UR6Class", "N", 4, 0), ("UR8Class", "N", 4, 0)], [[EIGHT_TO_SIX[i + 1], i + 1] for i in range(8)])
    return Paths(p("small.csv"), p("large.csv"), p("lookup.csv"), service, attributes, cubes, pinned, {"2022": p("layer.shp")})
