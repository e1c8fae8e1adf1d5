"""Names of measures taken apart: which domain, whose weighting, within which area, in what form."""

from __future__ import annotations

import re
from dataclasses import dataclass

from ..registry import BAND_WIDTH, DOMAINS, WEIGHTED_WIDTH, Edition

# The words by which published labels name weightings, areas, direction and split rules.
WEIGHTINGS = {"pw": "PHS population-weighted", "uw": "Scottish Government unweighted"}
AREAS = {"scotland": "within-Scotland", "hb": "within-NHS-Board", "hscp": "within-HSCP", "ca": "within-council-area"}
DIRECTION = "1 = most deprived"
SPLIT_RULES = {"a_part": "split postcodes resolved to the A part", "report": "split postcodes reported"}

FORMS = ["rank", *dict.fromkeys([*BAND_WIDTH, *WEIGHTED_WIDTH]), "most15pc", "least15pc"]
NAME = re.compile(rf"(?:(?P<domain>[a-z_]+)_domain_)?(?:(?P<weighting>{'|'.join(WEIGHTINGS)})_(?P<area>{'|'.join(AREAS)})_)?(?P<form>{'|'.join(FORMS)})")


@dataclass(frozen=True)
class Measure:
    name: str
    domain: str | None
    weighting: str | None
    area: str | None
    form: str

    @classmethod
    def named(cls, name: str) -> Measure:
        m = NAME.fullmatch(name)
        if m is None or (m["domain"] is None and m["weighting"] is None and m["form"] in BAND_WIDTH):
            raise ValueError(f"{name!r} names no measure")
        if m["domain"] is not None and m["domain"] not in DOMAINS:
            raise ValueError(f"{name!r}: no such domain; there are {sorted(DOMAINS)}")
        return cls(name, m["domain"], m["weighting"], m["area"], m["form"])

    @property
    def spark_type(self) -> str:
        return "double" if self.domain and self.form == "rank" else "long"

    def in_edition(self, edition: Edition) -> bool:
        """Whether the edition has it; what is not about one domain every edition has."""
        return self.domain is None or self.name in edition.measures()

    def source_column(self, edition: Edition) -> str | None:
        """Where the edition keeps the source of a domain's ranks, if its sources differ."""
        return edition.column(f"{self.domain}_domain_rank_source_status") if self.domain in edition.status_domains else None

    def parts(self) -> list[str]:
        """What the value is, a phrase for each side of it."""
        if self.domain is None and self.form == "rank":
            return []
        if self.form in ("most15pc", "least15pc"):
            return [WEIGHTINGS["pw"], f"{self.form.removesuffix('15pc')}-deprived 15% flag"]
        subject = [f"{self.domain} domain"] if self.domain else []
        weighting = "computed population-weighted" if self.domain and self.weighting else WEIGHTINGS[self.weighting or "uw"]
        return [*subject, weighting, f"{AREAS[self.area or 'scotland']} {self.form}"]

    def label(self, edition: str, split: str = "a_part", published: bool = True) -> str:
        head = f"SIMD {edition}" if self.parts() else f"SIMD {edition} {self.form}"
        return ", ".join([head, *self.parts(), DIRECTION, SPLIT_RULES[split], *([] if published else ["not published for this edition"])])
