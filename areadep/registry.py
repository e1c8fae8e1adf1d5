"""What is fixed about the data: editions of the index, classification versions, column names.

Everything here is configuration on the driver. The lists of values are fixed values that must
equal the published ones; column lists longer than that are produced from the rules below.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace

# ---- fixed values ------------------------------------------------------------------------------

DOMAINS = ("income", "employment", "health", "education", "access", "crime", "housing")
BAND_WIDTH = {"quintile": 5, "decile": 10, "vigintile": 20}
WEIGHTED_WIDTH = {"quintile": 5, "decile": 10}
GEOGRAPHIES = ("hb", "hscp", "ca")
FIRST_YEAR, LAST_YEAR = 1, 9999

# Published band columns of the health-service edition files, as suffix of the file's own prefix.
PUBLISHED_BANDS = {
    "CountryDecile": "pw_scotland_decile", "CountryQuintile": "pw_scotland_quintile",
    "HBDecile": "pw_hb_decile", "HBQuintile": "pw_hb_quintile",
    "HSCPDecile": "pw_hscp_decile", "HSCPQuintile": "pw_hscp_quintile",
    "CADecile": "pw_ca_decile", "CAQuintile": "pw_ca_quintile",
}
PUBLISHED_FLAGS = {"Most15pc": "most15pc", "Least15pc": "least15pc"}
UNWEIGHTED = ("uw_scotland_quintile", "uw_scotland_decile", "uw_scotland_vigintile")

# The long band cube: its columns, measurements and domain vocabulary.
CUBE_COLUMNS = ("FeatureCode", "FeatureName", "FeatureType", "DateCode", "Measurement", "Units", "Value", "SIMD Domain")
CUBE_MEASUREMENTS = ("Rank", "Quintile", "Decile", "Vigintile")
CUBE_DOMAINS = {
    "Income": "income", "Employment": "employment", "Health": "health",
    "Education Skills And Training": "education", "Access To Services": "access",
    "Crime": "crime", "Housing": "housing", "SIMD": "overall",
}
RANK_SOURCES_DISAGREE = "rank_sources_disagree"

# Directory vocabulary.
USER_TYPES = {"S": "small_user", "L": "large_user"}
LINK_SENTINELS = ("NO LINKP", "NO LINK")
POSTCODE_SHAPE = "[A-Z]{1,2}[0-9][A-Z0-9]?[0-9][A-Z]{2}"

# Rurality: 8-fold class -> 6-fold class, and the published label of each class.
EIGHT_TO_SIX = {1: 1, 2: 2, 3: 3, 4: 4, 5: 4, 6: 5, 7: 6, 8: 6}
SIXFOLD_LABELS = {
    1: "Large urban area", 2: "Other urban area", 3: "Accessible small town",
    4: "Remote small town", 5: "Accessible rural area", 6: "Remote rural area",
}
BNG_EPSG = 27700

# Policy texts returned with a linkage result.
EDITION_BY_YEAR = "PHS v3.5 Table 4: edition by year of the health data"
EDITION_THROUGHOUT = "PHS v3.5 section 3.2.1.2: one edition throughout"
RURALITY_BY_YEAR = "project choice: classification version by reference year of the health data"
RURALITY_THROUGHOUT = "project choice: latest classification version throughout"
BAND_DIRECTION = "1 = most deprived"

# Header of the small-user directory file, in file order. The large-user file has no census counts
# and no NeverDigitised, and carries LinkedSmallUserPostcode after DateOfDeletion.
SMALL_USER_HEADER = tuple("""
Postcode PostcodeDistrict PostcodeSector DateOfIntroduction DateOfDeletion GridReferenceEasting
GridReferenceNorthing Latitude Longitude SplitIndicator CouncilArea2019Code
UKParliamentaryConstituency2024Code ScottishParliamentaryRegion2026Code
ScottishParliamentaryConstituency2026Code ElectoralWard2022Code HealthBoardArea2019Code
HealthBoardArea2006Code HealthBoardArea1995Code IntegrationAuthority2019Code OutputArea2022Code
OutputArea2011Code OutputArea2001Code OutputArea1991Code DataZone2022Code DataZone2011Code
DataZone2001Code IntermediateZone2022Code IntermediateZone2011Code IntermediateZone2001Code
CensusHouseholdCount2022 CensusPopulationCount2022 CensusHouseholdCount2011
CensusPopulationCount2011 CensusHouseholdCount2001 CensusPopulationCount2001
CensusHouseholdCount1991 CensusPopulationCount1991 ScottishIndexOfMultipleDeprivation2020Rank
LAU2025Level1Code ITL2025Level2Code ITL2025Level3Code Locality2020Code Locality2022Code
Locality2001Code Locality1991Code Settlement2020Code Settlement2022Code Settlement2001Code
CivilParish1930Code EnterpriseRegion2008Code IslandCode LocalGovernmentDistrict1995Code
LocalGovernmentDistrict1991Code NationalPark2010Code RegistrationDistrict2007Code
ROACommunityPlanningPartnership2006Code ROALocal2006Code StrategicDevelopmentPlanningArea2013Code
TravelToWorkArea2011Code UrbanRural6Fold2022Code UrbanRural8Fold2022Code GridLinkIndicator
GridLinkPositionalAccuracy NeverDigitised
""".split())
LARGE_USER_HEADER = tuple(
    c for name in SMALL_USER_HEADER
    if not name.startswith("Census") and name != "NeverDigitised"
    for c in ((name, "LinkedSmallUserPostcode") if name == "DateOfDeletion" else (name,))
)
# Header of the latest-postcode lookup, in file order.
LOOKUP_HEADER = tuple("""
Postcode PostcodeDistrict PostcodeSector SplitIndicator LinkedSmallUserPostcode DateOfIntroduction
DateOfDeletion PostcodeType GridReferenceEasting GridReferenceNorthing OutputArea2022Code
OutputArea2011Code DataZone2022Code DataZone2011Code IntermediateZone2022Code
IntermediateZone2011Code OutputArea2001Code DataZone2001Code IntermediateZone2001Code
OutputArea1991Code CouncilArea2019Code RegistrationDistrict2007Code LocalGovernmentDistrict1995Code
LocalGovernmentDistrict1991Code ElectoralWard2022Code ScottishParliamentaryRegion2026Code
ScottishParliamentaryConstituency2026Code UKParliamentaryConstituency2024Code
HealthBoardArea2019Code HealthBoardArea2006Code HealthBoardArea1995Code
IntegrationAuthority2019Code StrategicDevelopmentPlanningArea2013Code CivilParish1930Code
TravelToWorkArea2011Code IslandCode UrbanRural6Fold2022Code UrbanRural8Fold2022Code
LAU2025Level1Code ITL2025Level2Code ITL2025Level3Code CensusHouseholdCount2022
CensusPopulationCount2022 CensusHouseholdCount2011 CensusPopulationCount2011
CensusHouseholdCount2001 CensusPopulationCount2001 CensusHouseholdCount1991
CensusPopulationCount1991 ScottishIndexOfMultipleDeprivation2020Rank
""".split())


# ---- editions and versions ---------------------------------------------------------------------

@dataclass(frozen=True)
class Edition:
    """One edition of the index: which zones it uses, what it published, how its files name it."""

    key: str
    vintage: int
    rows: int
    first_year: int
    last_year: int
    invert_bands: bool = False
    domains: tuple = DOMAINS
    prefix: str = ""
    zone_columns: tuple = ("DataZone", "IntZone", "HB", "HSCP", "CA")
    columns: dict = field(default_factory=dict)          # canonical name -> attribute-table column
    domain_columns: dict = field(default_factory=dict)   # domain -> attribute-table column
    cube_year: int | None = None
    half_ranks: str = "exact"                            # or "rounded_up"
    status_domains: tuple = ()

    def column(self, measure: str) -> str:
        return f"simd{self.key}_{measure}"

    def domain_ranks(self) -> list[str]:
        return [f"{d}_domain_rank" for d in self.domains]

    def domain_bands(self) -> list[str]:
        if self.cube_year is None:
            return []
        return [f"{d}_domain_{b}" for d in self.domains for b in BAND_WIDTH]

    def domain_statuses(self) -> list[str]:
        return [f"{d}_domain_rank_source_status" for d in DOMAINS if d in self.status_domains]

    def weighted_bands(self) -> list[str]:
        return [f"{d}_domain_pw_scotland_{b}" for d in self.domains for b in WEIGHTED_WIDTH]

    def service_measures(self) -> list[str]:
        return ["rank", *PUBLISHED_BANDS.values(), *PUBLISHED_FLAGS.values()]

    def government_measures(self) -> list[str]:
        return [*UNWEIGHTED, *self.domain_ranks(), *self.domain_bands(), *self.domain_statuses(),
                *self.weighted_bands(), "population"]

    def measures(self) -> list[str]:
        return self.service_measures() + self.government_measures()

    def publishes(self, measure: str) -> bool:
        return measure in self.measures()


# Names of the published attribute tables' columns, and the editions as published.
_ATTRIBUTES = {"datazone": "datazone", "rank": "rank", "quintile": "quintile", "decile": "decile", "vigintile": "vigintile"}
_DOMAIN_ATTRIBUTES = {"income": "incrank", "employment": "emprank", "health": "hlthrank", "education": "edurank",
                      "access": "gaccrank", "crime": "crimerank", "housing": "houserank"}
_CA_FIRST = ("DataZone", "IntZone", "CA", "HSCP", "HB")


def _edition(key, vintage, rows, years, population, **more) -> Edition:
    domains = more.pop("domains", DOMAINS)
    columns = {**_ATTRIBUTES, "population": population, **more.pop("columns", {})}
    renamed = more.pop("domain_columns", {})
    return Edition(key=key, vintage=vintage, rows=rows, first_year=years[0], last_year=years[1], domains=domains,
                   prefix=f"SIMD{key.upper()}", columns=columns,
                   domain_columns={d: renamed.get(d, _DOMAIN_ATTRIBUTES[d]) for d in domains}, **more)


EDITIONS = (
    _edition("2004", 2001, 6505, (1996, 2003), "totpop2001", invert_bands=True, cube_year=2004, half_ranks="rounded_up",
             domains=tuple(d for d in DOMAINS if d != "crime"), zone_columns=_CA_FIRST),
    _edition("2006", 2001, 6505, (2004, 2006), "sape2004", invert_bands=True, cube_year=2006, half_ranks="rounded_up",
             zone_columns=_CA_FIRST),
    _edition("2009v2", 2001, 6505, (2007, 2009), "sape2007", cube_year=2009, half_ranks="rounded_up", zone_columns=_CA_FIRST),
    _edition("2012", 2001, 6505, (2010, 2013), "sape2010", cube_year=2012, half_ranks="rounded_up", zone_columns=_CA_FIRST),
    _edition("2016", 2011, 6976, (2014, 2016), "sape2014", cube_year=2016),
    _edition("2020v2", 2011, 6976, (2017, LAST_YEAR), "sape2017", cube_year=2020, status_domains=("housing",),
             columns={"rank": "rankv2", "quintile": "quintilev2", "decile": "decilev2", "vigintile": "vigintilv2"},
             domain_columns={"income": "incrankv2"}),
)


@dataclass(frozen=True)
class RuralityVersion:
    key: str
    reference_year: int
    polygons: int = 8
    sixfold: str = "UR6FOLD"
    eightfold: str = "UR8FOLD"

    @property
    def stem(self) -> str:
        return "urbanrural" + self.key.replace("-", "_")


RURALITY_VERSIONS = tuple(
    [RuralityVersion(f"{y}-{y + 1}", y) for y in range(2003, 2014, 2)]
    + [RuralityVersion(str(y), y, sixfold="UR6Class", eightfold="UR8Class") for y in (2016, 2020, 2022)]
)


@dataclass(frozen=True)
class AgreementGate:
    """Thresholds of the placement gate, and the published columns it compares with."""

    version: str = "2022"
    sixfold: str = "UrbanRural6Fold2022Code"
    eightfold: str = "UrbanRural8Fold2022Code"
    principal: float = 0.995
    other: float = 0.99
    min_cohort: int = 1000


@dataclass(frozen=True)
class Registry:
    editions: tuple = EDITIONS
    rurality_versions: tuple = RURALITY_VERSIONS
    history_release: str = ""
    lookup_release: str = ""
    directory_rank: tuple | None = ("2020v2", "ScottishIndexOfMultipleDeprivation2020Rank")
    gate: AgreementGate = AgreementGate()

    def edition(self, key: str) -> Edition:
        for e in self.editions:
            if e.key == key:
                return e
        raise ValueError(f"unknown edition {key!r}; the editions are {', '.join(e.key for e in self.editions)}")

    def vintages(self) -> list[int]:
        return sorted({e.vintage for e in self.editions})

    def of_vintage(self, vintage: int) -> list[Edition]:
        return [e for e in self.editions if e.vintage == vintage]

    def edition_windows(self) -> list[tuple]:
        """(first year, last year, edition, vintage) of the recommended edition by year of the data."""
        return [(e.first_year, e.last_year, e.key, e.vintage) for e in self.editions]

    def rurality_windows(self) -> list[tuple]:
        """(first year, last year, version): a version holds until the year before the next one's."""
        vs = self.rurality_versions
        nexts = [v.reference_year - 1 for v in vs[1:]] + [LAST_YEAR]
        return [(v.reference_year, last, v.key) for v, last in zip(vs, nexts)]

    def optional_measures(self) -> list[str]:
        """Measures only some editions publish, in output order: ranks, bands, statuses, weighted bands."""
        statuses = [f"{d}_domain_rank_source_status" for d in DOMAINS if any(d in e.status_domains for e in self.editions)]
        return ([f"{d}_domain_rank" for d in DOMAINS] + [f"{d}_domain_{b}" for d in DOMAINS for b in BAND_WIDTH]
                + statuses + [f"{d}_domain_pw_scotland_{b}" for d in DOMAINS for b in WEIGHTED_WIDTH])

    def replace(self, **changes) -> "Registry":
        return replace(self, **changes)


REGISTRY = Registry()

# Output name of every core measure in a linkage result -> the stored measure, in output order.
CORE_OUTPUT = {"simd_rank": "rank"}
for _scope in ("scotland", "hb", "hscp", "ca"):
    for _band in ("quintile", "decile"):
        CORE_OUTPUT[f"phs_pw_{_scope}_{_band}"] = f"pw_{_scope}_{_band}"
for _flag in ("most15pc", "least15pc"):
    CORE_OUTPUT[f"phs_pw_{_flag}"] = _flag
for _m in UNWEIGHTED:
    CORE_OUTPUT[f"gov_{_m}"] = _m


def optional_output(measure: str) -> str:
    """Output name of an optional measure: computed_pw_<domain>_domain_<band> or gov_<measure>."""
    if "_pw_scotland_" in measure:
        domain, band = measure.split("_domain_pw_scotland_")
        return f"computed_pw_{domain}_domain_{band}"
    return f"gov_{measure}"
