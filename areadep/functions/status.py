"""What happened to a linked record, as ordered rules. The first rule that holds gives the status."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

from .keys import is_po_box, is_unlinked, part
from .years import year_out_of_range

USABLE = ("matched", "a_part", "linked_small_user")
UNDECIDED = ("ambiguous_postcode", "split_a_missing")


def first_rule(rules: list[tuple[Column, Column | str]], otherwise: Column | str) -> Column:
    as_col = lambda v: F.lit(v) if isinstance(v, str) else v
    head, *rest = rules
    return reduce(lambda acc, r: acc.when(r[0], as_col(r[1])), rest, F.when(head[0], as_col(head[1]))).otherwise(as_col(otherwise))


def _record_rules(suffix: Column, split_flagged: Column, choices: bool) -> dict:
    large = F.col("matched_user_type") == "large_user"
    link = "requested_link_postcode"
    return {
        "undecided": [(F.col("matched_candidate_count") > 1, "ambiguous_postcode"),
                      (~suffix.isin("", "A"), "split_a_missing")] if choices else [],
        "geography": [(is_po_box("matched_user_type", link), "po_box"),
                      (is_unlinked("matched_user_type", link), "unlinked_large_user"),
                      (F.col("source_key").isNull(), "linked_small_user_not_found")],
        "found": [(large, "linked_small_user"), (split_flagged, "a_part")],
    }


def latest_life_status() -> Column:
    """The newest life of a key that was found."""
    suffix = part("matched_pc_norm", "matched_pc_base")
    r = _record_rules(suffix, suffix == "A", True)
    return first_rule([*r["undecided"], *r["geography"], *r["found"]], "matched")


def stretch_status() -> Column:
    """A stretch of days of a known key; the stretch before its first life has no start."""
    suffix = part("matched_pc_norm", "matched_pc_base")
    r = _record_rules(suffix, suffix == "A", True)
    none = F.col("matched_pc_norm").isNull()
    return first_rule([
        (none & F.col("seg_from").isNull(), "postcode_not_yet_introduced"),
        (none & F.col("next_life_introduced_on").isNotNull(), "between_lives"),
        (none, "postcode_deleted_by_date"),
        *r["undecided"], *r["geography"],
        (F.col("from_previous_life"), "previous_life"),
        *r["found"]], "matched")


def lookup_status(split_flag="SplitIndicator") -> Column:
    """A record of a lookup of whole latest keys: no candidates to choose between."""
    r = _record_rules(F.lit(""), F.col(split_flag) == "Y", False)
    return first_rule([*r["geography"], *r["found"]], "matched")


def request_status(found="postcode_status", date: str | None = None) -> Column:
    """The key's own problem first, then a missing date, then the status of what was found."""
    rules = [(F.col("postcode_key").isNull(), "missing_postcode"), (F.col(found).isNull(), "not_found")]
    if date is not None:
        rules.append((F.col(date).isNull(), "missing_address_date"))
    return first_rule(rules, F.col(found))


def value_status(usable: tuple, missing: Column) -> Column:
    """An edition problem first, then a postcode problem, then a missing stored value."""
    return first_rule([(F.col("edition_status") != "ok", F.col("edition_status")),
                       (~F.col("postcode_status").isin(*usable), F.col("postcode_status")),
                       (missing, "missing_simd")], "matched")


def rurality_status(first_reference_year: int, stored="rurality_stored_status") -> Column:
    none, year = F.col("rurality_version").isNull(), F.col("analysis_year")
    return first_rule([
        (F.col("matched_pc_norm").isNull() | F.col("postcode_status").isin(*UNDECIDED), F.col("postcode_status")),
        (none & year.isNull(), "missing_year"),
        (none & year_out_of_range(year), "invalid_year"),
        (none & (year < first_reference_year), "before_first_version"),
        (none, "invalid_year"),
        (F.col(stored).isNotNull(), F.col(stored))], "matched")
