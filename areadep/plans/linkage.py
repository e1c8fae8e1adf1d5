"""Linking a cohort to a directory: one output row for every input row, and what happened to it.

`link_as_of`      history table, the life valid on the row's date, else the last one before it
`link_latest`     history table, the newest life of every key
`link_lookup`     lookup table of whole latest keys

Each returns the cohort with postcode_key, the matched record, the record that supplies geography
(`source_*`) and postcode_status. Any column of the directory can be carried along: `context` from
the matched record, `source` from the record that supplies geography. Few columns travel with the
record. Of many only a print does, through every shuffle and pass; the distinct sets of values of a
key are joined last, by key and print, and no row that has them is shuffled after.
Edition, version and measures are added by `plans.report`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

from ..functions import status as st
from ..functions.keys import Lives, normalised, part, request_key
from ..operators.lives import best_of_parts, best_part, geography_key, life_record, newest_lives
from ..operators.skew import BROADCAST_BYTES, cells, lookup_join, measured
from ..operators.timeline import as_of_join, broadcastable, stretches

NARROW = 8     # carried columns that travel with the record; of more only a print does, by which they are joined last: another plan, the same result
PRINT, CONTEXT, SOURCE_SET = "_print", "_context", "_source"
NESTED = (T.ArrayType, T.MapType, T.StructType, T.VariantType)
MATCHED = ["matched_pc_norm", "matched_pc_base", "matched_introduced_on", "matched_deleted_on", "matched_is_current",
           "matched_user_type", "requested_link_postcode", "matched_candidate_count"]
SOURCE = ["source_key", "source_introduced_on", "source_is_current"]


def _plain(history: DataFrame, columns) -> list[str]:
    """Columns of one value a cell, which can be hashed and grouped by as they are."""
    return [c for c in dict.fromkeys(columns) if not isinstance(history.schema[c].dataType, NESTED)]


def _hashed(columns: list[str]):
    """A print of some cells. Which are null is hashed as well: Spark's hash skips them, so that a value and a null would read like a null and a value."""
    return F.xxhash64(*columns, *[F.isnull(c) for c in columns])


def _printed(history: DataFrame, lives: Lives, context, source) -> DataFrame:
    """The directory with prints of each record: of what it gives as context, of what it gives as geography (both with its key), and of all that
    is read of it, which settles which of two newest ones is taken."""
    known = [c for c in (lives.key, lives.base, lives.start, lives.end, lives.current, lives.role, lives.link) if c in history.columns]

    def of(columns):
        plain = _plain(history, columns)
        # A list or map is not compared: then the record is meant, and not what it holds.
        return _hashed(list(dict.fromkeys([*([lives.key] if len(plain) == len(set(columns)) else known), *plain])))
    sets = history.withColumns({CONTEXT: of(context), SOURCE_SET: of(source)})
    return sets.withColumn(PRINT, _hashed([*known, CONTEXT, SOURCE_SET]))


def _sets(history: DataFrame, lives: Lives, columns, name: str, prefix: str, *more: str) -> DataFrame:
    """What the records of a key carry, each distinct set of values once: a key's lives mostly share theirs. `name` is the print they are found by.
    As columns to group by they meet in a hash table before they are shuffled; wide rows are never sorted for it."""
    columns = list(dict.fromkeys(columns))
    # The print comes last: of a name that stands before the cells it is made of, Spark derives what holds with each cell by its name or not.
    rows = history.select(*more, F.col(lives.key).alias("_ck"), *[F.col(c).alias(f"{prefix}{c}") for c in columns], F.col(name).alias("_cp"))
    return rows.distinct() if len(_plain(history, columns)) == len(columns) else rows.dropDuplicates(["_ck", "_cp"])


def _unfolded(columns, context, source) -> list[str]:
    """The columns of answers in their order, with those that a print stands for in its place."""
    place = {f"context_{CONTEXT}": [f"context_{c}" for c in dict.fromkeys(context)], f"source_{SOURCE_SET}": [f"source_{c}" for c in dict.fromkeys(source)]}
    if not place.keys() & set(columns):
        return list(columns)
    last = {c for names in place.values() for c in names}
    return [x for c in columns if c not in last for x in place.get(c, [c])]


def _small_whole(kept: DataFrame, whole: DataFrame, strategy: str, measure) -> tuple[DataFrame, bool]:
    """Of answers that are few: the whole ones if these may be broadcast as well. Their number tells of most, and only otherwise is the whole measured."""
    if strategy == "broadcast":
        return whole, True
    if kept.count() * 8 * cells(whole.schema) > BROADCAST_BYTES:
        return kept, False
    whole, small = measure(whole)
    if not small:
        whole.unpersist()
    return (whole, True) if small else (kept, False)


def _with_sets(answers: DataFrame, history: DataFrame, lives: Lives, context, source) -> DataFrame:
    """Answers that hold prints, with what these stand for."""
    for columns, name, key, prefix in ((context, CONTEXT, "matched_pc_norm", "context_"), (source, SOURCE_SET, "source_key", "source_")):
        held = f"{prefix}{name}"
        if columns:
            found = _sets(history, lives, columns, name, prefix)
            answers = answers.join(found, (F.col(key) == F.col("_ck")) & (F.col(held) == F.col("_cp")), "left").drop("_ck", "_cp")
    return answers.select(*_unfolded(answers.columns, context, source))


def _context(answers: DataFrame, lives: Lives, context, source) -> DataFrame:
    """The chosen record of each answer with its context, its own geography if it is a small user, and
    the key it links to otherwise."""
    pick = lambda cols: [F.col(f"rec.{c}").alias(c) for c in cols]
    small = F.coalesce(F.col("rec.role") == "small_user", F.lit(False))
    key = geography_key("rec", "candidates")
    own = F.struct(F.col("rec.pc_norm").alias("pc_norm"), F.col("rec.introduced_on").alias("introduced_on"),
                   F.col("rec.is_current").alias("is_current"), *pick(source))
    return answers.withColumns({
        "ctx": F.struct(F.col("rec.pc_norm").alias("pc_norm"), *pick(context)),
        "geo": F.when(small & key.isNotNull(), own), "link_key": F.when(~small, key)})


def _linked_lives(history: DataFrame, lives: Lives, source) -> DataFrame:
    """The lives of every small-user key some large user links to, one row per key. A key's lives never
    overlap, so the list is bounded by the calendar."""
    wanted = (history.where(F.col(lives.role) == "large_user").select(normalised(lives.link).alias("_w"))
              .where(F.col("_w").isNotNull() & (F.col("_w") != "")).distinct())
    small = history.where((F.col(lives.role) == "small_user") & (F.col(lives.end).isNull() | (F.col(lives.start) < F.col(lives.end))))
    small = small.join(wanted, F.col(lives.key) == F.col("_w"), "left_semi")
    life = F.struct(F.col(lives.start).alias("s"), F.col(lives.end).alias("e"), F.struct(*_geo_fields(lives, source)).alias("geo"))
    return small.groupBy(F.col(lives.key).alias("link_key")).agg(F.collect_list(life).alias("target"))


def _geo_fields(lives: Lives, source) -> list:
    return [F.col(lives.key).alias("pc_norm"), F.col(lives.start).alias("introduced_on"),
            F.col(lives.current).alias("is_current"), *[F.col(c) for c in source]]


def _named(df: DataFrame, kept: list[str], context, source, rule) -> DataFrame:
    """The answer as flat output columns with its status, worked out once per answer and not per row."""
    at = F.col
    out = df.select(
        *kept, at("rec.pc_norm").alias("matched_pc_norm"), at("rec.pc_base").alias("matched_pc_base"),
        at("rec.introduced_on").alias("matched_introduced_on"), at("rec.deleted_on").alias("matched_deleted_on"),
        at("rec.is_current").alias("matched_is_current"), at("rec.role").alias("matched_user_type"),
        at("rec.link").alias("requested_link_postcode"), at("candidates").alias("matched_candidate_count"),
        at("geo.pc_norm").alias("source_key"), at("geo.introduced_on").alias("source_introduced_on"),
        at("geo.is_current").alias("source_is_current"),
        *[at(f"ctx.{c}").alias(f"context_{c}") for c in context],
        *[at(f"geo.{c}").alias(f"source_{c}") for c in source])
    return out.withColumn("postcode_status", rule())


def _follow_links(segments: DataFrame, targets: DataFrame) -> DataFrame:
    """Stretches answered by a large user, cut where the linked record's lives start and end, each
    piece with the linked record valid on it. A previous life's link is read on that life's last day."""
    joined = _joined_by_link(segments, targets)
    inside = lambda d: d.isNotNull() & (F.col("seg_from").isNull() | (d > F.col("seg_from"))) & (F.col("seg_to").isNull() | (d < F.col("seg_to")))
    days = F.array_union(F.transform("target", lambda x: x["s"]), F.transform("target", lambda x: x["e"]))
    cuts = F.when(~F.col("from_previous_life"), F.array_sort(F.filter(days, inside)))
    cuts = F.concat(F.array(F.col("seg_from")), F.coalesce(cuts, F.array().cast("array<date>")))
    pieces = joined.withColumn("_cuts", cuts).select("*", F.posexplode("_cuts").alias("_i", "_from"))
    day = F.when(F.col("from_previous_life"), F.date_sub(F.col("rec.deleted_on"), 1)).otherwise(F.col("_from"))
    hit = F.filter("target", lambda x: (x["s"] <= day) & (x["e"].isNull() | (day < x["e"])))
    until = F.coalesce(F.try_element_at("_cuts", F.col("_i") + 2), F.col("seg_to"))
    geo = F.when(F.col("link_key").isNull(), F.col("geo")).when(F.size(hit) > 0, hit[0]["geo"])
    return pieces.withColumns({"seg_to": until, "seg_from": F.col("_from"), "geo": geo}).drop("_cuts", "_i", "_from", "target")


def _joined_by_link(answers: DataFrame, targets: DataFrame) -> DataFrame:
    """Answers with the `target` of their link_key, if any. Answers without a link get a key of their own
    that no record has, so they are spread over the shuffle and not gathered under null."""
    spread = F.coalesce(F.col("link_key"), F.concat(F.lit("#"), F.coalesce(F.col("rec.pc_norm"), F.col("postcode_key"))))
    right = targets.select(F.col("link_key").alias("_lk"), "target")
    return answers.withColumn("_spread", spread).join(right, F.col("_spread") == F.col("_lk"), "left").drop("_spread", "_lk")


def _carried(history: DataFrame, lives: Lives, context, source) -> tuple[DataFrame, list, list, bool]:
    """The printed directory, the columns that travel as context and as source, and whether these are prints."""
    history = _printed(history, lives, context, source)
    wide = len(dict.fromkeys([*context, *source])) > NARROW
    return (history, [CONTEXT], [SOURCE_SET], True) if wide else (history, list(context), list(source), False)


def as_of_table(history: DataFrame, lives: Lives = Lives(), context=(), source=()) -> DataFrame:
    """The dated answer of every base: one row per stretch of days, links followed. It depends on the
    directory alone; a caller with many cohorts can write it once and reuse it."""
    printed, c, s, wide = _carried(history, lives, context, source)
    answers = _stretches(printed, lives, c, s)
    return _with_sets(answers, printed, lives, context, source) if wide else answers


def _stretches(history: DataFrame, lives: Lives, context, source) -> DataFrame:
    """Of a printed directory, with few columns."""
    record = life_record(lives, [*dict.fromkeys([*context, *source]), PRINT])
    segments = stretches(history, lives.base, part(lives.key, lives.base), lives.start, lives.end, record)
    segments = segments.select(F.col(lives.base).alias("postcode_key"), "seg_from", "seg_to", "n_marks",
                               F.col("first_start").alias("first_introduced_on"), F.col("previous_end").alias("previous_life_deleted_on"),
                               F.col("next_start").alias("next_life_introduced_on"), F.col("from_previous").alias("from_previous_life"),
                               *best_of_parts())
    segments = _context(segments, lives, context, source)
    kept = ["postcode_key", "seg_from", "seg_to", "n_marks", "first_introduced_on", "previous_life_deleted_on", "next_life_introduced_on", "from_previous_life"]
    return _named(_follow_links(segments, _linked_lives(history, lives, source)), kept, context, source, st.stretch_status)


def _sets_by_base(answers: DataFrame, history: DataFrame, lives: Lives, context, source) -> list[tuple[DataFrame, str]]:
    """What the prints of dated answers stand for, by the base that asks for it and the print. Every set of a base is a row, once."""
    found = []
    if context:
        mine = _sets(history, lives, context, CONTEXT, "context_", lives.base)
        found.append((mine.withColumnsRenamed({lives.base: "postcode_key", "_cp": f"context_{CONTEXT}"}).drop("_ck"), f"context_{CONTEXT}"))
    if source:
        held = f"source_{SOURCE_SET}"
        pairs = answers.where(F.col("source_key").isNotNull()).select("postcode_key", "source_key", held).distinct()
        theirs = pairs.join(_sets(history, lives, source, SOURCE_SET, "source_"), (F.col("source_key") == F.col("_ck")) & (F.col(held) == F.col("_cp")))
        found.append((theirs.drop("source_key", "_ck", "_cp"), held))
    return found


def link_as_of(cohort: DataFrame, history: DataFrame, postcode: str = "postcode", address_date: str = "address_date", *,
               lives: Lives = Lives(), context=(), source=(), strategy: str = "auto", answers: DataFrame | None = None) -> DataFrame:
    """The record valid on each row's date. strategy: auto counts the answers and broadcasts them if
    they are few; sorted answers every distinct (key, date) once and joins back; broadcast trusts the
    caller's own check. `answers` is a table kept from as_of_table."""
    asked = cohort.withColumn("postcode_key", request_key(postcode))
    if address_date != "address_date":
        asked = asked.withColumn("address_date", F.col(address_date))
    printed, c, s, wide = _carried(history, lives, context, source) if answers is None else (None, None, None, False)
    segments, small = answers if answers is not None else _stretches(printed, lives, c, s), strategy == "broadcast"
    if strategy == "auto":
        segments, small = broadcastable(segments)
    if wide and small:
        segments, small = _small_whole(segments, _with_sets(segments, printed, lives, context, source), strategy, broadcastable)
    sets = _sets_by_base(segments, printed, lives, context, source) if wide and not small else ()
    found = as_of_join(asked, segments, "postcode_key", "address_date", small=small, sets=sets)
    if wide:
        found = found.select(*_unfolded(found.columns, context, source))
    dated = lambda c: F.when(F.col("address_date").isNotNull(), F.col(c))
    return found.withColumns({
        "postcode_status": st.request_status(date="address_date"), "from_previous_life": F.coalesce("from_previous_life", F.lit(False)),
        "previous_life_deleted_on": dated("previous_life_deleted_on"), "next_life_introduced_on": dated("next_life_introduced_on")})


def latest_table(history: DataFrame, lives: Lives = Lives(), context=(), source=()) -> DataFrame:
    """The answer of every base from newest lives, links followed. One row per base."""
    printed, c, s, wide = _carried(history, lives, context, source)
    answers = _newest(printed, lives, c, s)
    return _with_sets(answers, printed, lives, context, source) if wide else answers


def _newest(history: DataFrame, lives: Lives, context, source) -> DataFrame:
    """Of a printed directory, with few columns."""
    carried = list(dict.fromkeys([*context, *source]))
    own = [lives.base, lives.end, lives.current, lives.role, lives.link, PRINT]
    newest = newest_lives(history, lives, carry=own + [c for c in carried if c not in (lives.key, lives.start, *own)])
    best = best_part(newest, [lives.base], lives, [*carried, PRINT], live_first=True)
    best = best.select(F.col(lives.base).alias("postcode_key"), F.col("found.candidates").alias("candidates"), F.col("found.rec").alias("rec"))
    best = _context(best, lives, context, source)
    targets = newest.where(F.col(lives.role) == "small_user").select(
        F.col(lives.key).alias("link_key"), F.struct(*_geo_fields(lives, source)).alias("target"))
    return _named(_with_target(best, targets), ["postcode_key"], context, source, st.latest_life_status)


def _with_target(answers: DataFrame, targets: DataFrame) -> DataFrame:
    """Answers that link elsewhere take the geography of the linked record."""
    joined = _joined_by_link(answers, targets)
    return joined.withColumn("geo", F.coalesce("geo", "target")).drop("target", "link_key")


def link_latest(cohort: DataFrame, history: DataFrame, postcode: str = "postcode", *, lives: Lives = Lives(),
                context=(), source=(), strategy: str = "auto", answers: DataFrame | None = None) -> DataFrame:
    """The newest life of every key, whatever the date."""
    if answers is not None:
        return _link_keyed(cohort, answers, postcode, strategy)
    printed, c, s, wide = _carried(history, lives, context, source)
    whole = (lambda table: _with_sets(table, printed, lives, context, source)) if wide else None
    return _link_keyed(cohort, _newest(printed, lives, c, s), postcode, strategy, whole)


def lookup_table(main: DataFrame, lives: Lives = Lives(), context=(), source=(), split_flag: str = "SplitIndicator") -> DataFrame:
    """The answer of every key of a whole-key lookup. A split small-user record also answers links to
    its key followed by A; links to B or C find nothing."""
    # A lookup of whole keys has no base column: every key is its own base.
    if lives.base not in main.columns:
        main = main.withColumn(lives.base, F.col(lives.key))
    context = list(dict.fromkeys([*context, split_flag]))
    geo = F.struct(*_geo_fields(lives, source))
    small = F.coalesce(F.col(lives.role) == "small_user", F.lit(False))
    address = F.col(lives.key)
    addresses = F.when(F.col(split_flag) == "Y", F.array(address, F.concat(address, F.lit("A")))).otherwise(F.array(address))
    targets = main.where(small).select(F.explode(addresses).alias("link_key"), geo.alias("target"))
    answers = main.select(
        F.col(lives.key).alias("postcode_key"), F.lit(1).cast("long").alias("candidates"), F.struct(*life_record(lives)).alias("rec"),
        F.struct(F.col(lives.key).alias("pc_norm"), *[F.col(c) for c in context]).alias("ctx"),
        F.when(small, geo).alias("geo"), F.when(~small, normalised(lives.link)).alias("link_key"))
    return _named(_with_target(answers, targets), ["postcode_key"], context, source, lambda: st.lookup_status(f"context_{split_flag}"))


def link_lookup(cohort: DataFrame, main: DataFrame, postcode: str = "postcode", *, lives: Lives = Lives(), context=(), source=(),
                split_flag: str = "SplitIndicator", strategy: str = "auto", answers: DataFrame | None = None) -> DataFrame:
    """Equality on the whole key of a latest-key lookup."""
    table = answers if answers is not None else lookup_table(main, lives, context, source, split_flag)
    return _link_keyed(cohort, table, postcode, strategy)


def _link_keyed(cohort, table, postcode, strategy, whole=None) -> DataFrame:
    """`whole` gives the table with what its prints stand for."""
    small = strategy == "broadcast"
    if strategy == "auto":
        table, small = measured(table)
    if whole is not None:
        table, small = _small_whole(table, whole(table), strategy, measured) if small else (table, False)
        table = table if small else whole(table)
    asked = cohort.withColumn("postcode_key", request_key(postcode))
    return lookup_join(asked, table, ["postcode_key"], small=small).withColumn("postcode_status", st.request_status())
