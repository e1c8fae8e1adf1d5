"""Lives of a key turned into consecutive stretches of days with one answer each.

Between two neighbouring days on which any life of a key starts or ends nothing changes, so what is
valid on such a stretch, or failing that what ended last before it, is worked out once, from the life
table alone. A dated question is then an as-of join to a table with at most one matching row,
whatever the number of lives, dates or questions.

One shuffle by key and one ordered pass. A key's lives are bounded by the calendar: its parts are a
fixed few, and lives of one part never overlap. The pass counts the open lives of every part and
stops the job if two are open at once, so a table that breaks the rule can never be answered wrongly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..session import spread
from .skew import BROADCAST_BYTES, heavy_keys, key_counts, lookup_join, row_bytes

PARTS = ("", "A", "B", "C")
MAX_CHAIN = 512      # stretches per key beyond which a broadcast probe is not used


def stretches(lives: DataFrame, key: str, part: Column, start: str, end: str, record: list) -> DataFrame:
    """Per key: seg_from, seg_to, first_start, previous_end, next_start, from_previous, n_marks and
    part0..part3, the record of each of PARTS valid throughout the stretch or, where no part has
    one, the records that ended last (from_previous).
    The stretch before the first life has no seg_from and stands for a missing date as well."""
    known = F.when(part.isin(*PARTS), part).otherwise(F.raise_error(F.lit("a key has a part other than A, B or C")))
    rows = lives.where(F.col(key).isNotNull()).select(
        key, F.col(start).alias("_s"), F.col(end).alias("_e"), known.alias("_part"), F.struct(*record).alias("_rec"))
    real = F.col("_e").isNull() | (F.col("_s") < F.col("_e"))
    mark = lambda at, opens: F.struct(at.alias("at"), F.lit(opens).alias("opens"), real.alias("real"))
    events = (spread(rows, key).select(key, "_part", "_rec", F.inline(F.array(mark(F.col("_s"), True), mark(F.col("_e"), False))))
              .where(F.col("at").isNotNull()))

    # What lies ahead is worked out first, while a row holds one record: the state holds up to eight and is never sorted.
    backwards = W.partitionBy(key).orderBy(F.col("at").desc())
    events = events.select("*", F.dense_rank().over(backwards).alias("_ahead"),
                           F.last(F.when(F.col("opens"), F.col("at")), ignorenulls=True)
                           .over(backwards.rangeBetween(W.unboundedPreceding, W.currentRow)).alias("_opening"))
    ordered = W.partitionBy(key).orderBy("at")
    so_far = ordered.rangeBetween(W.unboundedPreceding, W.currentRow)     # every event of the day counts
    last_if = lambda test, value: F.last(F.when(test, value), ignorenulls=True).over(so_far)
    opens, closes, is_real = F.col("opens"), ~F.col("opens"), F.col("real")
    state = {"first_start": F.first("at").over(so_far), "previous_end": last_if(closes, F.col("at")),
             "last_real_end": last_if(closes & is_real, F.col("at"))}
    for i, p in enumerate(PARTS):
        mine = is_real & (F.col("_part") == p)
        state[f"open{i}"] = F.sum(F.when(mine & opens, 1).when(mine, -1).otherwise(0)).over(so_far)
        state[f"began{i}"] = last_if(mine & opens, F.col("_rec"))
        state[f"ended{i}"] = last_if(mine & closes, F.struct(F.col("at").alias("at"), F.col("_rec").alias("rec")))
    # One row a day: every event of a day carries the same state, so the last one speaks for all.
    following = W.partitionBy(key).orderBy("at")
    days = events.select(key, "at", "_ahead", "_opening", *[v.alias(k) for k, v in state.items()], F.lead("at").over(following).alias("seg_to"))
    days = days.where(F.col("seg_to").isNull() | (F.col("seg_to") > F.col("at")))
    days = days.withColumns({"idx": F.row_number().over(following), "next_start": F.lead("_opening").over(following)})
    days = days.withColumn("n_marks", F.col("idx") + F.col("_ahead") - 1)

    n = range(len(PARTS))
    crowded, anyone = F.greatest(*[f"open{i}" for i in n]) > 1, F.greatest(*[f"open{i}" for i in n]) > 0
    from_previous = ~anyone & F.col("last_real_end").isNotNull()
    chosen = lambda i: (F.when(F.col(f"open{i}") > 0, F.col(f"began{i}"))
                        .when(~anyone & (F.col(f"ended{i}.at") == F.col("last_real_end")), F.col(f"ended{i}.rec")))
    guard = F.when(crowded, F.raise_error(F.lit("lives of one key overlap"))).otherwise(from_previous)
    out = days.select(key, F.col("at").alias("seg_from"), "seg_to", "first_start", "previous_end", "next_start",
                      guard.cast("boolean").alias("from_previous"), "n_marks", "idx", *[chosen(i).alias(f"part{i}") for i in n])
    # The first mark of a key also gives the stretch before it.
    span = ["seg_from", "seg_to", "first_start", "previous_end", "next_start", "from_previous", "n_marks", *[f"part{i}" for i in n]]
    no_day = F.lit(None).cast("date")
    earlier = {"seg_from": no_day, "seg_to": F.col("seg_from"), "previous_end": no_day, "next_start": F.col("first_start"),
               "from_previous": F.lit(False), **{f"part{i}": F.when(F.lit(False), F.col(f"part{i}")) for i in n}}
    this = F.struct(*span)
    before = F.struct(*[earlier.get(c, F.col(c)).alias(c) for c in span])
    return out.select(key, F.inline(F.when(F.col("idx") == 1, F.array(before, this)).otherwise(F.array(this))))


def within(day: Column, seg_from: Column, seg_to: Column) -> Column:
    """A day inside a stretch; no day belongs to the stretch without a start only."""
    return ((day.isNull() & seg_from.isNull())
            | (day.isNotNull() & (seg_from.isNull() | (seg_from <= day)) & (seg_to.isNull() | (day < seg_to))))


def passed(rows: DataFrame, segments: DataFrame, key: str, date: str, as_: str = "_seg") -> DataFrame:
    """Each of `rows` with the stretch of its key its date falls in, by one ordered pass per key. The key is that of the pass, so that Spark knows where rows lie."""
    value = F.struct(*[F.col(c) for c in segments.columns if c != key])
    steps = segments.select(F.col(key).alias("_k"), F.col("seg_from").alias("_at"), F.lit(0).alias("_kind"), value.alias("_seg"))
    asks = rows.select(F.col(key).alias("_k"), F.col(date).alias("_at"), F.lit(1).alias("_kind"), F.struct(*rows.columns).alias("_row"))
    order = W.partitionBy("_k").orderBy(F.col("_at").asc_nulls_first(), "_kind").rowsBetween(W.unboundedPreceding, W.currentRow)
    latest = steps.unionByName(asks, allowMissingColumns=True).withColumn("_seg", F.last("_seg", ignorenulls=True).over(order)).where(F.col("_kind") == 1)
    inside = within(F.col("_at"), F.col("_seg.seg_from"), F.col("_seg.seg_to"))
    return latest.select(*[F.col("_k" if c == key else f"_row.{c}").alias(c) for c in rows.columns], F.when(inside, F.col("_seg")).alias(as_))


def beside(rows: DataFrame, table: DataFrame, key: str, name: str) -> DataFrame:
    """Rows that lie by `key`, with the one row of `table` for their key and `name`, a number. Only the key is an equality to Spark, so that
    rows stay where they are; a key has few names."""
    values = [c for c in table.columns if c not in (key, name)]
    right = table.select(F.col(key).alias("_bk"), F.col(name).alias("_bn"), *values)
    same = (F.col(key) == F.col("_bk")) & (F.col(name).bitwiseXOR(F.col("_bn")) == 0)
    return rows.join(right, same, "left").select(*rows.columns, *values)


SPAN = ("seg_from", "seg_to", "n_marks")


def as_of_join(left: DataFrame, segments: DataFrame, key: str, date: str, *, small: bool = False, sets=()) -> DataFrame:
    """Each row of `left` with the columns of the stretch of its key its date falls in.

    `small` says the stretches were counted and may be broadcast: nothing of `left` moves then. Otherwise rows meet the stretches in
    one ordered pass per key. Of keys that hold more than 1/HEAVY of the rows, every distinct date is answered once and joined back.
    `sets`, of (table, column), have what a number in a column of the stretches stands for, by key and number: joined last, to rows
    that then lie by key already."""
    values = [c for c in segments.columns if c != key and c not in SPAN]
    if small:
        right = segments.select(F.col(key).alias("_k"), "seg_from", "seg_to", *values)
        cond = (left[key] == right["_k"]) & within(left[date], right["seg_from"], right["seg_to"])
        return left.join(F.broadcast(right), cond, "left").select(*[left[c] for c in left.columns], *values)
    # Collected, fewer than HEAVY of them, so that the rows are counted once. Rows without a key meet no stretch and are spread like heavy ones.
    counts = key_counts(left, [key]).persist()
    heavy = [r[0] for r in heavy_keys(counts, [key]).collect() if r[0] is not None]
    counts.unpersist()
    of_heavy = F.coalesce(F.col(key).isin(heavy), F.lit(True))
    few, many = left.where(of_heavy), left.where(~of_heavy)
    asked = key_counts(few, [key, date]).persist()      # the days of fewer than HEAVY keys, read several times
    theirs = segments.where(F.col(key).isin(heavy))
    answered = passed(asked, theirs, key, date)         # holds the distinct days of a key, so it is bounded by the calendar
    flat = lambda rows: rows.select(*left.columns, *[F.col(f"_seg.{c}").alias(c) for c in values])
    met, apart = flat(passed(many, segments, key, date)), flat(lookup_join(few, answered.drop("n_rows"), [key, date], counts=asked))
    if sets:
        names = [name for _, name in sets]
        held = theirs.select(key, *names).distinct()
        for table, name in sets:
            met, held = beside(met, table, key, name), held.join(table, [key, name], "left")
        counts = answered.groupBy(key, *[F.col(f"_seg.{n}").alias(n) for n in names]).agg(F.sum("n_rows").alias("n_rows"))
        apart = lookup_join(apart, held, [key, *names], counts=counts)
    return met.unionByName(apart)


def broadcastable(segments: DataFrame) -> tuple[DataFrame, bool]:
    """The stretches, kept for reuse, and whether they were measured small enough to broadcast and to
    probe. One job, one row."""
    kept = segments.persist()
    size = kept.agg(F.coalesce(F.sum(row_bytes(kept.schema)), F.lit(0)).alias("bytes"), F.coalesce(F.max("n_marks"), F.lit(0)).alias("chain")).first()
    return kept, size["bytes"] <= BROADCAST_BYTES and size["chain"] <= MAX_CHAIN
