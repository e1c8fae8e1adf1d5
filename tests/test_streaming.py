"""The dated linkage on a stream while the directory changes, against the same linkage in batch."""

import pytest
from pyspark.sql import functions as F, types as T

from areadep.plans import standin as t
from areadep.plans.linkage import as_of_table, link_as_of
from areadep.streaming.dated import changes_of, gone, link_dated_stream

COLUMNS = ["id", "postcode_status", "matched_pc_norm", "matched_introduced_on", "source_key", "source_zone", "from_previous_life", "first_introduced_on",
           "previous_life_deleted_on", "next_life_introduced_on"]


def key_of(rows):
    return sorted(tuple(str(v) for v in r) for r in rows)


@pytest.fixture
def rocks(spark):
    name = "spark.sql.streaming.stateStore.providerClass"
    spark.conf.set(name, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    yield
    spark.conf.unset(name)


def test_the_directory_changes_between_batches(spark, sf, tmp_path, rocks):
    lives = t.lives(spark, sf).persist()
    cohort = t.cohort(spark, sf)
    first, second = cohort.where("id % 2 = 0"), cohort.where("id % 2 = 1")
    # Later: a tenth of the keys get no open life, one key in seventeen is gone.
    number = F.xxhash64("pc_base")
    later = lives.where(F.pmod(number, F.lit(17)) != 0).withColumn("deleted_on", F.when(F.pmod(number, F.lit(10)) == 3, F.coalesce("deleted_on", F.lit("1998-09-01").cast("date"))).otherwise(F.col("deleted_on")))
    later = later.where("deleted_on is null or introduced_on <= deleted_on").withColumn("is_current", F.col("deleted_on").isNull())
    tables = [as_of_table(x, t.TEST_LIVES, source=["zone"]) for x in (lives, later)]
    changes = [changes_of(x, v) for v, x in enumerate(tables, 1)]
    lost = lives.select(F.col("pc_base").alias("postcode_key")).distinct().join(later.select(F.col("pc_base").alias("postcode_key")).distinct(), "postcode_key", "left_anti")
    answer = T.StructType([f for f in tables[0].schema.fields if f.name not in ("postcode_key", "seg_from", "seg_to", "n_marks")])

    def run(k, requests, told):
        requests.write.mode("append").parquet(f"{tmp_path}/asked")
        told.write.mode("append").parquet(f"{tmp_path}/told")
        out = link_dated_stream(spark.readStream.schema(cohort.schema).parquet(f"{tmp_path}/asked"), spark.readStream.schema(told.schema).parquet(f"{tmp_path}/told"), answer)
        q = out.select(*COLUMNS).writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/ck").trigger(availableNow=True).start()
        q.awaitTermination(240)
        return spark.read.parquet(f"{tmp_path}/out").where(f"id % 2 = {k}")

    got = run(0, first, changes[0])
    assert key_of(got.collect()) == key_of(link_as_of(first, lives, lives=t.TEST_LIVES, source=["zone"]).select(*COLUMNS).collect())
    # What comes again of the old version is passed over.
    again = changes[0].where(F.pmod(F.xxhash64("postcode_key"), F.lit(5)) == 0)
    got = run(1, second, changes[1].unionByName(gone(lost, 2)).unionByName(again))
    want = link_as_of(second, later, lives=t.TEST_LIVES, source=["zone"]).select(*COLUMNS).collect()
    assert key_of(got.collect()) == key_of(want)
    assert key_of(want) != key_of(link_as_of(second, lives, lives=t.TEST_LIVES, source=["zone"]).select(*COLUMNS).collect())
