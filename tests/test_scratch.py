import pytest

from pyspark.sql import functions as F

from annalist.sources import scratch


def shuffle_files(spark):
    found = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {name for f in (found.apply(i) for i in range(found.size())) if (name := f.getName()).startswith("shuffle_")}


def test_shuffle_files_go_with_their_query(spark):
    before, setting = shuffle_files(spark), spark.conf.get(scratch._SHUFFLES)
    rows = scratch.materialize(spark.range(1000).groupBy(F.col("id") % 7).count(), "counted")
    assert rows.count() == 7
    spark.range(10).repartition(3, "id").write.format("noop").mode("overwrite").save()
    left = shuffle_files(spark) - before
    assert spark.conf.get(scratch._SHUFFLES) == setting
    with scratch.shuffles_removed(spark), scratch.shuffles_removed(spark):
        spark.range(1000).groupBy(F.col("id") % 7).count().write.format("noop").mode("overwrite").save()
    assert spark.conf.get(scratch._SHUFFLES) == setting
    # What is left is of the queries outside: a count, and a write that was not asked to remove any.
    assert len({n.split("_")[1] for n in left}) <= 2 and shuffle_files(spark) - before == left


def test_tables_of_a_scope_go_with_it(spark):
    outer = scratch.materialize(spark.range(3), "outer")
    with pytest.raises(RuntimeError, match="lost"):
        with scratch.passing(spark):
            kept = scratch.materialize(spark.range(4), "scope")
            with scratch.passing(spark):
                gone = scratch.materialize(spark.range(5), "inner")
            assert kept.count() == 4
            raise RuntimeError("lost")
    assert outer.count() == 3
    for df in (kept, gone):
        with pytest.raises(Exception, match="(?i)not.?exist"):
            df.count()
    made = scratch.settled(spark, lambda: scratch.materialize(spark.range(6), "way").where("id > 1"), "made")
    assert made.count() == 4 and not any("/way-" in p for p in scratch._written)
