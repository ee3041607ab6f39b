import gzip

import pytest
from pyspark.sql import functions as F

from spanfeat import session
from spanfeat.sources import readers, writers


def test_parquet_directory_glob_and_schema(spark, tmp_path):
    for year in (2015, 2016):
        spark.range(year).write.parquet(str(tmp_path / f"{year}.parquet"))
    assert readers.load_table(spark, str(tmp_path / "201*.parquet")).count() == 4031
    assert readers.load_table(spark, str(tmp_path / "2015.parquet"), "id long").count() == 2015
    both = [str(tmp_path / f"{y}.parquet") for y in (2015, 2016)]
    assert readers.load_table(spark, both).count() == 4031


def test_gzipped_csv_is_all_text_by_default(spark, tmp_path, rows):
    path = tmp_path / "stations.csv.gz"
    with gzip.open(path, "wt") as f:
        f.write("usaf,wban,country,begin,end\n000001,00001,US,20100101,20190304\n")
    df = readers.load_csv(spark, str(path), spread=3)
    assert {t for _, t in df.dtypes} == {"string"} and df.rdd.getNumPartitions() == 3
    assert rows(df.select("usaf", "end")) == [("000001", "20190304")]
    typed = readers.load_csv(spark, str(path), "usaf string, wban string, country string, begin int, end int")
    assert typed.first()["begin"] == 20100101


def test_fixed_width_file(spark, tmp_path, rows):
    path = tmp_path / "stations.txt"
    path.write_text("! comment\n\nPA ALLENTOWN         KABE  ABE\nIL CHICAGO/O'HARE    KORD  ORD\n")
    layout = [("state", 1, 2, "string"), ("name", 4, 17, "string"), ("icao", 22, 4, "string"), ("iata", 28, 3, "string")]
    assert rows(readers.load_fixed_width(spark, str(path), layout)) == [
        ("IL", "CHICAGO/O'HARE", "KORD", "ORD"),
        ("PA", "ALLENTOWN", "KABE", "ABE"),
    ]


def test_stage_is_partitioned_and_spread(spark, tmp_path):
    df = spark.range(4000).select("id", (F.col("id") % 2 + 2017).cast("int").alias("YEAR"))
    out = writers.checkpoint_stage(df, str(tmp_path / "s"), ["YEAR"])
    assert out.count() == 4000 and sorted(out.columns) == ["YEAR", "id"]
    assert sorted(p.name for p in (tmp_path / "s").glob("YEAR=*")) == ["YEAR=2017", "YEAR=2018"]
    pruned = out.filter("YEAR = 2018")
    assert "PartitionFilters: [isnotnull(YEAR" in pruned._jdf.queryExecution().executedPlan().toString()
    assert sorted(r.id for r in pruned.collect()) == list(range(1, 4000, 2))


def test_published_table(spark):
    writers.publish_table(spark.range(7), "spanfeat_published")
    assert readers.head_of_table(spark.table("spanfeat_published"), ["id"], 3).count() == 3
    spark.sql("DROP TABLE spanfeat_published")


def test_view_query_with_named_arguments(spark, rows):
    out = readers.query_view(spark, {"nums": spark.range(10)}, "SELECT id FROM nums WHERE id > :low", low=7)
    assert rows(out) == [(8,), (9,)]


def test_report_files(spark, tmp_path, rows):
    table = spark.createDataFrame([("x", 0.75)], "feature string, importance double")
    writers.save_table(table, str(tmp_path / "imp"))
    assert rows(readers.load_csv(spark, str(tmp_path / "imp"), "feature string, importance double")) == [("x", 0.75)]


def test_settle_runs_a_summary_once(spark):
    runs = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            runs.add(1)
            yield batch

    kept = session.settle(spark.range(0, 10, 1, 1).mapInArrow(count, "id long").withColumn("x", F.col("id") * 2))
    assert kept.agg(F.sum("x")).first()[0] == 90 and kept.count() == 10 and runs.value == 1
    assert "BroadcastHashJoin" in spark.range(10**9).join(kept, "id")._jdf.queryExecution().executedPlan().toString()
    empty = session.settle(spark.range(0))
    assert empty.count() == 0 and "LocalTableScan" in empty._jdf.queryExecution().executedPlan().toString()


def test_checkpoint_folder_comes_from_the_session(spark):
    root = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    assert session.checkpoint_root(spark) == root
    assert session.cut_lineage(spark.range(5)).count() == 5


def test_scan_profile(spark, rows):
    out = readers.scan_profile({"a": spark.range(3), "b": spark.range(2).withColumn("x", F.lit(1))})
    assert rows(out) == [("a", 3, 1), ("b", 2, 2)]


@pytest.mark.parametrize("bad", ["nope"])
def test_unknown_table(spark, bad):
    with pytest.raises(Exception, match=bad):
        readers.head_of_table(spark.table(bad), ["id"], 1).count()
