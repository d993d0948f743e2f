"""The panel's partitions follow the size of its input."""

import datetime

from tessera.sources import testdata_panel as tp


def test_panel_partitions_grow_with_the_input(spark, tmp_path, monkeypatch):
    day = datetime.date(1995, 3, 1)
    spark.createDataFrame([(i, i % 40, day, "1-URGENT") for i in range(200)],
                          "o_orderkey long, o_custkey long, o_orderdate date, o_orderpriority string").write.parquet(f"{tmp_path}/orders.parquet")
    spark.createDataFrame([(i, "A", float(i), "F", 0.05, 1) for i in range(200)],
                          "l_orderkey long, l_returnflag string, l_quantity double, l_linestatus string, l_discount double, l_linenumber int"
                          ).write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame([(i, f"c{i}", "BUILDING") for i in range(40)], "c_custkey long, c_name string, c_mktsegment string").write.parquet(
        f"{tmp_path}/customer.parquet")
    few = tp.season_panel(spark, str(tmp_path))
    assert few.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    monkeypatch.setattr(tp, "PARTITION_BYTES", 500)
    many = tp.season_panel(spark, str(tmp_path))
    assert many.rdd.getNumPartitions() == tp.panel_partitions(spark, str(tmp_path)) > 2 * spark.sparkContext.defaultParallelism
    assert sorted(map(tuple, few.collect())) == sorted(map(tuple, many.collect())) and few.count() == 40
