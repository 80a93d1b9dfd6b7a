"""The plans we want: pruned scans, pushed filters, chosen joins, no nested loops."""

import re

import pytest
from pyspark.sql import functions as F

from sparkweave.operators import joins as J
from sparkweave.plans import QUERIES
from sparkweave.session import new_folder
from sparkweave.sources import files, layout


def test_filters_merge_and_reach_the_scan(spark, sf, plan):
    text = plan(QUERIES["P03_chained_filters"](spark, sf))
    assert len(re.findall(r"\n?[ *(\d)+:-]*Filter ", text.split("== Initial Plan ==")[0])) == 1
    assert "GreaterThan(o_totalprice,100000.0)" in text and "EqualTo(o_orderstatus,F)" in text


def test_only_used_columns_are_read(spark, sf, plan):
    text = plan(QUERIES["A30_monthly_brand_revenue"](spark, sf))
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", text)
    assert any("l_quantity" in s for s in schemas) and not any("l_tax" in s or "p_name" in s or "o_totalprice" in s for s in schemas)


def test_partitions_are_pruned(spark, sf, plan):
    text = plan(QUERIES["S16_partition_pruning"](spark, sf))
    assert re.search(r"PartitionFilters: \[[^\]]*year#\d+ = 1998", text)


def test_top_n_is_limited_before_the_shuffle(spark, sf, plan):
    for name in ("W18_filter_on_window", "W19_top_n_per_group", "W22_latest_row_per_key", "T26_fixed_window_limit"):
        assert "WindowGroupLimit" in plan(QUERIES[name](spark, sf)), name


def test_top_k_sorts_no_table(spark, sf, plan):
    assert "TakeOrderedAndProject" in plan(QUERIES["O03_top_k"](spark, sf))


@pytest.mark.parametrize("name,node", [
    ("J29_broadcast_join", "BroadcastHashJoin"), ("J30_shuffled_hash_join", "ShuffledHashJoin"), ("J31_sort_merge_join", "SortMergeJoin"),
])
def test_join_choice(spark, sf, plan, name, node):
    assert node in plan(QUERIES[name](spark, sf))


def test_bucketed_tables_join_without_a_shuffle(spark, tables, plan):
    folder = new_folder(spark, "b")
    a = layout.bucketed(tables.orders.select("o_orderkey"), f"{folder}/a", ["o_orderkey"], 4)
    b = layout.bucketed(tables.lineitem.select("l_orderkey"), f"{folder}/b", ["l_orderkey"], 4)
    text = plan(a.join(b.hint("merge"), F.col("o_orderkey") == F.col("l_orderkey")))
    assert "SortMergeJoin" in text and "Exchange" not in text


def test_large_side_is_not_broadcast(spark):
    assert J.broadcast_checked(spark.range(100), limit=1000)._jdf.queryExecution().analyzed().toString().find("broadcast") < 0


def test_flagship_needs_no_expand(spark, sf, plan):
    """The distinct count of orders is a plain count over rows already grouped by order."""
    assert "Expand" not in plan(QUERIES["A30_monthly_brand_revenue"](spark, sf))


def test_compaction_reduces_files(spark):
    folder = new_folder(spark, "small")
    df = spark.range(1000)
    df.repartition(20).write.parquet(folder)
    out = layout.compact(spark, folder, df.schema, 2)
    assert out.count() == 1000 and out.select(F.input_file_name()).distinct().count() == 2
    assert files.file_sizes(spark, folder, "*.parquet").count() == 20
