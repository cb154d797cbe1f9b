"""Plans: what is read, what moves, where Python runs."""

from __future__ import annotations

from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from vitrine.operators import report
from vitrine.plans.catalog import QUERIES
from vitrine.session import shared_folder
from vitrine.sources import tables


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_scans_read_only_the_columns_they_need(spark, folder):
    text = plan(QUERIES["q_tier_counts"](spark, folder))
    scan = next(line for line in text.splitlines() if "lineitem.parquet" in line)
    for column in ("l_tax", "l_discount", "l_returnflag", "l_quantity"):
        assert column not in scan
    assert "p_name" not in text


def test_filters_reach_the_scan(spark, folder):
    lines = tables.table(spark, folder, "lineitem").where(F.col("l_extendedprice") > 100000)
    assert "PushedFilters: [IsNotNull(l_extendedprice), GreaterThan(l_extendedprice,100000.0)]" in plan(lines)


def test_market_means_move_no_listing(spark, folder):
    rows = QUERIES["q_opportunity"](spark, folder)
    text = plan(rows)
    assert "Window" not in text and "CartesianProduct" not in text
    assert "InMemoryTableScan" not in text and "BroadcastNestedLoopJoin" not in text


@pytest.mark.parametrize("name", ["q_silver", "q_gold", "q_bm25_topk", "q_boxplot", "q_column_profile"])
def test_no_python_and_no_cross_join(spark, folder, name):
    text = plan(QUERIES[name](spark, folder))
    for node in ("ArrowEvalPython", "BatchEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin", "MapInPandas"):
        assert node not in text


def test_topk_is_not_a_full_sort(spark, folder):
    assert "TakeOrderedAndProject" in plan(QUERIES["q_top_brands"](spark, folder))
    one = report.offers(QUERIES["q_location_map"](spark, folder).withColumn("preco", F.col("preco_medio"))
                        .withColumn("idade_veiculo", F.lit(1)), 2)
    assert "TakeOrderedAndProject" in plan(one)


@pytest.mark.parametrize("master", ["yarn", "local[4]"])
@pytest.mark.parametrize("shared", ["hdfs://shared/checkpoints", None])
def test_shared_folder_is_the_one_of_the_session(shared, master):
    used = []
    context = SimpleNamespace(master=master, setCheckpointDir=used.append, getCheckpointDir=lambda: used[-1] if used else None)
    session = SimpleNamespace(sparkContext=context, conf={"spark.checkpoint.dir": shared})
    if shared is None and master == "yarn":
        # A folder of one machine would lose what other machines write.
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            shared_folder(session)
        assert not used
        return
    folder = shared_folder(session)
    assert used == [folder] and folder == shared_folder(session) and (shared is None or folder == shared)
