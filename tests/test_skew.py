"""One player holds a third of all appearances: plans must split or reduce that player's rows."""

import contextlib

import pytest
from pyspark.sql import functions as F

import league
from touchline.plans import marts, staging
from touchline.sources.registry import struct_type

ROWS = 60_000


@pytest.fixture(scope="module")
def inputs(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("skew"))

    def stored(table, df):
        df.write.parquet(f"{root}/{table}")
        return spark.read.parquet(f"{root}/{table}")

    def typed(table, rows, **columns):
        fields = struct_type([f for f in league.REGISTRY[table] if f["name"] != "ingestion_timestamp"])
        default = {"string": F.lit("0.5"), "boolean": F.lit(False)}
        return rows.select(
            *[
                columns.get(f.name, default.get(f.dataType.simpleString(), F.lit(0)))
                .cast(f.dataType)
                .alias(f.name)
                for f in fields
            ]
        )

    i = F.col("id")
    noise = F.abs(F.xxhash64("id"))
    appearances = typed(
        "element_summary",
        spark.range(ROWS),
        element=F.when(i % 3 == 0, 1).otherwise(i % 5000),
        fixture=i,
        round=i % 38,
        opponent_team=i % 20,
        kickoff_time=F.lit("2025-09-01T12:00:00Z"),
        minutes=noise % 91,
        total_points=noise % 15,
        bps=noise % 10**12,
        selected=noise % 10**12,
    )
    players = typed("players", spark.range(5000), id=i, team=i % 20, web_name=F.hex(noise))
    teams = typed("teams", spark.range(20), id=i, name=F.concat(F.lit("T"), i))
    return (
        staging.stg_element_summary(stored("element_summary", appearances)),
        staging.stg_players(stored("players", players)),
        staging.stg_teams(stored("teams", teams)),
    )


@contextlib.contextmanager
def settings(spark, **values):
    names = {f"spark.sql.{k.replace('__', '.')}": v for k, v in values.items()}
    for name, value in names.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name in names:
            spark.conf.unset(name)


def executed(df):
    """Row count and the plan as it ran."""
    counted = df.agg(F.count(F.lit(1)), F.max(F.hash(*df.columns)))
    rows = counted.collect()[0][0]
    return rows, counted._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]


def test_fact_join_is_split(spark, inputs):
    with settings(
        spark,
        autoBroadcastJoinThreshold="10KB",
        adaptive__autoBroadcastJoinThreshold="10KB",
        adaptive__advisoryPartitionSizeInBytes="64KB",
        adaptive__skewJoin__skewedPartitionThresholdInBytes="128KB",
        adaptive__skewJoin__skewedPartitionFactor="1.5",
    ):
        rows, plan = executed(marts.fct_player_gameweek(*inputs))
    assert rows == ROWS
    assert "SortMergeJoin(skew=true)" in plan


def test_small_dimensions_are_broadcast_by_size(spark, inputs):
    _, plan = executed(marts.fct_player_gameweek(*inputs))
    assert "SortMergeJoin" not in plan and plan.count("BroadcastHashJoin") >= 3


def shuffled_rows(spark, df):
    """Most rows any one shuffle of ``df`` wrote, from the metrics of the executed plan."""
    df.collect()
    nodes = [df._jdf.queryExecution().executedPlan()]
    most = 0
    while nodes:
        node = nodes.pop()
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            nodes.append(node.executedPlan())
            continue
        if name.endswith("QueryStage"):
            nodes.append(node.plan())
            continue
        if name == "Exchange":
            most = max(most, node.metrics().apply("shuffleRecordsWritten").value())
        children = node.children()
        nodes.extend(children.apply(i) for i in range(children.size()))
    return most


def test_reductions_shuffle_little(spark, inputs):
    appearances = inputs[0].coalesce(2)
    groups = 5000
    assert 0 < shuffled_rows(spark, marts.season_totals(appearances)) <= 2 * groups
    one_player = appearances.where("player_id = 1")
    assert one_player.count() >= ROWS / 3
    assert 0 < shuffled_rows(spark, marts.recent_form(one_player)) <= 2 * marts.FORM_ROWS
