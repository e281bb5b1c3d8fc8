"""A node with most of the edges is split over tasks by the joins of components()."""

import pytest

from lamella.llm import common

SETTINGS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.files.maxPartitionBytes": "256k",
    "spark.sql.shuffle.partitions": "16",
}


def _most_read(spark, first):
    """The most shuffled rows that a task has read in the stages from number first on."""
    store, most, stage = spark.sparkContext._jsc.sc().statusStore(), 0, first
    missing = 0
    while missing < 50:  # numbers of stages that were skipped are not kept
        tasks = store.taskList(stage, 0, 10_000)
        missing = 0 if tasks.size() else missing + 1
        for i in range(tasks.size()):
            metrics = tasks.apply(i).taskMetrics()
            if metrics.isDefined():
                most = max(most, metrics.get().shuffleReadMetrics().recordsRead())
        stage += 1
    return most


@pytest.fixture
def tight(spark):
    before = {k: spark.conf.get(k, None) for k in SETTINGS}
    for k, v in SETTINGS.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_a_hub_is_no_single_task(spark, tight):
    members = 120_000
    edges = spark.range(1, members + 1).selectExpr("id as u", "0L as v").repartition(16)
    tracker = spark.sparkContext.statusTracker()
    spark.range(1).count()
    first = max(s for j in tracker.getJobIdsForGroup(None) if (job := tracker.getJobInfo(j)) for s in job.stageIds) + 1
    found = common.components(edges)
    assert found.where("root <> 0").isEmpty() and found.count() >= members
    # A third of what meets at the hub, at most: it would be all of it in one task.
    assert 1000 < _most_read(spark, first) < members / 3
