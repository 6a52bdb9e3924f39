"""Physical-plan checks: pruning, broadcast only of bounded sides, one scan per query."""

from __spark_entry__ import queries
from tests.conftest import SF_SMALL


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_similarity_broadcasts_the_single_probe(spark):
    p = plan(queries()["similar_by_vector"](spark, SF_SMALL))
    assert "BroadcastNestedLoopJoin" in p and "BroadcastExchange" in p


def test_rmse_by_model_single_pruned_scan(spark):
    df = queries()["rmse_by_model"](spark, SF_SMALL)
    p = plan(df)
    assert p.count("FileScan parquet") == 1
    scan = [ln for ln in p.splitlines() if "FileScan parquet" in ln][0]
    assert "l_partkey" not in scan and "l_tax" not in scan


def test_filter_pushdown(spark):
    p = plan(queries()["filter_in"](spark, SF_SMALL))
    assert "PushedFilters: [In(o_orderpriority" in p


def test_tfidf_topk_vocabulary_is_broadcast(spark):
    p = plan(queries()["tfidf_weights"](spark, SF_SMALL))
    assert "BroadcastHashJoin" in p


def _single_partition_children(p: str) -> list[str]:
    lines = p.splitlines()
    out = []
    for i, ln in enumerate(lines):
        if "Exchange SinglePartition" in ln and i + 1 < len(lines):
            out.append(lines[i + 1].strip())
    return out


def test_single_partition_exchanges_only_over_bounded_inputs(spark):
    """Every SinglePartition exchange sits on a per-partition table (keyed by the partition
    id), a global aggregate (one row per task), or a window on a counted-small aggregate."""
    for name in ["sliding_windows", "tfidf_weights", "similar_by_vector", "sliced_metrics", "rmse_by_model",
                 "stratified_split", "auroc_exact"]:
        p = plan(queries()[name](spark, SF_SMALL))
        for child in _single_partition_children(p):
            bounded = ("_lm_pid" in child or "keys=[]" in child or "InMemoryTableScan" in child
                       or "HashAggregate(keys=[_s" in child)
            assert bounded, f"{name}: unbounded single-partition input: {child[:160]}"
