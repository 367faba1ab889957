"""Physical-plan guards: no cartesian products or nested-loop joins, no Python
evaluation, pruned scans and map-side aggregation where the plan should have them."""

import contextlib
import io

import pytest

import __spark_entry__ as ent
from tarmac.plans.catalog import QUERIES

SMOKE = "/root/testdata/sf0.001"
# Queries that fit forests or run streams eagerly are covered by their own tests.
EAGER = {"accuracy", "response_json", "response_rows", "response_stream", "request_stream", "forest_train",
         "forest_score", "artifact_roundtrip", "artifact_listing", "score_union", "stream_score",
         "stream_resume"}
FORBIDDEN = ["CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
             "PythonUDF", "FlatMapGroupsInPandas"]


def plan_of(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - EAGER))
def test_no_pairwise_or_python_operators(spark, name):
    plan = plan_of(QUERIES[name](spark, SMOKE))
    for bad in FORBIDDEN:
        assert bad not in plan, (name, bad)


def test_flagship_prunes_and_aggregates_map_side(spark):
    plan = plan_of(ent.entry(spark))
    line_schema = [ln for ln in plan.splitlines() if "ReadSchema: struct<l_orderkey" in ln][0]
    for unused in ("l_discount", "l_tax", "l_linestatus", "l_extendedprice", "l_returnflag"):
        assert unused not in line_schema
    assert "partial_count" in plan and "partial_avg" in plan


def test_flight_view_broadcasts_only_the_nation_dimension_explicitly(spark):
    from tarmac.plans import inputs
    plan = plan_of(inputs.flights(spark, SMOKE))
    assert "PushedFilters: [IsNotNull(n_nationkey)]" in plan


def test_queries_without_distance_read_no_flights(spark, monkeypatch):
    from tarmac.plans import catalog, inputs

    def refuse(*_):
        raise AssertionError("the distance dimension is not needed here")
    monkeypatch.setattr(inputs, "distance_dimension", refuse)
    for name in ("date_features", "request_defaults", "valid_requests", "requested_models", "score_scope_row",
                 "score_scope_batch", "request_stamp"):
        plan = catalog.QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
        assert "lineitem" not in plan, name


def test_cluster_without_shared_folder_is_refused():
    import pytest

    from tarmac import session

    class Context:
        master = "spark://host:7077"

        def getConf(self):
            return {}

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()
        conf = {}

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.checkpoint_root(Session())


def test_table_scores_meet_the_fitted_ones_without_a_join_of_all_rows(spark):
    plan = plan_of(QUERIES["forest_table_score"](spark, SMOKE))
    assert "Union" not in plan and "SortMergeJoin" not in plan
    # Rows are dealt to blocks as they are; scoring by block moves neither vectors nor fitted results.
    assert plan.count("hashpartitioning(block#") == 1 and "__block#" not in "".join(
        ln for ln in plan.splitlines() if "hashpartitioning" in ln)


def shuffle_files(spark) -> set[str]:
    blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {n for n in (blocks.apply(i).getName() for i in range(blocks.length())) if n.startswith("shuffle_")}


def test_stored_frames_leave_no_shuffle_files(spark):
    import time

    from tarmac.session import SHUFFLE_CLEANUP
    from tarmac.sources.tables import stored
    before, was = shuffle_files(spark), spark.conf.get(SHUFFLE_CLEANUP, None)
    out = stored(spark.range(1_000).repartition(5, "id"), "test-shuffle")
    assert spark.conf.get(SHUFFLE_CLEANUP, None) == was
    end = time.time() + 20                                                # files are removed in the background
    while time.time() < end and any(f.endswith(".data") for f in shuffle_files(spark) - before):
        time.sleep(0.2)
    assert not any(f.endswith(".data") for f in shuffle_files(spark) - before)
    assert out.count() == 1_000
