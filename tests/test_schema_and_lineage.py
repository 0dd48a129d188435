from datetime import datetime

import pytest

from meterline.operators import lineage, schema

T0 = datetime(2024, 1, 1)
STEPS = ["one", "two", "three"]


def test_schema_table_and_gaps(spark):
    df = spark.createDataFrame([(1, None), (2, "x")], "a int, b string")
    table = schema.schema_table(df, {"a": "first"})
    assert [tuple(r) for r in table.orderBy("position").collect()] == [
        ("a", 1, "int", "first", 2), ("b", 2, "string", None, 1),
    ]
    assert [r.column_name for r in schema.dictionary_gaps(table, {"a": "first"}).collect()] == ["b"]
    both = schema.data_dictionary({"t": df, "u": df.select("a")})
    assert both.count() == 3


def test_overlap(spark):
    rows = [("y", 1, "a"), ("g", 1, "a"), ("y", 1, "b"), ("y", 2, "a")]
    df = spark.createDataFrame(rows, "kind string, month int, column_name string")
    overlap = schema.schema_overlap(df, by=["month"])
    assert {(r.month, r.column_name): (r.kinds, r.is_common) for r in overlap.collect()} == {
        (1, "a"): (["g", "y"], True), (1, "b"): (["y"], False), (2, "a"): (["y"], True),
    }
    counts = {r.month: (r.n_common, r.n_single, r.n_columns) for r in schema.overlap_counts(overlap, ["month"]).collect()}
    assert counts == {1: (1, 1, 2), 2: (1, 1, 1)}
    assert schema.schema_overlap(df.filter("month = 1")).filter("is_common").count() == 1


def test_drift(spark):
    old = schema.schema_table(spark.createDataFrame([(1, 2, 3)], "a int, b int, c int"))
    new = schema.schema_table(spark.createDataFrame([(1, 2, 3)], "a int, b bigint, d int"))
    changes = {r.column_name: r.change for r in schema.drift(old, new).collect()}
    assert changes == {"a": "unchanged", "b": "retyped", "c": "dropped", "d": "added"}


def test_facets(spark):
    facets = schema.dataset_facets(spark.createDataFrame([(1,)], "a int"), "t", {"a": "x"}, overwritten=True)
    row = facets.first()
    assert (row.dataset, row.lifecycle_change, row.description, row.n_values) == ("t", "OVERWRITE", "x", 1)


def outcomes(spark, *failed):
    rows = [
        (name, T0, T0, 10, 100, "two" if name in failed else None, "boom" if name in failed else None,
         "at two" if name in failed else None)
        for name in ("a", "b", "c")
    ]
    return spark.createDataFrame(rows, lineage.OUTCOMES)


def test_clean_run_has_all_events(spark):
    log = lineage.run_events(outcomes(spark), "etl", STEPS)
    assert log.count() == 2 + 3 * (2 + 2 * len(STEPS))
    assert log.select("run_id").distinct().count() == 1 + 3 * (1 + len(STEPS))
    assert lineage.invalid_transitions(log).count() == 0 and lineage.failures(log).count() == 0
    job = log.filter("parent_run_id IS NULL AND event_type = 'COMPLETE'").first()
    assert (job.row_count, job.size_bytes) == (30, 300)
    assert job.inputs[0]["namespace"] == "file"


@pytest.mark.parametrize("isolate,ending", [(True, "COMPLETE"), (False, "FAIL")])
def test_failures_reach_every_nested_run(spark, isolate, ending):
    log = lineage.run_events(outcomes(spark, "b"), "etl", STEPS, isolate=isolate)
    failed = [(r.job_namespace, r.job_name) for r in lineage.failures(log).collect()]
    assert ("step", "two") in failed and ("run_steps", "b") in failed
    assert log.filter("job_name = 'three'").count() == 4  # not reached for b
    assert log.filter("parent_run_id IS NULL").orderBy("seq").collect()[1].event_type == ending
    assert lineage.failures(log).filter("error_message = 'boom' AND stack_trace = 'at two'").count() == len(failed)


def test_invalid_transitions(spark):
    runs = {
        "ok": ["START", "RUNNING", "COMPLETE"],
        "no start": ["COMPLETE"],
        "closed": ["START", "FAIL", "RUNNING"],
        "twice": ["START", "START"],
        "odd": ["START", "PAUSED"],
    }
    rows = [(run, T0, i, state) for run, states in runs.items() for i, state in enumerate(states)]
    log = spark.createDataFrame(rows, "run_id string, event_time timestamp, seq bigint, event_type string")
    wrong = {(r.run_id, r.previous_state, r.event_type) for r in lineage.invalid_transitions(log).collect()}
    assert wrong == {
        ("no start", "OTHER", "COMPLETE"), ("closed", "FAIL", "RUNNING"), ("twice", "START", "START"),
        ("odd", "START", "PAUSED"),
    }


def test_run_tree(spark):
    log = lineage.run_events(outcomes(spark), "etl", STEPS)
    tree = lineage.run_tree(log)
    assert {r["depth"]: r["count"] for r in tree.groupBy("depth").count().collect()} == {0: 1, 1: 3, 2: 9}
    step = tree.filter("depth = 2 AND parent_name = 'a' AND job_name = 'one'").first()
    assert step.root_name == "etl"


def test_column_lineage(spark):
    raw = spark.createDataFrame([(1, 2, None)], "a_x int, b_x int, c int")
    edges = lineage.column_lineage(raw, {"a_x": "x", "b_x": "x"})
    assert {r.output_column: (r.input_columns, r.n_values) for r in edges.collect()} == {
        "x": (["a_x", "b_x"], 2), "c": (["c"], 0),
    }
