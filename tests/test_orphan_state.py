"""The orphan state survives failing batches, repeated batches, restarts and merging."""

import datetime as dt

import pytest

from seedloom.operators import orphans
from seedloom.operators.orphans import PendingOrphans, parent_rows, periodic_counts, referring_rows


def t(month):
    return dt.datetime(2024, month, 5)


@pytest.fixture
def rows(spark):
    def refs(*ids):
        return referring_rows(spark.createDataFrame([(f"r-{i}-{m}", t(m), i) for i, m in ids], "id string, received_at timestamp_ntz, f string"), "t", {"f": "p"})

    def ups(*ids):
        return parent_rows(spark.createDataFrame([(i, t(m), None) for i, m in ids], "id string, received_at timestamp_ntz, deleted_at timestamp_ntz"), "p")

    return refs, ups


def reasons(state, **options):
    return {r.id: r.reason for r in state.open_references(**options).collect()}


def test_a_failed_batch_is_applied_again(spark, rows, tmp_path, monkeypatch):
    refs, ups = rows
    state = PendingOrphans(spark, f"file://{tmp_path}/s").apply(refs(("a", 1), ("b", 1)), ups(("c", 1)))
    for step in ("written", "write_text"):  # before the tables of the batch are whole, and just before its commit
        with monkeypatch.context() as m:
            m.setattr(orphans, step, lambda *a, **k: 1 / 0)
            with pytest.raises(ZeroDivisionError):
                state.apply(refs(("c", 2), ("d", 2)), ups(("a", 2)))
        assert reasons(state) == {"r-a-1": "missing", "r-b-1": "missing"} and state.number == 0
    state.apply(refs(("c", 2), ("d", 2)), ups(("a", 2)))
    assert reasons(state) == {"r-a-1": "late", "r-b-1": "missing", "r-d-2": "missing"}


def test_a_batch_counts_once_and_survives_a_restart(spark, rows, tmp_path):
    refs, ups = rows
    folder = f"file://{tmp_path}/s"
    PendingOrphans(spark, folder).apply(refs(("a", 1)), ups(("c", 1)), number=7)
    state = PendingOrphans(spark, folder)
    assert state.number == 7 and reasons(state) == {"r-a-1": "missing"}
    state.apply(refs(("x", 1)), ups(("a", 1)), number=7)  # was applied already
    assert reasons(state) == {"r-a-1": "missing"}
    PendingOrphans(spark, folder).apply(refs(("c", 2), ("d", 3)), ups(("a", 2)), number=8)
    assert reasons(PendingOrphans(spark, folder)) == {"r-a-1": "late", "r-d-3": "missing"}


def test_merging_changes_nothing(spark, rows, tmp_path, monkeypatch):
    refs, ups = rows
    monkeypatch.setattr(orphans, "MERGED", 2)
    gone = spark.createDataFrame([("p", "p1", t(6))], "target string, ref_id string, deleted_at timestamp_ntz")
    states = {}
    for name, merged in (("many", 2), ("one", 1000)):
        monkeypatch.setattr(orphans, "MERGED", merged)
        state = PendingOrphans(spark, f"file://{tmp_path}/{name}")
        for k in range(5):
            state.apply(refs((f"p{k}", k + 1), (f"p{k + 1}", k + 1), ("never", k + 1)), ups((f"p{k}", k + 1)), gone if k == 3 else None)
        states[name] = reasons(PendingOrphans(spark, f"file://{tmp_path}/{name}"))
        assert len(state._parts["met"]) == (2 if merged == 2 else 5)
    assert states["many"] == states["one"]
    assert states["one"]["r-p1-1"] == "deleted" and states["one"]["r-p2-2"] == "late" and states["one"]["r-p5-5"] == "missing" and states["one"]["r-never-1"] == "missing" and "r-p3-4" not in states["one"]


def test_counts_as_they_stood(spark, rows):
    refs, _ = rows
    parents = parent_rows(spark.createDataFrame([("a", t(3), t(5)), ("a", t(4), None), ("b", t(1), None)], "id string, received_at timestamp_ntz, deleted_at timestamp_ntz"), "p")
    found = periodic_counts(refs(("a", 1), ("a", 3), ("b", 2), ("c", 4)), parents, [t(2), t(4), t(6)])
    got = sorted((r.as_of, r.period, r.reason, r.open_references) for r in found.collect())
    assert got == [
        ("2024-02-05", "2024-01", "missing", 1), ("2024-04-05", "2024-01", "late", 1), ("2024-06-05", "2024-01", "deleted", 1), ("2024-06-05", "2024-03", "deleted", 1), ("2024-06-05", "2024-04", "missing", 1),
    ]
    with pytest.raises(ValueError):
        periodic_counts(refs(("a", 1)), parents, [])


def test_commits_are_never_replaced(spark, rows, tmp_path):
    refs, ups = rows
    folder = f"file://{tmp_path}/s"
    first, second = PendingOrphans(spark, folder), PendingOrphans(spark, folder)
    first.apply(refs(("a", 1)), ups(("c", 1)))
    with pytest.raises(FileExistsError):  # a second writer
        second.apply(refs(("b", 1)), ups(("c", 1)))
    assert reasons(PendingOrphans(spark, folder)) == {"r-a-1": "missing"}
