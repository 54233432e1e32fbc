"""A silver batch is computed once and held on disk, not cached: a cached partition is one block of an executor's memory."""

from __future__ import annotations

from pathlib import Path

import pytest
from pyspark.sql import DataFrame

from millrace.plans import adapter
from millrace.streaming import jobs, silver


@pytest.mark.parametrize("merge", [jobs.merge_batch, lambda f, i, root: silver.merge_batch(f, i, root, 4)], ids=["snapshot", "bucketed"])
def test_a_batch_is_held_on_disk(spark, tmp_path, monkeypatch, merge):
    def cached(self, *_):
        raise AssertionError("a batch was cached")

    for name in ("persist", "cache"):
        monkeypatch.setattr(DataFrame, name, cached)
    root = str(tmp_path / "silver")
    events = adapter.events(spark, "/root/testdata/sf0.001")
    frames = adapter.frames(events)
    done = merge(frames, 0, root)
    assert done["valid"] + done["rejected"] == frames.count() and done["new_edits"] > 0 and done["new_quarantine"] > 0
    again = merge(frames, 1, root)
    assert (again["new_edits"], again["new_quarantine"]) == (0, 0)
    assert not list(Path(root, "held").glob("*"))  # deleted with the batch
