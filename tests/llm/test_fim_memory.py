"""Moving texts takes a bounded multiple of a small batch of bytes, and a worker keeps none of it."""

from __future__ import annotations

import tracemalloc

import pyarrow as pa

from reviewlake.llm import fim


class _Frame:
    """Stands in for a table: keeps the function that mapInArrow is given."""

    def select(self, *columns):
        return self

    def mapInArrow(self, run, schema):  # noqa: N802
        self.run = run
        return self


def test_a_task_holds_little(spark, monkeypatch):
    given = []
    monkeypatch.setattr(fim, "give_back", lambda: given.append(True), raising=False)
    texts = [b"some words, and more of them " * 40] * 4000
    draws = [pa.array([7 * i % 1000 for i in range(4000)], pa.int64())] * 4
    batch = pa.RecordBatch.from_arrays([pa.array(range(4000)), pa.array(texts), *draws], names=list("abcdef"))
    run = fim.transform(_Frame()).run
    tracemalloc.start()
    rows = sum(made.num_rows for made in run(iter([batch])))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert rows == 4000 and given == [True]
    assert peak < 24 << 20
