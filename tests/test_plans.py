"""No registered query may join by nested loop, or run Python row by row, in any of its steps."""

import pytest
from pyspark.sql.readwriter import DataFrameWriter

import oracle
from herald import registry
from plans import physical

STREAMED = [n for n in registry.QUERIES if n.startswith("stream_")]


@pytest.mark.parametrize("name", [n for n in registry.QUERIES if n not in STREAMED])
def test_plan(spark, name, monkeypatch):
    steps, write = [], DataFrameWriter.parquet

    def recorded(self, path, *args, **options):
        steps.append(physical(self._df))
        return write(self, path, *args, **options)

    monkeypatch.setattr(DataFrameWriter, "parquet", recorded)
    steps.append(physical(registry.QUERIES[name](spark, oracle.SF_DIR)))
    for text in steps:
        for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"):
            assert bad not in text, bad
