"""Helpers to look into executed plans."""

from __future__ import annotations


def plan_text(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def scan_metric(df, metric: str) -> int:
    """Sum of a metric over the file scans of a plan, in a run of its own."""
    fresh = df.select("*")  # a plan run twice reports listing metrics only once
    fresh.collect()
    total = 0
    waiting = [fresh._jdf.queryExecution().executedPlan()]
    while waiting:
        node = waiting.pop()
        if node.nodeName().startswith("Scan"):
            metrics = node.metrics().iterator()
            while metrics.hasNext():
                entry = metrics.next()
                total += entry._2().value() if entry._1() == metric else 0
        if node.nodeName() == "AdaptiveSparkPlan":
            waiting.append(node.executedPlan())
        if node.nodeName().endswith("QueryStage"):
            waiting.append(node.plan())
        children = node.children().iterator()
        while children.hasNext():
            waiting.append(children.next())
    return total


def parquet_writes(monkeypatch) -> list[tuple[str, int]]:
    """Plan and number of tasks of every Parquet write from now on, each taken as the write begins."""
    from pyspark.sql import DataFrameWriter

    seen, write = [], DataFrameWriter.parquet

    def parquet(self, path, *args, **options):
        seen.append((plan_text(self._df), self._df.rdd.getNumPartitions()))
        return write(self, path, *args, **options)

    monkeypatch.setattr(DataFrameWriter, "parquet", parquet)
    return seen
