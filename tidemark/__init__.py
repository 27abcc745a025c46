"""Change-log analytics as Spark jobs: incremental loads, history, facts, marts, checks and metrics."""
