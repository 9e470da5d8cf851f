"""runlens: pipeline event-log analytics as plain Spark DataFrame jobs.

Layers (each a set of pure DataFrame -> DataFrame functions):

* ``sources``   – find event-log tables, read them, align their schemas and
                  stack them into one consolidated table; sinks and views.
* ``functions`` – column expressions shared by the operators.
* ``operators`` – enrichment, per-run folding and every derived table.
* ``plans``     – the refresh plan (materialise runs once, derive the rest)
                  and the registry of named queries with their SQL oracles.
* ``streaming`` – mergeable run state, incremental refresh and a
                  Structured Streaming driver built on it.
"""

from runlens.config import Config

__all__ = ["Config"]
