"""rankforge: weekly ranking, enrichment and attention analytics on Spark.

Three raw, append-only inputs (a weekly ranked list, a metadata catalogue with
JSON payloads, daily page-view counts) become a star schema and one wide weekly
scorecard. Every step is a DataFrame -> DataFrame function; Catalyst plans the
whole chain.

Sub-packages:

* ``functions`` - column expressions (null/blank rules, safe casts, JSON, keys)
* ``operators`` - reusable table operators (top-1 per key, bridges, calendars,
  trailing windows, disjunctive joins, reports, data-quality checks)
* ``sources``   - raw schemas, readers/writers, landing, CSV export, and
  stand-in raw tables derived from the TPC-H-like test tables
* ``plans``     - the staging -> intermediate -> marts model graph and the
  ordered build that materialises it
* ``streaming`` - incremental append landing with Structured Streaming
"""

from rankforge.session import get_session, checkpoint_dir  # noqa: F401

__all__ = ["get_session", "checkpoint_dir"]
