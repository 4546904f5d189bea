"""airdata: airline operations analytics as distributed Spark jobs.

Layout
------
- ``sources``   table readers, airline views derived from the driver tables,
                raw-file readers and writers
- ``functions`` pure column expressions (cleaning, banding, formatting)
- ``operators`` DataFrame -> DataFrame operators (keys, maintenance,
                validation, quality, analytics, graph)
- ``plans``     the query catalogue wired to tables, plus DuckDB oracle SQL
- ``streaming`` incremental ingest with Structured Streaming
"""

from airdata.session import get_session, checkpoint_dir

__all__ = ["get_session", "checkpoint_dir"]
