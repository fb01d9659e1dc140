"""veloframe: trip analytics as Spark DataFrame operators.

Every operator takes DataFrames (or Columns) and returns DataFrames (or
Columns). Work is expressed with native Spark SQL expressions and
``pyspark.ml`` estimators so that Catalyst can prune, push down and
code-generate the whole plan; no operator pulls data to the driver.

Sub-packages:

* ``functions``  – Column -> Column helpers (safe casts, day of week, flags).
* ``sources``    – schemas, delimited-text ingest, catalog sinks, fixture views.
* ``operators``  – relational, feature, encoding and learning operators.
* ``plans``      – composed jobs and the query catalog.
* ``streaming``  – the same ingest on a file-stream source.
"""

from veloframe.session import build_session, ensure_checkpoint_dir, shared_folder

__all__ = ["build_session", "ensure_checkpoint_dir", "shared_folder"]
