"""cuadra: governed monthly data marts on PySpark.

Every operator takes and returns DataFrames and is built from Spark SQL
expressions, joins and aggregations, so Catalyst plans the work.

Sub-packages:

* ``sources``    delimited and fixed-width text scans, header records, file templates
* ``functions``  column expressions (decimal-comma parsing, periods, typed casts)
* ``operators``  mapping, data-quality rules, joins, period analytics
* ``sinks``      partition replace, upsert, selective update, versions, change tracking
* ``plans``      the monthly pipelines and the fixture adapter
* ``streaming``  incremental ingest of a landing folder with the same operators
"""

from cuadra.session import get_session, shared_dir

__all__ = ["get_session", "shared_dir"]
