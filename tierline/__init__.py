"""tierline: layered (raw -> validated -> analytics) data processing on Spark.

Every operator is a plain ``DataFrame -> DataFrame`` function built on the
DataFrame / SQL / Structured Streaming APIs.  Sub-packages:

* ``sources``    batch readers, landing reads with bad-row handling, high-watermarks
* ``sinks``      table writers, schema evolution, CSV export, audit rows
* ``operators``  cleansing, quality rules, dedup, ranking, upsert/diff, layout, monitoring
* ``functions``  Column-expression helpers (money sums, safe ratios, rules, bit interleave)
* ``plans``      composed data products and layer jobs, plus the query registry
* ``streaming``  Structured Streaming forms of ingest, dedup, alerts and upsert
"""

__version__ = "0.1.0"
