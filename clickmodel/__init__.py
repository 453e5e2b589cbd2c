"""clickmodel: Spark-native operators for modelling nested web-analytics event exports.

Every operator takes and returns a ``DataFrame`` (usable with ``df.transform``) and is
built from Spark's own column expressions, so Catalyst sees the whole plan.

Layout:
    functions/  column-level expressions (keys, URLs, params, dates, names)
    operators/  DataFrame -> DataFrame transforms (base, items, dedup, staging, sessions, ...)
    sources/    daily file scans, partition discovery, sinks, test-table adapter
    plans/      incremental date/file planning and the three batch jobs
    streaming/  file-stream form of the base job (incremental pickup of landed days)
"""

__version__ = "0.1.0"
