"""comms_lake: a Spark-native pipeline for mailbox, calendar and
meeting-transcript records.

Every public operator is a lazy ``DataFrame -> DataFrame`` function built on
the DataFrame / SQL API; nothing pulls data to the driver.

Layout:
    sources/    readers for landed pages, logs, documents and the test tables
    functions/  column expressions (slugs, quoting, time, people, HTML, VTT)
    operators/  mail, calendar, meetings, digests, documents, operations
    plans/      the named query catalog and its DuckDB oracle SQL
    streaming/  incremental (AvailableNow) jobs with foreachBatch sinks
"""

__all__ = ["session"]
