"""punctua: event-reliability analytics expressed as PySpark jobs.

Layers, from the bottom up:

``functions``  column expressions (no Python UDFs)
``operators``  DataFrame -> DataFrame building blocks
``sources``    landing files, load ledger, seeds, exports, table publishing
``plans``      staging, the fact table, quality checks, reports, freshness
``stats``      intervals, clustered logistic regression, cluster bootstrap
``streaming``  incremental loads, upserts, alert throttling
``catalog``    the registered queries and their SQL counterparts
"""
