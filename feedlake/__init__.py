"""feedlake: feed snapshots to a current-state table and a keyed mirror, on Spark.

Layers, each usable on its own:

``functions``  Column expressions that clean one feed field.
``sources``    Readers and writers: XML feeds, versioned Parquet tables, CSV.
``operators``  DataFrame -> DataFrame steps: latest row, merge, fold, sync, checks.
``plans``      The two jobs built from them: feeds to silver, silver to mirror.
``streaming``  The same silver job driven by a file stream.
"""
