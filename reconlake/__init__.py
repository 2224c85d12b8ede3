"""reconlake: move warehouse tables into a lake with Spark and prove that nothing was lost.

Sub-packages
------------
``functions``  column expressions (row hashes, date arithmetic, SQL text, status labels)
``sources``    JDBC, files, catalog tables, SQL script folders
``sinks``      Parquet folders and catalog tables
``operators``  DataFrame -> DataFrame building blocks, all lazy
``plans``      loads, exports and the script gate; the only place that triggers actions
``queries``    registry of named queries with their SQL oracles
"""
