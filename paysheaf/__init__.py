"""paysheaf: Spark-native payroll, roster and player-statistics analytics.

Subpackages
-----------
functions  Column -> Column cleaners and lookups (money, names, codes, clubs, keys).
sources    Readers for the given tables, record files, documents and captured pages,
           plus the fixture adapters that derive payroll-shaped data from the given tables.
operators  DataFrame -> DataFrame jobs: header detection, salary ETL, rosters, stats,
           analytics and data-quality reports.
sinks      CSV / Parquet / table writers and parameterised SQL.
plans      The query catalog (Spark query + DuckDB oracle text per key).
streaming  Notes on using the row-local operators on streaming frames.
"""

__version__ = "0.1.0"
