"""rehome: migration reconciliation on Spark.

A source snapshot and a target snapshot of an analytics workspace go in as
DataFrames; plan tables (create / skip / rewire / archive / fail per object),
dead-letter tables and readiness metrics come out.  Everything is a lazy
DataFrame plan built from built-in Spark SQL functions.
"""

__version__ = "0.1.0"
