"""starfold: a Spark-native sales ELT pipeline and reporting layer.

Raw sales drops (CSV files, or rows derived from the TPC-H-like driver
tables) are cleaned with built-in expressions, accepted or rejected one file
at a time, folded into a star schema with set-based keyed upserts, rolled up
by month, audited, and reported on.  Every step is an ordinary DataFrame
transformation so Catalyst and AQE plan the physical work.
"""

__all__ = ["session"]
