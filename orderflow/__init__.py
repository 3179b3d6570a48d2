"""orderflow: sharded order ingestion and delivery tracking as Spark DataFrame operators.

Subpackages
-----------
functions   column expressions (routing hashes, codecs, id parsing)
sources     readers / writers (driver tables, message logs, ledger, acks, logs)
operators   DataFrame -> DataFrame operators (validate, joins, aggregates, windows, state)
streaming   Structured Streaming jobs built from the same operators
plans       the registered queries and their DuckDB oracle SQL
"""

__version__ = "0.1.0"
