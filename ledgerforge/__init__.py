"""Data-quality operators, layered tables and reports for transaction ledgers on Spark."""
