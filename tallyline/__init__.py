"""Change-data-capture ledger reconciliation on Spark DataFrames."""
