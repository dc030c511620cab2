"""Tallymark: covenant analytics over a transaction ledger, expressed as Spark DataFrames."""
