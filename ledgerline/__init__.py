"""Reconciliation of transaction and vendor-payment feeds on Spark DataFrames."""
