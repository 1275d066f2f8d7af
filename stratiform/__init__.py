"""Cohort curation and analytics on Spark DataFrames."""
