"""Spark-first curation engine: operators are functions from DataFrame to DataFrame."""
