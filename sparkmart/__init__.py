"""Lakehouse modelling operators on Spark DataFrames: raw JSON documents to a star schema."""
