"""Lodestone: web-extraction ETL on DataFrames."""
