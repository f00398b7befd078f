"""Corpus analytics, retrieval and curation expressed as Spark DataFrames."""
