"""Concept-graph and corpus-preparation engine built on Spark DataFrames."""
