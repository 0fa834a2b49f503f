"""Operators over DataFrames: harmonization, joins, statistics, retrieval, lineage, graph."""
