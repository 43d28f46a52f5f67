"""Relational, graph, text, vector and physics operators over Spark DataFrames for food-science knowledge data."""
