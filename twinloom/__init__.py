"""Queries and streams over digital twins, their properties and their feeds, on Spark."""
