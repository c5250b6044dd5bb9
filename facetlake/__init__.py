"""Cube-sphere tile analytics and training-data operators on Spark DataFrames."""
