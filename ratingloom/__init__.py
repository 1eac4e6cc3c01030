"""Ratings, keyed series and linked views as Spark DataFrame operators."""
