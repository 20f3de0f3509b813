"""Listing-price analytics as Spark DataFrame and Spark ML jobs."""
