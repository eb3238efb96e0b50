"""Medallion analytics for a car-parts data lake, written as Spark jobs."""
