"""Crop-observation analytics as Spark DataFrame jobs."""
