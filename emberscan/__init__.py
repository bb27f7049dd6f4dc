"""Spark-native batch and stream analytics over satellite hotspot detections."""

__version__ = "0.1.0"
