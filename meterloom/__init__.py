"""Interval-meter readings on Spark: plain functions from DataFrame to DataFrame."""

__version__ = "0.1.0"
