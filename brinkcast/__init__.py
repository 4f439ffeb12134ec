"""Spark-native forecasting and evaluation of escalations in labelled text streams."""

__version__ = "0.1.0"
