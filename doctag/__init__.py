"""Tagging of titled documents on Spark."""
