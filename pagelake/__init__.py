"""Spark jobs that turn tables of collected web pages into clean record tables."""

__version__ = "0.1.0"
