"""Filings, market and document analytics for Apache Spark."""
