"""Millrace: Spark-native preparation of raw tables for analysis.

Profile, clean, deduplicate, enrich, join, summarise, load and check bounded
tables with DataFrame and SQL operators. Nothing here runs Python per row.
"""
