"""Comparable daily tables from differently shaped feeds, on Spark."""
