"""Readmission analytics over hospital-encounter tables, written as Spark jobs."""
