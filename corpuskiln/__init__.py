"""Spark jobs for preparing and auditing corpora of exercises on their way to formal source files."""
