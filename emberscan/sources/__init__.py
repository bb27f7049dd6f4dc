"""Readers and writers: files, date-partitioned lake, databases, boundaries."""
