"""Subscriber-retention features and models as Spark DataFrame jobs."""
