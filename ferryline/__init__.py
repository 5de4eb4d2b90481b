"""Batch movement, keyed updates, archiving and retry bookkeeping as Spark DataFrame operators."""
