"""tallymart: a retail commerce analytics library written as PySpark DataFrame jobs."""
