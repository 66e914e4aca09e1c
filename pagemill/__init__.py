"""pagemill: page text in, instruction-tuning rows out, as Spark DataFrame jobs."""
