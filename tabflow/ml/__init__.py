"""Small ML jobs on Spark MLlib (fit/transform/evaluate run as Spark jobs)."""
