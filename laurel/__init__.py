"""laurel: award and performance analytics on event tables, written for Spark."""
