"""Linear referencing of point observations on Spark."""
