"""pointstream: time-series recovery and delivery on Spark."""
