"""Time series from dated report files, on Spark."""
