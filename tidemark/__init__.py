"""Timeline analytics on Spark: interval, sequence, text and signal operators as DataFrame functions."""
