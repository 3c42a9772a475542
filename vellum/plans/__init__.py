"""Whole jobs (scan, convert, classify, reduce, upload) and the registered
query catalogue over the driver's test tables."""
