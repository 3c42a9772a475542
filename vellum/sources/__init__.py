"""Readers and writers: file listings, inventory tables, message tables and
the stand-in tables derived from the driver's test data."""
