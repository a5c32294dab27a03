"""Whole queries: the catalogue on the driver tables and the stage graph."""
