"""Readers, codec, sinks and the testdata-derived fixtures."""
