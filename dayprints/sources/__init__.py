"""Readers, writers and the datapoint view over the driver's tables."""
