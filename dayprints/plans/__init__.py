"""Whole jobs: from stored datapoints and marks to stored indicators and marks."""
