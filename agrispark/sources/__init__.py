"""Readers and writers of observation, sample, legend and split files."""
