"""Inputs: schemas, readers, and the view over the test tables."""
