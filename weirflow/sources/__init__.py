"""Inputs: text lines, generated numbers, typed records."""
