"""Keyed dataflow operators over tables and streams, written as Spark DataFrame functions."""
