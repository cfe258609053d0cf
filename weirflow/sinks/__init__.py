"""Outputs: checkpointed text files, time buckets, routed outputs."""
