"""Readers and writers: study files, Parquet marts, artifacts, shards."""
