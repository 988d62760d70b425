"""Readers and writers: streams, files, dimension tables and sinks."""
