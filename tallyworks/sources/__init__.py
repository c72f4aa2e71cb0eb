"""Readers and writers for attribute rows, delimited text, file corpora and binned outputs."""
