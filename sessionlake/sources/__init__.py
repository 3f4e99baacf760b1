"""Inputs and outputs: real session-file readers (``raw``), adapters that shape
the benchmark tables into provider-format lines (``adapters``), and sinks."""
