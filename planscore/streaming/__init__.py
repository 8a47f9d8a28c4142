"""Incremental maintenance of program actuals with Structured Streaming."""
