"""End-to-end pipelines (flag pipeline, repair pipeline) and plan checks."""
