"""Inputs (form folders, derived study tables) and outputs (Parquet / text / dated tables)."""

from visitline.sources import fixtures, forms, sinks

__all__ = ["fixtures", "forms", "sinks"]
