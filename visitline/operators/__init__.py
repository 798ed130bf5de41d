"""The user-level operators: plain ``DataFrame -> DataFrame`` functions for ``df.transform``."""

from visitline.operators import ages, conflicts, flags, repair, stack

__all__ = ["ages", "conflicts", "flags", "repair", "stack"]
