"""Constants of the study tests (a module of its own name: test folders may each have a ``conftest``)."""

from __future__ import annotations

import datetime as dt

SF_SMALL = "/root/testdata/sf0.001"
D = dt.date(2020, 1, 1)
D_DAY = (D - dt.date(1970, 1, 1)).days


def day(k: int) -> dt.date:
    """``d + k`` of the golden cases."""
    return D + dt.timedelta(days=k)
