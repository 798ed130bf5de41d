"""Constants of the operator tests (a module of its own name: test folders may each have a ``conftest``)."""

from __future__ import annotations

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
