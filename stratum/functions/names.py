"""Identifiers in Spark SQL text."""

from __future__ import annotations

import re

_PART = re.compile(r"`((?:[^`]|``)*)`|([^.`]+)")


def quote(name: str) -> str:
    """Back-quoted SQL identifier."""
    return "`" + str(name).replace("`", "``") + "`"


def name_parts(name: str) -> list[str]:
    """The plain parts of a dotted name; parts may be back-quoted."""
    return [q.replace("``", "`") if q else plain for q, plain in _PART.findall(name)]
