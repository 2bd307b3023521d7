"""Document paths.

A path names a chain of object keys, written ``a.b.c``. A literal dot inside a
key is escaped as ``\\.``; every backslash is then dropped. A leading ``$``
step is ignored. Paths are static job parameters, so they are split once on
the driver while the plan is built; nothing here runs per row.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

_UNESCAPED_DOT = re.compile(r"(?<!\\)\.")


def parse_path(path: str | Sequence[str]) -> list[str]:
    """Split a dotted path into its key steps (a list passes through)."""
    if isinstance(path, str):
        steps = [part.replace("\\", "") for part in _UNESCAPED_DOT.split(path.strip())]
        if steps and steps[0] == "$":
            steps = steps[1:]
    else:
        steps = list(path)
    if not steps or any(not isinstance(s, str) or s == "" for s in steps):
        raise ValueError(f"invalid document path: {path!r}")
    return steps


def variant_path(key: str) -> str | None:
    """A ``variant_get`` path selecting one object key, or None if the key
    cannot be quoted (it holds both quote characters)."""
    if '"' not in key:
        return '$["' + key + '"]'
    if "'" not in key:
        return "$['" + key + "']"
    return None
