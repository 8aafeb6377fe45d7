"""JSON path handling for message extraction.

A configured ``path`` is relative to the message root (``a.b[0]`` means
``$.a.b[0]``).  A path that already starts with ``$`` or ``[`` is taken as
a full JSONPath, so keys containing dots can be addressed as
``$['k.d']``.
"""

from __future__ import annotations

import re

# A top-level key that needs no JSONPath syntax: no dot, bracket or
# wildcard.  Such keys are read from one shared ``from_json`` struct.
_PLAIN_KEY = re.compile(r"^[^.\[\]*]+$")


def full_path(path: str) -> str:
    """Return the JSONPath for a configured path."""
    path = path.strip()
    if path.startswith("$"):
        return path
    if path.startswith("["):
        return "$" + path
    return "$." + path


def plain_key(path: str) -> str | None:
    """The top-level key when ``path`` addresses one directly, else None."""
    p = path.strip()
    if p.startswith("$."):
        p = p[2:]
    elif p.startswith("$") or p.startswith("["):
        m = re.fullmatch(r"\$?\[['\"]([^'\"]+)['\"]\]", p)
        return m.group(1) if m else None
    if p and _PLAIN_KEY.match(p) and p == p.strip():
        return p
    return None
