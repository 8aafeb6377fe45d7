"""Internal column names that no column of the caller's can have."""

from __future__ import annotations

from collections.abc import Iterable


def free_prefix(taken: Iterable[str], stem: str = "__sw") -> str:
    """A prefix with which none of the names ``taken`` starts (in any case);
    the same for the same names, so a restarted stream has the same plan."""
    names = [t.lower() for t in taken]
    while any(n.startswith(stem) for n in names):
        stem = f"_{stem}"
    return f"{stem}_"
