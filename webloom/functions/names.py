"""Names and texts in SQL."""

from __future__ import annotations

import re


def valid_name(name: str) -> bool:
    """A letter or ``_`` first, then letters, digits, ``_`` and dots, 128 at most."""
    return re.fullmatch(r"[A-Za-z_][A-Za-z0-9_.]{0,127}", name) is not None


def quote_name(name: str) -> str:
    """Each part of a dotted name in backticks. Parts that are quoted already, by backticks
    or double quotes, may hold dots."""
    parts = re.findall(r"`(?:[^`]|``)*`|\"(?:[^\"]|\"\")*\"|[^.`\"]+", name)
    if not parts or ".".join(parts) != name or "\0" in name:
        raise ValueError(f"not a name: {name[:80]!r}")
    plain = [p[1:-1].replace(p[0] * 2, p[0]) if p[0] in "`\"" else p for p in parts]
    return ".".join("`" + p.replace("`", "``") + "`" for p in plain)


def quote_text(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"
