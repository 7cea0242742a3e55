"""Spark's patterns in Python."""

from __future__ import annotations

# What the short classes mean in Java's patterns.
SHORT = {"w": "A-Za-z0-9_", "d": "0-9", "s": r" \t\n\x0B\f\r"}


def ascii_classes(pattern: str) -> str:
    """The pattern with short classes written out, since Python's mean all of Unicode."""
    out, i, inside = [], 0, False
    while i < len(pattern):
        c = pattern[i]
        if c == "\\" and i + 1 < len(pattern):
            e = pattern[i + 1]
            if e in SHORT:
                out.append(SHORT[e] if inside else f"[{SHORT[e]}]")
            elif e.lower() in SHORT and not inside:
                out.append(f"[^{SHORT[e.lower()]}]")
            else:
                out.append(c + e)
            i += 2
            continue
        inside = c == "[" or inside and c != "]"
        out.append(c)
        i += 1
    return "".join(out)
