"""Spans of a text as ``kind:start:end``, in code points, end exclusive."""

from __future__ import annotations

Span = tuple[int, int, str]  # start, end, kind


def joined(spans: list[Span], kinds: tuple[str, ...]) -> str:
    """Spans by start, those of one start in the order of ``kinds``, joined by commas."""
    order = {k: i for i, k in enumerate(kinds)}
    ranked = sorted(spans, key=lambda s: (s[0], order[s[2]], s[1]))
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in ranked)
