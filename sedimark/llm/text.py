"""Small helpers on single texts."""

from __future__ import annotations

from collections.abc import Iterator

_STEP = 1 << 20


def stretches(text: str, step: int = _STEP) -> Iterator[str]:
    """The whole text in consecutive parts, cut only at a space or line break, so words stay whole."""
    start = 0
    while len(text) - start > step:
        ends = [e for e in (text.find(" ", start + step), text.find("\n", start + step)) if e >= 0]
        if not ends:
            break
        yield text[start : min(ends) + 1]
        start = min(ends) + 1
    if start < len(text):
        yield text[start:]


class Numbers(dict):
    """Numbers units in the order in which they are met."""

    def __init__(self) -> None:
        self.names: list[str] = []

    def __missing__(self, unit: str) -> int:
        number = self[unit] = len(self.names)
        self.names.append(unit)
        return number
