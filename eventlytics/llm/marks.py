"""Control strings that texts can't forge."""

from __future__ import annotations

from itertools import product


def check_marks(marks: list[str], escape: str = "\\") -> None:
    """Raise unless the strings can be told apart wherever texts stand beside them.

    No string may be empty, hold ``escape`` or another one, or end with what another
    one (or itself) begins with: then no end of a text, followed by a mark, makes
    another mark, and marks in a text never overlap.
    """
    if len(set(marks)) < len(marks) or any(len(m) < 2 or escape in m for m in marks):
        raise ValueError(f"marks must differ, have two characters at least and hold no {escape}: {marks}")
    for a, b in product(marks, marks):
        if a != b and b in a or any(a[-n:] == b[:n] for n in range(1, min(len(a), len(b)))):
            raise ValueError(f"{a} and {b} overlap")
