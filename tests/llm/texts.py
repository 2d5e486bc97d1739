"""Documents with the cases that every operator must take."""

from __future__ import annotations

import random

WORDS = "the of and to in amber river stone lantern orchard copper meadow signal harbor velvet thunder pocket ribbon".split()


def prose(n: int, seed: int) -> str:
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) + r.choice(["", "", "", ".", ",", "\n"]) for _ in range(n))


def documents() -> list[tuple]:
    base, other = prose(160, 1), prose(120, 2)
    long_ = prose(60_000, 3)
    return [
        (1, base, "en", "a"),
        (2, base, "en", "a"),
        (3, base.replace("river", "rivers", 1), "en", "b"),
        (4, None, "en", "a"),
        (5, "", None, "a"),
        (6, "   \n\t ", "en", None),
        (7, other[:300] + base[:400], "en", None),
        (8, long_, "en", "b"),
        (8, long_, "en", "b"),
        (9, "ÀÉ naïve café – 東京 🎉 " * 12, "fr", "c"),
        (10, "x", "fr", "c"),
        (11, "a" * 3000, "en", "c"),
        (None, other, None, "a"),
        (12, other, "en", "a"),
        (13, "12 34!? " * 9, "en", "a"),
        (-5, other[:100], "en", "d"),
        (2**60, "two words", "en", "d"),
    ]
