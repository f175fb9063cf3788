"""Small invented texts for the tests of this folder."""

import random
import re
from collections import Counter

VOCABULARY = [a + b for a in ("ka", "lo", "mi", "ren", "sta", "vo") for b in ("n", "ter", "ly", "sh", "d")]


def sentence(r: random.Random, words: int) -> str:
    return " ".join(r.choice(VOCABULARY) for _ in range(words))


def edited(r: random.Random, text: str, changes: int) -> str:
    words = text.split(" ")
    for _ in range(changes):
        words[r.randrange(len(words))] = r.choice(VOCABULARY) + "x"
    return " ".join(words)


def bag(text: str | None, size: int = 5) -> Counter:
    """Five-word shingles in lower case, with counts; of shorter texts the whole text."""
    words = re.findall(r"[0-9a-z\x80-\U0010ffff]+", (text or "").lower())
    if len(words) < size:
        return Counter([tuple(words)] if words else [])
    return Counter(tuple(words[i : i + size]) for i in range(len(words) - size + 1))


def jaccard(a: Counter, b: Counter) -> float:
    return sum((a & b).values()) / sum((a | b).values()) if a or b else 0.0
