"""Plain versions of what operators compute, for small inputs."""

from __future__ import annotations

import re

WORD = re.compile(r"\S+")
SENTENCE = re.compile(r"[^\n]*?[.!?](?=\s|$)|[^\n]+")


def passage_units(text: str, min_words: int = 24, run: int = 50):
    """(start, stop, normalised words) of all lines and sentences of more than `min_words` words and all runs."""
    found = set()
    for pattern in (SENTENCE, re.compile(r"[^\n]+")):
        for m in pattern.finditer(text):
            raw = m.group()
            if len(raw.split()) > min_words:
                found.add((m.start() + len(raw) - len(raw.lstrip()), m.start() + len(raw.rstrip())))
    places = [m.span() for m in WORD.finditer(text)]
    found |= {(places[i][0], places[i + run - 1][1]) for i in range(len(places) - run + 1)}
    return [(a, b, " ".join(text[a:b].lower().split())) for a, b in sorted(found)]


def repeated_characters(texts: dict, **sizes) -> dict:
    """By document, the characters of units that occur earlier, by key and place."""
    first, out = set(), {}
    for k in sorted(texts):
        out[k] = set()
        for start, stop, words in passage_units(texts[k], **sizes):
            if words in first:
                out[k].update(range(start, stop))
            first.add(words)
    return out
