"""Texts for the tests of this folder."""

from __future__ import annotations

import random
import re

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def prose(rnd: random.Random, words: int) -> str:
    syllables = "ka to mi ren sol ba te lu or an is the ver du ne po ri".split()
    out = []
    for i in range(words):
        w = "".join(rnd.choice(syllables) for _ in range(rnd.randint(1, 3)))
        out.append(w + ("." if i % 9 == 8 else ""))
    return " ".join(out)


def near(rnd: random.Random, text: str, changes: int) -> str:
    words = text.split(" ")
    for _ in range(changes):
        words[rnd.randrange(len(words))] = f"x{rnd.randrange(10**6)}"
    return " ".join(words)
