"""Texts and schemas that several tests use."""

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long, row_id long, size string, label string, kept string, rest string"


def prose(seed: int, words: int, stem: str = "w") -> str:
    rng = random.Random(seed)
    return " ".join(f"{stem}{rng.randrange(400)}{rng.choice(['', ',', '.'])}" for _ in range(words))
