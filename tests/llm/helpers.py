"""Small documents with the awkward cases every operator must bear."""

import random

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon".split()
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def prose(rng: random.Random, n: int) -> str:
    return " ".join(rng.choice(WORDS) + str(rng.randrange(50)) for _ in range(n))


def edited(rng: random.Random, text: str, times: int) -> str:
    words = text.split(" ")
    for _ in range(times):
        words[rng.randrange(len(words))] = "edit" + str(rng.randrange(10**6))
    return " ".join(words)


def awkward(seed: int = 1, n: int = 60) -> list[tuple]:
    """Copies, near copies, repeated rows, nulls in every column, blanks, one very long text."""
    rng = random.Random(seed)
    base = [prose(rng, rng.randrange(1, 120)) for _ in range(n)]
    rows = [(i, t, rng.choice(["en", "de", None]), rng.choice(["a", "b", "é", None, "a"]), len(t)) for i, t in enumerate(base)]
    for k in range(n // 2):
        text = base[k]
        rows.append((n + k, edited(rng, text, rng.randrange(0, 6)), "en", "a", len(text)))
    rows += [(1000, None, "en", "a", None), (1001, "", None, None, 0), (1002, " \t\n\x0b\x0c\r ", "en", "b", 7), (1003, "one TWO", "en", "b", 7), (1004, "one two", "en", "b", 7)]
    rows += [(1005, base[0].upper(), "en", "a", 1), (1005, base[0].upper(), "en", "a", 1), (None, base[1], "en", "a", 1), (1006, "ünï code wörd 😀 " * 30, "fr", "é", 1)]
    rows.append((1007, prose(rng, 30_000), "en", "long", 1))
    return rows
