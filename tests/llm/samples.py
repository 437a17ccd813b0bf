"""Made-up documents for the tests."""

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
SYLLABLES = ["ba", "de", "ki", "lo", "mu", "ra", "se", "tu", "vo", "ze"]


def prose(rng, n):
    return [rng.choice(SYLLABLES) + rng.choice(SYLLABLES) + rng.choice(SYLLABLES) for _ in range(n)]


def corpus(seed=1, n=60):
    """Plain, copied, nearly copied, empty, null, blank, short and one very long text."""
    rng = random.Random(seed)
    texts = []
    for i in range(n):
        words = prose(rng, rng.randrange(1, 140))
        text = "".join(w + rng.choice([" ", " ", " ", "\n", "  "]) for w in words)
        if i % 4 == 0:
            text += "\nShared Footer line \t"
        texts.append(text)
        if i % 7 == 0:
            texts.append(text)
        if i % 5 == 0 and len(words) > 60:
            changed = list(words)
            changed[len(words) // 2] = "other"
            texts.append(" ".join(changed))
    texts += ["", None, " \n\t ", "Héllo wörld", "one", " ".join(prose(rng, 6000)), "a\n\na\n", "shared FOOTER line"]
    rows = [
        (i, t, rng.choice(["en", "de", None]), rng.choice(["s1", "s1", "s2", None]), None if t is None else len(t))
        for i, t in enumerate(texts)
    ]
    return rows
