"""Texts that the tests of the training-data operators share."""

import random


def prose(seed, n, vocabulary=400):
    """``n`` words from a fixed vocabulary."""
    r = random.Random(seed)
    return " ".join(f"w{r.randrange(vocabulary)}" for _ in range(n))
