"""Invented words for the fixtures."""

SYLLABLES = "ka lo mi ren tas vol zu per nid osk ulm fra gen hid".split()


def prose(rng, n):
    """n invented words."""
    return " ".join("".join(rng.choices(SYLLABLES, k=rng.randint(1, 3))) for _ in range(n))
