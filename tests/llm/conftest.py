import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
SYLLABLES = "an be ca do en fi go hu in jo ka lu mi no or pa qu re sa to un vi wo xe yo zu".split()


@pytest.fixture(scope="session")
def prose():
    """Invented sentences: ``prose(seed, words)``."""

    def make(seed, words):
        rng = random.Random(seed)
        return " ".join("".join(rng.choices(SYLLABLES, k=rng.randint(1, 4))) for _ in range(words))

    return make


@pytest.fixture(scope="session")
def documents(spark):
    """Rows of ``documents`` from texts or (doc_id, text) pairs; ``extra`` adds clashing columns."""

    def make(texts, lang="en", source="s", extra=()):
        pairs = [p if isinstance(p, tuple) else (i, p) for i, p in enumerate(texts)]
        rows = [(i, t, lang, source, None if t is None else len(t)) for i, t in pairs]
        df = spark.createDataFrame(rows, SCHEMA).repartition(3)
        for name in extra:
            df = df.selectExpr("*", f"'x' AS `{name}`")
        return df

    return make


# Texts that every operator has to take: null, empty, white space, one word, long, repeated.
@pytest.fixture(scope="session")
def odd_texts(prose):
    long = prose(99, 30_000)
    return [None, "", "  \n\t ", "x", "\x0bÉté\x0c ß", "a" * 70_000, long, long, "w " * 500, "\n\n\n", "é́ ￿ 😀" * 40]
