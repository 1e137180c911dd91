"""Small tables with the awkward rows that every operator must take."""

import random

SF = "/root/testdata/sf0.001"

WORDS = "the quick brown fox jumps over a lazy dog while seven wise old owls watch from tall green trees near water".split()


def sentence(rng, n=9):
    words = [rng.choice(WORDS) + rng.choice(["", "s", "ed", "ing", "ly"]) for _ in range(n)]
    return " ".join(words).capitalize() + "."


def prose(seed, sentences=12):
    rng = random.Random(seed)
    return " ".join(sentence(rng) for _ in range(sentences))


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, component_id string, `row.x` int"


def awkward(spark):
    """Null id, null and empty texts, white space, repeated rows, a long text, clashing extra columns."""
    long_text = " ".join(prose(i, 10) for i in range(300))
    texts = [
        (1, prose(1), "en"), (1, prose(1), "en"), (2, prose(1), None), (3, None, "en"), (4, "", "en"),
        (5, " \t\n ", None), (None, prose(2), "en"), (None, None, None), (6, long_text, "en"), (7, "One", "de"),
        (8, "12 34 %%", "fr"), (9, "a\x00b � <|endoftext|> <|startoftext|> é", "fr"),
    ]
    rows = [(i, t, lang, None, None if t is None else len(t), 0.5, "x", 3) for i, t, lang in texts]
    return spark.createDataFrame(rows, SCHEMA)


def empty(spark, schema=SCHEMA):
    return spark.createDataFrame([], schema)
