"""Documents with the awkward rows every operator has to take, and small helpers."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size int, kept string, rep int, row string, label string"


def words(n, seed, letters="abcdefghij"):
    rng = random.Random(seed)
    return [" ".join("".join(rng.choice(letters) for _ in range(rng.randint(2, 7))) for _ in range(n))][0]


def awkward_rows():
    """Null id, text, language and source; empty and blank text; a very long one; ties; repeated rows."""
    long = words(30_000, 1)
    rows = [
        (1, None, "en", "a"),
        (2, "", "en", "a"),
        (3, " \n\t ", None, "a"),
        (4, long, "en", "b"),
        (5, words(120, 2), "en", None),
        (5, words(120, 2), "en", None),
        (6, words(120, 2), "fr", "b"),
        (None, words(80, 3), "fr", "b"),
        (None, None, None, None),
        (7, "short text", "fr", "a"),
        (8, words(90, 4), "fr", "é"),
        (9, words(90, 4) + " more", "en", "b"),
        (10, words(70, 5) + " ééé ñandú 漢字 𝒳", "en", "a"),
    ]
    return [(i, t, g, s, None if t is None else len(t), 1, "x", 2, "y", None) for i, t, g, s in rows]


def awkward(spark):
    return spark.createDataFrame(awkward_rows(), SCHEMA)


def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()
