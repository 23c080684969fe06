"""Hard rows for the operators: nulls, empty and long texts, ties, repeats, clashing columns."""

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
LONG = " ".join(f"word{i % 977} and{i % 13}" for i in range(30_000))
ROWS = [
    (1, "The house of the people is near the river and the old bridge", "en", "b", 1),
    (2, "the HOUSE of the people is near the river and the old bridge ", "en", "a", 1),
    (3, None, None, None, None),
    (4, "", "en", "a", 0),
    (5, " \t\n\x0b\x0c\r ", None, "b", 3),
    (6, "Une maison est dans la forêt avec les arbres\nthe same line here\n  THE SAME LINE HERE \nshort", "fr", "a", 9),
    (7, "the same line here\nune autre ligne pour le texte", "fr", "é", 9),
    (8, LONG, "en", "b", len(LONG)),
    (9, "The house of the people is near the river and the old bridge", "en", "b", 1),
    (9, "The house of the people is near the river and the old bridge", "en", "b", 1),
    (None, "no id here but the same line here\nthe same line here", "en", None, 5),
    (10, "12345 !!! ???", None, "c", 3),
    (11, "日本語 ẞß <|endoftext|> İstanbul \U0001f600 a\u00a0b", None, "c", 3),
    (12, "x" * 5000, "en", "c", 5000),
]


def frame(spark, rows=ROWS, clash=()):
    from pyspark.sql import functions as F

    df = spark.createDataFrame(rows, SCHEMA)
    return df.withColumns({c: F.lit(f"own {c}") for c in clash}) if clash else df


def copies(n, hot):
    """n rows of which a share are copies of one text, in other spacing."""
    return [(i, f"hot text {'  ' * (i % 3)} of many rows" if i % hot == 0 else f"text number {i // 2} stands alone", "en", "s", 1) for i in range(n)]
