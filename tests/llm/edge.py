"""Rows that every operator must take: nulls, empty and long texts, ties, repeated rows, odd column names."""

CLASHES = ["id", "t", "n", "h", "row", "key", "words", "spans", "base", "label", "x", "y", "fold", "host", "path", "listed", "kept", "score", "ids", "digest"]
LONG = " ".join(f"wort{i % 977} lang{i % 31}" for i in range(30_000))
ROWS = [
    (1, "The cat sat on the mat and looked at the dog, then it went home to sleep.", "en", "a", 70),
    (1, "The cat sat on the mat and looked at the dog, then it went home to sleep.", "en", "a", 70),
    (2, "The cat sat on the mat and looked at the dog, then it went home to sleep.", "en", None, 70),
    (3, None, None, None, None),
    (4, "", "de", "b", 0),
    (5, " \n\t ", None, "b", 4),
    (6, LONG, "de", "b", len(LONG)),
    (7, "x" * 50_000, "en", "c", 50_000),
    (None, "Der Hund lief über die Straße und sah die Katze im Garten des Nachbarn.", "de", "b", 70),
    (8, "#*$ %&| <> 123 !!! ...", "en", "a", 22),
    (9, "日本語 テキスト 𝔘𝔫𝔦 mail: jo@mail.example.com, +49 (030) 555-1234.", "xx", "a", 60),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, rows=ROWS, clashes=True):
    from pyspark.sql import functions as F
    df = spark.createDataFrame(rows, SCHEMA)
    return df.select("*", *(F.lit(c).alias(c) for c in CLASHES)) if clashes else df


def empty(spark):
    return documents(spark, [])
