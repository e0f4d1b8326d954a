"""Small tables with the awkward cases: nulls, empty and long texts, ties, repeated rows, clashing column names."""

WORDS = "the quick brown fox jumps over a lazy dog while seven wise owls watch from an old oak tree in silence".split()
LONG = " ".join(WORDS[i % 20] + str(i * i % 97) for i in range(6000))
PASSAGE = " ".join(f"shared{i}" for i in range(20))
TEXTS = [
    (1, "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi " + PASSAGE),
    (2, "other words come first here " + PASSAGE + " and others last"),
    (3, None),
    (4, ""),
    (5, " \n\t "),
    (6, LONG),
    (7, LONG),
    (8, LONG + " changed"),
    (9, "Ünïcödé wörds ≠ ascii 日本語 テキスト ▁mark 𝒳 <|endoftext|> </s> <0x0A>"),
    (10, "one two"),
    (11, "ONE two"),
    (12, "x" * 4000),
    (13, "same line\nsame line\nother"),
    (13, "same line\nsame line\nother"),
    (None, "a row without an id " + PASSAGE),
    (None, None),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, label string, score string, part int, bucket int, fp string, hashes string, length string"


def documents(spark, texts=TEXTS):
    rows = [(d, t, "en", "s", None if t is None else len(t), "x", "y", 1, 2, "f", "h", "l") for d, t in texts]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
