"""Documents that an operator must survive: nulls, empty and long texts, repeats, clashing columns."""

LONG = " ".join(f"word{i % 977}x{i}" for i in range(60_000))
PLAIN = "the old house of the river and to the mill in that is for was with some other words that stand here " * 5

ROWS = [
    (1, PLAIN, "en"),
    (2, None, "en"),
    (None, PLAIN + " and more", None),
    (3, "", "xx"),
    (4, " \n\t ", "fr"),
    (5, LONG, "de"),
    (6, PLAIN, "en"),
    (6, PLAIN, "en"),
    (7, "É🙂 漢字 <|endoftext|> it's\x00\x1c odd\r\n", "es"),
    (8, "one two three", "en"),
]
#: Names that operators use for columns of their own.
CLASH = ["row", "ids", "node", "token", "at", "shard", "slot", "secrets", "kept", "words", "start", "n_words"]


def documents(spark, rows=ROWS):
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` string" for c in CLASH)
    full = [(*r, "s", len(r[1] or ""), *[None] * len(CLASH)) for r in rows]
    return spark.createDataFrame(full, schema).repartition(3)
