"""Small texts that the tests of this folder share."""

LONG = " ".join(f"w{i * 7919 % 1009}" for i in range(3000))
BASE = " ".join(f"base{i}" for i in range(60))
NEAR = " ".join(f"base{i}" if i != 59 else "other" for i in range(60))

#: Null, empty and long texts, copies, near copies, repeated rows, null ids.
TEXTS = [
    (1, BASE), (2, BASE), (3, NEAR), (4, None), (5, ""), (6, " \t\n"), (7, LONG), (8, LONG + " end"),
    (9, "two words"), (10, "two  WORDS"), (None, BASE), (12, "é漢字😀 ▁ mark"), (9, "two words"),
    (14, "mail a.b@c.example.com now"), (15, "a" * 5000), (16, "ab " * 700),
]

#: Names that the operators use inside, as further columns of the input.
EXTRA = ("row", "node", "seed", "found", "score", "spans", "terms", "_row", "_terms", "_spans", "_clean",
         "_gone", "_quality", "_found", "text_hash", "n_shingles", "list", "h", "piece_ids")


def documents(spark, rows, extra=True):
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    values = [(i, text, "en", "s", len(text or "")) for i, text in rows]
    if extra:
        schema += "".join(f", `{name}` string" for name in EXTRA)
        values = [value + tuple("x" for _ in EXTRA) for value in values]
    return spark.createDataFrame(values, schema)
