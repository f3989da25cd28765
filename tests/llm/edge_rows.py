"""Rows that every operator must take: nulls, empty and very long texts, repeated rows, odd white space."""

EDGE = [
    (3, "The quick brown fox jumps over the lazy dog. " * 3, "en", "a"),
    (3, "The quick brown fox jumps over the lazy dog. " * 3, "en", "a"),
    (1, None, None, None),
    (None, "no id here, only words and more words", "en", "b"),
    (2, "", "fr", None),
    (7, " \t\n ", None, "b"),
    (5, "12 34 !!", "de", "b"),
    (6, "Été à la plage\x85où \x1c ÀÉ MIT License; Apache LICENSE", "fr", "c"),
    (9, "word " * 30_000 + "end", "en", "a"),
    (8, "Le chat est sur la table. Il dort!", "fr", "c"),
]
