"""Rows that every corpus operator has to stand: nulls, empty and long texts, ties, repeated rows, clashing columns."""

AWKWARD = [
    (1, "Alpha beta gamma\nSame line here\nalpha", "en"),
    (2, "Alpha beta gamma\n same LINE here \r\nomega", None),
    (3, None, "de"),
    (4, "", None),
    (5, " \t\n\x0b ", "fr"),
    (None, "a text without an id\nSame line here", "en"),
    (6, "Ünïcode ÄÖ ß words 日本語 \U0001f600 x\u0000y", "de"),
    (7, "word " * 30_000, "en"),
    (8, "Alpha beta gamma\nSame line here\nalpha", "en"),
    (8, "Alpha beta gamma\nSame line here\nalpha", "en"),
    (9, "x", "es"),
]
SCHEMA = "doc_id bigint, text string, lang string, fp string, pos int, score double, component_id string, w string, n_words int"


def awkward(spark, rows=None):
    """The rows, with columns whose names clash with those that operators use inside."""
    return spark.createDataFrame([(*r, "clash", 7, 0.5, "c", "w", 3) for r in (AWKWARD if rows is None else rows)], SCHEMA)
