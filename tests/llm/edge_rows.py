"""Rows that every operator must bear."""

LONG = "word " * 4000 + "end of a very long text with some other words in it"
EDGE = [  # (doc_id, text): null, empty and blank texts, ties, repeated rows, a null id
    (1, None), (2, ""), (3, " \n\t "), (4, "a"), (5, "a"), (6, LONG), (7, LONG), (7, LONG), (8, "12 34 !!"),
    (9, "Ünïcode 🙂 text, it's fine — and it's fine."), (None, "a text without an id"), (11, "x" * 300),
]
