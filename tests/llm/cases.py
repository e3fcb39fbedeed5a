"""Texts with edge cases, shared by the tests of this folder."""

import random

WORDS = ("the old river ran past a mill and under seven stone bridges before it met grey sea where gulls cried over boats "
         "mit license apache general public é ß 漢字 don't it's 42 3.14 licensed released version").split()


def prose(seed: int, n: int) -> str:
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) + ("\n" if r.random() < 0.08 else "") for _ in range(n)).replace("\n ", "\n")


def edge_rows() -> list[tuple]:
    """(doc_id, text): nulls, empties, ties, copies, near copies, repeated rows, a very long text."""
    long = prose(99, 30_000)
    base = prose(7, 300)
    words = base.split(" ")
    near = [" ".join(w if i != k else "changed" for i, w in enumerate(words)) for k in (20, 150, 280)]
    rows = [(1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "one"), (6, "Two words"), (10, base), (11, base), (12, near[0]), (13, near[1]),
            (14, near[2]), (20, long), (21, long + " tail"), (22, "a" * 5000), (23, "a" * 400), (30, "x\nx\nx\nx"), (31, "x\nx\ny"),
            (40, base), (40, base), (None, base), (None, None), (50, "<|endoftext|> mit license <|startoftext|>"), (51, "\x00\x01 \x7f é́ İ ΑΣ")]
    rows += [(100 + i, prose(i, 5 + 13 * i)) for i in range(25)]
    return rows
