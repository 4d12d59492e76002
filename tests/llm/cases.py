"""Awkward documents that every operator must take: nulls, empty and long texts, ties, repeats, clashing column names."""

from __future__ import annotations

import random

CLASHING = "doc_id long, text string, pos string, line string, row string, rep string, component string, b string, n string, h string"
WORDS = ("the river bends near old mills where quiet people carry bread along narrow streets and a lamp is lit for "
         "travellers of distant hills with songs that rise to open windows by night").split()


def prose(seed: int, n: int) -> str:
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) + str(r.randrange(40)) * (r.random() < 0.5) for _ in range(n))


def awkward() -> list[tuple[int | None, str | None]]:
    base = prose(1, 80)
    near = base.split()
    near[40] = "changed"
    return [
        (1, base), (2, base), (3, " ".join(near)), (4, base.upper()), (5, None), (6, ""), (7, "   \n\t "), (8, "one two three"),
        (9, "one two three"), (10, "One\nTWO\nthree"), (11, "\n".join([prose(2, 12)] * 3 + ["", "tail line"])), (12, prose(3, 4000)),
        (13, prose(3, 4000) + " end"), (14, "<|endoftext|> in the middle <|endoftext|>"), (15, "日本語 テスト é 🎉 x\u0085y"), (16, "a"),
        (17, prose(2, 12).replace("and", "or")), (18, "!!!" * 50), (19, "word " * 300), (-5, prose(5, 30)), (2, base), (None, base),
        (20, "Permission granted. All rights reserved. " + prose(6, 20))]


def table(spark, rows=None):
    rows = awkward() if rows is None else rows
    return spark.createDataFrame([(i, t, "p", "l", "r", "re", "c", "b", "n", "h") for i, t in rows], CLASHING).repartition(3)


def empty(spark):
    return spark.createDataFrame([], CLASHING)


def distinct_ids() -> list[tuple[int, str | None]]:
    """The documents without the row of no id and the repeated row."""
    seen, out = set(), []
    for i, t in awkward():
        if i is not None and i not in seen:
            seen.add(i)
            out.append((i, t))
    return out
