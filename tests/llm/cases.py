"""Small awkward tables: nulls, empty and very long texts, ties, repeated rows, no rows, columns with names used inside."""

from __future__ import annotations

import random

SCHEMA = "doc_id long, text string, lang string, id long, key string, shard string, band long, n long, piece string, guest string, places string"
WORDS = "the a of and Thing OTHER word. word, été Straße naïve 42 don't <b> x_y ½ 日本語 end".split()


def sentence(r: random.Random, n: int) -> str:
    return " ".join(r.choice(WORDS) + (str(r.randint(0, 30)) if r.random() < 0.5 else "") for _ in range(n))


def documents() -> list[tuple[int | None, str | None, str | None]]:
    r = random.Random(5)
    shared = sentence(r, 45)
    base = [sentence(r, r.randint(0, 90)) for _ in range(30)]
    rows: list[tuple[int | None, str | None, str | None]] = [(10 * i + 7, t, "en" if i % 2 else "de") for i, t in enumerate(base)]
    rows += [(3, None, "en"), (4, "", "de"), (5, " \n\t ", None), (6, "one", "en"), (8, "\x1c\x1d a\x0bb\x0cc\rd", None)]
    rows += [(400 + i, f"{sentence(r, 10)} {shared}\n{sentence(r, 12)}", None) for i in range(6)]
    rows += [(500, base[3], "de"), (501, base[3].upper(), "en"), (502, base[3] + " more", "en")]
    rows += [(600, "a " * 3000, "en"), (601, "x" * 9000, "en"), (602, sentence(r, 4000), "de"), (603, "a " * 60, None)]
    rows += [(700, base[5], "en"), (700, base[5], "en")]  # a repeated row
    rows += [(710, base[7], "en"), (710, base[8], "en")]  # an id with two texts
    rows += [(None, base[9], "en"), (None, sentence(r, 50), None)]
    r.shuffle(rows)
    return rows


def frame(spark, rows):
    """The rows with further columns whose names the operators use inside."""
    return spark.createDataFrame(
        [(i, t, lang, -1, "k", "s", 9, 8, "p", "g", "x") for i, t, lang in rows], SCHEMA
    ).repartition(3)


def unique_ids(rows):
    """Only rows whose id no other row has."""
    ids = [i for i, _, _ in rows]
    return [row for row in rows if row[0] is not None and ids.count(row[0]) == 1]


def words(text: str | None) -> list[bytes]:
    return (text or "").encode().split()
