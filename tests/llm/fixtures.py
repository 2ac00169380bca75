"""Small awkward tables: nulls everywhere, empty and long texts, ties, repeated rows, clashing names."""

from __future__ import annotations

DOCS = "doc_id long, text string, lang string, source string, n_chars long, text_key string, maybe boolean, bucket int, key string, tokens string, __kept long, rep long, component string, at int"
LONG = " ".join(f"word{i % 997} tail{i}" for i in range(30_000))
BASE = " ".join(f"alpha{i}" for i in range(60))
LINE = "This very long line is shared by many documents"


def rows(texts: list) -> list[tuple]:
    return [(i, t, "en", f"s{(i or 0) % 2}", 0 if t is None else len(t), "x", True, 1, "k", "t", 5, 6, "c", 7) for i, t in texts]


AWKWARD = [
    (1, BASE),
    (2, BASE + " extra"),
    (3, BASE.upper()),
    (4, None),
    (5, ""),
    (6, " \t\n\x0b\x0c\r "),
    (7, LONG),
    (8, LONG + " end"),
    (9, "one"),
    (10, "one"),
    (11, "two words"),
    (12, f"{LINE}\nfirst\n{LINE}"),
    (13, f"  {LINE.upper()} \nsecond"),
    (14, f"{LINE}\nthird"),
    (15, "Ünïcode € 漢字 \U0001f600 ▁ mark"),
    (1, BASE),
    (None, "no id here at all, but words"),
    (None, None),
    (-5, BASE),
    (14, f"{LINE}\nan other text\n{LINE}\nunder one id"),
    (13, "keep me first\nkeep me second"),
    (2**62, "Released under the MIT License."),
]


def awkward(spark):
    return spark.createDataFrame(rows(AWKWARD), DOCS)


def empty(spark):
    return spark.createDataFrame([], DOCS)
