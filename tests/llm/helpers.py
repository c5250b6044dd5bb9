"""Small tables and brute-force versions for the tests of the operators."""

import random
import re

LETTERS = "abcdefghijklmnopqrstuvwxyz"


def words(rng: random.Random, n: int, of: int = 3000) -> list[str]:
    return ["".join(rng.choice(LETTERS) for _ in range(2)) + str(rng.randrange(of)) for _ in range(n)]


def spaced(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", LETTERS)))


def marked(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", LETTERS)))


#: Texts that every operator must bear.
ODD = [None, "", " \t\n\r\x0b\x0c", "a", "A", "é", "\x00\x1c\x1f", "a\xa0b c", "x" * 70_000, "y " * 40_000, "日本語 テキスト", "😀😀 😀", "-- !! ??"]


def odd_docs(spark, extra="score double, size long, kept string, _id long"):
    """The odd texts, twice each, under ids that repeat, with a null id and columns whose names operators use inside."""
    rows = [(i, t, "s", 1.5, 7, "k", 9) for i, t in enumerate(ODD)] * 2 + [(None, "no id here", None, None, None, None, None)]
    return spark.createDataFrame(rows, f"doc_id long, text string, source string, {extra}")


def union_find(ids, links):
    up = {i: i for i in ids}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for a, b in links:
        a, b = root(a), root(b)
        up[max(a, b)] = min(a, b)
    return {i: root(i) for i in ids}
