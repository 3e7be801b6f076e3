"""Small tables with the hard cases: nulls, empty and long texts, ties, repeated rows, clashing column names."""

from __future__ import annotations

import random

DATA = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size int, component_id string, text_ string"


def prose(rng: random.Random, n: int, vocabulary: int = 400) -> list[str]:
    return [f"{rng.choice('bcdfglmnprst')}{rng.choice('aeiou')}{rng.randrange(vocabulary)}" for _ in range(n)]


def rows(seed: int = 3) -> list[tuple]:
    """About 150 documents: near copies by few edits, exact copies, shared passages, self-repeats, and the odd cases."""
    rng, out = random.Random(seed), []
    passage = prose(rng, 60)
    for i in range(40):
        w = prose(rng, rng.choice([3, 4, 5, 6, 19, 20, 21, 60, 150]))
        out.append(w)
        for _ in range(rng.randrange(3)):
            near = list(w)
            for _ in range(rng.randrange(4)):
                near[rng.randrange(len(near))] = f"x{rng.randrange(9)}"
            out.append(near)
        if i % 5 == 0:
            out.append(w[:2] + passage[rng.randrange(20) : 20 + rng.randrange(40)] + w[2:])
        if i % 9 == 0:
            out.append(w + w)
    base = prose(rng, 120)
    for i in range(25):  # a chain in which each is near the next and the ends are not near
        out.append(base[i:] + prose(rng, i))
    out += [["la"] * 45, ["la"] * 45, ["la"] * 70]
    texts = [" ".join(w) for w in out]
    rng.shuffle(texts)
    texts += ["", "   \n\t ", None, "A", "a", "Ünïcode word   other\u0085x", "A B C D E", "a b c d e", "a\tb\x0bc\x0cd\re f", "\U0001f600 " * 30, "don't <|endoftext|> stop  \n\n  x"]
    texts.append("\n".join(["Buy | now | $$$ !!!"] * 30))
    texts.append(" ".join(prose(rng, 20_000, 9000)))
    table = [(i * 3 + 1, t, ["en", "de", None][i % 3], ["web", "book", "web", None, ""][i % 5], None, i, "c", "t") for i, t in enumerate(texts)]
    table += [table[5], table[5], table[40], (None, texts[7], "en", "web", None, 0, "c", "t"), (None, None, None, None, None, None, None, None)]
    return table


def frame(spark, table=None, parts: int = 3):
    return spark.createDataFrame(rows() if table is None else table, SCHEMA).repartition(parts)


def unique(table) -> list[tuple]:
    """(doc_id, text) of the rows with an id, once."""
    return sorted({r[0]: r[1] for r in table if r[0] is not None}.items())
