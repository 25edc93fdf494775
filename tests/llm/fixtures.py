"""Small document tables with the cases that every operator must survive."""

from __future__ import annotations

import random

WORDS = ("the of rend and threlyes ofthstthor nd ouble edoution wh onharent Zu und dieüauß der "
         "queasmitaó ardo por ososí l'étre it's 42 3.14 — … naïve été 中文 字 😀 "
         "<|endoftext|> <|startoftext|> x<|endoftext|>y  nbsp tab\tbed").split(" ")
ODD_TEXTS = [None, "", " ", "\n\n", "a", "  two  spaces  ", "tail ", " head", "a\n b\n\n  c \t d\r\n",
             "x  y  z ᠎w \x1cq ​v", "ΣΊΣΥΦΟΣ ΟΔΟΣ Σ", "İstanbul İ", "́start  ́x",
             "<|endoftext|>", "a <|endoftext|>  b<|endoftext|>c", "'s 's it's 't", "!!! *** ###", "123 4567  89"]


def random_text(rng: random.Random, words: int) -> str:
    gaps = [" "] * 12 + ["  ", "\n", " \n", "\n ", "\t"]
    return "".join(rng.choice(WORDS) + rng.choice(gaps) for _ in range(words))


def documents(spark, texts, extra: bool = True):
    """A documents table; with `extra`, columns whose names clash with those of operators."""
    columns = "doc_id long, text string, lang string, source string, n_chars long"
    rows = [(i, t, ("en", "fr", None)[i % 3], (f"src{i % 3}", None)[i % 5 == 4], len(t or ""))
            for i, t in enumerate(texts)]
    if extra:
        clash = ("id", "key", "size", "hash", "fp", "component", "digest", "kept", "copies", "part", "source_size",
                 "language", "_row", "_n", "u", "v")
        columns += "".join(f", {c} int" for c in clash)
        rows = [(*row, *[7] * len(clash)) for row in rows]
    return spark.createDataFrame(rows, columns)
