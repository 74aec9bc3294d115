"""Small inputs with the awkward cases every operator must take."""

import random

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, id long, ids string, length int, "
          "digest string, spans string, n int, value double, rep long, shard int, rank int, token long")


def documents(spark, texts, extra=True):
    """A documents table; the columns after n_chars carry clashing names."""
    rows = [(i, t, "en" if i is None or i % 3 else None, f"s{(i or 0) % 2}", None if t is None else len(t))
            for i, t in texts]
    if not extra:
        return spark.createDataFrame(rows, SCHEMA.split(", id long")[0])
    return spark.createDataFrame([r + (7, "x", 1, "d", "s", 2, 0.5, 3, 4, 5, 6) for r in rows], SCHEMA)


def awkward():
    """(doc_id, text): NULLs, blanks, one word, a very long text, repeated
    rows, a repeated id, ties."""
    rnd = random.Random(5)
    words = ["alpha", "beta", "gamma", "delta", "eps", "zeta", "Ä", "世界", "it's", "x1", "don't", "!!"]
    long = " ".join(rnd.choice(words) + ("\n" if rnd.random() < 0.1 else "") for _ in range(30_000))
    mid = "\n".join(" ".join(rnd.choice(words) for _ in range(12)) for _ in range(9))
    return [(0, None), (1, ""), (2, " \n\t "), (3, "one"), (4, long), (5, mid), (6, mid), (6, mid), (7, mid + "\ntail end"),
            (8, mid), (8, "same id, other text"), (None, mid), (None, None), (9, "<|endoftext|> a <|endoftext|>"),
            (10, "a b c d e"), (11, "A B C D E"), (12, "a" * 5000)]
