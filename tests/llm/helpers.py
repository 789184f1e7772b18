"""Small inputs for the tests of this folder."""

from __future__ import annotations

import random

SF = "/root/testdata/sf0.001"
DOCUMENTS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
SYLLABLES = "an er in th on re st nd he ou ly ing tion ea".split()


def words(rng: random.Random, n: int) -> list[str]:
    return ["".join(rng.choice(SYLLABLES) for _ in range(rng.randrange(1, 4))) for _ in range(n)]


def odd_texts() -> list[str | None]:
    """Null, empty, white space, control characters, other scripts, and a long text."""
    return [None, "", " ", "\n\n\t ", "a", "\x00\x1c", "日本語 😀 é", "A " * 50_000, "x" * 30_000, "<|endoftext|> ok", "ab cd　ef"]


def documents(spark, texts, ids=None):
    rows = [(i, t, "en", "s", None) for i, t in zip(ids if ids is not None else range(len(texts)), texts)]
    return spark.createDataFrame(rows, DOCUMENTS)


def save(df, folder, name):
    df.write.mode("overwrite").parquet(f"{folder}/{name}.parquet")
