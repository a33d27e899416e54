from __future__ import annotations

import random
import re

DOCS = "doc_id long, text string, lang string, source string, n_chars long, score string, kept string, n_words string, size string, component_id string, found string, words string"
LOW = str.maketrans({chr(i): chr(i + 32) for i in range(65, 91)})


def docs(spark, rows):
    """Documents from (doc_id, text[, lang[, source]]), with extra columns whose names the operators use themselves."""
    full = []
    for r in rows:
        i, text, lang, source = (*r, *[None] * 4)[:4]
        full.append((i, text, lang, source, None if text is None else len(text), "s", "k", "w", "z", "c", "f", "v"))
    return spark.createDataFrame(full, DOCS)


def prose(seed: int, n: int, words: int = 400) -> str:
    r = random.Random(seed)
    return " ".join(f"w{r.randrange(words)}" for _ in range(n))


def space_words(text: str | None) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def collected(df, key="doc_id"):
    return {r[key]: r for r in df.collect()}
