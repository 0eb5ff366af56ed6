"""Small corpora with the awkward cases, and plain versions of the operators' rules."""

from __future__ import annotations

import random
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id long, key string, component string"


def sentence(rng: random.Random, words: int) -> str:
    syllables = ["an", "be", "cor", "di", "el", "fu", "gar", "hi", "ist", "jo", "kel", "lu", "mo", "ner", "ö", "pi"]
    return " ".join("".join(rng.choices(syllables, k=rng.randint(1, 4))) for _ in range(words))


def edited(rng: random.Random, text: str, share: float) -> str:
    return " ".join(w if rng.random() >= share else w + "x" for w in text.split(" "))


def documents(seed: int = 3, fresh: int = 30) -> list[tuple]:
    """Rows of SCHEMA: copies, near copies in chains, empty, null and long texts, repeated rows, null ids and sources."""
    rng = random.Random(seed)
    texts: list[str | None] = []
    for _ in range(fresh):
        lines = [sentence(rng, rng.randint(3, 40)) for _ in range(rng.randint(1, 6))]
        texts.append("\n".join(lines))
    for base in texts[:6]:
        chain = base
        for _ in range(4):
            chain = edited(rng, chain, 0.02)
            texts.append(chain)
    texts += [texts[0]] * 3 + [texts[1].upper(), texts[2].replace(" ", "\t \n")]
    texts += [None, "", " \t\n ", "one", "one two three four", "One  two three four", "a b c d e", "ö ä\x0bü", "\U0001f600 x\x85y z", "<s> ▁ </s>"]
    texts += [sentence(rng, 4000), "x" * 30_000, "same " * 3000, "\n" * 500]
    rows = [
        (i, t, "en", rng.choice(["a", "b", "ü", "B", None]), None if t is None else len(t), -i, "k", "c") for i, t in enumerate(texts)
    ]
    rows += rows[:3] * 2  # repeated rows
    rows += [(4, "another text of document four that has some words", "en", "a", 3, 1, "k", "c")]
    rows += [(None, texts[0], "en", "a", 1, 1, "k", "c"), (None, None, None, None, None, None, None, None)]
    rng.shuffle(rows)
    return rows


def frame(spark, rows: list[tuple]):
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def smallest_reachable(nodes, links) -> dict:
    """For every node the smallest one that links reach."""
    parent = {n: n for n in nodes}

    def root(n):
        while parent[n] != n:
            parent[n] = parent[parent[n]]
            n = parent[n]
        return n

    for a, b in links:
        a, b = sorted((root(a), root(b)))
        parent[b] = a
    return {n: root(n) for n in nodes}


def shingles(text: str | None, words: int = 5) -> set[str]:
    found = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not found:
        return set()
    return {" ".join(found[i : i + words]) for i in range(max(1, len(found) - words + 1))}
