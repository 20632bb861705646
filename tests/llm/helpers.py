"""Brute-force versions and the awkward documents every operator must bear."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def documents(spark: SparkSession, rows: list[tuple[int | None, str | None]], **more) -> DataFrame:
    df = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], SCHEMA)
    return df.coalesce(2) if not more else df


def plain(n: int, seed: int = 1) -> str:
    """n words without any repeated neighbourhood."""
    return " ".join(f"w{(i * 7919 + seed * 104729) % 1000003}x" for i in range(n))


def words(text: str | None) -> list[str]:
    return WORD.findall(text or "")


def shingle_set(text: str | None, width: int) -> set[tuple[str, ...]]:
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = words(lower)
    return {tuple(w[i : i + width]) for i in range(len(w) - width + 1)} if len(w) >= width else {tuple(w)} if w else set()


def components(rows: list[tuple[int, str | None]], width: int, percent: int) -> dict[int, int]:
    """Smallest reachable id of every row, all pairs compared."""
    sets = [(i, shingle_set(t, width)) for i, t in rows]
    name = {i: i for i, _ in rows}

    def top(x: int) -> int:
        while name[x] != x:
            x = name[x]
        return x

    for a, (i, s) in enumerate(sets):
        for j, t in sets[:a]:
            if s and t and 100 * len(s & t) >= percent * len(s | t):
                x, y = sorted((top(i), top(j)))
                name[y] = x
    return {i: top(i) for i, _ in rows}


def word_distance(a: list[str], b: list[str]) -> int:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (x != y))
    return row[-1]


def deduped(rows: list[tuple[int, str | None]], min_words: int = 8) -> dict[int, str | None]:
    """Texts without the lines that an earlier line repeats within one word edit."""
    seen: list[list[str]] = []
    out = {}
    for i, text in sorted(rows, key=lambda r: r[0]):
        kept = []
        for line in (text or "").split("\n"):
            w = words(line)
            if w:
                near = any(w == s or (min(len(w), len(s)) >= min_words and abs(len(w) - len(s)) < 2 and word_distance(w, s) <= 1) for s in seen)
                seen.append(w)
                if near:
                    continue
            kept.append(line)
        out[i] = None if text is None else "\n".join(kept)
    return out


def overlap_items(text: str | None, items: list[tuple[int, str | None]]) -> dict[int, int]:
    """Best window of every item that the text overlaps."""
    norm = lambda t: words((t or "").lower().translate({ord(c): None for c in ",.;:!?\"'()[]{}"}))
    doc, found = norm(text), {}
    for item, body in items:
        w = norm(body)
        if len(w) < 5:
            continue
        size, need = (13, 11) if len(w) >= 13 else (len(w), len(w))
        for s in range(len(w) - size + 1):
            for d in range(1 - size, len(doc)):
                n = sum(0 <= d + k < len(doc) and doc[d + k] == w[s + k] for k in range(size))
                if n >= need:
                    found[item] = max(found.get(item, 0), n)
    return found
