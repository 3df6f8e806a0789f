"""Documents for the tests of the training-data operators, and plain versions to compare with."""

from __future__ import annotations

import random
import re

SPACE = re.compile(r"[^\x20\x09-\x0D]+")
UPPER = {c: c + 32 for c in range(65, 91)}


def words(text: str | None) -> list[str]:
    return SPACE.findall(text or "")


def prose(rng: random.Random, n: int, size: int = 4000) -> str:
    out = [f"w{rng.randrange(size)}" for _ in range(n)]
    for k in range(9, n, 10):
        out[k] += ".\n" if k % 3 else ". "
    return " ".join(out)


def documents(seed: int = 5) -> list[tuple]:
    """(doc_id, text, n_words, n_lines, spans): the last three have names that results use too."""
    rng = random.Random(seed)
    base, other, passage, line = prose(rng, 160), prose(rng, 90), prose(rng, 60), "The same long line, again and again"
    texts = [
        None, "", " \t\n ", "one", "Two words", base, base, base.replace("w1", "x1", 3), base.upper(), other,
        "start here " + passage + " " + prose(rng, 70), prose(rng, 40) + " " + passage + " tail", passage,
        f"{line}\n{prose(rng, 60)}\n  {line.upper()}\t", f"x\n{line}", f"{line}\n{line}\nshort\nshort", "a b c " * 400, "É é ß ñ " * 30,
        prose(rng, 20_000), "\n\n\n", "  ", other + " " + prose(rng, 5), "😀 " * 60,
    ]
    rows = [(i * 7 % 101, t, -1, "clash", None) for i, t in enumerate(texts)]
    return rows + [rows[5], rows[0]]  # repeated rows


SCHEMA = "doc_id int, text string, n_words int, n_lines string, spans string"


def jaccard_groups(texts: dict[int, str | None], width: int, percent: int) -> dict[int, int]:
    sets = {}
    for i, t in texts.items():
        w = [x.translate(UPPER) for x in words(t)]
        sets[i] = {tuple(w)} if 0 < len(w) < width else set(zip(*(w[k:] for k in range(width)), strict=False))
    group = {i: i for i in sets}

    def root(i: int) -> int:
        while group[i] != i:
            i = group[i]
        return i

    ids = sorted(i for i in sets if sets[i])
    for at, i in enumerate(ids):
        for j in ids[at + 1 :]:
            both = len(sets[i] & sets[j])
            if 100 * both >= percent * len(sets[i] | sets[j]):
                a, b = root(i), root(j)
                group[max(a, b)] = min(a, b)
    return {i: root(i) for i in sets}


def kept_lines(rows: list[tuple], min_docs: int = 3) -> list[tuple]:
    """doc_id -> kept text, one entry per row."""
    key = lambda x: x.strip(" \t\n\x0b\x0c\r").translate(UPPER)
    holders: dict[str, list[int]] = {}
    for doc, text, *_ in rows:
        for k in {key(x) for x in (text or "").split("\n")}:
            if len(k) >= 20:
                holders.setdefault(k, []).append(doc)
    gone = {k: max(h) for k, h in holders.items() if len(set(h)) >= min_docs}
    return sorted((doc, "\n".join(x for x in (text or "").split("\n") if gone.get(key(x), doc) == doc)) for doc, text, *_ in rows)
