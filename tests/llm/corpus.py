"""Small corpora with every awkward case, and brute-force versions of the operators."""

from __future__ import annotations

import random
import re
from collections import Counter

WORD = re.compile(r"[^\x20\x09-\x0D]+")
# Columns that operators use themselves must not disturb them.
CLASHING = (
    "id block print row key size shard slot n n_words n_tokens kept removed piece length "
    "component gram _id _print _stays code query measured"
).split()


def corpus(seed: int = 7) -> list[tuple[int | None, str | None]]:
    rng = random.Random(seed)
    names = ["".join(rng.choices("abcdeéñö", k=rng.randint(1, 9))) for _ in range(400)]

    def prose(n: int) -> str:
        return " ".join(rng.choices(names, k=n))

    passage = prose(60)
    texts: list[str | None] = [prose(rng.randint(1, 150)) for _ in range(40)]
    base = prose(120).split()
    for _ in range(12):
        near = list(base)
        for _ in range(rng.randint(0, 4)):
            near[rng.randrange(len(near))] = "edit" + str(rng.random())
        texts.append(" ".join(near))
    texts += [f"{prose(20)} {passage} {prose(20)}" for _ in range(12)]
    texts += [texts[3]] * 9
    texts += [texts[50].upper(), texts[50].replace(" ", "\n\t ")]
    texts += [None, "", " \t\n", "\n\n", "one", "two words", "one", "a b c", "A b C"]
    texts += ["don't <|endoftext|> stop  <|endoftext|>", "zero\x00byte \x00", "漢字 𓀀 ﬁ ▁x 　y"]
    texts += ["x" * 5000, "ab " * 1500, "# $ % & | < > *" * 20, "line\nline\nline\nline\n" * 9]
    texts += [prose(9000)]
    rows = list(enumerate(texts))
    rows += [(2, texts[2]), (2, texts[5]), (None, texts[3]), (None, "lonely words here"), (None, None)]
    rows += [(None, texts[7])] * 2
    rng.shuffle(rows)
    return rows


def frame(spark, rows, clashing: bool = True):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    if clashing:
        from pyspark.sql import functions as F

        df = df.select("*", *[F.lit(k).alias(c) for k, c in enumerate(CLASHING)])
    return df.repartition(5)


def words(text: str | None) -> list[str]:
    return WORD.findall(text or "")


def lowered(text: str | None) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def in_order(rows):
    """Rows with unlike ids in the order of their ids, null last."""
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))


def quality(text: str | None) -> tuple[int, ...]:
    own = words(text)
    seen = Counter(tuple(own[i : i + 3]) for i in range(len(own) - 2))
    again = [False] * len(own)
    for i in range(len(own) - 2):
        if seen[tuple(own[i : i + 3])] > 1:
            again[i : i + 3] = [True] * 3
    lines = [line for line in (text or "").split("\n") if words(line)]
    symbols = sum(c in "#*$%&|<>" for c in text or "")
    return len(own), sum(map(len, own)), symbols, len(lines) - len(set(lines)), sum(again)


def shingles(text: str | None, n: int) -> frozenset:
    own = words(lowered(text))
    if not own:
        return frozenset()
    return frozenset(tuple(own[i : i + n]) for i in range(max(1, len(own) - n + 1)))


def jaccard_components(rows, n: int, percent: int) -> list[tuple]:
    sets = [shingles(text, n) for _, text in rows]
    parent = list(range(len(rows)))

    def root(i: int) -> int:
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            both = len(a & b)
            if both and 100 * both >= percent * (len(a) + len(b) - both):
                parent[root(i)] = root(j)
    least: dict[int, int] = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[root(i)] = min(doc, least.get(root(i), doc))
    return [
        (doc, len(sets[i]), least.get(root(i)) if sets[i] else doc)
        for i, (doc, _) in enumerate(rows)
    ]


def without_windows(rows, k: int) -> list[tuple]:
    seen, out = set(), []
    for doc, text in in_order(rows):
        own = words(text)
        gone = [False] * len(own)
        for i in range(len(own) - k + 1):
            window = tuple(own[i : i + k])
            if window in seen:
                gone[i : i + k] = [True] * k
            seen.add(window)
        kept = " ".join(w for w, g in zip(own, gone, strict=True) if not g)
        out.append((doc, len(own), sum(gone), kept))
    return out


def without_bytes(rows, k: int) -> list[tuple]:
    raw = [(doc, (text or "").encode()) for doc, text in rows]
    seen = Counter(t[i : i + k] for _, t in raw for i in range(len(t) - k + 1))
    out = []
    for doc, text in raw:
        gone = bytearray(len(text))
        for i in range(len(text) - k + 1):
            if seen[text[i : i + k]] > 1:
                gone[i : i + k] = b"\1" * k
        spans = len(re.findall(b"\1+", bytes(gone)))
        kept = bytes(b for b, g in zip(text, gone, strict=True) if not g)
        out.append((doc, len(text), sum(gone), spans, kept))
    return out
