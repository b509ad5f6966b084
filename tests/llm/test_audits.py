"""Filter audit, decontamination and whitening against brute force."""

from __future__ import annotations

import random
import re
import sys
from collections import defaultdict
from itertools import permutations
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

import corpus as C  # noqa: E402
from compare import assert_same, duck  # noqa: E402

from starnorm.llm import decontamination, filter_audit, suffix_array, whitening  # noqa: E402
from starnorm.llm.oracle import ORACLE  # noqa: E402
from starnorm.llm.queries import QUERIES  # noqa: E402

SF_DIR = "/root/testdata/sf0.01"


def clashing(df, names):
    return df.select("*", *[F.lit(k).alias(c) for k, c in enumerate(names.split())])


# Filter audit


def audited_rows():
    rng = random.Random(3)
    some = ["alpha", "Beta", "GAMMA DELTA", "x", "1", "é", "#tag"]
    texts = [" ".join(rng.choices(some, k=rng.choice([1, 99, 100, 140]))) for _ in range(60)]
    texts += [" ".join(f"w{i}" for i in range(k)) for k in (99, 100, 101)]
    texts += [texts[60]] * 20 + [None, "", None, "", " \n", "A" * 11 + "b" * 99, "a　b"]
    rows = [(i, t, rng.choice(["en", "de", None, ""])) for i, t in enumerate(texts)]
    rows += [(5, texts[5], "en"), (5, texts[5], "fr"), (5, texts[7], "en"), (None, texts[5], "en")]
    rows += [(None, None, None), (None, "only here", "xx"), (None, "only here", "xx")]
    rng.shuffle(rows)
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for i in range(0, 80, 2)]
    labels += [(2, 1, 1), (2, 0, 0), (None, 1, 1), (None, 1, 1), (9999, 1, 1)]
    return rows, labels


def audited(rows, labels):
    good, toxic = ({i for i, *v in labels if v[k] == 1 and i is not None} for k in (0, 1))
    least = {}
    for i, text, _ in rows:
        if i is not None:
            least[text or ""] = min(i, least.get(text or "", i))

    def fails(i, text):
        text = text or ""
        words = C.words(text)
        first = least.get(text)
        return {
            "A": len(words) < 100,
            "B": 100 * len(set(words)) < 80 * len(words),
            "C": 100 * len(re.findall("[A-Z]", text)) > 10 * len(text),
            "D": bool(re.search(r"[#$%&*|]", text)),
            "E": first is not None and (i is None or i > first),
        }

    parts = defaultdict(list)
    for i, text, part in rows:
        parts[part or ""].append((i, fails(i, text)))
    out = []
    for part, docs in parts.items():
        lines, totals = [], defaultdict(int)
        for order in permutations("ABCDE"):
            for k, x in enumerate(order):
                here = [i for i, f in docs if f[x] and not any(f[y] for y in order[:k])]
                totals[x] += len(here)
                lines.append(
                    (
                        part,
                        "".join(order),
                        k + 1,
                        sum(not any(f[y] for y in order[: k + 1]) for _, f in docs),
                        len(here),
                        sum(f[x] for _, f in docs) - len(here),
                        sum(f[x] and sum(f.values()) == 1 for _, f in docs),
                        sum(i in good for i in here),
                        sum(i in toxic for i in here),
                        x,
                    )
                )
        out += [(*line[:-1], totals[line[-1]]) for line in lines]
    return sorted(out)


def test_filter_audit(spark):
    rows, labels = audited_rows()
    docs = clashing(
        spark.createDataFrame(rows, "doc_id long, text string, lang string"),
        "id part digest mask n good words first least key is_good",
    ).repartition(5)
    judged = clashing(
        spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), "labelled good id n"
    )
    got = filter_audit.audit_documents(docs, judged)
    assert sorted(tuple(r) for r in got.collect()) == audited(rows, labels)
    assert filter_audit.audit_documents(docs.limit(0), judged).count() == 0
    assert {r["good_lost"] for r in filter_audit.audit_documents(docs, judged.limit(0)).collect()} == {0}


@pytest.mark.parametrize("n", [2, 3, 4, 5])
def test_shapley_weights_solve_the_least_squares_problem(n):
    rng = random.Random(n)
    removed = [0] + [rng.randint(0, 100) for _ in range(2**n - 1)]
    expected = [0] * n
    for order in permutations(range(n)):
        before = 0
        for i in order:
            expected[i] += removed[before | 1 << i] - removed[before]
            before |= 1 << i
    weights = filter_audit.shapley_weights(n)
    assert [sum(a * b for a, b in zip(w, removed, strict=True)) for w in weights] == expected


# Decontamination


def plain_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", C.lowered(text))


def contaminated(rows, items, window):
    out = []
    for doc, text in rows:
        words, hit, found = plain_words(text), set(), set()
        for name, item in items:
            own = plain_words(item)
            k = min(window, len(own))
            for p in range(len(own) - k + 1 if k else 0):
                for q in range(len(words) - k + 1):
                    if words[q : q + k] == own[p : p + k]:
                        hit |= set(range(q, q + k))
                        found.add("" if name is None else str(name))
        out.append((doc, len(words), len(hit), tuple(sorted(found)), bool(hit)))
    return out


def leaky():
    rng = random.Random(11)
    vocabulary = ["".join(rng.choices("abcé0", k=rng.randint(1, 6))) for _ in range(60)]

    def prose(n):
        return " ".join(rng.choices(vocabulary, k=n))

    items = [(i, prose(rng.randint(3, 60))) for i in range(25)]
    items += [(25, items[3][1]), (25, items[4][1]), (26, items[3][1]), (None, items[5][1])]
    items += [(27, None), (28, ""), (29, "--- !"), (30, "ABC"), (31, "abc abc abc abc"), (2, items[6][1])]
    items += [(32, "z " * 300)]
    texts = [prose(rng.randint(1, 80)) for _ in range(30)]
    for _ in range(20):
        own = plain_words(rng.choice(items[:25])[1])
        at = rng.randrange(len(own))
        piece = own[at : at + rng.randint(5, 40)]
        texts.append(f"{prose(9)}. {', '.join(piece).upper()}-{prose(7)}")
    texts += [items[3][1], items[3][1], "abc abc\nabc\x00abc abc", "z " * 3000, "z" * 5000]
    texts += [None, "", " .!", "ab　c", "z " * 9, "z " * 10, items[7][1] + " " + items[8][1]]
    rows = list(enumerate(texts))
    rows += [(3, texts[40]), (None, texts[41]), (None, texts[41]), (None, None)]
    return rows, items


@pytest.fixture(scope="module")
def leaks(spark):
    rows, items = leaky()
    docs = clashing(
        spark.createDataFrame(rows, "doc_id long, text string"), "id n_words spans items row found0 end"
    )
    bench = clashing(spark.createDataFrame(items, "item_id long, text string"), "item raw id pieces")
    return rows, items, docs.repartition(4), bench


def small(monkeypatch, shard, chunk, piece):
    for name, size in (("SHARD_BYTES", shard), ("SLICE_BYTES", shard), ("CHUNK_BYTES", chunk)):
        monkeypatch.setattr(decontamination, name, size)
    monkeypatch.setattr(decontamination, "PIECE_WORDS", piece)


KEY = lambda row: (row[0] is None, row[0] or 0, row[1:])


@pytest.mark.parametrize(
    ("shard", "chunk", "piece", "window"),
    [(2 << 20, 16 << 20, 1 << 16, 10), (500, 16 << 20, 1 << 16, 10), (3000, 2500, 20, 10), (2 << 20, 4000, 50, 4)],
)
def test_decontamination(leaks, monkeypatch, shard, chunk, piece, window):
    rows, items, docs, bench = leaks
    small(monkeypatch, shard, chunk, piece)
    got = [
        (r["id"], r["n_words"], r["n_hit"], tuple(r["items"]), r["contaminated"])
        for r in decontamination.mark(docs, bench, window=window).collect()
    ]
    assert sorted(got, key=KEY) == sorted(contaminated(rows, items, window), key=KEY)


def test_decontaminated_rows_keep_their_columns(leaks):
    rows, items, docs, bench = leaks
    kept = decontamination.decontaminated(docs, bench)
    assert kept.columns == docs.columns
    expected = [r[0] for r in contaminated(rows, items, 10) if not r[-1]]
    got = [r["doc_id"] for r in kept.collect()]
    assert sorted(got, key=str) == sorted(expected, key=str)
    assert decontamination.decontaminated(docs, bench.limit(0)).count() == len(rows)
    assert decontamination.mark(docs.limit(0), bench).count() == 0


def test_longest_matches(leaks):
    rows, items, docs, bench = leaks
    expected = {}
    for name, item in items:
        own = plain_words(item)
        least = min(10, len(own))
        for doc, text in rows:
            words = plain_words(text)
            for p in range(len(own) - least + 1 if least else 0):
                for q in range(len(words)):
                    n = 0
                    while p + n < len(own) and q + n < len(words) and own[p + n] == words[q + n]:
                        n += 1
                    if n >= least:
                        key = "" if name is None else str(name)
                        new = (-n, doc is None, doc or 0, q)
                        expected[key] = min(expected.get(key, new), new)
    got = {
        r["item"]: (-r["n_words"], r["id"] is None, r["id"] or 0, r["start"])
        for r in decontamination.longest_matches(docs, bench).collect()
    }
    assert got == expected


def test_very_long_texts_are_searched_in_slices(spark):
    item = " ".join(f"q{i}" for i in range(12))
    rows = [(1, "lorem " * 600_000 + item + " ipsum" * 300_000), (2, "x" * 4_000_000 + " " + item)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame([(7, item)], "item_id long, text string")
    got = {r["id"]: (r["n_words"], r["n_hit"], r["spans"]) for r in decontamination.mark(docs, bench).collect()}
    assert got == {1: (900_012, 12, [(600_000, 600_012)]), 2: (13, 12, [(1, 13)])}


def test_suffix_array():
    rng = np.random.default_rng(5)
    for _ in range(30):
        words = rng.integers(0, 4, rng.integers(1, 80))
        array = suffix_array.SuffixArray(words, words.size + 1)
        places = array.places.tolist()
        text = [*words.tolist(), 0]
        live = [text[p : text.index(0, p)] for p in places if text[p]]
        assert live == sorted(live) and sorted(places) == list(range(words.size))
        for length in (1, 2, 5):
            start = int(rng.integers(0, words.size))
            wanted = words[start : start + length]
            lo, hi = np.array([0]), np.array([words.size])
            for depth, word in enumerate(wanted):
                lo, hi = array.narrowed(lo, hi, depth, np.array([word]))
            if (wanted > 0).all():
                found = sorted(array.occurrences(lo, hi)[1].tolist())
                places = range(words.size - wanted.size + 1)
                assert found == [p for p in places if (words[p : p + wanted.size] == wanted).all()]


# Whitening


def dense(x, k):
    away = x - x.sum(axis=0) / len(x)
    value, axes = np.linalg.eigh(away.T @ away / len(x))
    value, axes = value[::-1], axes[:, ::-1]
    return value, away @ axes[:, :k] / np.sqrt(value[:k])


@pytest.mark.parametrize(("size", "guards"), [(30, 2), (30, 40), (5, 12), (1, 12)])
def test_whitening(spark, monkeypatch, size, guards):
    monkeypatch.setattr(whitening, "GUARDS", guards)
    monkeypatch.setattr(whitening.leading, "__defaults__", (guards, 6))
    rng = np.random.default_rng(size)
    values = rng.normal(size=(200, size)) * np.linspace(3, 0.2, size) + 5
    rows = [(i, v.tolist()) for i, v in enumerate(values)]
    rows += [(7, rows[7][1]), (None, rows[9][1]), (None, rows[9][1])]
    whole = list(rows)
    rows += [(900, None), (901, [None] * size), (902, [float("nan")] * size), (903, [float("inf")] * size)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    df = clashing(df, "id x n i j v deviation whitened").repartition(4)
    got = whitening.whiten(df).collect()
    x = np.floor(1024 * np.array([v for _, v in whole])).astype(np.int64) + 100_000
    k = min(8, size)
    value, white = dense(x, k)
    n, sums = len(x), x.sum(axis=0)
    exact = [sum((n * int(a) - int(s)) ** 2 for a, s in zip(r, sums, strict=True)) for r in x]
    assert len(got) == n * k
    assert {r["n"] for r in got} == {n}
    assert max(r["identity_error"] for r in got) < 1e-10
    for c in range(k):
        mine = sorted(((r["id"] is None, r["id"] or 0), r) for r in got if r["component"] == c + 1)
        own = sorted(((i is None, i or 0), j) for j, (i, _) in enumerate(whole))
        sign = np.sign(mine[0][1]["whitened"] * white[own[0][1], c])
        for (a, r), (b, j) in zip(mine, own, strict=True):
            assert a == b and int(r["deviation"]) == exact[j]
            assert abs(r["whitened"] * sign - white[j, c]) < 1e-9
            assert abs(r["explained"] - value[c] / value.sum()) < 1e-12


def test_whitening_of_awkward_tables(spark):
    def of(rows):
        df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
        return whitening.whiten(df).collect()

    assert of([]) == [] and of([(1, [1.0, 2.0])]) == [] and of([(1, None), (2, [None])]) == []
    assert of([(1, []), (2, [])]) == [] and of([(1, [0.5]), (2, [0.5])]) == []
    # Shorter vectors end in zeros; a constant dimension has no component.
    got = of([(1, [1.0]), (2, [1.0, 1.0]), (3, [1.0, 0.0])])
    assert sorted((r["id"], r["component"]) for r in got) == [(1, 1), (2, 1), (3, 1)]
    assert sorted(int(r["deviation"]) for r in got) == [1024**2, 1024**2, 4 * 1024**2]
    huge = of([(1, [3e38, 1.0]), (2, [-3e38, 2.0]), (3, [1e30, 3.0])])
    assert {r["component"] for r in huge} == {1} and max(r["identity_error"] for r in huge) < 1e-9
    assert all(int(r["deviation"]) > 2**64 for r in huge)


def test_equal_eigenvalues_and_wide_blocks():
    rng = np.random.default_rng(1)
    axes = np.linalg.qr(rng.normal(size=(60, 60)))[0]
    value = np.concatenate([[9.0, 5, 5, 5, 4], np.full(20, 3.0), np.linspace(2.99, 0, 35)])
    v = (axes * value) @ axes.T
    found, block = whitening.leading(lambda q: v @ q, 60, 8, guards=2, degree=5)
    assert np.allclose(found, value[:8], atol=1e-10)
    assert np.allclose(v @ block, block * found, atol=1e-9)
    assert np.allclose(block.T @ block, np.eye(8), atol=1e-12)


@pytest.mark.parametrize("name", ["op11_filter_audit", "op12_decontamination"])
def test_against_sql(spark, name):
    assert assert_same(QUERIES[name](spark, SF_DIR), duck(SF_DIR), ORACLE[name])
