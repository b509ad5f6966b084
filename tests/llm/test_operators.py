"""Every operator against brute force on a corpus with every awkward case."""

from __future__ import annotations

import math
import sys
import zlib
from collections import Counter, defaultdict
from functools import partial
from pathlib import Path

import numpy as np
import pytest
import public_tokenizers
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

sys.path.insert(0, str(Path(__file__).resolve().parent))

import corpus as C  # noqa: E402
from compare import assert_same, duck  # noqa: E402

import __spark_entry__ as registry  # noqa: E402
import corpus_pipeline  # noqa: E402
from starnorm.llm import (  # noqa: E402
    blocks,
    context_tree,
    hamming_topk,
    jaccard_join,
    lm_scoring,
    packing,
    quality_rules,
    ranks,
    routes,
    sentencepiece_codec,
    sharding,
    substring_dedup,
    suffix_dedup,
    token_counts,
)
from starnorm.llm.oracle import ORACLE  # noqa: E402
from starnorm.llm.queries import QUERIES  # noqa: E402
from starnorm.sizing import BROADCAST_BYTES  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"
ROWS = C.corpus()


@pytest.fixture(scope="module")
def docs(spark):
    return C.frame(spark, ROWS).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return C.frame(spark, [])


@pytest.fixture(params=["straight", "in hops"])
def way(request, monkeypatch):
    """Messages go straight to their receivers, or by relays."""
    monkeypatch.setattr(routes, "FAN_BITS", 10 if request.param == "straight" else 1)


@pytest.fixture(autouse=True)
def small_blocks(monkeypatch):
    """Many blocks, shards, lots and tiles even for little text."""
    monkeypatch.setattr(blocks, "BLOCK_BYTES", 20_000)
    monkeypatch.setattr(lm_scoring, "SHARD_BYTES", 20_000)
    monkeypatch.setattr(suffix_dedup, "SHARD_BYTES", 20_000)
    monkeypatch.setattr(ranks, "LOT_ROWS", 20)
    monkeypatch.setattr(sharding, "LOT_GROUPS", 10)
    monkeypatch.setattr(sharding, "FAN_IN", 3)
    monkeypatch.setattr(jaccard_join, "TILE", 5)


def rows_of(df, *columns):
    order = lambda row: tuple((v is None, v if v is not None else 0) for v in row)
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=order)


def as_rows(rows):
    return sorted(rows, key=lambda row: tuple((v is None, v if v is not None else 0) for v in row))


def test_token_counts(docs):
    library = Tokenizer.from_file(str(public_tokenizers.path("byte_bpe_50k.json")))

    def of(text):
        n = len(library.encode(text or "", add_special_tokens=False).ids)
        return len((text or "").encode()), n, n > 1024

    got = rows_of(token_counts.count_tokens(docs), "id", "n_bytes", "n_tokens", "over_limit")
    assert got == as_rows((d, *of(t)) for d, t in ROWS)


def test_very_long_runs(spark):
    """Runs of two million characters, with what stands around them, as the library has them."""
    library = Tokenizer.from_file(str(public_tokenizers.path("byte_bpe_50k.json")))
    texts = [f"a{c * 2_000_000}b <|endoftext|>{c}" for c in (" ", "\n", "\t", "a", "1", "!", "漢", " \n")]
    rows = list(enumerate(texts))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    ids = [np.array(library.encode(t, add_special_tokens=False).ids + [0], "<u4") for t in texts]
    counts = rows_of(token_counts.count_tokens(df), "id", "n_tokens")
    assert counts == [(i, own.size - 1) for i, own in enumerate(ids)]
    pieces = packing.pack(df)
    got = rows_of(pieces, "id", "start", "length", "ids_crc32")
    assert got == [
        (i, lo, hi - lo, zlib.crc32(own[lo:hi].tobytes()))
        for i, own in enumerate(ids)
        for lo, hi in _cuts(own.size, packing.CAPACITY)
    ]


def _cuts(size, capacity):
    marks = [0, *range(size % capacity or capacity, size + 1, capacity)]
    return list(zip(marks, marks[1:], strict=False))


def test_quality_rules(docs):
    ledger = quality_rules.ledger(docs)
    names = ["word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    assert rows_of(ledger, "id", "n_words", *names) == as_rows((d, *C.quality(t)) for d, t in ROWS)
    failed = [r["failed"] for r in ledger.collect()]
    whole = quality_rules.mask(quality_rules.POLICIES["v2"])
    kept = sum(f & whole == 0 for f in failed)
    for row in quality_rules.ablations(ledger, "v2").collect():
        bit = quality_rules.mask((row["rule"],))
        assert row["n_failed"] == sum(f & bit != 0 for f in failed)
        assert row["n_kept_without"] == sum(f & whole & ~bit == 0 for f in failed)
    good = quality_rules.keep_good(docs)
    assert good.columns == docs.columns and good.count() == kept


@pytest.mark.parametrize(
    ("words", "percent", "broadcast_bytes"), [(4, 85, BROADCAST_BYTES), (5, 80, BROADCAST_BYTES), (4, 85, 0)]
)
def test_jaccard_components(docs, monkeypatch, words, percent, broadcast_bytes):
    by_size = partial(jaccard_join.lookup, broadcast_bytes=broadcast_bytes)
    monkeypatch.setattr(jaccard_join, "lookup", by_size)
    got = jaccard_join.jaccard_components(docs, words=words, percent=percent)
    expected = C.jaccard_components(ROWS, words, percent)
    assert rows_of(got, "id", "n_shingles", "component_id") == as_rows(expected)


def test_jaccard_keeps_one_of_each(docs, way):
    kept = jaccard_join.keep_one_of_each_component(docs, words=5, percent=80)
    assert kept.columns == docs.columns
    texts = [r["text"] for r in kept.collect()]
    groups = Counter(c for _, n, c in C.jaccard_components(list(enumerate(t for _, t in ROWS)), 5, 80) if n)
    wordless = sum(not C.words(t) for _, t in ROWS)
    assert len(texts) == len(groups) + wordless
    left = C.jaccard_components(list(enumerate(texts)), 5, 80)
    assert all(i == c for i, _, c in left)


def test_hamming_top_k(spark):
    rng = np.random.default_rng(3)
    vectors = rng.normal(size=(300, 20)).round(2)
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
    rows += [(300 + i, vectors[7].tolist()) for i in range(40)]
    rows += [(400, None), (401, []), (402, [1.0, None, float("nan")]), (None, vectors[0].tolist())]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    df = df.withColumn("id", F.lit(1)).withColumn("code", F.lit(2))
    got = rows_of(hamming_topk.top_k(df, F.col("vec_id") % 50 == 0, k=5), "query_id", "rank", "id", "distance")

    def code(v):
        bits = [x is not None and not math.isnan(x) and x > 0 for x in v]
        return np.array(bits + [False] * (20 - len(bits)))

    known = [(i, code(v)) for i, v in rows if v is not None]
    expected = []
    for q, own in known:
        if q is not None and q % 50 == 0:
            near = sorted((int((own != c).sum()), i is None, i or 0, i) for i, c in known)[:5]
            expected += [(q, k + 1, n[3], n[0]) for k, n in enumerate(near)]
    assert got == as_rows(expected)


def unlike_ids():
    """Rows with an id that no other row has; the order among equal ids is a matter of hashes."""
    count = Counter(d for d, _ in ROWS)
    return [r for r in ROWS if r[0] is not None and count[r[0]] == 1]


def test_window_dedup(spark, way):
    rows = [*unlike_ids(), (None, "x y " * 30)]
    got = substring_dedup.remove_repeated_windows(C.frame(spark, rows), window=20)
    expected = as_rows(C.without_windows(rows, 20))
    assert rows_of(got, "id", "n_words", "n_removed", "kept_text") == expected
    for r in got.collect():
        assert sum(s["end"] - s["start"] for s in r["removed"]) == r["n_removed"]


def test_window_dedup_keeps_one_of_equal_rows(spark):
    text = " ".join(f"w{i}" for i in range(30))
    rows = [(1, text)] * 3 + [(None, text)] * 2
    got = substring_dedup.remove_repeated_windows(C.frame(spark, rows)).collect()
    assert sorted((r["id"] is None, r["n_removed"]) for r in got) == [
        (False, 0), (False, 30), (False, 30), (True, 30), (True, 30)
    ]


@pytest.mark.parametrize("hot_level", [1, 8])
def test_byte_dedup(docs, monkeypatch, hot_level, way):
    monkeypatch.setattr(suffix_dedup, "HOT_LEVEL", hot_level)
    got = suffix_dedup.remove_repeated_bytes(docs).withColumn("kept", F.hex("kept"))
    expected = [(*r[:4], r[4].hex().upper()) for r in C.without_bytes(ROWS, 200)]
    assert rows_of(got, "id", "n_bytes", "n_removed", "n_spans", "kept") == as_rows(expected)


def test_byte_dedup_of_documents(docs):
    got = suffix_dedup.without_repeated_bytes(docs)
    assert got.columns == docs.columns
    expected = [r[4].decode("utf-8", "ignore") for r in C.without_bytes(ROWS, 200)]
    assert sorted(r["text"] for r in got.collect()) == sorted(t for t in expected if t)


def test_shards(docs):
    got = sharding.shard_documents(docs, shards=6).collect()
    raw = sorted(((d is None, d or 0), len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for d, t in ROWS)
    assert sorted(((r["id"] is None, r["id"] or 0), r["size"], r["text_crc32"]) for r in got) == raw
    slots, groups = defaultdict(list), defaultdict(set)
    for r in got:
        slots[r["shard"]].append(r["slot"])
        groups[r["size"], r["text_crc32"]].add(r["shard"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(len(g) == 1 for key, g in groups.items() if key[0] > 16)


def test_shards_balance_through_lots_and_levels(spark, monkeypatch):
    """Texts of all sizes, several copies of one: shards differ by less than one usual text.

    A group must be small beside what a shard gets of its lot, or it shows.
    """
    monkeypatch.setattr(sharding, "LOT_GROUPS", 300)
    rng = np.random.default_rng(4)
    texts = ["x" * int(n) + str(i) for i, n in enumerate(rng.exponential(300, 1500))]
    rows = list(enumerate(texts)) + [(2000 + i, texts[5]) for i in range(12)] + [(None, None)] * 9
    got = sharding.shard_documents(C.frame(spark, rows), shards=6).collect()
    sizes = Counter()
    for r in got:
        sizes[r["shard"]] += r["size"]
    whole = sum(len((t or "").encode()) + 16 for _, t in rows)
    assert sum(sizes.values()) == whole and len(sizes) == 6
    assert max(sizes.values()) - min(sizes.values()) < 300
    assert len({r["shard"] for r in got if r["text_crc32"] == zlib.crc32(texts[5].encode())}) == 1


def test_differencing_balances():
    rng = np.random.default_rng(1)
    sizes = rng.integers(1, 1000, 200)
    single = np.zeros((200, 7), np.int64)
    single[:, -1] = sizes
    total, places = sharding.difference(single)
    sums = np.bincount(places[:, -1], sizes, minlength=7)
    assert sorted(sums) == total.tolist() and sums.max() - sums.min() <= 5


def test_packing(docs):
    library = Tokenizer.from_file(str(public_tokenizers.path("byte_bpe_50k.json")))
    got = packing.pack(docs).collect()
    expected, total = [], 0
    for d, text in ROWS:
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        total += ids.size
        first = ids.size % 2048 or 2048
        cuts = [0, *range(min(first, ids.size), ids.size + 1, 2048)]
        for k, (lo, hi) in enumerate(zip(cuts, cuts[1:], strict=False)):
            expected.append((d, k, lo, hi - lo, zlib.crc32(ids[lo:hi].tobytes())))
    assert as_rows(tuple(r[:5]) for r in got) == as_rows(expected)
    sequences = defaultdict(list)
    for r in got:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(sequences) <= -(-total // 2048) + 1


def test_plan_is_best_fit_decreasing():
    rng = np.random.default_rng(5)
    for _ in range(30):
        lengths = sorted(rng.integers(1, 33, rng.integers(1, 200)).tolist(), reverse=True)
        free: list[int] = []
        for n in lengths:
            fits = [k for k, room in enumerate(free) if room >= n]
            if fits:
                free[min(fits, key=lambda k: free[k])] -= n
            else:
                free.append(32 - n)
        slots = packing.plan(dict(Counter(lengths)), 32)
        used: Counter = Counter()
        for s in slots:
            for rank in range(s.first, s.last):
                used[s.sequence + (rank - s.first) // s.each] += s.length
        assert sum(used.values()) == sum(lengths) and max(used.values()) <= 32
        assert len(used) == len(free)


def kt(a: int, b: int) -> float:
    p = 0.0
    for k in range(a):
        p += math.log(k + 0.5)
    for k in range(b):
        p += math.log(k + 0.5)
    return p - sum(math.log(k) for k in range(1, a + b + 1))


def ctw_log10(training: list[bytes], text: bytes, depth: int) -> float:
    """Context-tree weighting as defined, node by node."""
    counts = defaultdict(lambda: [0, 0])
    children = defaultdict(set)
    pad = b"\n" * depth

    def decisions(x):
        for j in range(8):
            yield (1 << j) | (x >> (8 - j)), (x >> (7 - j)) & 1

    for t in training:
        t = pad + t
        for i in range(depth, len(t)):
            for z, bit in decisions(t[i]):
                for d in range(depth + 1):
                    context = t[i - d : i]
                    counts[z, context][bit] += 1
                    if d:
                        children[z, context[1:]].add(context)

    def below(z, context):
        return sum(weighted(z, c) for c in children[z, context])

    def weighted(z, context):
        own = kt(*counts[z, context])
        if len(context) == depth:
            return own
        return math.log(0.5) + np.logaddexp(own, below(z, context))

    def probability(z, context, whole, bit):
        a, b = counts.get((z, context), (0, 0))
        estimate = ([a, b][bit] + 0.5) / (a + b + 1)
        if len(context) == depth:
            return estimate
        if a + b == 0:
            return 0.5
        stop = math.exp(math.log(0.5) + kt(a, b) - weighted(z, context))
        deeper = whole[len(whole) - len(context) - 1 :]
        return stop * estimate + (1 - stop) * probability(z, deeper, whole, bit)

    out, text = 0.0, pad + text
    for i in range(depth, len(text)):
        for z, bit in decisions(text[i]):
            out += math.log10(probability(z, b"", text[i - depth : i], bit))
    return out


def test_language_model_scores(spark, way):
    rows = [(i, t) for i, t in enumerate(["ab ab b", "Ab  ab\ta", None, "é a", "", "b", "abab", "a b", "ba ab a"])]
    rows += [(None, "ab"), (3, "é a")]
    got = lm_scoring.score_documents(C.frame(spark, rows)).collect()
    learned = [r for r in rows if not lm_scoring.held_out(r[0])]
    tokens = Counter(w for _, t in learned for w in [*C.words(C.lowered(t)), None])
    total, distinct = sum(tokens.values()), len(tokens)
    scored = lambda t: " ".join(C.words(C.lowered(t))).encode() + b"\n"
    training = [scored(t) for _, t in learned]
    expected = []
    for d, t in rows:
        own = [*C.words(C.lowered(t)), None]
        base = sum(math.log10((tokens[w] + 0.5) / (total + 0.5 * (distinct + 1))) for w in own)
        known = sum(tokens[w] > 0 for w in own)
        score = ctw_log10(training, scored(t), context_tree.DEPTH)
        expected.append((d, lm_scoring.held_out(d), len(own), known, total, base, score))
    for have, want in zip(as_rows(tuple(r[:7]) for r in got), as_rows(expected), strict=True):
        assert have[:5] == want[:5]
        assert have[5:] == pytest.approx(want[5:], rel=1e-5)


def test_sentencepiece(docs):
    library = sentencepiece.SentencePieceProcessor(model_file=sentencepiece_codec.default_path())
    coded = sentencepiece_codec.encode(docs)
    expected = []
    for d, text in ROWS:
        ids = library.encode(text or "")
        crc = zlib.crc32(np.array(ids, "<u4").tobytes())
        expected.append((d, None if text is None else str(ids), crc, None if text is None else library.decode(ids)))
    got = [(r["id"], None if r["ids"] is None else str(r["ids"]), r["ids_crc32"], r["decoded"]) for r in coded.collect()]
    assert as_rows(got) == as_rows(expected)
    assert rows_of(sentencepiece_codec.decode(coded), "id", "text") == rows_of(coded, "id", "decoded")


def test_viterbi_finds_the_best_path():
    pieces = ["a", "b", "c", "ab", "bc", "abc", "ca"]
    scores = [-3.0, -3.5, -2.0, -4.0, -4.5, -8.0, -3.2]
    codec = sentencepiece_codec.Codec(pieces, scores, {}, 0, merges=False)

    def best(text):
        if not text:
            return 0.0
        return max(
            (s + best(text[len(p) :]) for p, s in zip(pieces, scores, strict=True) if text.startswith(p)),
            default=-math.inf,
        )

    for text in ("abcabc", "caab", "bcaabca", "cccab"):
        path = codec.scored(text)
        assert "".join(pieces[i] for i in path) == text
        assert sum(scores[i] for i in path) == pytest.approx(best(text))


def _field(number, value):
    """A field of a protocol buffer: a number, a float or bytes."""
    if isinstance(value, int):
        return bytes([number << 3, value])
    if isinstance(value, float):
        return bytes([number << 3 | 5]) + np.float32(value).tobytes()
    size = len(value)
    head = [number << 3 | 2, size & 127 | 128, size >> 7] if size > 127 else [number << 3 | 2, size]
    return bytes(head) + value


def _model(pieces, kind, byte_fallback):
    """A model file of (string, score), written by hand."""
    special = [("<unk>", 0.0, 2), ("<s>", 0.0, 3), ("</s>", 0.0, 3)]
    raw = [(f"<0x{b:02X}>", 0.0, 6) for b in range(256)] if byte_fallback else []
    own = [(p, s, 1) for p, s in pieces]
    out = b"".join(
        _field(1, _field(1, p.encode()) + _field(2, s) + _field(3, t)) for p, s, t in [*special, *raw, *own]
    )
    trainer = _field(3, kind) + (bytes([35 << 3 & 127 | 128, 35 >> 4, 1]) if byte_fallback else b"")
    normalizer = _field(1, b"identity") + _field(3, 1) + _field(4, 0) + _field(5, 1)
    return out + _field(2, trainer) + _field(3, normalizer)


@pytest.mark.parametrize("byte_fallback", [False, True])
def test_models_of_scored_pieces(spark, tmp_path, byte_fallback):
    rng = np.random.default_rng(8)
    letters = "abcdeé"
    strings = {"".join(rng.choice(list(letters), rng.integers(2, 5))) for _ in range(60)}
    strings |= {"▁" + s for s in list(strings)[:25]} | {"▁", *letters[:-1], "xé", "▁▁"}
    pieces = [(s, float(np.float32(-rng.uniform(2, 12)))) for s in sorted(strings)]
    path = tmp_path / "scored.model"
    path.write_bytes(_model(pieces, sentencepiece_codec.UNIGRAM, byte_fallback))
    library = sentencepiece.SentencePieceProcessor(model_file=str(path))
    texts = ["".join(rng.choice(list("abcdeéxz  ü"), rng.integers(0, 40))) for _ in range(300)]
    texts += ["", " ", "zz", "züz a", "é", "xéé", "  a  b ", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["id"]: r["ids"] for r in sentencepiece_codec.encode(docs, path=str(path)).collect()}
    assert got == {i: None if t is None else library.encode(t) for i, t in enumerate(texts)}


def test_other_kinds_of_models_are_refused(spark, tmp_path):
    path = tmp_path / "words.model"
    path.write_bytes(_model([("▁a", -1.0)], 3, False))
    docs = spark.createDataFrame([], "doc_id long, text string")
    with pytest.raises(ValueError, match="neither"):
        sentencepiece_codec.encode(docs, path=str(path))
    assert sentencepiece_codec.merging(sentencepiece_codec.default_path())


def test_empty_tables(empty, spark):
    for result in (
        token_counts.count_tokens(empty),
        quality_rules.ledger(empty),
        quality_rules.keep_good(empty),
        jaccard_join.jaccard_components(empty),
        jaccard_join.keep_one_of_each_component(empty),
        substring_dedup.remove_repeated_windows(empty),
        suffix_dedup.remove_repeated_bytes(empty),
        suffix_dedup.without_repeated_bytes(empty),
        sharding.shard_documents(empty),
        packing.pack(empty),
        lm_scoring.score_documents(empty),
        sentencepiece_codec.encode(empty),
        hamming_topk.top_k(
            spark.createDataFrame([], "vec_id long, embedding array<float>"), F.col("vec_id") % 50 == 0
        ),
    ):
        assert result.collect() == []


@pytest.mark.parametrize("name", list(ORACLE))
def test_query_matches_sql(spark, name):
    assert_same(QUERIES[name](spark, SF_DIR), duck(SF_DIR), ORACLE[name])


def test_registered():
    names = registry.queries().keys()
    assert {*QUERIES, "pipeline"} <= names
    assert all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 14))


def test_pipeline_on_awkward_rows(spark, docs):
    """Each stage takes all its predecessor kept, and the columns stay."""
    plain = docs.select("doc_id", "text").withColumns(
        {"lang": F.lit("en"), "source": F.lit("s"), "n_chars": F.length("text").cast("long")}
    )
    kept = plain
    for _, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, kept, SF_DIR)
        assert kept.columns == plain.columns
        assert kept.where("n_chars <> length(text)").count() == 0
    good = [(d, t) for d, t in ROWS if _good(t)]
    groups = {c for _, _, c in C.jaccard_components(list(enumerate(t for _, t in good)), 5, 80)}
    assert corpus_pipeline.STAGES[1][1](spark, corpus_pipeline.quality(spark, plain, SF_DIR), SF_DIR).count() == len(groups)
    packed = corpus_pipeline.packed(spark, kept, SF_DIR)
    assert packed.select("doc_id").distinct().count() == kept.select("doc_id").distinct().count()


def _good(text):
    n, chars, symbols, dup, again = C.quality(text)
    lines = sum(bool(C.words(line)) for line in (text or "").split("\n"))
    return not (
        n < 50
        or 100 * again > 50 * n
        or chars < 2 * n
        or chars > 20 * n
        or 10 * symbols > n
        or (dup >= 3 and 100 * dup > 30 * lines)
    )


def test_pipeline_runs(spark):
    assert corpus_pipeline.run(spark, SF_DIR).count() > 0
