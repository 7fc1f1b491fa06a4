"""Hard negatives, source divergence and byte-level BPE against plain Python versions and the tokenizer library."""

import collections
import hashlib
import math
import random
import re

import numpy as np
import pyarrow as pa
import pytest
import public_tokenizers
import tiktoken
from pyspark.sql import functions as F

from tillmark.llm import byte_bpe, divergence, hard_negatives

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN


# ------------------------------------------------------------------ hard negatives


def negatives_by_brute_force(rows, positives=5, negatives=5):
    """rows: (vec_id, label, ints) that take part."""
    found = []
    for anchor, label, query in rows:
        if anchor % 100:
            continue
        scored = [(-sum(a * b for a, b in zip(query, v)), i, other) for i, other, v in rows if i != anchor]
        best = sorted(x for x in scored if x[2] == label)[:positives]
        for minus, positive, _ in best:
            fit = sorted(x for x in scored if x[2] != label and -100 * x[0] >= -80 * minus and x[0] >= minus)[:negatives]
            found += [(anchor, positive, k + 1, i, -minus, -s) for k, (s, i, _) in enumerate(fit)]
    return sorted(found)


def mined(spark, rows, schema="vec_id bigint, label int, embedding array<float>, anchor string, tm_x int", **sizes):
    table = spark.createDataFrame(rows, schema).repartition(3)
    vectors = hard_negatives.whole_vectors(table)
    return sorted(tuple(r) for r in hard_negatives.mine(vectors, F.col("vec_id") % 100 == 0, **sizes).collect())


def whole(rows):
    sound = [r for r in rows if None not in r[:3] and all(x is not None and math.isfinite(x) for x in r[2])]
    return [(i, label, [math.floor(256 * float(np.float32(x))) for x in v]) for i, label, v, *_ in sound]


def random_rows(count, dims, labels, seed, spread=1.0):
    draw = random.Random(seed)
    middle = [[draw.gauss(0, spread) for _ in range(dims)] for _ in range(labels)]
    return [
        (i * 10, label, [float(np.float32(draw.gauss(m, 1) / 8)) for m in middle[label]], "x", 1)
        for i in range(count) for label in [draw.randrange(labels)]
    ]


@pytest.mark.parametrize(("dims", "spread", "sizes"), [
    (64, 0.5, {}), (3, 1.0, {"row_block": 16, "anchor_block": 4, "seed_rows": 10}), (70, 0.3, {"row_block": 50, "seed_rows": 200}),
])
def test_negatives_equal_brute_force(spark, dims, spread, sizes):
    rows = random_rows(300, dims, 4, dims, spread)
    found = mined(spark, rows, **sizes)
    assert found == negatives_by_brute_force(whole(rows)) and found


def test_negatives_of_odd_rows(spark):
    rows = random_rows(120, 5, 3, 1)
    rows += [
        (None, 1, [1.0] * 5, "x", 1), (7, None, [1.0] * 5, "x", 1), (8, 1, None, "x", 1), (9, 1, [1.0, None, 0.0, 0.0, 0.0], "x", 1),
        (11, 1, [float("nan")] * 5, "x", 1), (12, 1, [float("inf")] * 5, "x", 1), (13, 2, [], "x", 1), (14, 2, [0.5], "x", 1),
        (3000, 77, [0.25] * 5, "x", 1),  # alone in its label
        (3100, 78, [0.25] * 5, "x", 1), (3101, 78, [-0.25] * 5, "x", 1),  # a positive below zero has an empty window
        (15, 0, [0.125] * 5, "x", 1), (16, 0, [0.125] * 5, "x", 1), (17, 1, [0.125] * 5, "x", 1), (18, 1, [0.125] * 5, "x", 1),
        (900_000, 1, [0.0] * 5, "x", 1),  # scores nothing with all rows
    ]
    assert mined(spark, rows, row_block=32, seed_rows=16) == negatives_by_brute_force(whole(rows))


def test_negatives_of_repeated_rows_and_large_components(spark):
    rows = random_rows(60, 4, 2, 5)
    rows += [rows[3], rows[4], rows[4]]
    found = mined(spark, rows)
    assert found == negatives_by_brute_force(whole(rows))
    large = [(i, label, [x * 1e7 for x in v], a, b) for i, label, v, a, b in random_rows(80, 4, 2, 6)]
    assert mined(spark, large) == negatives_by_brute_force(whole(large))
    with pytest.raises(ValueError):
        mined(spark, [(100, 1, [1e12], "x", 1), (1, 1, [1e12], "x", 1)])


def test_negatives_of_no_rows(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(1, 1, [1.0], "x", 1)]) == []


def test_posting_lists_leave_out_covered_dimensions():
    rows = pa.table({
        "vec_id": pa.array([1, 2], pa.int64()), "label": pa.array([0, 0], pa.int64()),
        "ints": pa.array([[1] * 32 + [90] * 32, [90] * 64], pa.list_(pa.int16())), "norm": [math.hypot(*[1] * 32, *[90] * 32), math.hypot(*[90] * 64)],
    })
    index = hard_negatives.Index(rows, 100.0)
    parts = {left_out: list(members) for left_out, members, _ in index.lists(5000)}
    assert parts == {32: [0], 0: [1]}
    assert [left_out for left_out, _, _ in index.lists(-5)] == [0]


# -------------------------------------------------------------- source divergence


TERM = re.compile("[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+")


def fold_ascii(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def divergence_by_brute_force(rows, min_documents, most=50):
    counts, holders, groups = collections.defaultdict(collections.Counter), collections.defaultdict(collections.Counter), set()
    for text, lang, source in rows:
        words = TERM.findall(fold_ascii(text or ""))
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        counts[lang, source].update(words)
        holders[lang].update(set(words))
    found = []
    for lang in {g[0] for g in groups}:
        kept = [t for t, n in holders[lang].items() if n >= min_documents]
        sources = sorted(s for x, s in groups if x == lang)

        def shares(counter):
            total = sum(counter[t] for t in kept)
            return {t: 1 + 10**9 * (counter[t] + 5) // (total + 5 * len(kept)) for t in kept}

        p = {s: shares(counts[lang, s]) for s in sources}
        q = shares(sum((counts[lang, s] for s in sources), collections.Counter()))
        for s in sources:
            pairs = [(-sum(abs(p[s][t] - p[o][t]) for t in kept), o.encode()) for o in sources if o != s]
            terms = [(q[t] - p[s][t], t.encode()) for t in kept if counts[lang, s][t] and p[s][t] > q[t]]
            for part, items in (("pair", sorted(pairs)), ("term", sorted(terms)[:most])):
                found += [(lang, s, part, i.decode(), -v, k + 1) for k, (v, i) in enumerate(items)]
    return sorted(found)


def audited(spark, rows, min_documents, **sizes):
    table = spark.createDataFrame([(*r, 1, "x") for r in rows], "text string, lang string, source string, term int, n string").repartition(3)
    return sorted(tuple(r) for r in divergence.divergence(table, min_documents, **sizes).collect())


@pytest.mark.parametrize("tree_items", [200_000, 7])
def test_divergence_equals_brute_force(spark, tree_items):
    draw = random.Random(3)
    words = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(90)] + ["Été", "été", "日本", "don't", "A1b"]
    rows = [
        (" ".join(draw.choices(words, [1 / (k + 1) for k in range(len(words))], k=draw.randrange(40))), draw.choice(["en", "de", None]), f"s{draw.randrange(7)}")
        for _ in range(400)
    ]
    rows += [(None, "en", "only null"), ("", None, None), ("12 .. !", "xx", "a"), ("\x7f\u0080 é", "xx", "b"), ("x" * 50_000 + " " + "wa " * 3000, "en", "s1")]
    rows += [("same rows", "yy", "one")] * 20
    assert audited(spark, rows, 10, tree_items=tree_items) == divergence_by_brute_force(rows, 10)


def test_divergence_without_rows_or_terms(spark):
    assert audited(spark, [], 2) == []
    assert audited(spark, [("a b", "en", "s"), ("c", "en", "t")], 2) == [("en", "s", "pair", "t", 0, 1), ("en", "t", "pair", "s", 0, 1)]


def test_shares_are_exact_beyond_64_bits(spark):
    row = spark.range(1).select(
        divergence.share(F.lit(10**13), F.lit(3 * 10**13), F.lit(10**7)).alias("p"), divergence.share(F.lit(0), F.lit(10**15), F.lit(7)).alias("z")
    ).first()
    assert row["p"] == 1 + 10**9 * (10**13 + 5) // (3 * 10**13 + 5 * 10**7) and row["z"] == 1


# ------------------------------------------------------------------ byte-level BPE


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=byte_bpe.read_ranks(RANKS), special_tokens={})


@pytest.fixture(scope="module")
def codec():
    ranks = byte_bpe.read_ranks(RANKS)
    return byte_bpe.Codec(ranks, byte_bpe.merge_table(ranks), PATTERN)


def odd_texts():
    draw = random.Random(11)
    letters = "abcdefghijklmnopqrstuvwxyz"
    yield from ["", " ", "  a", "a  ", "a\n \nb", "it's  don't\t\tx we'LL", "a\x1cb\x1d c\x00d", "x\u2028y\xa0z\u3000 q", "<|endoftext|>", "١٢٣ Ⅷ½ ²³"]
    yield from ["a" * 5000, "…" * 3000, " " * 4000, "=-" * 2000, "é" * 3001, "日本語のテキスト" * 300, "😀" * 900, "a" + "…" * 1500 + "b"]
    yield "".join(draw.choice(letters) for _ in range(5000))
    for _ in range(60):
        yield "".join(draw.choice(letters + letters.upper() + "    \n\t.,;'\"-_é日😀0123456789") for _ in range(draw.randrange(400)))


def test_ids_equal_the_library(codec, library):
    texts = list(odd_texts())
    for text, ids, decoded in zip(texts, codec.encode(texts), codec.decode([np.frombuffer(x, np.int32) for x in codec.encode(texts)])):
        assert np.frombuffer(ids, np.int32).tolist() == library.encode_ordinary(text)
        assert decoded == text.encode()


def test_window_by_window_equals_the_library(codec, library):
    for text in ("…" * 700, "ab" * 900, "z" * 1300, "日本語" * 300):
        assert codec._encode_in_order(text.encode()).tolist() == library._encode_single_piece(text.encode())


def test_words_of_any_size_are_contracted(codec, library):
    draw = random.Random(5)
    words = ["".join(draw.choice("aeinst") for _ in range(size)).encode() for size in (2, 40, 1023, 1024, 3000)]
    assert [np.frombuffer(ids, np.int32).tolist() for ids in codec.contract(words)] == [library._encode_single_piece(w) for w in words]


def test_parts_are_cut_before_runs_of_white_space_only(codec, library):
    texts = ["a\u3000 b", "a\u3000\n\nb", "é x à y", "a\x85\tb", " ", "", "  a b", "c\u2009 \u2009 d  ", "\xa0 \xa0\n e", "a \u3000b"]
    raw = [t.encode() for t in texts]
    cuts, whole = byte_bpe._cuts(raw), b"".join(raw).decode()
    assert [whole.encode()[i:j].decode() for i, j in zip(cuts, cuts[1:])] == [
        "a\u3000 b", "a\u3000\n\nb", "é", " x", " à", " y", "a\x85\tb", " ", "  a", " b", "c\u2009 \u2009 d", "  ", "\xa0 \xa0\n e", "a", " \u3000b",
    ]
    assert [np.frombuffer(ids, np.int32).tolist() for ids in codec.encode(texts)] == [library.encode_ordinary(t) for t in texts]


def test_distinct_parts_meet_the_pattern_once_and_outlive_a_full_memory(library, monkeypatch):
    ranks = byte_bpe.read_ranks(RANKS)
    codec = byte_bpe.Codec(ranks, byte_bpe.merge_table(ranks), PATTERN)
    plain, seen = codec.pattern, []

    class Counted:
        def findall(self, part):
            seen.append(part)
            return plain.findall(part)

    codec.pattern = Counted()
    monkeypatch.setattr(byte_bpe, "REMEMBERED", 3)
    for text in ("one two six two two", "one two", "one two ten", "one two"):
        assert np.frombuffer(codec.encode([text])[0], np.int32).tolist() == library.encode_ordinary(text)
    assert seen == ["one", " two", " six", " ten"]


def test_whole_table(spark, small, library):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    found = {r["doc_id"]: r for r in byte_bpe.digests(byte_bpe.round_trips(docs, RANKS, PATTERN)).collect()}
    assert len(found) == len(texts)
    for doc_id, text in texts.items():
        ids = library.encode_ordinary(text)
        row = found[doc_id]
        assert row["n_tokens"] == len(ids) and row["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()
        assert row["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()


def test_rows_of_every_kind(spark, library):
    rows = [(1, None, 5, "a"), (None, "two words", 5, "b"), (3, "", 5, "c"), (4, "same", 5, "d"), (4, "same", 5, "d")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, ids int, decoded string").repartition(2)
    encoded = byte_bpe.encode_documents(docs, RANKS, PATTERN)
    found = sorted(((r["doc_id"], r["ids"], bytes(r["decoded"])) for r in byte_bpe.decode_documents(encoded, RANKS).collect()), key=str)
    assert found == sorted(((i, library.encode_ordinary(t or ""), (t or "").encode()) for i, t, *_ in rows), key=str)
    assert byte_bpe.round_trips(docs.limit(0), RANKS, PATTERN).count() == 0


def test_unknown_and_null_ids_are_refused(codec, spark):
    with pytest.raises(ValueError):
        codec.decode([np.array([60_000])])
    with pytest.raises(Exception, match="null"):
        byte_bpe.decode_documents(spark.createDataFrame([(1, [5, None])], "doc_id bigint, ids array<int>"), RANKS).collect()
