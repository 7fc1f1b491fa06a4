import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from helpers import duplicate_classes, shingle_set

from tillmark.llm import near_duplicates as nd
from tillmark.llm.components import components


def result(df):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in df.collect()}


def word(random_):
    return "".join(random_.choice("abcdefgh") for _ in range(3))


@pytest.fixture(scope="module")
def texts():
    """Near copies at every distance, chains, a shared passage, and defined edge cases."""
    rnd = random.Random(5)
    rows, passage = [], [word(rnd) for _ in range(40)]
    for _ in range(12):
        base = [word(rnd) for _ in range(rnd.choice((6, 30, 120)))]
        rows.append(" ".join(base))
        for _ in range(12):  # each copy changes its predecessor, so chains drift away from the first
            base = list(base)
            for _ in range(rnd.randint(0, 3)):
                base[rnd.randrange(len(base))] = word(rnd)
            rows.append(" ".join(base))
    rows += [" ".join(passage + [word(rnd) for _ in range(11)]) for _ in range(60)]
    rows += ["A b C", "a\tB c", "a b", "", " \n", None, "x " * 3000, "X " * 4000, "one word"]
    rnd.shuffle(rows)
    return list(enumerate(rows))


def test_classes_equal_brute_force(spark, texts):
    docs = spark.createDataFrame(texts, "doc_id bigint, text string").repartition(3)
    assert result(nd.near_duplicates(docs)) == duplicate_classes(texts)


def test_whole_small_table_equals_brute_force(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    expected = duplicate_classes([(r["doc_id"], r["text"]) for r in docs.collect()])
    assert result(nd.near_duplicates(docs)) == expected


def test_salted_lists_lose_no_link(spark, texts, monkeypatch):
    monkeypatch.setattr(nd, "SALT_ABOVE", 0)
    real = nd.np.ceil
    monkeypatch.setattr(nd.np, "ceil", lambda x: real(x * 300))  # many parts although the counts are small
    docs = spark.createDataFrame(texts, "doc_id bigint, text string")
    assert result(nd.near_duplicates(docs)) == duplicate_classes(texts)


def test_prefixes_follow_exact_frequency(spark, texts, monkeypatch):
    """Rows of the shared prefix shingles against plain counting, for bucketed and for hot cells."""
    docs = spark.createDataFrame(texts, "doc_id bigint, text string").repartition(3)
    sets = {nd._set_key(s): s for s in (nd.shingles((t or "").encode()) for _, t in texts) if len(s)}
    cells = np.zeros(nd.FREQUENCY_CELLS, np.int64)
    for found in sets.values():
        cells += np.bincount(nd._cell(found), minlength=nd.FREQUENCY_CELLS)
    values, counts = np.unique(np.concatenate(list(sets.values())), return_counts=True)
    held = dict(zip(values.tolist(), counts.tolist()))
    for hot in (False, True):
        if hot:
            monkeypatch.setattr(nd, "HOT_LEAST", 1.0)
        limit = nd._hot_limit(cells)
        expected = set()
        for key, found in sets.items():
            cell = cells[nd._cell(found)]
            rank = [(c if c > limit else held[s], s) for s, c in zip(found.tolist(), cell.tolist())]
            for place, (count, s) in enumerate(sorted(rank)[: nd.prefix_size(len(found), 75)], 1):
                if count > 1:
                    expected.add((int(np.uint64(s).view(np.int64)), key, len(found), place))
        rows = nd.shared_prefixes(docs, 5, 75, cells).select("token", "class", "n", "place").collect()
        assert len(rows) == len(expected) and {tuple(r) for r in rows} == expected


def test_empty_table_and_null_ids(spark):
    assert nd.near_duplicates(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0
    rows = [(None, "a b c d e f"), (7, "x y z"), (7, "x y z")]
    found = nd.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert sorted(map(str, found)) == sorted(
        map(str, [type(found[0])(doc_id=None, n_shingles=2, component_id=None)] + 2 * [type(found[0])(doc_id=7, n_shingles=1, component_id=7)])
    )


def test_rows_that_share_an_id_keep_their_own_texts(spark):
    base = [f"w{i}" for i in range(40)]
    rows = [(1, " ".join(base)), (1, " ".join(reversed(base))), (1, " ".join(base)), (2, " ".join(base + ["more"]))]
    found = nd.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in found) == [(1, 36, 1)] * 3 + [(2, 37, 1)]


def test_keep_one_keeps_columns_and_reduces_repeats(spark):
    rows = [(3, "a b c d e f g", 1), (1, "a b c d e f g", 2), (9, "", 3), (9, "", 3), (4, None, 4)]
    kept = nd.keep_one(spark.createDataFrame(rows, "doc_id bigint, text string, class int"))
    assert kept.columns == ["doc_id", "text", "class"]
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 4, 9]


def test_keep_one_of_rows_without_ids_and_with_repeated_ids(spark):
    base = [f"w{i}" for i in range(40)]
    copy, near, other = " ".join(base), " ".join(base + ["more"]), " ".join(reversed(base))
    rows = [
        (None, copy, 1), (5, copy, 2), (6, near, 3), (None, "only without an id here", 4), (None, "only without an id here", 5),
        (7, other, 6), (7, "another text under the same id", 7), (None, None, 8), (None, "", 9), (8, "", 10), (8, "", 11),
    ]
    kept = nd.keep_one(spark.createDataFrame(rows, "doc_id bigint, text string, tm_key int"))
    assert kept.columns == ["doc_id", "text", "tm_key"]
    found = [(r["doc_id"], r["text"], r["tm_key"]) for r in kept.collect()]
    assert {x[2] for x in found} - {4, 5, 10, 11} == {2, 6, 7, 8, 9}
    assert len(found) == 7 and len({x[:2] for x in found}) == 7


def test_keep_one_of_an_empty_table(spark):
    assert nd.keep_one(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0


def test_suffix_filter_is_a_lower_bound():
    rnd = np.random.default_rng(3)
    for _ in range(300):
        x, y = (np.unique(rnd.integers(0, 60, rnd.integers(0, 40)).astype(np.uint64)) for _ in "xy")
        assert nd.distance_floor(x, y) <= len(np.setxor1d(x, y))


def test_components_of_a_long_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(5, i) for i in range(6, 40)] + [(70, 70)]
    found = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert found == {**{i: 100 for i in range(100, 161)}, **{i: 5 for i in range(5, 40)}}


def test_shingles_are_sets_of_windows():
    text = "The the THE a b c the the the a b"
    assert len(nd.shingles(text.encode())) == len(shingle_set(text))


def test_links_only_span_the_classes(spark, texts):
    join = nd.JaccardJoin(spark.createDataFrame(texts, "doc_id bigint, text string"))
    assert not hasattr(join, "links")
    edges = join.spanning_links.select("a", "b")
    roots = {r["node"]: r["root"] for r in components(edges).collect()}
    first = {r["class"]: r["first_id"] for r in join.classes.collect()}
    lowest = {}
    for key, i in first.items():
        root = roots.get(key, key)
        lowest[root] = min(i, lowest.get(root, i))
    expected = duplicate_classes(texts)
    assert all(expected[i][1] == lowest[roots.get(key, key)] for key, i in first.items())


def test_unlinked_copies_meet_once_and_not_per_shared_shingle(spark, monkeypatch):
    """Copies that differ too much share many prefix shingles; the last join must not make a row for each of those."""
    rnd = random.Random(3)
    base = [word(rnd) for _ in range(160)]
    rows = []
    for number in range(60):
        copy = list(base)
        for at in rnd.sample(range(160), 3):
            copy[at] = f"{number}.{at}"
        rows.append((number, " ".join(copy)))
    made = []

    def counted(join, find=nd.JaccardJoin._open_matches):
        found = find(join)
        made.append((found.count(), found.distinct().count()))
        return found

    monkeypatch.setattr(nd, "HUB_ROUNDS", 0)
    monkeypatch.setattr(nd.JaccardJoin, "_open_matches", counted)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert result(nd.near_duplicates(docs)) == duplicate_classes(rows)
    (matches, pairs), = made
    assert pairs > 50 and matches < 5 * pairs


def test_a_full_bucket_takes_little_memory():
    size = nd.BUCKET_ROWS
    token = np.random.default_rng(1).integers(0, 2**63, size // 2, dtype=np.uint64)
    columns = [np.tile(token, 2), np.repeat(np.arange(2), size // 2), np.full(size, 9, np.int32)]
    rows = pa.table({"part": [0]} | {c: pa.array([x.tobytes()], pa.binary()) for c, x in zip(("token", "class", "n"), columns)})
    tracemalloc.start()
    try:
        found = nd._count_bucket(np.ones(nd.FREQUENCY_CELLS), 8)(rows)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert sum(len(x) for x in found.column("hits").to_pylist()) == 8 * size and peak < 100e6


def test_sizes_of_sets_travel_once_for_each_class():
    """A bucket row takes 16 bytes a shingle; the size of a set is not repeated with its shingles."""
    texts = [" ".join(f"w{i}x{j}" for j in range(300)) for i in range(20)] + [None, "", "a b"]
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(len(texts))), "text": texts})
    cells = np.zeros(nd.FREQUENCY_CELLS, np.int64)
    for out in (nd._scan_buckets(5, cells, 8), nd._scan_buckets(5, cells + 2000 * (np.arange(len(cells)) < 50), 8)):
        rows = pa.Table.from_batches(list(out([batch])))
        sent = sum(len(x) for name in rows.column_names[1:] for x in rows.column(name).to_pylist())
        assert sent == 16 * (20 * 296 + 1) + 12 * 21
        sized = np.frombuffer(b"".join(rows.column("sized").to_pylist()), np.int64)
        n = np.frombuffer(b"".join(rows.column("n").to_pylist()), np.int32)
        assert dict(zip(sized.tolist(), n.tolist())) == {nd._set_key(s): len(s) for s in (nd.shingles((t or "").encode()) for t in texts) if len(s)}
