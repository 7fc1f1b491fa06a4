"""Columns of any name through the pipeline's stages, and a language model that does not depend on the number of tasks."""

import gc
import tracemalloc

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tillmark.llm import decontamination, language_model, personal_data, pieces

NAMES = ["doc_id", "text", "tm_text", "tm_email", "a.b", "TM_Key", "tm_spans", "tmu_0", "n_chars"]


@pytest.fixture(scope="module")
def odd_names(spark):
    texts = ["write to me@example.org now", None, "", "eins zwei drei vier fuenf sechs sieben acht neun zehn elf zwoelf dreizehn und mehr"]
    rows = [(i, t, "x", i, "y", "z", 1.5, [i], len(t or "")) for i, t in enumerate(texts)]
    schema = "doc_id bigint, text string, tm_text string, tm_email int, `a.b` string, TM_Key string, tm_spans double, tmu_0 array<int>, n_chars bigint"
    return spark.createDataFrame(rows, schema)


def untouched(df):
    kept = [c for c in NAMES if c not in ("text", "n_chars")]
    return sorted(tuple(map(str, r)) for r in df.select(*[F.col(f"`{c}`") for c in kept]).collect())


def test_redact_keeps_columns_of_any_name(odd_names):
    redacted = personal_data.redact(odd_names)
    assert redacted.columns == NAMES and untouched(redacted) == untouched(odd_names)
    assert {r["doc_id"]: r["text"] for r in redacted.collect()}[0] == "write to <EMAIL> now"


@pytest.mark.parametrize("words", [200_000, 12])
def test_decontaminate_keeps_columns_of_any_name(spark, odd_names, monkeypatch, words):
    monkeypatch.setattr(decontamination, "MAX_ITEM_WORDS", words)
    items = spark.createDataFrame([("a", "nothing of this is in any document at all, not one line"), ("b", "nor is this")], "item_id string, text string")
    clean = decontamination.decontaminate(odd_names, items)
    assert clean.columns == NAMES and untouched(clean) == untouched(odd_names)


def test_pieces_leave_the_collector_as_it_was(spark, odd_names):
    pieces.encode_documents(odd_names).collect()

    def state(batches):
        import pyarrow as pa

        yield pa.RecordBatch.from_arrays([pa.array([gc.isenabled()])], ["on"])

    assert all(r["on"] for r in spark.range(8).repartition(4).mapInArrow(state, "on boolean").collect())


def test_model_does_not_depend_on_the_number_of_partitions(spark, small):
    docs = spark.read.parquet(f"{small.replace('0.001', '0.01')}/documents.parquet").select("doc_id", "text")
    reached = []
    for parts in (1, 24):
        scored = language_model.score_documents(docs.repartition(parts)).where("held_out")
        row = scored.agg((F.sum("score") / F.sum("n_tokens")).alias("model"), (F.sum("base_score") / F.sum("n_tokens")).alias("base")).first()
        assert row["model"] > row["base"] + 0.05
        reached.append(row["model"])
    assert abs(reached[0] - reached[1]) < 0.05


def test_pieces_met_again_are_not_searched_again():
    """Words that come back outlive those met once; word round trips need no byte by byte decoding."""
    model, known = pieces.PieceModel(), {}
    common = [f"again{i}" for i in range(200)]
    searched, plain = [], model.encode_words

    def counted(words):
        words = list(words)
        searched.extend(words)
        return plain(words)

    model.encode_words = counted
    for k in range(6):
        texts = [" ".join(common), " ".join(f"once{k}x{i}" for i in range(60_000))]
        new = model.learn([model.marked(t) for t in texts], known)
        assert all(model.decodes_to(word, ids) for word, ids in list(new.items())[::500])
        assert len(known) <= pieces.REMEMBERED + 60_200
    assert len(searched) == 6 * 60_000 + 200
    for word in ("▁日本\x07語", "▁<0x41>", "▁a"):
        ids = plain([word])[word]
        assert model.decodes_to(word, ids) and model.decode(ids, inside=True) == word.replace("▁", " ")
        assert not model.decodes_to(word + "b", ids) and not model.decodes_to("▁", ids)


def test_pieces_of_many_words_take_little_memory(spark):
    """The words of a task are given up in time: a task over 400,000 distinct words holds a bounded part of them."""
    class Captured:
        def select(self, *names):
            return self

        def mapInArrow(self, run, schema):
            return run

    texts = [" ".join(f"w{i:x}q{j:x}" for j in range(2000)) for i in range(200)]
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(200)), "text": texts})
    run = pieces.encode_documents(Captured())
    tracemalloc.start()
    try:
        rows = sum(out.num_rows for out in run([batch]))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert rows == 200 and peak < 100e6
