"""What a task of the piece encoder holds besides its batch of rows."""

from __future__ import annotations

import random
import tracemalloc

import pyarrow as pa
import sentencepiece

from rowbridge.llm import pieces, queries


def _task(spark, monkeypatch):
    """The function that encodes the batches of one task, outside of Spark."""
    docs = spark.createDataFrame([], "text string, doc_id long")
    monkeypatch.setattr(type(docs), "mapInArrow", lambda self, run, schema: run)
    return pieces.encode(docs, pieces.load(queries.piece_model()), decoded="decoded")


def _batch(texts: list[str | None]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(texts, pa.string()), pa.array(range(len(texts)))], names=["__text", "doc_id"])


def test_a_batch_is_encoded_in_small_groups(spark, monkeypatch):
    rng = random.Random(3)
    words = ["".join(rng.choices("abcdefghij", k=7)) for _ in range(20_000)]
    texts = [" ".join(rng.choices(words, k=200)) for _ in range(1500)]
    run, batch = _task(spark, monkeypatch), _batch(texts)
    tracemalloc.start()
    n = sum(made.num_rows for made in run([batch]))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert n == len(texts)
    assert peak < 16_000_000, f"{peak} bytes of Python objects for {batch.nbytes} bytes of rows"


def test_rows_keep_their_ids_across_groups(spark, monkeypatch, texts):
    monkeypatch.setattr(pieces, "GROUP_BYTES", 3000)
    monkeypatch.setattr(pieces, "TABLE_ENTRIES", 50)
    library = sentencepiece.SentencePieceProcessor(model_file=queries.piece_model())
    task = _task(spark, monkeypatch)
    made = [*task([_batch(texts[:9]), _batch([]), _batch(texts[9:])])]
    got = pa.Table.from_batches(made).to_pylist()
    assert len(made) > 3 and len(got) == len(texts)
    for r, text in zip(got, texts, strict=True):
        assert r["ids"] == [*library.encode(text or ""), library.eos_id()]
        assert r["decoded"] == library.decode(r["ids"])


def test_schedules_of_a_mix_need_no_python_worker(spark):
    from rowbridge.llm import mixing

    made = mixing.schedules(spark, [[(0.0, 3.0), (0.5, 1.0), (1, 0)], [(0, 1), (1, 2)]])
    assert "ExistingRDD" not in made._jdf.queryExecution().executedPlan().toString()
    assert [(r.turn, [tuple(s) for s in r.knots], r.integral) for r in made.orderBy("turn").collect()] == [
        (0, [(0.0, 3.0, -4.0, 0.0, 1.0), (0.5, 1.0, -2.0, 1.0, 0.25)], 1.25),
        (1, [(0.0, 1.0, 1.0, 0.0, 1.5)], 1.5),
    ]
    assert made.dtypes == [
        ("turn", "int"), ("knots", "array<struct<x0:double,w0:double,slope:double,before:double,area:double>>"), ("integral", "double")
    ]
