from __future__ import annotations

import sys
import types

import pytest
from pyspark.sql import functions as F

from rowbridge.operators.transforms import apply_chain, register, register_batches


def step(name, **parameter):
    return {"name": name, "parameter": parameter}


def rows(df):
    return [tuple(r) for r in df.orderBy("id").collect()]


def test_trim_strips_control_characters(spark):
    df = spark.createDataFrame([("1", " \t\x00Ødegård\x1f\n"), ("2", "　x　"), ("3", None)], "id string, name string")
    assert rows(apply_chain(df, [step("trim", columnIndex=[1, 3])])) == [("1", "Ødegård"), ("2", "　x　"), ("3", None)]


def test_replace_is_literal(three):
    out = apply_chain(three, [step("replace", columnIndex=[1], oldValue="Ødegård", newValue="Solveig")])
    assert [r.name for r in out.orderBy("id").collect()] == ["Solveig", "Šárka", "Ng Wei"]
    dots = apply_chain(three, [step("replace", columnIndex=[3], oldValue=".", newValue="")])
    assert dots.where("id = '2'").head().badge == "east4@gateexample"
    assert apply_chain(three, [step("replace", columnIndex=[1], oldValue="x")]) is three
    with pytest.raises(ValueError):
        apply_chain(three, [step("replace", oldValue="", newValue="x")])


@pytest.mark.parametrize(
    "op, value, kept",
    [
        ("=", "172", ["2"]),
        ("!=", "172", ["1", "3"]),
        (">", "172", ["3"]),
        ("<", "172", ["1"]),
        (">=", "172", ["2", "3"]),
        ("<=", 172, ["1", "2"]),
        (">", "old", []),
        (">", "NaN", []),
    ],
)
def test_filter(three, op, value, kept):
    out = apply_chain(three, [step("filter", columnIndex=[2], op=op, value=value)])
    assert [r.id for r in out.orderBy("id").collect()] == kept


def test_filter_edges(spark, three):
    df = spark.createDataFrame([("1", "NaN"), ("2", None), ("3", " 7 "), ("4", "abc")], "id string, v string")
    kept = lambda **p: [r.id for r in apply_chain(df, [step("filter", **p)]).orderBy("id").collect()]
    assert kept(columnIndex=[1], op=">", value="1") == ["3"]
    assert kept(columnIndex=1, op="!=", value="abc") == ["1", "2", "3"]
    assert kept(columnIndex="1", op="=", value="abc") == ["4"]
    assert kept(op="=", value="abc") == ["1", "2", "3", "4"]
    assert kept(columnIndex=[9], op="=", value="abc") == ["1", "2", "3", "4"]
    # The smallest index decides, not the first listed.
    assert kept(columnIndex=[1, 0], op="=", value="4") == ["4"]
    with pytest.raises(ValueError):
        kept(columnIndex=[1], op="like", value="a")


def test_dateformat(three):
    change = dict(columnIndex=[4], fromFormat="yyyy-MM-dd HH:mm:ss", toFormat="yyyyMMddHHmmss")
    odd = three.withColumn("entered", F.when(F.col("id") == "2", "soon").otherwise(F.col("entered")))
    out = apply_chain(odd, [step("dateformat", **change)])
    assert [r.entered for r in out.orderBy("id").collect()] == ["20310611081530", "soon", "20310612170545"]


def test_md5_of_text_only(three):
    out = apply_chain(three, [step("md5encrypt", columnIndex=[1, 2])]).orderBy("id").collect()
    assert [r.name for r in out] == [
        "c5067b800fe3dfb9a4891841605294cc",
        "f7e7d06b534f19222a7043331e9390c9",
        "8e1073fe285ba7c0a221ac44177c2112",
    ]
    assert [r.height for r in out] == [158, 172, 190]


def test_zero_one(spark):
    df = spark.createDataFrame([("1", 1, "0"), ("2", 0, "x"), ("3", 7, None)], "id string, flag int, t string")
    out = rows(apply_chain(df, [step("zeroonetoboolean", columnIndex=[1, 2])]))
    assert out == [("1", "true", "false"), ("2", "false", "x"), ("3", "7", None)]


def test_chain_follows_order(three):
    chain = [
        step("trim", columnIndex=[1]),
        step("replace", columnIndex=[1], oldValue="Ødegård", newValue="Solveig"),
        step("filter", columnIndex=[2], value="160", op=">"),
    ]
    assert [r.name for r in apply_chain(three, chain).orderBy("id").collect()] == ["Šárka", "Ng Wei"]


def test_custom_steps(three):
    register("Shout", lambda df, p: df.withColumn("name", F.concat("name", F.lit(p.get("mark", "!")))))
    register_batches("taller", lambda batch, p: batch.assign(height=batch["height"] + p["by"]))
    module = types.ModuleType("steps_for_test")
    module.upper = lambda df, p: df.withColumn("badge", F.upper("badge"))
    sys.modules["steps_for_test"] = module
    out = apply_chain(three, ["shout", step("TALLER", by=2), "steps_for_test.upper"]).where("id = '1'").head()
    assert (out.name, out.height, out.badge) == ("Ødegård!", 160, "NORTH.17@GATE.EXAMPLE")
    for unknown in ("nothing", "no_module.step"):
        with pytest.raises(ValueError):
            apply_chain(three, [unknown])


def test_chain_is_one_stage_without_python(spark, three):
    chain = [
        "trim",
        step("replace", oldValue="a", newValue="b"),
        step("filter", columnIndex=[2], value="160", op=">"),
        step("dateformat", columnIndex=[4], fromFormat="yyyy-MM-dd HH:mm:ss", toFormat="yyyy"),
        step("md5encrypt", columnIndex=[1]),
        step("zeroonetoboolean", columnIndex=[2]),
    ]
    plan = apply_chain(three, chain)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan


def test_chain_runs_on_a_stream(spark, three, tmp_path):
    three.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(three.schema).parquet(str(tmp_path / "in"))
    chain = ["trim", step("filter", columnIndex=[2], value="160", op=">")]
    query = (
        apply_chain(stream, chain)
        .writeStream.format("parquet")
        .option("path", str(tmp_path / "out"))
        .option("checkpointLocation", str(tmp_path / "state"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination(120)
    assert spark.read.parquet(str(tmp_path / "out")).count() == 2
