"""Candles: arriving files, silver rows, schema versions."""

import json

from conftest import rows
from pyspark.sql import types as T

from tallyweave.sources.files import CANDLES
from tallyweave.streaming import candles as cs


def _message(n, short=None, **more):
    arrays = {
        "c": [1.0 + i for i in range(n)], "h": [2.0] * n, "l": [0.5] * n, "o": [1.5] * n,
        "t": [f"2024-01-0{i + 1}" for i in range(n)], "v": [5_000_000_000 + i for i in range(n)],
        "symbol": ["ACME"] * n, "file": ["a.json"] * n,
    }
    if short:
        arrays[short] = arrays[short][:-1]
    return {**{name: json.dumps(a) for name, a in arrays.items()}, **more}


def _write(folder, name, *messages):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(json.dumps(m) for m in messages) + "\n")


def test_zip_to_the_shortest(spark):
    messages = [_message(3), _message(3, short="v"), _message(0), _message(2, c="[1.0, oops")]
    missing = {**_message(2), "h": None}
    df = spark.createDataFrame(
        [tuple(m[f.name] for f in CANDLES) for m in [*messages, missing]], CANDLES)
    got = rows(cs.silver(df).select("Close_Prices", "Timestamp", "Volume", "Stock"))
    assert got == sorted([
        (1.0, "2024-01-01", 5_000_000_000, "ACME"), (2.0, "2024-01-02", 5_000_000_001, "ACME"),
        (3.0, "2024-01-03", 5_000_000_002, "ACME"),
        (1.0, "2024-01-01", 5_000_000_000, "ACME"), (2.0, "2024-01-02", 5_000_000_001, "ACME"),
    ], key=lambda r: tuple(map(str, r)))


def test_stream_equals_batch_and_reads_files_once(spark, tmp_path):
    source, table, progress = tmp_path / "in", str(tmp_path / "bronze"), str(tmp_path / "progress")
    _write(source, "1.json", _message(3), _message(2))

    def run(schema=CANDLES):
        cs.append_to_table(
            cs.candle_stream(spark, str(source), schema), table, progress).awaitTermination()
        return cs.bronze(spark, table, schema)

    batch = spark.read.schema(CANDLES).json(str(source))
    assert rows(cs.silver(run())) == rows(cs.silver(batch))
    assert run().count() == 2
    # A later file brings one more column; a restart with the wider schema
    # reads it, and rows from before have NULL there.
    wider = T.StructType([*CANDLES.fields, T.StructField("vw", T.StringType())])
    _write(source, "2.json", _message(1, vw="[9.0]"))
    after = run(wider)
    assert sorted(str(r.vw) for r in after.collect()) == ["None", "None", "[9.0]"]
    assert cs.silver(after).count() == 6


def test_silver_on_a_stream(spark, tmp_path):
    _write(tmp_path / "in", "1.json", _message(3))
    run = cs.append_to_table(
        cs.silver(cs.candle_stream(spark, str(tmp_path / "in"))),
        str(tmp_path / "out"), str(tmp_path / "progress"))
    run.awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 3
    assert set(cs.TABLES) == {"stocks_bronze", "stocks_silver"}
