"""Weight files, catalogues and cards."""

import hashlib
import json
import struct

import pytest
from pyspark.sql import functions as F

from millrace.operators import dialog, reports
from millrace.sources import catalog, jsonl, sinks, tensor_files


def string(text):
    return struct.pack("<Q", len(text.encode())) + text.encode()


def weights(folder):
    head = json.dumps({"__metadata__": {}, "w.a": {"dtype": "BF16", "shape": [2], "data_offsets": [0, 4]}}).encode()
    (folder / "m.safetensors").write_bytes(struct.pack("<Q", len(head)) + head + b"\0" * 4)
    keys = string("general.architecture") + struct.pack("<I", 8) + string("arch") + string("list") + struct.pack("<IIQ", 9, 4, 2) + struct.pack("<II", 1, 2)
    tensors = b"".join(string(n) + struct.pack("<IQQIQ", 2, 4, 4, t, 0) for n, t in (("blk.0.x", 12), ("blk.11.x", 12), ("out", 99)))
    (folder / "m.gguf").write_bytes(b"GGUF" + struct.pack("<IQQ", 3, 3, 2) + keys + tensors)
    (folder / "other.bin").write_bytes(b"x")


def test_inventory(spark, tmp_path):
    weights(tmp_path)
    found = tensor_files.inventory(spark, f"file://{tmp_path}")
    assert {(r.architecture, r.tensor, r.dtype) for r in found.collect()} == {(None, "w.a", "BF16"), ("arch", "blk.0.x", "Q4_K"), ("arch", "blk.11.x", "Q4_K"), ("arch", "out", "type 99")}
    assert {r.draft_layers for r in found.collect()} == {0}
    digests = {r.path.rsplit("/", 1)[-1]: (r.size, r.sha256) for r in tensor_files.digests(spark, f"file://{tmp_path}", piece=7).collect()}
    data = {n: (tmp_path / n).read_bytes() for n in ("m.safetensors", "m.gguf")}
    assert digests == {n: (len(d), hashlib.sha256(d).hexdigest()) for n, d in data.items()}
    row = next(r for r in tensor_files.summary(found).collect() if r.path.endswith("gguf"))
    assert (row.counts, row.max_block) == ({"Q4_K": 2, "type 99": 1}, 11)


def test_catalogue(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text(json.dumps({"user": "q", "assistant": "a"}) + "\n")
    (tmp_path / "empty.jsonl").write_text("\n")
    rows = spark.createDataFrame([("u", "v")], "instruction string, response string")
    sinks.publish(rows, f"file://{tmp_path}/pub/r1", ["instruction", "response"], split="test")
    local = catalog.Source("a", local=f"file://{tmp_path}/a.jsonl")
    away = catalog.Source("b", local=f"file://{tmp_path}/empty.jsonl", published=f"file://{tmp_path}/pub")
    gone = catalog.Source("c", optional=True)
    revisions = catalog.resolve_revisions([local, away, gone], {"b": "r1"})
    assert revisions == {"a": "local", "b": "r1"}
    assert catalog.load(spark, local, revisions).first().source_id == "a-0"
    assert [tuple(r) for r in catalog.load(spark, away, revisions).collect()] == [("u", "v")]
    assert catalog.load(spark, gone, revisions) is None
    with pytest.raises(LookupError):
        catalog.load(spark, catalog.Source("d"), revisions)


def test_card(spark):
    rows = spark.range(1_500).select(F.lit("en").alias("language"), F.lit("s").alias("source"))
    assert "| en | 1,500 |" in reports.card(rows, "T").first().markdown
    many = spark.range(300).select(F.lit("en").alias("language"), F.concat(F.lit("s"), "id").alias("source"))
    text = reports.card(many, "T").first().markdown
    assert text.startswith("# T\n\n300 rows\n\n| language | rows |") and text.count("| 1 |") == 300
    assert "0 rows" in reports.card(many.limit(0), "T").first().markdown


def test_documents_are_whole(spark, tmp_path):
    path = f"file://{tmp_path}/deep/a.json"
    sinks.write_document(spark, path, {"b": 1, "a": {"d": "é", "c": None}})
    sinks.write_document(spark, path, {"b": 2, "a": {}})
    assert (tmp_path / "deep" / "a.json").read_text(encoding="utf-8") == '{\n  "a": {},\n  "b": 2\n}\n'
    assert not (tmp_path / "deep" / "a.json.tmp").exists()
    gone = jsonl.read_document(spark, f"file://{tmp_path}/none.json").select(F.to_json("value").alias("v")).collect()
    assert [r.v for r in gone] == ["{}"]


def test_dialog_fallback(spark):
    df = spark.createDataFrame([([], "q", "a"), (None, "q", ""), ([{"role": "model", "content": "x"}], "q", "a")], f"m {dialog.TURNS}, i string, r string")
    sizes = [r[0] for r in df.select(F.size(dialog.dialog_messages(F.col("m"), F.col("i"), F.col("r")))).collect()]
    assert sizes == [2, 0, 0]
