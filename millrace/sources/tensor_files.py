"""Names and types of the tensors in weight files, read from their headers only.

A task gets paths, opens each through Arrow's file systems (local disks and object stores), and reads the header; the
weights stay where they are. Both layouts are public formats.
"""

from __future__ import annotations

import hashlib
import json
import struct
from collections.abc import Iterator

import pandas as pd
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators.tensors import block_index

SCHEMA = "path string, architecture string, draft_layers long, tensor string, dtype string"
#: Fixed values of the format: type numbers of tensors, and struct codes of metadata values.
TENSOR_TYPES = {0: "F32", 1: "F16", 2: "Q4_0", 3: "Q4_1", 6: "Q5_0", 7: "Q5_1", 8: "Q8_0", 9: "Q8_1", 10: "Q2_K", 11: "Q3_K", 12: "Q4_K", 13: "Q5_K", 14: "Q6_K", 15: "Q8_K", 16: "IQ2_XXS", 17: "IQ2_XS", 18: "IQ3_XXS", 19: "IQ1_S", 20: "IQ4_NL", 21: "IQ3_S", 22: "IQ2_S", 23: "IQ4_XS", 24: "I8", 25: "I16", 26: "I32", 27: "I64", 28: "F64", 29: "IQ1_M", 30: "BF16"}
VALUE_CODES = {0: "B", 1: "b", 2: "H", 3: "h", 4: "I", 5: "i", 6: "f", 7: "?", 10: "Q", 11: "q", 12: "d"}
_STRING, _ARRAY = 8, 9


def json_header(file) -> list[tuple[str | None, int, str, str]]:
    """(architecture, draft layers, tensor, dtype) from a file that begins with the length of a JSON header."""
    (size,) = struct.unpack("<Q", file.read(8))
    return [(None, 0, name, x["dtype"]) for name, x in json.loads(file.read(size)).items() if name != "__metadata__"]


def keyed_header(file) -> list[tuple[str | None, int, str, str]]:
    """(architecture, draft layers, tensor, dtype) from a file of typed keys and tensor entries."""

    def number(code: str):
        return struct.unpack("<" + code, file.read(struct.calcsize(code)))[0]

    def text() -> str:
        return file.read(number("Q")).decode("utf-8", "replace")

    def value(kind: int):
        if kind == _STRING:
            return text()
        if kind == _ARRAY:
            inner, n = number("I"), number("Q")
            return [value(inner) for _ in range(n)]
        return number(VALUE_CODES[kind])

    if file.read(4) != b"GGUF":
        raise ValueError("not a file of this format")
    number("I")
    tensors, keys = number("Q"), number("Q")
    facts = {}
    for _ in range(keys):
        key = text()
        facts[key] = value(number("I"))
    # the first key that ends so counts the draft layers
    draft = next((int(v) for k, v in facts.items() if k.endswith("nextn_predict_layers")), 0)
    out = []
    for _ in range(tensors):
        name = text()
        file.read(8 * number("I"))  # its shape
        kind = number("I")
        number("Q")
        out.append((facts.get("general.architecture"), draft, name, TENSOR_TYPES.get(kind, f"type {kind}")))
    return out


def _paths(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.{safetensors,gguf}").load(folder).select("path")


def _opened(path: str):
    store, place = fs.FileSystem.from_uri(path if "://" in path else path.replace("file:", "file://", 1))
    return store.open_input_file(place)


def inventory(spark: SparkSession, folder: str) -> DataFrame:
    """(path, architecture, draft_layers, tensor, dtype) of all weight files below a folder."""
    files = _paths(spark, folder)

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for path in batch["path"]:
                with _opened(path) as file:
                    rows += [(path, *r) for r in (keyed_header(file) if path.endswith(".gguf") else json_header(file))]
            yield pd.DataFrame(rows, columns=["path", "architecture", "draft_layers", "tensor", "dtype"])

    return files.mapInPandas(read, SCHEMA)


def digests(spark: SparkSession, folder: str, piece: int = 1 << 22) -> DataFrame:
    """(path, size, sha256) of all weight files below a folder, read in pieces."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for path in batch["path"]:
                digest, size = hashlib.sha256(), 0
                with _opened(path) as file:
                    while part := file.read(piece):
                        digest.update(part)
                        size += len(part)
                rows.append((path, size, digest.hexdigest()))
            yield pd.DataFrame(rows, columns=["path", "size", "sha256"])

    return _paths(spark, folder).mapInPandas(read, "path string, size long, sha256 string")


def summary(tensors: DataFrame) -> DataFrame:
    """Per file: architecture, draft layers, number of tensors by type, and the largest block number."""
    per = tensors.groupBy("path", "dtype").agg(F.first("architecture").alias("architecture"), F.first("draft_layers").alias("draft_layers"), F.count(F.lit(1)).alias("n"), F.max(block_index(F.col("tensor"))).alias("block"))
    return per.groupBy("path").agg(F.first("architecture").alias("architecture"), F.first("draft_layers").alias("draft_layers"), F.map_from_entries(F.array_sort(F.collect_list(F.struct("dtype", "n")))).alias("counts"), F.max("block").alias("max_block"))
