"""Token ids in Arrow IPC files of equal-length sequences.

Layout of a file: record batches with the columns
  ids   fixed_size_list<uint16 or uint32>[length]  the sequence's ids, the last one padded with 0
  mask  fixed_size_list<bool>[length]              true for ids, false for padding
  docs  list<struct<doc_id, offset, n_tokens>>     documents that begin in this sequence; offset counts the file's ids
and, in the schema's metadata, the place of the file in the whole: first doc_id, partition, number. All sequences have
one length and lie uncompressed in one buffer, so sequence i of a mapped file is read in place, without a copy.
A document lies in one file. Documents ascend by id over the files; nulls come first.

Documents are dealt by range of id, encoded partition by partition, and cut into files of bounded size. The files are
written by Spark's own committer: a row is a whole file without its last six bytes, the closing magic, and that magic
is the writer's line separator. So they reach any store that Spark writes to, and a lost task leaves nothing behind.

Encoding goes through a memo of white-space-separated units, which is exact for a tokenizer whose normalizer and
pre-tokenizer treat white space as a break and drop it; texts with U+001C to U+001F, which Python takes for white space
and the tokenizer does not, are encoded whole, and so is every text for other tokenizers.

Edge cases: null and empty texts are the end id alone; repeated ids are ordered by text and each keep an entry; other
columns, whatever their names, are not read; an empty table writes no file and reads back as no rows. A long text is encoded whole, into one file.
"""

from __future__ import annotations

import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.llm.common import broadcast_if, materialize, release_memory, small_batches, text_of, work_path

MAGIC = "ARROW1"
LENGTH = 2048
#: Ids after which a file ends at the next document's end, and sequences in a record batch.
FILE_IDS = 4_000_000
BATCH_ROWS = 256
#: Units that each of the memo's two generations holds.
MEMO_UNITS = 300_000
#: Units longer than this aren't remembered.
MEMO_CHARS = 64
DOCS = pa.list_(pa.struct([("doc_id", pa.int64()), ("offset", pa.int64()), ("n_tokens", pa.int64())]))
_encoders: dict[str, Encoder] = {}


class Memo(dict):
    """Ids of units, with the memo before it as a second generation.

    lowered: units are lower-case Latin-1 just now, on which the normalizer does nothing; letters are one pre-token then.
    """

    def __init__(self, encoder: Encoder, old: dict) -> None:
        super().__init__()
        self.encoder, self.old, self.lowered = encoder, old, False

    def __missing__(self, unit: str) -> bytes:
        ids = self.old.get(unit)
        if ids is None:
            if self.lowered and unit.isalpha():
                ids = self.encoder.word(unit)
            elif unit[-1] in ".,;:!?" and unit[:-1].isalpha():
                # letters and the mark after them are different pre-tokens; of a rare word only the word is kept
                known = unit[:-1] in self
                ids = self[unit[:-1]] + self[unit[-1]]
                if not known:
                    return ids
            else:
                ids = self.encoder.direct(unit)
        if len(unit) <= MEMO_CHARS:
            self[unit] = ids
        return ids


class Encoder:
    """Ids of texts as little-endian bytes."""

    def __init__(self, path: str) -> None:
        import json

        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(path)
        self.model.no_truncation()
        self.model.no_padding()
        self.dtype = np.dtype("<u2") if self.model.get_vocab_size(with_added_tokens=True) <= 1 << 16 else np.dtype("<u4")
        with open(path, encoding="utf-8") as file:
            text = file.read()
        # the vocabulary is not needed here
        spec = json.loads(text[: text.index('"model"')] + '"model": null}')
        parts = lambda x, key: (x or {}).get(key) or ([x] if x else [])
        normal = [(p["type"], p.get("pattern"), p.get("content")) for p in parts(spec.get("normalizer"), "normalizers")]
        known = [("NFC", None, None), ("Replace", {"Regex": r"\s+"}, " "), ("Lowercase", None, None)]
        breaks = [p for p in parts(spec.get("pre_tokenizer"), "pretokenizers") if p["type"] == "Split" and p["invert"] and p["behavior"] == "Removed"]
        pattern = breaks[0]["pattern"].get("Regex", "") if breaks else ""
        letters_apart = pattern.endswith(r"[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
        added = [a["content"] for a in spec.get("added_tokens", [])]
        self.by_unit = normal == known and letters_apart and spec.get("post_processor") is None and not any(c.isspace() for a in added for c in a) and not any(a["lstrip"] or a["rstrip"] for a in spec.get("added_tokens", []))
        # with lower-case special strings, lowering a text can't make or break one
        self.lowers = all(a == a.lower() for a in added)
        # bytes as the byte-level pre-tokenizer writes them: printable ones as they are, the others from 256 up
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        shown = {b: chr(b) for b in plain} | {b: chr(256 + n) for n, b in enumerate(x for x in range(256) if x not in plain)}
        self.written = {c: "".join(shown[b] for b in chr(c).encode()) for c in range(128, 256)}
        self.bare, self.code = self.model.model, self.dtype.char
        self.memo = Memo(self, {})

    def word(self, unit: str) -> bytes:
        """Ids of lower-case Latin-1 letters: one pre-token, so that the model alone gives them."""
        shown = unit if unit.isascii() else unit.translate(self.written)
        return array(self.code, [t.id for t in self.bare.tokenize(shown)]).tobytes()

    def direct(self, text: str) -> bytes:
        return np.array(self.model.encode(text, add_special_tokens=False).ids, self.dtype).tobytes()

    def encode(self, text: str) -> bytes:
        if not self.by_unit or any(c in text for c in "\x1c\x1d\x1e\x1f"):
            return self.direct(text)
        if len(self.memo) > MEMO_UNITS:
            self.memo.old = {}
            self.memo = Memo(self, self.memo)
        self.memo.lowered = False
        if self.lowers and "<|" not in text:
            try:  # Latin-1 is composed, and its lower case doesn't depend on what stands around
                text.encode("latin-1")
                text = text.lower()
                self.memo.lowered = True
            except UnicodeEncodeError:
                pass
        return b"".join(map(self.memo.__getitem__, text.split()))


def encoder(path: str) -> Encoder:
    """The worker's encoder for a tokenizer file, made once in a Python process."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def file_bytes(docs: list[tuple[int | None, bytes]], dtype: np.dtype, length: int, place: dict[str, str]) -> pa.Buffer:
    """An Arrow IPC file of documents given as (id, bytes of ids)."""
    ids = np.frombuffer(b"".join(x for _, x in docs), dtype)
    n = -(-len(ids) // length)
    padded, mask = np.zeros(n * length, dtype), np.zeros(n * length, bool)
    padded[: len(ids)], mask[: len(ids)] = ids, True
    sizes = np.array([len(x) // dtype.itemsize for _, x in docs], np.int64)
    offsets = np.cumsum(sizes) - sizes
    began = np.searchsorted(offsets // length, np.arange(n + 1))
    entries = pa.StructArray.from_arrays([pa.array([i for i, _ in docs], pa.int64()), pa.array(offsets), pa.array(sizes)], fields=list(DOCS.value_type))
    lists = pa.ListArray.from_arrays(pa.array(began, pa.int32()), entries, type=DOCS)
    columns = [pa.FixedSizeListArray.from_arrays(pa.array(padded), length), pa.FixedSizeListArray.from_arrays(pa.array(mask), length), lists]
    table = pa.table(columns, names=["ids", "mask", "docs"]).replace_schema_metadata(place)
    out = pa.BufferOutputStream()
    with pa.ipc.new_file(out, table.schema) as writer:
        writer.write_table(table, max_chunksize=BATCH_ROWS)
    return out.getvalue()


def write_sequences(docs: DataFrame, path: str, tokenizer_path: str, *, id_col: str = "doc_id", text_col: str = "text", end_id: int = 1, length: int = LENGTH, file_ids: int = FILE_IDS) -> None:
    """Encode every document, append end_id, and write the files below path."""
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col(id_col).cast("long").alias("id"), text_of(text_col).alias("text"))
    ordered = rows.repartitionByRange(parts, "id").sortWithinPartitions("id", "text")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, part, number = encoder(tokenizer_path), TaskContext.get().partitionId(), 0
        end = np.array([end_id], tokens.dtype).tobytes()
        held: list[tuple[int | None, bytes]] = []
        size = 0

        def cut() -> pa.RecordBatch:
            place = {"first": "" if held[0][0] is None else str(held[0][0]), "part": str(part), "number": str(number)}
            content = file_bytes(held, tokens.dtype, length, place)
            ends = pa.array([0, content.size - len(MAGIC)], pa.int32()).buffers()[1]
            return pa.RecordBatch.from_arrays([pa.Array.from_buffers(pa.binary(), 1, [None, ends, content])], names=["file"])

        for batch in batches:
            for key, text in zip(batch.column(0), batch.column(1)):
                held.append((key.as_py(), tokens.encode(text.as_py()) + end))
                size += len(held[-1][1]) // tokens.dtype.itemsize
                if size >= file_ids:
                    yield cut()
                    held, size, number = [], 0, number + 1
        if held:
            yield cut()
        held.clear()
        release_memory()

    files = ordered.mapInArrow(encode, "file binary")
    with small_batches(spark):
        files.select(F.col("file").cast("string").alias("value")).write.option("lineSep", MAGIC).option("maxRecordsPerFile", 1).text(path)


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """From the files: doc_id, start (ids of all documents before it), n_tokens, ids_crc32 (of 32-bit ids)."""

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                if not len(content.as_buffer()):
                    continue
                table = pa.ipc.open_file(content.as_buffer()).read_all()
                place = {k.decode(): v.decode() for k, v in table.schema.metadata.items()}
                ids = memoryview(table["ids"].combine_chunks().flatten().to_numpy().astype("<u4")).cast("B")
                entries = table["docs"].combine_chunks().flatten()
                keys, offsets, sizes = (entries.field(k) for k in range(3))
                sums = [zlib.crc32(ids[4 * o : 4 * (o + n)]) for o, n in zip(offsets.to_numpy().tolist(), sizes.to_numpy().tolist())]
                rows = len(keys)
                total = int(sizes.to_numpy().sum())
                const = lambda v, t: pa.array([v] * rows, t)
                yield pa.RecordBatch.from_arrays([const(int(place["first"]) if place["first"] else None, pa.int64()), const(int(place["part"]), pa.int64()), const(int(place["number"]), pa.int64()), const(total, pa.int64()), keys, offsets, sizes, pa.array(sums, pa.int64())], names=["first", "part", "number", "total", "doc_id", "offset", "n_tokens", "ids_crc32"])

    files = spark.read.format("binaryFile").load(path).select("content")
    found = materialize(files.mapInArrow(parse, "first long, part long, number long, total long, doc_id long, offset long, n_tokens long, ids_crc32 long"), "sequence-index")
    place = ["part", "number"]
    by_file = found.select("first", *place, "total").distinct()
    order = Window.orderBy(F.col("first").asc_nulls_first(), "part", "number")
    starts = materialize(by_file.select(*place, (F.sum("total").over(order) - F.col("total")).alias("before")), "sequence-files")
    few = broadcast_if(starts, starts.count(), 100_000)
    return found.join(few, place).select("doc_id", (F.col("before") + F.col("offset")).alias("start"), "n_tokens", "ids_crc32")


def token_files(docs: DataFrame, tokenizer_path: str, path: str | None = None, **options) -> DataFrame:
    """Write the files (below the shared folder, if no path is given) and return what read_documents finds in them."""
    path = path or work_path(docs.sparkSession, "sequences")
    write_sequences(docs, path, tokenizer_path, **options)
    return read_documents(docs.sparkSession, path)


def open_sequences(path: str) -> pa.ipc.RecordBatchFileReader:
    """A file on a local disk, mapped: get_batch(i).column("ids")[j] is read in place."""
    return pa.ipc.open_file(pa.memory_map(path))
