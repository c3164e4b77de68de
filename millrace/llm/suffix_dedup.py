"""Repeated byte strings across documents, found by deep-shallow sorting of suffixes.

Every string of `MATCH` bytes has an anchor: the place of the 16-byte gram in it with the smallest hash, leftmost first.
Equal strings have their anchors at the same place, so that only suffixes under one anchor need to be sorted together,
and neighbouring strings with one anchor travel together in a frame of 84 bytes around it. Strings that begin 16 or
fewer bytes before their anchor all have the 32 bytes from the anchor on, and the others the 32 bytes up to its end.
These are their key; a frame holds strings of one key, so that a gram that is common in a language, with surroundings
that differ, is no hot key.

 1. Documents are dealt to blocks. A block sends each distinct key's hash once, dealt to buckets by its upper bits; the
    bucket answers which of them occur in two or more documents.
 2. A block sends each distinct frame of a shared key once, with the smallest and largest id that has it there.
 3. A bucket sorts the suffixes (the strings' starts) in its frames, shallow first: like a multikey quicksort it
    partitions every group by its next character, but with characters of eight and five bytes and by a sort of all
    groups' characters at once instead of a ternary split, to a depth of 18 bytes; then blind tries take the groups that
    still agree. A trie's node knows only the place where its
    members first differ; members are dealt by the byte at that place, level by level for all tries at once, until a
    node's members agree in all 50 bytes. The smallest id of each such class goes back to the blocks.
 4. A block removes the bytes of strings whose class has a smaller id than the document.

A hot string costs a frame a block, not a row a document. With many blocks the frames of a bucket are first merged in
groups of `MERGE` blocks, so that a hot string costs the bucket a frame a group. The texts are shuffled once; the steps
read the same exchange. The buckets are as many as the blocks to a factor of two, so that neither grows with the input. Strings are compared
byte by byte; an answer names its frame to a block by a hash of 128 bits.

Edge cases: null and empty texts have no bytes; a null id counts as larger than any other; repeated ids are not smaller
than each other; texts under 50 bytes lose nothing; other columns, whatever their names, are not read; an empty table
gives an empty result. Long texts are handled whole,
in pieces of bounded size where a step needs more memory than the text.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import materialize, text_of

MATCH, GRAM = 50, 16
SPAN = MATCH - GRAM + 1
FRAME = 2 * MATCH - GRAM
#: A key's bytes, and the most bytes that a string with the key to the right begins before its anchor.
KEY, RIGHT = 2 * GRAM, GRAM
#: A frame's row: its bytes, first and last string in it, and two bytes to a multiple of eight.
ROW = FRAME + 4
GAP = 64
SHALLOW = 18
BLOCK_BYTES = 2_000_000
PIECE = 1 << 15
NO_ID = (1 << 63) - 1
_M = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]
_FOLDS = [np.array([pow(m, 2 * k + 3, 1 << 64) | 1 for k in range(ROW // 8)], np.uint64) for m in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)]
#: Blocks whose frames of a bucket are merged before the bucket judges them.
MERGE = 1_024


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _M[3]
    return x ^ (x >> np.uint64(29))


def gram_hash(words: np.ndarray, at: int | np.ndarray, n: int = 0) -> np.ndarray:
    """Hashes of the grams at n places from `at` on, or at the places of an array."""
    first, second = (words[at : at + n], words[at + 8 : at + 8 + n]) if n else (words[at], words[at + 8])
    return mix(first * _M[0] + (second ^ _M[2]) * _M[1])


def packed(parts: list[np.ndarray]) -> pa.Array:
    """Each array's bytes, compressed."""
    squeeze = zstandard.ZstdCompressor(level=1).compress
    return pa.array([squeeze(p.tobytes()) for p in parts], pa.binary())


def unpacked(column: pa.ChunkedArray) -> list[bytes]:
    stretch = zstandard.ZstdDecompressor().decompress
    return [stretch(x.as_py()) for x in column]


def key_hash(words: list[np.ndarray], right: bool | np.ndarray) -> np.ndarray:
    """Hashes of keys from their four words and whether they lie to the right of the anchor."""
    first = mix(words[0] * _M[0] + (words[1] ^ _M[2]) * _M[1])
    second = mix(words[2] * _M[1] + (words[3] ^ _M[0]) * _M[2])
    return mix(first * _M[0] + second * _M[1] + np.asarray(right, np.uint64))


def key_of(frames: np.ndarray) -> np.ndarray:
    """The hashes of frames' keys."""
    words = np.ascontiguousarray(frames[:, MATCH - KEY : MATCH - GRAM + KEY]).view("<u8")
    right = frames[:, FRAME] >= MATCH - GRAM - RIGHT
    return key_hash([np.where(right, words[:, k + 2], words[:, k]) for k in range(4)], right)


class Block:
    """The texts of a block in one buffer, by ascending id, with their anchors."""

    def __init__(self, table: pa.Table) -> None:
        ids = table.column("id").to_numpy()
        order = np.argsort(ids, kind="stable")
        self.order, self.ids = order, ids[order]
        column = table.column("text").combine_chunks()
        column = column.chunk(0) if isinstance(column, pa.ChunkedArray) and column.num_chunks else column
        offsets = np.frombuffer(column.buffers()[1], np.int64 if pa.types.is_large_string(column.type) else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
        data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
        self.lengths = np.diff(offsets)[order]
        self.starts = GAP + np.cumsum(self.lengths + GAP) - (self.lengths + GAP)
        self.buffer = np.zeros(GAP + int((self.lengths + GAP).sum()), np.uint8)
        for at, size, k in zip(self.starts.tolist(), self.lengths.tolist(), order.tolist()):
            self.buffer[at : at + size] = data[offsets[k] : offsets[k] + size]
        self._anchors()

    def _anchors(self) -> None:
        """anchor, low, high: each anchor with the first and last string of a key that it belongs to; key: the key's
        hash; owner: the document."""
        buffer, n = self.buffer, len(self.buffer) - MATCH + 1
        words = np.ndarray((len(buffer) - 7,), "<u8", buffer, strides=(1,))
        place = np.empty(n, np.int32 if n < 1 << 31 else np.int64)
        for at in range(0, n, PIECE * 4):
            end = min(at + PIECE * 4, n)
            m = end - at + SPAN - 1
            least = (gram_hash(words, at, m) & np.uint64(0xFFFFFFFF00000000)) | np.arange(m, dtype=np.uint64)
            width = 1
            while 2 * width <= SPAN:
                least = np.minimum(least[:-width], least[width:])
                width *= 2
            if width < SPAN:
                least = np.minimum(least[: len(least) - (SPAN - width)], least[SPAN - width :])
            place[at:end] = (least & np.uint64(0xFFFFFFFF)).astype(np.int64) + at
        rooms = np.maximum(self.lengths - MATCH + 1, 0)
        valid = np.zeros(n + 1, np.int8)
        valid[self.starts[rooms > 0]] = 1
        valid[(self.starts + rooms)[rooms > 0]] -= 1
        at = np.flatnonzero(np.cumsum(valid[:-1], dtype=np.int8)).astype(place.dtype)
        where = place[at]
        new = np.ones(len(at), bool)
        new[1:] = (where[1:] != where[:-1]) | (at[1:] != at[:-1] + 1)
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(at)) - 1 if len(first) else first
        anchor, low, high = (x.astype(np.int64) for x in (where[first], at[first], at[last]))
        cut = anchor - RIGHT
        left, right = np.flatnonzero(low < cut), np.flatnonzero(high >= cut)
        self.anchor = np.concatenate([anchor[left], anchor[right]])
        self.low = np.concatenate([low[left], np.maximum(low, cut)[right]])
        self.high = np.concatenate([np.minimum(high, cut - 1)[left], high[right]])
        hashes = [np.zeros(0, np.uint64)]
        for places, is_right in ((anchor[left] - (KEY - GRAM), False), (anchor[right], True)):
            for i in range(0, len(places), PIECE):
                hashes.append(key_hash([words[places[i : i + PIECE] + 8 * k] for k in range(4)], is_right))
        self.key = np.concatenate(hashes)
        self.owner = np.searchsorted(self.starts, self.anchor, "right") - 1

    def frames(self, chosen: np.ndarray) -> np.ndarray:
        """Rows of the chosen anchors' frames; 0 outside their strings."""
        anchor = self.anchor[chosen]
        left = anchor - (MATCH - GRAM)
        rows = np.zeros((len(chosen), ROW), np.uint8)
        rows[:, :FRAME] = self.buffer[left[:, None] + np.arange(FRAME)]
        low, high = self.low[chosen] - left, self.high[chosen] - left
        column = np.arange(FRAME, dtype=np.uint8)
        rows[:, :FRAME] *= (column >= low.astype(np.uint8)[:, None]) & (column < (high + MATCH).astype(np.uint8)[:, None])
        rows[:, FRAME], rows[:, FRAME + 1] = low, high
        return rows



def name_of(rows: np.ndarray, half: int) -> np.ndarray:
    """Half of the 128-bit names of frames; the first begins with 32 bits of the key's hash."""
    name = mix((mix(rows.view("<u8")) * _FOLDS[half]).sum(1, dtype=np.uint64))
    return name if half else (key_of(rows) << np.uint64(32)) | (name >> np.uint64(32))


def distinct(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each different frame is, and each frame's place among them. Frames of one name are compared in full."""
    words, name = rows.view("<u8"), name_of(rows, 0)
    by = np.argsort(name)
    new = np.ones(len(by), bool)
    new[1:] = name[by[1:]] != name[by[:-1]]
    tied = np.flatnonzero(~new)
    if (words[by[tied]] != words[by[tied - 1]]).any():
        _, first, place = np.unique(words, axis=0, return_index=True, return_inverse=True)
        return first, place.reshape(-1)
    place = np.empty(len(by), np.int64)
    place[by] = np.cumsum(new) - 1
    return by[new], place


def merged(rows: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Different frames with the smallest and largest id that has them, and each given frame's place among them."""
    first, place = distinct(rows)
    least, most = np.full(len(first), NO_ID), np.zeros(len(first), np.int64)
    np.minimum.at(least, place, low)
    np.maximum.at(most, place, high)
    return rows[first], least, most, place


def sort_classes(frames: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The suffixes in frames in order, as (frame, offset), and for each whether it equals the one before in MATCH bytes."""
    counts = high - low + 1
    frame = np.repeat(np.arange(len(frames), dtype=np.int32), counts)
    offset = (np.arange(len(frame)) - np.repeat(np.cumsum(counts) - counts - low, counts)).astype(np.int32)
    flat = frames.reshape(-1)
    words = np.ndarray((len(flat) - 7,), ">u8", flat, strides=(1,))
    start = frame.astype(np.int64) * ROW + offset
    # shallow: partitions by a character of eight bytes, then of five, which share a word with their group's number
    own = words[start].astype(np.uint64)
    order = np.argsort(own)
    own = own[order]
    equal = np.zeros(len(order), bool)
    equal[1:] = own[1:] == own[:-1]
    for depth in range(8, SHALLOW, 5):
        tied = np.flatnonzero(_tied(equal))
        if not len(tied):
            break
        items = order[tied]
        group = np.cumsum(~equal[tied]).astype(np.uint64)
        own = (group << np.uint64(40)) | (words[start[items] + depth].astype(np.uint64) >> np.uint64(24))
        by = np.argsort(own)
        own, order[tied] = own[by], items[by]
        same = np.zeros(len(own), bool)
        same[1:] = own[1:] == own[:-1]
        equal[tied] = same
    # deep: blind tries for the groups that are left, all of them one level at a time
    pending = np.flatnonzero(_tied(equal))
    steps = [*range(SHALLOW, MATCH - 8, 8), MATCH - 8]
    while len(pending):
        items = order[pending]
        heads = ~equal[pending]
        group = np.cumsum(heads) - 1
        first = np.flatnonzero(heads)
        mine, leader = start[items], start[items[first]][group]
        unlike = np.zeros(len(items), np.uint64)
        for step in steps:
            unlike |= (words[mine + step] ^ words[leader + step]).astype(np.uint64)
        other = np.flatnonzero(unlike)
        if not len(other):
            break
        # members that differ from their group's first: where they do so first
        differ = np.full(len(items), MATCH, np.int64)
        for step in reversed(steps):
            x = (words[mine[other] + step] ^ words[leader[other] + step]).astype(np.uint64)
            lead = sum((x < np.uint64(1 << (64 - 8 * k))).astype(np.int64) for k in range(1, 8))
            differ[other] = np.where(x != 0, step + lead, differ[other])
        branch = np.minimum.reduceat(differ, first)[group]
        open_ = branch < MATCH
        pending, items, group = pending[open_], items[open_], group[open_]
        own = (group << 8) | flat[start[items] + branch[open_]]
        by = np.argsort(own)
        own, order[pending] = own[by], items[by]
        again = np.zeros(len(own), bool)
        again[1:] = own[1:] == own[:-1]
        equal[pending] = again
        pending = pending[_tied(again)]
    return frame[order], offset[order], equal


def _tied(equal: np.ndarray) -> np.ndarray:
    """The members of groups of two or more."""
    tied = equal.copy()
    tied[:-1] |= equal[1:]
    return tied


def repeats(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", with_kept: bool = False) -> DataFrame:
    """A row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256, and with_kept the remaining bytes (kept)."""
    key = F.col(id_col).cast("long")
    own = docs.select(F.coalesce(key, F.lit(NO_ID)).alias("id"), text_of(text_col).alias("text"))
    total = own.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-total // BLOCK_BYTES))
    bits = min(32, max(6, blocks.bit_length() - 1))
    merges = -(-blocks // MERGE)
    dealt = own.select(F.pmod(F.xxhash64("id", "text"), F.lit(blocks)).alias("block"), "id", "text")
    top = np.uint64(64 - bits)

    def bucketed(block: Block) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Distinct keys ascending, each anchor's place among them, the buckets with keys, and where each begins."""
        keys, places = np.unique(block.key, return_inverse=True)
        bucket, begins = np.unique((keys >> top).astype(np.int64), return_index=True)
        return keys, places, bucket, np.append(begins, len(keys))

    def name(table: pa.Table) -> int:
        return table.column("block")[0].as_py()

    def ask(table: pa.Table) -> pa.Table:
        block = Block(table)
        keys, places, bucket, begins = bucketed(block)
        by = np.lexsort((block.owner, places))
        twice = np.zeros(len(keys), bool)
        p, o = places[by], block.owner[by]
        twice[p[1:][(p[1:] == p[:-1]) & (block.ids[o[1:]] != block.ids[o[:-1]])]] = True
        rest = ((keys << np.uint64(bits)) >> np.uint64(32)).astype("<u4")
        rows = [(rest[a:b].tobytes(), np.packbits(twice[a:b]).tobytes()) for a, b in zip(begins[:-1], begins[1:])]
        n = len(rows)
        return pa.table([pa.array([name(table)] * n, pa.int64()), pa.array(bucket, pa.int64()), *(pa.array([r[k] for r in rows], pa.binary()) for k in range(2))], names=["block", "bucket", "keys", "twice"])

    def share(table: pa.Table) -> pa.Table:
        keys = [np.frombuffer(x.as_py(), "<u4") for x in table.column("keys")]
        twice = np.concatenate([np.unpackbits(np.frombuffer(x.as_py(), np.uint8), count=len(g)) for x, g in zip(table.column("twice"), keys)]).astype(bool)
        values, places, counts = np.unique(np.concatenate(keys), return_inverse=True, return_counts=True)
        shared = counts > 1
        shared[places[twice]] = True
        parts = np.split(shared[places], np.cumsum([len(g) for g in keys])[:-1])
        return pa.table([table.column("block"), table.column("bucket"), pa.array([np.packbits(p).tobytes() for p in parts], pa.binary())], names=["block", "bucket", "shared"])

    def send(table: pa.Table, masks: pa.Table) -> pa.Table:
        block = Block(table)
        keys, places, bucket, begins = bucketed(block)
        shared = np.zeros(len(keys), bool)
        at = {b: k for k, b in enumerate(bucket.tolist())}
        for b, mask in zip(masks.column("bucket").to_pylist(), masks.column("shared")):
            a, z = begins[at[b]], begins[at[b] + 1]
            shared[a:z] = np.unpackbits(np.frombuffer(mask.as_py(), np.uint8), count=z - a)
        chosen = np.flatnonzero(shared[places])
        kept: list[tuple[np.ndarray, ...]] = []
        for i in range(0, len(chosen), PIECE):
            part = chosen[i : i + PIECE]
            owners = block.ids[block.owner[part]]
            kept.append(merged(block.frames(part), owners, owners)[:3])
        if not kept:
            return packed_frames(np.zeros((0, ROW), np.uint8), *[np.zeros(0, np.int64)] * 2, name(table))
        return packed_frames(*merged(*(np.concatenate(x) for x in zip(*kept)))[:3], name(table))

    def packed_frames(rows: np.ndarray, least: np.ndarray, most: np.ndarray, sender: int) -> pa.Table:
        """A row per bucket with frames, for the bucket's judge."""
        of = (key_of(rows) >> top).astype(np.int64)
        by = np.argsort(of, kind="stable")
        rows, least, most, of = rows[by], least[by], most[by], of[by]
        bucket, begins = np.unique(of, return_index=True)
        cuts = list(zip(begins, np.append(begins[1:], len(of))))
        columns = [packed([x[a:b] for a, b in cuts]) for x in (rows, least, most - least)]
        return pa.table([pa.array([sender] * len(cuts), pa.int64()), pa.array(bucket, pa.int64()), *columns], names=["block", "bucket", "frames", "low", "more"])

    def load_frames(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Frames, ids, and the row of the table that each frame is from."""
        frames, low, more = (unpacked(table.column(c)) for c in ("frames", "low", "more"))
        rows = np.frombuffer(b"".join(frames), np.uint8).reshape(-1, ROW)
        least = np.frombuffer(b"".join(low), "<i8")
        return rows, least, least + np.frombuffer(b"".join(more), "<i8"), np.repeat(np.arange(len(table)), [len(x) // 8 for x in low])

    def merge(table: pa.Table) -> pa.Table:
        """The frames of a bucket from one group of blocks, once each; the group's number is their sender."""
        rows, low, high, _ = load_frames(table)
        return packed_frames(*merged(rows, low, high)[:3], table.column("block")[0].as_py() // MERGE)

    def runs_table(senders: list, frames: np.ndarray, sender: np.ndarray, a: np.ndarray, z: np.ndarray, least: np.ndarray, bucket: int) -> pa.Table:
        """A row per sender with the runs of its frames."""
        marks = np.stack([name_of(frames, 0), name_of(frames, 1)], 1)
        block, begins = np.unique(sender, return_index=True)
        cuts = list(zip(begins, np.append(begins[1:], len(sender))))
        columns = [packed([x[i:j] for i, j in cuts]) for x in (marks, a, z, least)]
        return pa.table([pa.array([senders[k] for k in block], pa.int64()), pa.array([bucket] * len(cuts), pa.int64()), *columns], names=["block", "bucket", "marks", "first", "last", "least"])

    def load_runs(runs: pa.Table) -> tuple[np.ndarray, ...]:
        """Runs by the first half of their frames' names, ascending."""
        load = lambda c, kind: np.frombuffer(b"".join(unpacked(runs.column(c))), kind)
        marks, first, last, least = load("marks", "<u8").reshape(-1, 2), load("first", np.uint8), load("last", np.uint8), load("least", "<i8")
        by = np.argsort(marks[:, 0], kind="stable")
        return marks[by], first[by], last[by], least[by]

    def runs_of(rows: np.ndarray, marks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The pairs (frame, run) that agree in their names."""
        own = name_of(rows, 0)
        lo, hi = np.searchsorted(marks[:, 0], own, "left"), np.searchsorted(marks[:, 0], own, "right")
        has = np.flatnonzero(hi > lo)
        lo, times = lo[has], (hi - lo)[has]
        run = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times - lo, times)
        same = marks[run, 1] == np.repeat(name_of(rows[has], 1), times)
        return np.repeat(has, times)[same], run[same]

    def split(table: pa.Table, runs: pa.Table) -> pa.Table:
        """The runs of a bucket's merged frames, for each block of the group that has them."""
        if not len(table) or not len(runs):
            return runs.slice(0, 0).select(["block", "bucket", "marks", "first", "last", "least"])
        rows, _, high, of = load_frames(table)
        marks, a, z, least = load_runs(runs)
        frame, run = runs_of(rows, marks)
        later = least[run] < high[frame]
        frame, run = frame[later], run[later]
        by = np.argsort(of[frame], kind="stable")
        frame, run = frame[by], run[by]
        return runs_table(table.column("block").to_pylist(), rows[frame], of[frame], a[run], z[run], least[run], table.column("bucket")[0].as_py())

    def judge(table: pa.Table) -> pa.Table:
        given, low, high, of = load_frames(table)
        frames, least_id, most_id, place = merged(given, low, high)
        part = (key_of(frames) >> np.uint64(8)) % np.uint64(max(1, len(frames) // 4_000))
        found: list[tuple[np.ndarray, ...]] = []
        by = np.argsort(part)
        for own in np.split(by, np.flatnonzero(np.diff(part[by])) + 1) if len(by) else []:
            rows = frames[own]
            frame, offset, equal = sort_classes(rows, rows[:, FRAME].astype(np.int64), rows[:, FRAME + 1].astype(np.int64))
            heads = np.flatnonzero(~equal)
            least = np.minimum.reduceat(least_id[own][frame], heads)[np.cumsum(~equal) - 1]
            hit = least < most_id[own][frame]
            frame, offset, least = frame[hit], offset[hit], least[hit]
            by_place = np.argsort(frame * np.int32(64) + offset)
            frame, offset, least = frame[by_place], offset[by_place], least[by_place]
            new = np.ones(len(frame), bool)
            new[1:] = (frame[1:] != frame[:-1]) | (offset[1:] != offset[:-1] + 1) | (least[1:] != least[:-1])
            a = np.flatnonzero(new)
            z = np.append(a[1:], len(frame)) - 1 if len(a) else a
            found.append((own[frame[a]], offset[a].astype(np.uint8), offset[z].astype(np.uint8), least[a]))
        name_, a, z, least = (np.concatenate(x) for x in zip(*found)) if found else (np.zeros(0, np.int64), *[np.zeros(0, np.uint8)] * 2, np.zeros(0, np.int64))
        # every sender that has the frame gets its runs
        by = np.argsort(name_, kind="stable")
        name_, a, z, least = name_[by], a[by], z[by], least[by]
        lo, hi = np.searchsorted(name_, place, "left"), np.searchsorted(name_, place, "right")
        times = hi - lo
        run = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times - lo, times)
        row = np.repeat(np.arange(len(place)), times)
        later = least[run] < high[row]
        run, row = run[later], row[later]
        return runs_table(table.column("block").to_pylist(), given[row], of[row], a[run], z[run], least[run], table.column("bucket")[0].as_py())

    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * with_kept

    def cut(table: pa.Table, runs: pa.Table) -> pa.Table:
        block = Block(table)
        cover = np.zeros(len(block.buffer) + 1, np.int32)
        if len(runs):
            marks, first, last, least = load_runs(runs)
            wanted, own = np.unique(marks[:, 0] >> np.uint64(32)), block.key & np.uint64(0xFFFFFFFF)
            near = np.minimum(np.searchsorted(wanted, own), len(wanted) - 1)
            chosen = np.flatnonzero(wanted[near] == own)
            for i in range(0, len(chosen), PIECE):
                part = chosen[i : i + PIECE]
                frame, run = runs_of(block.frames(part), marks)
                anchor = part[frame]
                later = least[run] < block.ids[block.owner[anchor]]
                run, left = run[later], block.anchor[anchor[later]] - (MATCH - GRAM)
                np.add.at(cover, left + first[run], 1)
                np.add.at(cover, left + last[run].astype(np.int64) + MATCH, -1)
        removed = np.cumsum(cover[:-1]) > 0
        out = []
        for key, at, size in zip(block.ids.tolist(), block.starts.tolist(), block.lengths.tolist()):
            gone, data = removed[at : at + size], block.buffer[at : at + size]
            n = int(np.count_nonzero(gone))
            spans = int(np.count_nonzero(gone[1:] & ~gone[:-1])) + int(n > 0 and gone[0])
            kept = data[~gone].tobytes() if n else data.tobytes()
            out.append((None if key == NO_ID else key, size, n, spans, hashlib.sha256(kept).hexdigest(), *([kept] if with_kept else [])))
        types = [pa.int64()] * 4 + [pa.string()] + [pa.binary()] * with_kept
        return pa.table([pa.array(c, t) for c, t in zip(zip(*out) if out else [[]] * len(types), types)], names=[x.split()[0] for x in schema.split(", ")])

    asked = dealt.groupBy("block").applyInArrow(ask, "block long, bucket long, keys binary, twice binary")
    masks = asked.groupBy("bucket").applyInArrow(share, "block long, bucket long, shared binary")
    sent_types, run_types = "block long, bucket long, frames binary, low binary, more binary", "block long, bucket long, marks binary, first binary, last binary, least binary"
    sent = dealt.groupBy("block").cogroup(masks.groupBy("block")).applyInArrow(send, sent_types)
    if merges == 1:
        judged = sent.groupBy("bucket").applyInArrow(judge, run_types)
    else:  # in two steps, there and back
        group = F.floor(F.col("block") / MERGE).cast("long")
        sent = materialize(sent, "suffix-frames")
        fewer = sent.groupBy("bucket", group.alias("group")).applyInArrow(merge, sent_types)
        answers = fewer.groupBy("bucket").applyInArrow(judge, run_types)
        judged = sent.groupBy("bucket", group.alias("group")).cogroup(answers.groupBy("bucket", F.col("block").alias("group"))).applyInArrow(split, run_types)
    return dealt.groupBy("block").cogroup(judged.groupBy("block")).applyInArrow(cut, schema)
