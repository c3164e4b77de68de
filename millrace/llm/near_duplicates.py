"""N-gram Jaccard join: a MinHash LSH forest over five-word shingles, and exact verification.

Words are runs of non-blank characters, lower-cased; a text of one to four words is one shingle. Documents with equal
word sequences are one class with a weight; only classes are compared.

Forest. A signature has `TREES` * `DEPTH` minima; tree t holds the slices of DEPTH minima of all classes in sorted order,
which is the prefix trie of them: a node at depth d is a run of slices with one prefix of length d. Classes of one node
meet, and a link of similarity s is found with chance 1 - (1 - s**d)**TREES. Matched prefixes are shortened from DEPTH on
until the links at the threshold, the least likely ones, are found with the chance `recall`; that depends on no data, so
that links don't depend on other rows. The tries are dealt by ranges of (tree, slice, class), so that a node of any size
spreads over tasks; a task walks its range once and drops the slices that are alone.

Verification. Every bucket's members bring their shingle sets; all pairs in it that meet here for the first time (in no
earlier tree) are compared exactly by counting common shingles. A member's links are summed and
its root in the bucket returned, so that no pair becomes a row. A bucket of more than `MEMBERS` is cut into parts, and
each two parts are one task. Buckets with the same members as one of an earlier tree are dropped.

Classes, links and components stay distributed. Shingles are compared as 64-bit hashes.

Edge cases: null texts and texts without words have no links and a class of their own; null ids count as the largest;
repeated rows are copies; an empty table gives an empty result; columns of any name pass through. Texts are compared
whole. Parameters with which no depth reaches the recall are an error.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import broadcast_if, materialize, release_memory, text_of, without
from millrace.llm.graph import components

WORDS, TREES, DEPTH = 5, 16, 6
MEMBERS = 512
MEMO_WORDS = 60_000
#: Shingle columns that are counted at once, and shingles whose minima are taken at once.
COLUMNS, PIECE = 8_192, 1 << 16
_rng = np.random.default_rng(20_240_917)
FACTORS = _rng.integers(1, 1 << 63, TREES * DEPTH, dtype=np.uint64) | np.uint64(1)
ADDENDS = _rng.integers(0, 1 << 63, TREES * DEPTH, dtype=np.uint64)
_POWERS = np.array([pow(0x9E3779B97F4A7C15, k + 1, 1 << 64) for k in range(WORDS)], np.uint64)


class WordHashes(dict):
    """64-bit hashes of words, remembered."""

    def __missing__(self, word: str) -> int:
        value = xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass"))
        self[word] = value
        return value

    def of(self, text: str) -> np.ndarray:
        if len(self) > MEMO_WORDS:
            self.clear()
        # split() also breaks at separators outside ASCII, which are no blanks here
        words = text.lower().split() if text.isascii() and not any(c in text for c in "\x1c\x1d\x1e\x1f") else [w.decode("utf-8", "surrogatepass") for w in text.lower().encode("utf-8", "surrogatepass").split()]
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


_hashes = WordHashes()


def shingles(words: np.ndarray) -> np.ndarray:
    """Hashes of the five-word shingles of word hashes, repeats included."""
    n = max(1, len(words) - WORDS + 1)
    if not len(words):
        return np.zeros(0, np.uint64)
    total = np.zeros(n, np.uint64)
    for k in range(min(WORDS, len(words))):
        total += words[k : k + n] * _POWERS[k]
    total ^= total >> np.uint64(31)
    total *= np.uint64(0xBF58476D1CE4E5B9)
    total ^= total >> np.uint64(29)
    return total


def signatures(sets: list[np.ndarray], trees: int) -> np.ndarray:
    """A row of minima for each non-empty set."""
    out = np.empty((trees * DEPTH, len(sets)), np.uint32)
    starts = np.cumsum([0] + [len(s) for s in sets])[:-1]
    everything = np.concatenate(sets)
    room = np.empty_like(everything)
    for k in range(trees * DEPTH):
        np.multiply(everything, FACTORS[k], out=room)
        np.add(room, ADDENDS[k], out=room)
        out[k] = np.minimum.reduceat(room, starts) >> np.uint64(32)
    return np.ascontiguousarray(out.T)


def sketch(docs: DataFrame, id_col: str, text_col: str, trees: int) -> DataFrame:
    """A row per document: id, digest (of the text), class (16 bytes; null without words), signature."""
    own = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text_col).alias("digest"), text_of(text_col).alias("text"))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            classes: list[bytes | None] = []
            minima: list[bytes | None] = []
            held: list[np.ndarray] = []
            places: list[int] = []
            size = 0

            def flush() -> None:
                for place, row in zip(places, signatures(held, trees) if held else ()):
                    minima[place] = row.tobytes()
                held.clear()
                places.clear()

            for text in batch.column("text"):
                words = _hashes.of(text.as_py())
                classes.append(xxhash.xxh3_128_digest(words.tobytes()) if len(words) else None)
                minima.append(None)
                if len(words):
                    held.append(shingles(words))
                    places.append(len(minima) - 1)
                    size += len(held[-1])
                if size >= PIECE:
                    flush()
                    size = 0
            flush()
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("digest"), pa.array(classes, pa.binary()), pa.array(minima, pa.binary())], names=["id", "digest", "class", "signature"])
        _hashes.clear()
        release_memory()

    return own.mapInArrow(rows, "id long, digest long, class binary, signature binary")


def chance(s: float | np.ndarray, depth: int, trees: int):
    """The chance that two sets of similarity s meet at a depth in some tree."""
    return 1 - (1 - np.asarray(s, float) ** depth) ** trees


def depth_of(threshold: float, recall: float, trees: int) -> int:
    """The largest depth where a pair at the threshold meets with the chance recall."""
    for depth in range(DEPTH, 0, -1):
        if chance(threshold, depth, trees) >= recall:
            return depth
    raise ValueError(f"{trees} trees find links of similarity {threshold} with chance {chance(threshold, 1, trees):.4f} at most")


def trie_runs(classes: DataFrame, depth: int, trees: int) -> DataFrame:
    """(class, tree, prefix) of the classes that share a prefix of some depth in the sorted tries, and of those at the
    ends of a task's range, whose neighbours are in another task."""
    slices = classes.select("class", F.explode(F.sequence(F.lit(0), F.lit(trees - 1))).alias("tree"), "signature")
    slices = slices.select("class", "tree", F.expr(f"substring(signature, tree * {4 * DEPTH} + 1, {4 * DEPTH})").alias("slice"))
    count = int(classes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tries = slices.repartitionByRange(count, "tree", "slice", "class").sortWithinPartitions("tree", "slice", "class")

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.schema([("class", pa.binary()), ("tree", pa.int32()), ("prefix", pa.binary())])
        held: pa.Table | None = None  # the last row, whose successor is not known yet
        held_met = True  # whether it is to be kept anyway: it met the row before it, or is the first

        def nodes(table: pa.Table) -> np.ndarray:
            names = table.column("prefix").combine_chunks()
            names = names.cast(pa.binary(4 * depth))
            data = np.frombuffer(names.buffers()[1], np.uint32)[names.offset * depth : (names.offset + len(names)) * depth].reshape(-1, depth)
            return np.concatenate([table.column("tree").to_numpy().astype(np.uint32)[:, None], data], 1)

        for batch in batches:
            if not batch.num_rows:
                continue
            prefixes = pa.array([x[: 4 * depth] for x in batch.column("slice").to_pylist()], pa.binary())
            table = pa.table([batch.column("class"), batch.column("tree"), prefixes], schema=kind)
            table = table if held is None else pa.concat_tables([held, table]).combine_chunks()
            own = nodes(table)
            same = (own[1:] == own[:-1]).all(1)
            met = np.zeros(len(own), bool)
            met[1:] |= same
            met[:-1] |= same
            met[0] |= held_met
            held, held_met = table.slice(len(own) - 1), bool(met[-1])
            yield from table.slice(0, len(own) - 1).filter(pa.array(met[:-1])).to_batches()
        if held is not None:
            yield from held.to_batches()

    return tries.mapInArrow(walk, "class binary, tree int, prefix binary")


def buckets(classes: DataFrame, depth: int, trees: int) -> DataFrame:
    """(class, tree, key, n) for the members of the nodes of a depth that have two or more. Of nodes with the same
    members, told by two 64-bit sums, one is taken."""
    keyed = materialize(trie_runs(classes, depth, trees).select("class", "tree", F.xxhash64("tree", "prefix").alias("key")), "tries")
    found = keyed.groupBy("key", "tree").agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("class")).alias("mark"), F.bit_xor(F.xxhash64("class", F.lit(1))).alias("mark_2")).filter(F.col("n") > 1)
    once = found.groupBy("n", "mark", "mark_2").agg(F.min(F.struct("tree", "key")).alias("b")).select("n", F.col("b.tree").alias("b_tree"), F.col("b.key").alias("b_key"))
    return keyed.join(once, (F.col("key") == F.col("b_key")) & (F.col("tree") == F.col("b_tree"))).select("class", "tree", "key", "n")


def common_counts(sets: list[np.ndarray]) -> np.ndarray:
    """Numbers of common elements of each two sets."""
    n = len(sets)
    owner = np.repeat(np.arange(n), [len(s) for s in sets])
    values, column, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = times > 1
    counts = np.zeros((n, n), np.float32)
    renumber = np.cumsum(shared) - 1
    use = shared[column]
    rows, cols = owner[use], renumber[column[use]]
    by = np.argsort(cols, kind="stable")
    rows, cols = rows[by], cols[by]
    for start in range(0, int(shared.sum()), COLUMNS):
        a, b = np.searchsorted(cols, (start, start + COLUMNS))
        part = np.zeros((n, min(COLUMNS, int(shared.sum()) - start)), np.float32)
        part[rows[a:b], cols[a:b] - start] = 1
        counts += part @ part.T
    return counts.astype(np.int64)


def compare(sets: list[np.ndarray], minima: np.ndarray, part: np.ndarray, tree: int, depth: int, threshold: float) -> np.ndarray:
    """The verified pairs (i, j) of one task that meet here for the first time."""
    sizes = np.array([len(s) for s in sets])
    common = common_counts(sets)
    either = sizes[:, None] + sizes[None, :] - common
    near = np.triu(common >= threshold * either - 1e-9, 1)
    if part.max() > part.min():  # pairs inside a part belong to the task of that part with itself
        near &= part[:, None] != part[None, :]
    i, j = np.nonzero(near)
    met = np.zeros(len(i), bool)
    for t in range(tree):
        met |= (minima[i, t, :depth] == minima[j, t, :depth]).all(1)
    return np.stack([i[~met], j[~met]], 1)


def verify(members: DataFrame, sets: DataFrame, depth: int, threshold: float, trees: int) -> DataFrame:
    """(class, root, links): per task and class with links."""
    parts = F.ceil(F.col("n") / MEMBERS).cast("int")
    cut = members.withColumn("parts", parts).withColumn("part", F.pmod(F.xxhash64("class"), F.col("parts")).cast("int"))
    spread = cut.select("class", "tree", "key", "part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other"))
    tasks = spread.select("class", "tree", "part", F.xxhash64("key", "tree", F.least("part", "other"), F.greatest("part", "other")).alias("task"))
    count = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = tasks.join(sets, "class").repartition(count, "task").sortWithinPartitions("task").select("task", "class", "tree", "part", "copies", "signature", "shingles")

    def judged(rows: list[tuple]) -> list[tuple]:
        n = len(rows)
        held = [np.frombuffer(r[6], np.uint64) for r in rows]
        minima = np.stack([np.frombuffer(r[5], np.uint32) for r in rows]).reshape(n, trees, DEPTH)
        pairs = compare(held, minima, np.array([r[3] for r in rows]), rows[0][2], depth, threshold)
        if not len(pairs):
            return []
        copies = np.array([r[4] for r in rows])
        links = np.bincount(pairs[:, 0], copies[pairs[:, 1]], n) + np.bincount(pairs[:, 1], copies[pairs[:, 0]], n)
        root = np.arange(n)
        while True:  # smallest place over the links, until nothing changes
            before = root.copy()
            np.minimum.at(root, pairs[:, 0], root[pairs[:, 1]])
            np.minimum.at(root, pairs[:, 1], root[pairs[:, 0]])
            root = root[root]
            if (root == before).all():
                break
        return [(rows[k][1], rows[root[k]][1], int(links[k])) for k in np.flatnonzero(links)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [pa.binary(), pa.binary(), pa.int64()]
        held: list[tuple] = []

        def done(out: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out) if out else [[]] * 3, types)], names=["class", "root", "links"])

        for batch in batches:
            out: list[tuple] = []
            for row in zip(*(batch.column(k) for k in range(batch.num_columns))):
                row = tuple(x.as_py() for x in row)
                if held and held[0][0] != row[0]:
                    out += judged(held) if len(held) > 1 else []
                    held = []
                held.append(row)
            yield done(out)
        yield done(judged(held) if len(held) > 1 else [])
        release_memory()

    return dealt.mapInArrow(run, "class binary, root binary, links long")


def shingle_sets(docs: DataFrame, wanted: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(class, shingles): the sorted distinct shingles of one document of each wanted class (w_id, w_digest)."""
    own = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text_col).alias("digest"), text_of(text_col).alias("text"))
    named = wanted.select("w_id", "w_digest")
    texts = own.join(broadcast_if(named, named.count(), 1_000_000), F.col("id").eqNullSafe(F.col("w_id")) & (F.col("digest") == F.col("w_digest")), "left_semi").select("text")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = [_hashes.of(x.as_py()) for x in batch.column(0)]
            found = [(xxhash.xxh3_128_digest(w.tobytes()), np.unique(shingles(w)).tobytes()) for w in words if len(w)]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.binary()) for c in (zip(*found) if found else [[]] * 2)], names=["class", "shingles"])
        _hashes.clear()
        release_memory()

    return texts.mapInArrow(rows, "class binary, shingles binary").dropDuplicates(["class"])


def groups(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.8, recall: float = 0.999, trees: int = TREES) -> DataFrame:
    """A row per document: id, digest (of the text), class_id, n_links, and first (whether it stands for its group: the
    smallest id, of one id the smallest digest)."""
    sketches = materialize(sketch(docs, id_col, text_col, trees), "sketches")
    one = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "digest")).alias("one")
    classes = sketches.filter("class is not null").groupBy("class").agg(F.count(F.lit(1)).alias("copies"), F.first("signature").alias("signature"), one)
    classes = materialize(classes.select("class", "copies", "signature", F.col("one.id").alias("w_id"), F.col("one.digest").alias("w_digest")), "classes")
    depth = depth_of(threshold, recall, trees)
    members = materialize(buckets(classes, depth, trees), "buckets")
    chosen = classes.join(members.select("class").distinct(), "class", "left_semi")
    sets = materialize(shingle_sets(docs, chosen, id_col, text_col).join(classes.select("class", "copies", "signature"), "class"), "shingles")
    everything = materialize(verify(members, sets, depth, threshold, trees), "links")
    labels = components(everything.select(F.col("class").alias("a"), F.col("root").alias("b")))
    linked = everything.groupBy("class").agg(F.sum("links").alias("links"))
    by_class = classes.select("class", "copies").join(linked, "class", "left").join(labels.withColumnRenamed("node", "class"), "class", "left")
    by_class = by_class.select("class", F.coalesce("label", "class").alias("label"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    # written, so that the joins' sides are dealt for them alone and Spark can split a large class or group
    placed = materialize(sketches.select("id", "digest", "class").join(materialize(by_class, "labels"), "class", "left"), "placed")
    named = materialize(placed.filter("label is not null").groupBy("label").agg(one), "named")
    alone = F.col("label").isNull()
    stands = F.col("id").eqNullSafe(F.col("one.id")) & F.col("digest").eqNullSafe(F.col("one.digest"))
    return placed.join(named, "label", "left").select("id", "digest", F.when(alone, F.col("id")).otherwise(F.col("one.id")).alias("class_id"), F.coalesce("n_links", F.lit(0)).alias("n_links"), (alone | F.coalesce(stands, F.lit(False))).alias("first"))


def jaccard_join(docs: DataFrame, **options) -> DataFrame:
    """A row per document: doc_id, class_id (smallest id of its group), n_links (documents of similarity >= threshold)."""
    return groups(docs, **options).select(F.col("id").alias("doc_id"), "class_id", "n_links")


def one_of_each(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The documents that stand for their groups, with their own columns; of repeated rows one."""
    found = materialize(groups(docs, id_col=id_col, text_col=text_col, **options), "groups")
    left = without(docs, found.filter("not first"), id_col, text_col, 1_000_000)
    repeated = found.filter("first").groupBy("id", "digest").count().filter("count > 1").limit(1).count()
    return left.dropDuplicates([id_col, text_col]) if repeated else left
