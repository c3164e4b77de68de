import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest

from millrace.llm import suffix_dedup


def brute(rows):
    """(doc_id, n_bytes, n_removed, n_spans, digest, kept) in the order of ids; nulls are the largest id."""
    seen, out = set(), []
    order = sorted(range(len(rows)), key=lambda k: (rows[k][0] is None, rows[k][0] or 0))
    k = 0
    while k < len(order):
        same = [j for j in order[k:] if rows[j][0] == rows[order[k]][0]]
        new = set()
        for j in same:
            data = (rows[j][1] or "").encode()
            gone = np.zeros(len(data), bool)
            for p in range(len(data) - 49):
                if data[p : p + 50] in seen:
                    gone[p : p + 50] = True
                new.add(data[p : p + 50])
            kept = np.frombuffer(data, np.uint8)[~gone].tobytes()
            spans = int((gone[1:] & ~gone[:-1]).sum()) + int(len(gone) > 0 and gone[0])
            out.append((rows[j][0], len(data), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest(), kept))
        seen |= new
        k += len(same)
    return sorted(out, key=str)


def found(df):
    return sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256, bytes(r.kept)) for r in suffix_dedup.repeats(df, with_kept=True).collect()), key=str)


def texts(seed):
    random.seed(seed)
    word = lambda: "".join(random.choices("abé ", k=random.randrange(2, 9)))
    pool = ["".join(word() for _ in range(40)) for _ in range(12)]
    out = []
    for _ in range(60):
        parts = [random.choice(pool)[random.randrange(100) :][: random.randrange(20, 200)] if random.random() < 0.6 else word() for _ in range(random.randrange(1, 6))]
        out.append("".join(parts))
    out += ["a" * n for n in (49, 50, 51, 400)] + ["ab" * 60, "ba" * 60, "x" * 49 + "y", "\0" * 120, "\0" * 60 + "z", pool[0], pool[0], ""]
    random.shuffle(out)
    return out


@pytest.mark.parametrize("seed,block,merge", [(1, 2_000_000, 1_024), (2, 300, 1_024), (3, 2_000, 1_024), (2, 300, 4), (3, 2_000, 1)])
def test_against_brute_force(spark, monkeypatch, seed, block, merge):
    monkeypatch.setattr(suffix_dedup, "BLOCK_BYTES", block)
    monkeypatch.setattr(suffix_dedup, "MERGE", merge)
    rows = list(enumerate(texts(seed)))
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as block", "2 as id", "3 as bucket").repartition(3)
    assert found(df) == brute(rows)


def test_documents(spark, documents, plain_documents):
    assert found(documents) == brute([(i, t) for i, t, _ in plain_documents])


def test_odd_rows(spark, odd_docs, no_docs):
    assert found(odd_docs) == brute([(r.doc_id, r.text) for r in odd_docs.collect()])
    assert found(no_docs) == []


def test_sort_is_the_order_of_suffixes():
    rng = np.random.default_rng(4)
    frames = np.zeros((400, suffix_dedup.ROW), np.uint8)
    frames[:, : suffix_dedup.FRAME] = rng.integers(97, 99, (400, suffix_dedup.FRAME))
    frames[200:] = frames[rng.integers(0, 200, 200)]
    flips = rng.integers(0, suffix_dedup.FRAME, 200)
    frames[np.arange(200, 400), flips] ^= rng.integers(0, 2, 200).astype(np.uint8)
    low, high = np.zeros(400, np.int64), np.full(400, 34)
    frame, offset, equal = suffix_dedup.sort_classes(frames, low, high)
    suffixes = [frames[f, o : o + 50].tobytes() for f, o in zip(frame, offset)]
    assert [False] + [a == b for a, b in zip(suffixes, suffixes[1:])] == equal.tolist()
    assert len(suffixes) == 400 * 35 and suffixes == sorted(suffixes)


def test_frames_of_one_name_are_compared(monkeypatch):
    rows = np.random.default_rng(2).integers(0, 3, (300, suffix_dedup.ROW)).astype(np.uint8)
    rows[:, 4:] = 0
    for name in (suffix_dedup.name_of, lambda rows, half: np.zeros(len(rows), np.uint64)):
        monkeypatch.setattr(suffix_dedup, "name_of", name)
        first, place = suffix_dedup.distinct(rows)
        assert len(first) == len({r.tobytes() for r in rows}) and (rows[first][place] == rows).all()


def test_common_grams_are_no_keys():
    """Texts that have only one anchor gram in common share no key, and frames have the keys of their anchors."""
    rng = random.Random(5)
    gram = "a common passage"
    words = ["".join(rng.choices("bcdfghjklm", k=60)) + gram + "".join(rng.choices("bcdfghjklm", k=60)) for _ in range(50)]
    table = pa.table({"id": pa.array(range(50), pa.int64()), "text": words})
    block = suffix_dedup.Block(table)
    assert len(gram) == suffix_dedup.GRAM and len(set(block.key.tolist())) == len(block.key)
    chosen = np.arange(len(block.anchor))
    assert (suffix_dedup.key_of(block.frames(chosen)) == block.key).all()
    strings = sorted(p for a, z in zip(block.low, block.high) for p in range(a, z + 1))
    assert strings == [p for at, n in zip(block.starts, block.lengths) for p in range(at, at + n - 49)]
