"""Vector codes against plain loops."""

import hashlib
import math
import random

import numpy as np
import pytest

from parceltrail.llm import part_codes

SCHEMA = "vec_id long, embedding array<float>, label int"
CLASHES = "vector code error part position n label_error _label"


def expected(rows, parts=8, entries=16, rounds=6, scale=4096):
    kept = [
        (i, [math.floor(scale * float(np.float32(x))) for x in v], label)
        for i, v, label in rows
        if v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    if not kept:
        return []
    length = len(kept[0][1])
    bounds = [[int(x) for x in (piece[0], piece[-1] + 1)] if len(piece) else [0, 0] for piece in np.array_split(range(length), parts)]
    same = [r for r in kept if len(r[1]) == length]
    books = [[r[1][a:b] for r in same[:entries]] for a, b in bounds]

    def assign(part, book):
        far = [sum((x - y) ** 2 for x, y in zip(part, e)) for e in book]
        return far.index(min(far)), min(far)

    for _ in range(rounds):
        for p, (a, b) in enumerate(bounds):
            members = {}
            for r in same:
                members.setdefault(assign(r[1][a:b], books[p])[0], []).append(r[1][a:b])
            for e, group in members.items():
                books[p][e] = [sum(c) // len(group) for c in zip(*group)]
    sha = hashlib.sha256(",".join(str(c) for book in books for e in book for c in e).encode()).hexdigest()
    out, labels = [], {}
    for i, v, label in kept:
        code = error = None
        if len(v) == length:
            found = [assign(v[a:b], books[p]) for p, (a, b) in enumerate(bounds)]
            code, error = "".join(f"{e:02x}" for e, _ in found), sum(f for _, f in found)
            labels[label] = labels.get(label, 0) + error
        out.append((i, code, error, label))
    return sorted(((i, c, e, labels.get(label), sha) for i, c, e, label in out), key=repr)


def found(spark, rows, clash=False, **how):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    for name in CLASHES.split() if clash else []:
        df = df.selectExpr("*", f"'clash' AS `{name}`")
    result = part_codes.compress(df, **how).select("vec_id", "code", "error", "label_error", "codebooks_sha256")
    return sorted((tuple(r) for r in result.collect()), key=repr)


def vectors(seed, n, dims, cells=None):
    rng = random.Random(seed)
    draw = (lambda: rng.randrange(cells) / 8) if cells else (lambda: rng.gauss(0, 0.3))
    return [(i, [draw() for _ in range(dims)], rng.choice([None, 1, 2])) for i in range(n)]


@pytest.mark.parametrize("cells", [None, 3])
def test_codes_of_plain_vectors_and_of_many_ties(spark, cells):
    rows = vectors(1, 150, 16, cells)
    assert found(spark, rows, clash=True) == expected(rows)


def test_awkward_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = vectors(2, 40, 16) + [
        (100, None, 1),
        (101, [None] + [0.0] * 15, 1),
        (102, [nan] * 16, 1),
        (103, [inf] + [0.0] * 15, None),
        (104, [], 1),
        (105, [0.5] * 9, 7),
        (None, [0.25] * 16, None),
        (106, [0.0] * 16, 2),
        (107, [-0.0001] * 16, 2),
    ]
    rows += [(5, [0.125] * 16, 1)] * 60 + [(5, [0.5] * 16, 1)]
    assert found(spark, rows) == expected(rows)


def test_few_rows_odd_lengths_and_none(spark):
    for rows in (vectors(3, 5, 16), vectors(4, 30, 11), vectors(5, 20, 3), [(1, [], 1), (2, [], None)], []):
        assert found(spark, rows) == expected(rows)


def test_components_beyond_doubles(spark):
    rows = [(i, [v * (1 + i % 7), -v, v / 3, float(i)], 1) for i, v in enumerate([1e3, 1e5, 2.5e5, 1e4] * 6)]
    assert found(spark, rows, parts=2, entries=4) == expected(rows, 2, 4)


def test_trie_in_narrow_steps(monkeypatch):
    """More nodes than are expanded at a time, long common prefixes, and integers that longs can't square."""
    monkeypatch.setattr(part_codes, "WIDTH", 3)
    rng = np.random.default_rng(5)
    for scale in (1, 1 << 40):
        parts = np.unique(rng.integers(-3, 4, (400, 5)), axis=0) * scale
        entries = rng.integers(-3, 4, (7, 5)) * scale
        codes, far = part_codes.nearest(parts, entries)
        squares = ((parts.astype(object)[:, None, :] - entries.astype(object)[None]) ** 2).sum(axis=2)
        assert codes.tolist() == [list(row).index(min(row)) for row in squares]
        assert far.tolist() == [min(row) for row in squares]
