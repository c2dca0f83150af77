"""MinHash and odd sketches against brute force on full sets."""

import random

import numpy as np
import pytest

from parceltrail.llm import odd_sketch

from .conftest import prose

CLASHES = "n key bands sketch node bucket a b component component_id kept content set class chunk n_shingles _key _id"


def shingle_set(text):
    words = (text or "").encode().lower().split()
    return frozenset(zip(words, words[1:])) if len(words) > 1 else frozenset((w,) for w in words)


def expected(rows):
    """Sorted (doc_id, n_shingles, component_id, kept)."""
    sets = [shingle_set(r[1]) for r in rows]
    least = {}
    for r, s in zip(rows, sets):
        if s and r[0] is not None:
            least[s] = min(r[0], least.get(s, r[0]))
    nodes = sorted(least, key=least.get)
    root = dict(zip(nodes, nodes))

    def find(s):
        while root[s] is not s:
            s = root[s]
        return s

    for i, s in enumerate(nodes):
        for t in nodes[i + 1 :]:
            common = len(s & t)
            if 100 * common >= 80 * (len(s) + len(t) - common):
                root[find(t)] = find(s)
    ids = {}
    for s in nodes:
        ids[find(s)] = min(least[s], ids.get(find(s), least[s]))
    out = []
    for r, s in zip(rows, sets):
        component = None if r[0] is None else ids[find(s)] if s else r[0]
        out.append((r[0], len(s), component, r[0] == component))
    return sorted(out, key=repr)


def found(df):
    rows = odd_sketch.digest(df).select("doc_id", "n_shingles", "component_id", "kept").collect()
    return sorted((tuple(r) for r in rows), key=repr)


def edited(text, seed, share):
    """The text with a share of its words replaced."""
    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(10**6)}" if rng.random() < share else w for w in text.split())


def test_awkward_rows(documents, awkward):
    rows = [r[:2] for r in awkward] + [(30, "X"), (31, "x  "), (32, "a b"), (33, "A\tB"), (34, "a b a b a"), (None, None)]
    assert found(documents(rows, CLASHES)) == expected(rows)
    assert found(documents([])) == []
    assert found(documents([(1, None), (2, "")])) == expected([(1, None), (2, "")])


@pytest.fixture(scope="module")
def groups():
    """Copies, near copies on both sides of the limit, chains, and ids of strays before those of a group."""
    rows, at = [], 1000
    for g in range(6):
        base = prose(g, 150, 2000)
        for k in range(25):
            share = (0.0, 0.02, 0.05, 0.08, 0.1)[k % 5] if g < 4 else 0.055
            rows.append((at, edited(base, 100 * g + k, share)))
            at += 7
        # A stray with half of the text, smaller than all ids of its group.
        rows.append((g, " ".join(base.split()[:115]) + " " + prose(50 + g, 30)))
        rows += [(at + 1, base.upper()), (at + 2, base.upper())]
    return rows


def test_groups_and_strays(documents, groups):
    assert found(documents(groups)) == expected(groups)


def test_buckets_of_many_chunks(documents, groups, monkeypatch):
    """Buckets split to chunks of three members, classes with chunks of their own."""
    monkeypatch.setattr(odd_sketch, "CHUNK", 3)
    # The first pairs find nothing, so that the comparison within the buckets has to find all links.
    plain, calls = odd_sketch._confirmed, []

    def first_none(pairs, sets):
        calls.append(1)
        return plain(pairs, sets).where("a < 0") if len(calls) == 1 else plain(pairs, sets)

    monkeypatch.setattr(odd_sketch, "_confirmed", first_none)
    monkeypatch.setattr(odd_sketch, "_estimated", lambda pairs, nodes: pairs.where("a < 0"))
    small = [r for r in groups if r[0] < 1400]
    # Buckets of two members are not compared again, so each text has a third in its buckets.
    assert [r[2:] for r in found(documents(small))] == [r[2:] for r in expected(small)]
    assert len(calls) > 1


def test_same_id_in_several_classes(documents):
    one, other = prose(1), prose(2)
    rows = [(5, one), (5, other), (3, one + " more"), (9, other), (5, one), (7, "alone here")]
    assert found(documents(rows)) == expected(rows)
    kept = sorted((r.doc_id, r.text) for r in odd_sketch.keep_first(documents(rows)).collect())
    assert kept == sorted([(3, one + " more"), (5, other), (7, "alone here")])


def test_long_texts_in_pieces(monkeypatch):
    text = (prose(3, 5000) + " éÉ X").encode()
    whole = odd_sketch.shingles(text, odd_sketch._Words())
    assert len(whole) == len(shingle_set(text.decode()))
    for piece in (1, 7, 100):
        monkeypatch.setattr(odd_sketch, "PIECE", piece)
        assert (odd_sketch.shingles(text, odd_sketch._Words()) == whole).all()
    assert len(odd_sketch.shingles(b"   one  ", odd_sketch._Words())) == 1
    assert len(odd_sketch.shingles(b" \t ", odd_sketch._Words())) == 0


@pytest.mark.parametrize("similar", [0.8, 0.9, 0.98])
def test_estimates_are_close(similar):
    """Means within 0.01 and deviations as the samples' number allows."""
    rng = np.random.default_rng(7)
    guesses = []
    for _ in range(300):
        n = 400
        common = round(2 * n * similar / (1 + similar))
        drawn = rng.integers(0, 1 << 63, 2 * n - common, dtype=np.uint64)
        sets = [np.unique(drawn[:n]), np.unique(drawn[n - common :])]
        one, other = odd_sketch.sketches(odd_sketch.samples(sets))
        guesses.append(odd_sketch.similarity(np.array([np.bitwise_count(one ^ other).sum(dtype=np.int64)]))[0])
    assert abs(np.mean(guesses) - similar) < 0.01
    assert np.std(guesses) < 1.4 * np.sqrt(similar * (1 - similar) / odd_sketch.SAMPLES) + 0.005


def test_pairs_at_the_limit_share_a_band():
    rng = np.random.default_rng(8)
    for _ in range(200):
        drawn = rng.integers(0, 1 << 63, 110, dtype=np.uint64)
        sets = [np.unique(drawn[:99]), np.unique(drawn[11:])]
        both = odd_sketch.bands(odd_sketch.samples(sets))
        assert (both[0] == both[1]).any()


def test_the_wide_sketch_never_drops_a_link():
    """Differing bits are at most the differing shingles, and tell most pairs below the limit."""
    rng = np.random.default_rng(9)
    dropped = 0
    for common in (360, 356, 330, 300) * 50:
        drawn = rng.integers(0, 1 << 63, 800 - common, dtype=np.uint64)
        one, other = np.unique(drawn[:400]), np.unique(drawn[400 - common :])
        bits = [np.frombuffer(odd_sketch.wide_sketch(s), dtype=np.uint64) for s in (one, other)]
        apart = int(np.bitwise_count(bits[0] ^ bits[1]).sum())
        assert apart <= 800 - 2 * common
        may = odd_sketch.can_link(np.array([apart]), np.array([800]))[0]
        assert may or 100 * common < 80 * (800 - common)
        dropped += not may
    assert dropped >= 95


def test_forests_connect_what_their_pairs_connect():
    rng = np.random.default_rng(10)
    for n, pairs in ((2, 1), (30, 25), (60, 400), (5, 0)):
        cls = rng.integers(0, n, 2 * n)
        x, y = rng.integers(0, 2 * n, (2, pairs))
        apart = cls[x] != cls[y]
        x, y = x[apart], y[apart]
        kept = odd_sketch._forest(x, y, rng.random(len(x)).round(1), cls)

        def parts(x, y):
            union = odd_sketch.Union(n)
            union.link(cls[x], cls[y])
            return union.root.tolist()

        assert parts(x[kept], y[kept]) == parts(x, y)
        assert len(kept) == n - len(set(parts(x, y)))
