"""SimHash classes and suffix dedup against brute force."""

import hashlib
from collections import defaultdict

import numpy as np
import pytest
from xxhash import xxh64_intdigest

from parceltrail.llm import simhash, suffix, suffix_sort
from parceltrail.llm.components import components

from .conftest import prose

CLASHES = "component_id fingerprint node id a b chunk body size bucket keys strings _x sub block"


def expected_print(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def expected_classes(rows, bits=3):
    """{(doc_id, fingerprint): component} of rows with an id."""
    prints = defaultdict(set)
    for doc_id, text in rows:
        if doc_id is not None:
            prints[expected_print(text)].add(doc_id)
    nodes = sorted(prints)
    root = {p: p for p in nodes}

    def find(p):
        while root[p] != p:
            p = root[p]
        return p

    for i, p in enumerate(nodes):
        for q in nodes[i + 1 :]:
            if (p ^ q).bit_count() <= bits:
                root[find(q)] = find(p)
    least = defaultdict(lambda: 1 << 62)
    for p in nodes:
        least[find(p)] = min(least[find(p)], *prints[p])
    return {(i, f"{p:016x}"): least[find(p)] for p in nodes for i in prints[p]}


def test_fingerprints_and_classes(documents, awkward):
    near = [(100 + i, prose(50, 300) + " word" * (i % 3)) for i in range(12)]
    rows = [r[:2] for r in awkward] + near
    found = simhash.digest(documents(rows, CLASHES)).collect()
    assert len(found) == len(rows)
    expected = expected_classes(rows)
    for r in found:
        if r.doc_id is None:
            assert r.component_id is None
        else:
            assert expected[r.doc_id, r.fingerprint] == r.component_id
    assert {r.fingerprint for r in found if r.doc_id in (2, 3, 4)} == {"0" * 16}


@pytest.mark.parametrize("most", [200_000, 5])
def test_trie_join_links_what_brute_force_links(spark, most):
    """Clusters, chains of three bits, and subtries too large for one task."""
    rng = np.random.default_rng(3)
    prints = set()
    for _ in range(40):
        base = int(rng.integers(0, 1 << 63)) << 1
        for _ in range(12):
            flips = rng.choice(64, int(rng.integers(0, 5)), replace=False)
            prints.add(base ^ sum(1 << int(b) for b in flips))
    chain = 0xF0F0
    for i in range(0, 63, 3):
        chain ^= 0b111 << i
        prints.add(chain)
    prints = sorted(prints)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    df = spark.createDataFrame([(p,) for p in signed], "fingerprint long").repartition(4)
    links = simhash.links(df, 3, most)
    assert links.count() <= (4 if most > 5 else 4 * 93) * len(prints)
    found = {r.node: r.component for r in components(links).collect()}
    root = list(range(len(prints)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 3:
                root[find(i)] = find(j)
    groups = defaultdict(set)
    for i, p in enumerate(signed):
        groups[find(i)].add(p)
    expected = {p: min(g) for g in groups.values() for p in g if p != min(g)}
    assert found == expected


def test_more_bits_than_blocks_are_refused(spark):
    with pytest.raises(ValueError, match="at most 3 bits"):
        simhash.links(spark.createDataFrame([(1,)], "fingerprint long"), 4)


def test_few_links_are_united_in_one_task(spark):
    rng = np.random.default_rng(4)
    links = [tuple(int(x) for x in rng.integers(-200, 200, 2)) for _ in range(150)] + [(i, i + 1) for i in range(1000, 1100)]
    df = spark.createDataFrame(links, "a long, b long")
    plain, one = (sorted(map(tuple, components(df, few=few).collect())) for few in (0, 1_000))
    assert plain == one and one
    assert components(df.limit(0), few=10).count() == 0


def test_components_of_paths_stars_and_repeats(spark):
    path = [(i, i + 1) for i in range(50)]
    star = [(100, 100 + i) for i in range(1, 60)]
    rows = path + star + [(5, 4), (200, 200), (-3, 100), (100, 101)]
    found = {r.node: r.component for r in components(spark.createDataFrame(rows, "a long, b long")).collect()}
    assert found == {i: 0 for i in range(1, 51)} | {i: -3 for i in range(100, 160)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_keep_first_keeps_one_of_each_class(documents, awkward):
    df = documents([r for r in awkward], "_id _n _gone component_id")
    kept = simhash.keep_first(df)
    assert kept.columns == df.columns
    ids = [r.doc_id for r in kept.collect()]
    named = set(expected_classes([r[:2] for r in awkward]).values())
    assert sorted(i for i in ids if i is not None) == sorted(named) and ids.count(None) == 2


def test_repeated_rows_leave_one(documents):
    rows = [(7, prose(1)), (7, prose(1)), (7, prose(1)), (8, prose(9))]
    assert sorted(r.doc_id for r in simhash.keep_first(documents(rows)).collect()) == [7, 8]


def test_one_id_with_several_texts_keeps_each_class(documents):
    # 7 has two unlinked texts; 9 a copy of 3's text and one of its own; both texts of 5 are near copies of 4's.
    near = [prose(4) + end for end in ("", "!", " ")]
    assert len(set(expected_classes(list(enumerate(near))).values())) == 1
    rows = [(7, prose(1)), (7, prose(2)), (3, prose(3)), (9, prose(3)), (9, prose(5)), (9, prose(5))]
    rows += [(4, near[0]), (5, near[1]), (5, near[2]), (6, near[0])]
    kept = sorted((r.doc_id, r.text) for r in simhash.keep_first(documents(rows)).collect())
    assert kept == sorted([(7, prose(1)), (7, prose(2)), (3, prose(3)), (9, prose(5)), (4, near[0])])


def test_one_text_of_the_first_id_stays(documents):
    rows = [(4, prose(4), "en", "a"), (4, prose(4) + "!", "en", "a"), (5, prose(4), "en", "a"), (4, prose(4), "fr", "b")]
    kept = [[tuple(r) for r in simhash.keep_first(documents(rows[::step])).collect()] for step in (1, -1)]
    assert len(kept[0]) == 1 and kept[0][0][0] == 4 and kept[0] == kept[1]


def test_empty_tables(documents):
    assert simhash.digest(documents([])).count() == 0
    assert suffix.digest(documents([])).count() == 0
    assert suffix.cut(documents([])).count() == 0


def expected_removal(rows):
    rows = [(i, (t or "").encode()) for i, t in rows]
    least = {}
    for i, t in rows:
        for p in range(len(t) - 49):
            if i is not None:
                least[t[p : p + 50]] = min(least.get(t[p : p + 50], i), i)
    out = []
    for i, t in rows:
        gone = np.zeros(len(t) + 1, dtype=int)
        for p in range(len(t) - 49):
            if i is not None and least[t[p : p + 50]] < i:
                gone[p : p + 50] = 1
        gone = gone[: len(t)]
        kept = bytes(b for b, g in zip(t, gone) if not g)
        spans = int((np.diff(np.concatenate([[0], gone])) == 1).sum())
        out.append((i, len(t), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("hot", [suffix.HOT, 1, 0])
def test_suffix_dedup(documents, awkward, hot, monkeypatch):
    monkeypatch.setattr(suffix, "CHUNK", 3000)  # many chunks
    monkeypatch.setattr(suffix, "BUCKET", 30_000)
    shared = prose(70, 40)
    rows = [r[:2] for r in awkward if r[0] != 5] + [(5, prose(1, 2000))]
    rows += [(20 + i, prose(80 + i, 30) + shared + prose(180 + i, 20)) for i in range(12)]
    rows += [(50, "ab" * 400), (51, "ab" * 200), (52, "é" * 100), (53, "xé" + "é" * 60)]
    found = suffix.digest(documents(rows, CLASHES), hot).collect()
    assert sorted((tuple(r) for r in found), key=str) == expected_removal(rows)


def test_cut_returns_documents(documents):
    rows = [(1, prose(1)), (2, "start " + prose(1) + " end"), (3, None), (4, prose(5)), (None, prose(1))]
    df = documents(rows, "chunk body strings keys")
    found = {r.doc_id: r for r in suffix.cut(df).collect()}
    assert suffix.cut(df).schema == df.schema
    assert found[1].text == prose(1) and found[None].text == prose(1) and found[3].text is None
    assert found[2].text == "start  end".replace("  ", " " + " ", 1) or found[2].text in ("start  end", "start end")
    assert found[2].n_chars == len(found[2].text) and found[4].text == prose(5)


def test_sorting_slices():
    rng = np.random.default_rng(1)
    for letters in (1, 2, 5):
        data = rng.integers(97, 97 + letters, 600).astype(np.uint8)
        text = suffix_sort.Hashed(data)
        start, length = rng.integers(0, 500, 400), rng.integers(0, 100, 400)
        group = rng.integers(0, 3, 400).astype(np.uint64)
        key = [(int(group[i]), data[start[i] : start[i] + length[i]].tobytes()) for i in range(400)]
        order = suffix_sort.sort_slices(text, start, length, group)
        assert [key[i] for i in order] == sorted(key)
        kinds = suffix_sort.classes(text, start, length, group)
        assert len(set(zip(kinds.tolist(), key))) == len(set(key)) == len(set(kinds.tolist()))


def test_a_hash_collision_does_not_join_texts(monkeypatch):
    """With a hash that knows no bytes everything collides; comparing bytes still tells texts apart."""
    data = np.frombuffer(b"abcabdabcabe", dtype=np.uint8)
    text = suffix_sort.Hashed(data)
    text.prefix[:] = 0
    start = np.array([0, 3, 6, 9])
    kinds = suffix_sort.classes(text, start, np.full(4, 3), np.zeros(4, dtype=np.uint64))
    assert kinds[0] == kinds[2] and len(set(kinds.tolist())) == 3
