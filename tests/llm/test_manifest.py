"""The Merkle manifest against a plain hash tree."""

import hashlib
import zlib
from collections import defaultdict

import pytest

from parceltrail.llm import merkle

from .conftest import prose

CLASHES = "leaf digest tree place size block way root changed _place _copy _start _lang _at _part"


def sha(*parts):
    return hashlib.sha256(b"".join(parts)).hexdigest().encode()


def field(value):
    if value is None:
        return b"-"
    raw = str(value).encode()
    return b"%d:%s" % (len(raw), raw)


def leaf(doc_id, source, lang, n_chars, text):
    return sha(*map(field, (doc_id, source, lang, n_chars, text)))


def tree(digests, fan):
    levels = [digests]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([sha(*below[i : i + fan]) for i in range(0, len(below), fan)])
    return levels


def expected(rows, fan=8, every=3):
    """Sorted rows of the result."""
    langs = defaultdict(list)
    for doc_id, text, lang, source in rows:
        full = (doc_id, source, lang, None if text is None else len(text), text)
        langs[lang].append((doc_id is not None, doc_id or 0, leaf(*full), full))
    names = sorted(langs, key=lambda n: (n is not None, (n or "").encode()))
    for members in langs.values():
        members.sort(key=lambda m: m[:3])
    trees = {n: tree([m[2] for m in langs[n]], fan) for n in names}
    crown = tree([trees[n][-1][0] for n in names], fan)
    root, out = crown[-1][0], []
    for at, name in enumerate(names):
        for i, (_, _, own, full) in enumerate(langs[name]):
            digest, proof = own, b""
            if full[0] is not None and zlib.crc32(str(full[0]).encode()) % every == 0 and full[4] is not None:
                digest = leaf(*full[:4], full[4].encode().lower().decode())
            for levels, place in ((trees[name], i), (crown, at)):
                for level in levels[:-1]:
                    first = place // fan * fan
                    run = level[first : first + fan]
                    proof += b"".join(d for k, d in enumerate(run) if first + k != place)
                    run[place - first] = digest
                    digest, place = sha(*run), place // fan
            texts = [d.decode() for d in (own, trees[name][-1][0], root, sha(proof), digest)]
            out.append((full[0], *texts, digest == root))
    return sorted(out, key=repr)


def found(df, **how):
    return sorted((tuple(r) for r in merkle.verify(df, **how).collect()), key=repr)


def whole(rows):
    return [(r + (None,) * 4)[:4] for r in rows]


def test_awkward_rows(documents, awkward):
    capital = [(20 + i, prose(i).upper(), "EN", "A") for i in range(4)]
    rows = awkward + capital
    assert found(documents(rows, CLASHES)) == expected(whole(rows))
    noticed = [r for r in expected(whole(rows)) if not r[-1]]
    assert noticed


@pytest.mark.parametrize("fan, levels", [(2, 2), (3, 1), (8, 2)])
def test_many_blocks_and_languages(documents, fan, levels):
    """Trees of several tables, last runs of one node, and more languages than a block holds."""
    sizes = {"big": 70, "odd": 65, "one": 1, "exact": fan**levels, "more": fan**levels + 1}
    sizes |= {f"x{i:02d}": 1 + i % 3 for i in range(20)}
    rows = [(1000 * k + i, f"Text {i}", name, None) for k, (name, n) in enumerate(sizes.items()) for i in range(n)]
    assert found(documents(rows), fan=fan, levels=levels) == expected(rows, fan)


def test_empty_table_one_row_and_one_language(documents):
    assert found(documents([])) == []
    for rows in ([(3, "Only", "en", "a")], [(i, f"T{i}", None, None) for i in range(9)]):
        assert found(documents(rows)) == expected(rows)


def test_repeated_rows_without_ids(documents):
    rows = [(None, "Same", "en", "a")] * 100 + [(5, "Same", "en", "a")] * 30
    assert found(documents(rows)) == expected(rows)


def test_folding_resumes_the_state_before_the_slot():
    children = [sha(b"%d" % i) for i in range(8)]
    parent = merkle.Parent(children)
    assert parent.digest == sha(*children)
    for slot in range(8):
        changed = [*children[:slot], sha(b"new"), *children[slot + 1 :]]
        assert parent.fold(slot, sha(b"new")) == sha(*changed)
        assert parent.fold(slot, children[slot]) == parent.digest
        assert parent.siblings(slot) == b"".join(children[:slot] + children[slot + 1 :])
