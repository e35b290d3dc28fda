import random
import re

import numpy as np
import pytest

from stormledger.llm import minhash


def brute_force(rows, words, percent):
    def shingles(text):
        low = (text or "").translate({c: c + 32 for c in range(65, 91)})
        w = re.findall("[^\x20\x09-\x0d]+", low)
        if not w:
            return set()
        return {tuple(w[i : i + words]) for i in range(max(1, len(w) - words + 1))}

    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    least = {}
    for i, (k, _) in enumerate(rows):
        least[find(i)] = min(k, least.get(find(i), k))
    return {k: (len(sets[i]), least[find(i)]) for i, (k, _) in enumerate(rows)}


def found(df):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in df.collect()}


def test_chains_and_groups_against_brute_force(docs_of):
    """Copies at growing distance from a base: links that only some members of a bucket have."""
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(3000)]
    rows = []
    for _ in range(4):
        base = rng.choices(vocabulary, k=120)
        for edits in (0, 0, 1, 1, 2, 2, 3, 3, 4, 5, 6, 7, 8):
            copy = list(base)
            for _ in range(edits):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            rows.append((len(rows) * 3 + 1, " ".join(copy)))
    rng.shuffle(rows)
    got = minhash.near_duplicates(docs_of(rows), words=4)
    assert found(got) == brute_force(rows, 4, 80)


def test_edge_texts(docs_of):
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "One two"), (5, "one TWO"), (6, "one"), (7, "É é"), (8, "é é"), (9, "x" * 5000)]
    got = minhash.near_duplicates(docs_of(rows).withColumnRenamed("source", "bands"), words=4)
    assert found(got) == brute_force(rows, 4, 80)
    assert found(got)[5] == (1, 4) and found(got)[8] == (1, 8)


def test_repeated_rows_null_ids_and_empty_table(docs_of):
    rows = [(1, "a b c d e"), (1, "a b c d e"), (None, "a b c d e"), (2, "a b c d e")]
    got = sorted(((r.doc_id, r.component_id, r.kept) for r in minhash.near_duplicates(docs_of(rows)).collect()), key=str)
    assert got == [(1, 1, True), (1, 1, True), (2, 1, False), (None, None, True)]
    assert minhash.near_duplicates(docs_of([])).count() == 0
    assert sorted(r.doc_id or 0 for r in minhash.keep_one(docs_of(rows)).collect()) == [0, 1]


def test_every_coordinate_fills_and_estimates():
    a = minhash.mix(np.arange(1, 101, dtype=np.uint64))
    b = minhash.mix(np.arange(21, 121, dtype=np.uint64))  # 80 of 120 in common
    one = minhash.mix(np.arange(1, 2, dtype=np.uint64))
    s = minhash.sketches(np.concatenate([a, b, one]), np.array([100, 200, 201]), 240)
    assert (s != np.uint64(0xFFFFFFFFFFFFFFFF)).all()
    assert abs((s[0] == s[1]).mean() - 80 / 120) < 0.12


def test_blocks_of_a_bucket(docs_of, monkeypatch):
    """Small blocks: the same components."""
    monkeypatch.setattr(minhash, "BLOCK", 3)
    rng = random.Random(8)
    base = [f"v{i}" for i in range(60)]
    rows = []
    for i in range(25):
        copy = list(base)
        for _ in range(i % 6):
            copy[rng.randrange(60)] = f"n{rng.randrange(9)}"
        rows.append((i, " ".join(copy)))
    assert found(minhash.near_duplicates(docs_of(rows), words=4)) == brute_force(rows, 4, 80)


def test_ids_with_several_texts(docs_of):
    """Links of one text are not lost to another text of the same id, whichever row comes first."""
    rng = random.Random(11)
    text = lambda: " ".join(rng.choices([f"v{i}" for i in range(900)], k=80))
    a, b, c = text(), text(), text()
    near = lambda t: " ".join([*t.split()[:-2], "odd", "end"])
    rows = [(1, a), (1, b), (3, near(b)), (2, a), (5, c), (4, near(c)), (4, c), (4, "own words only here"), (None, b), (6, "x y"), (1, a)]
    # rows are the documents; a group is named after its smallest id
    want = sorted([(1, 1), (1, 1), (1, 1), (3, 1), (2, 1), (5, 4), (4, 4), (4, 4), (4, 4), (None, None), (6, 6)], key=str)
    for given in (rows, rows[::-1], [rows[i] for i in (1, 0, 2, 7, 6, 5, 4, 3, 10, 9, 8)]):
        table = docs_of(given).withColumnRenamed("lang", "id")
        got = minhash.near_duplicates(table).collect()
        assert sorted(((r.doc_id, r.component_id) for r in got), key=str) == want
        assert all(r.kept == (r.doc_id == r.component_id) or r.doc_id is None for r in got)
        kept = minhash.keep_one(table).collect()
        assert [k for k, _ in sorted(((r.doc_id, r.text) for r in kept), key=str)] == [1, 1, 4, 4, 6, None]
        assert {r.text for r in kept if r.doc_id == 1} == {a, b}
        texts = {r.text for r in kept if r.doc_id == 4}
        assert len(texts) == 2 and "own words only here" in texts


def test_numbers_for_texts_beside_extreme_ids(docs_of):
    low, high = -(2**63), 2**63 - 1
    got = minhash.near_duplicates(docs_of([(low, "a b c d e f"), (low, "g h i j k l"), (7, "a b c d e f")])).collect()
    assert sorted((r.doc_id, r.component_id) for r in got) == [(low, low), (low, low), (7, low)]
    with pytest.raises(ValueError, match="numbers"):
        minhash.near_duplicates(docs_of([(low, "a"), (low, "b"), (high, "c")]))
