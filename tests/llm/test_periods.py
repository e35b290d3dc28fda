import hashlib
import random
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from stormledger.llm import periods
from stormledger.llm.queries import QUERIES


def brute_force(words):
    """(start, period, length) of every run, by trying every period at every place."""
    n, out = len(words), set()
    for p in range(1, n // 4 + 1):
        i = 0
        while i + p < n:
            j = i
            while j + p < n and words[j] == words[j + p]:
                j += 1
            length = j - i + p
            if j > i and length >= max(6, 4 * p):
                smaller = (q for q in range(1, p) if all(words[k] == words[k + q] for k in range(i, i + length - q)))
                if next(smaller, None) is None:
                    out.add((i, p, length))
            i = max(j, i + 1) if j == i else j + 1
    return sorted(out)


def through_tiles(words):
    """Fragments of the tiles, stitched in plain Python."""
    number = {}
    ids = [number.setdefault(w, len(number)) for w in words]
    found = sorted(set(periods.fragments([[9] * 3, ids, [], [9] * 3])[1]))
    out = []
    for p, start, stop in found:
        if out and out[-1][0] == p and start <= out[-1][2]:
            out[-1][2] = max(out[-1][2], stop)
        else:
            out.append([p, start, stop])
    return sorted((s, p, e - s + p) for p, s, e in out if e - s + p >= max(6, 4 * p))


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from("aab"), max_size=70), st.integers(1, 17), st.integers(0, 90), st.lists(st.sampled_from("abc"), max_size=30))
def test_tiles_against_brute_force(head, p, n, tail):
    base = head[:p] or ["z"]
    words = [*head, *(base[i % len(base)] for i in range(n)), *tail]
    assert through_tiles(words) == brute_force(words)


def test_long_runs_of_every_octave():
    rng = random.Random(4)
    for p in (1, 2, 3, 5, 8, 31, 64, 100, 257):
        base = [rng.randrange(10**6) for _ in range(p)]
        words = [rng.randrange(10**6) for _ in range(rng.randint(0, 700))]
        start = len(words)
        words += [base[i % p] for i in range(4 * p + rng.randint(2, 3 * p + 2))]
        length = len(words) - start
        words += [-1, *words[:50]]
        assert through_tiles(words) == [(start, p, length)]


def texts():
    rng = random.Random(7)
    word = lambda: rng.choice(["ab", "c", "dé", "日本", "e-f", "g"])
    some = lambda k: " ".join(word() for _ in range(k))
    block = some(40)
    return [
        None, "", " \n\t", "one", "a a a a a", "a a a a a a", "a a a a a a a a a a a a", " x\ty\nx y\x0bx y\x0cx y ",
        "b " * 5000, "a b " * 700 + "c", some(30) + " " + (block + " ") * 9 + some(20), (some(3) + " ") * 4, "q " + "r s t " * 40 + "r s " * 40,
        *(some(rng.randint(1, 120)) for _ in range(40)), *((some(rng.randint(1, 6)) + " ") * rng.randint(2, 30) + some(8) for _ in range(30)),
    ]


def digests(text):
    raw = (text or "").encode().split()
    runs = brute_force(raw)
    gone = {i for s, p, n in runs for i in range(s + p, s + n)}
    sha = lambda b: hashlib.sha256(b).hexdigest()
    top = min(runs, key=lambda r: (-r[2], r[0], r[1])) if runs else None
    longest = (top[0], top[2], top[1], 1000 * top[2] // top[1]) if top else (None,) * 4
    lines = "".join(f"{s},{n},{p}\n" for s, p, n in runs)
    return (len(runs), *longest, sha(lines.encode()), sha(b" ".join(w for i, w in enumerate(raw) if i not in gone)))


COLUMNS = ["n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


def test_digests_against_brute_force(docs_of):
    rows = [*enumerate(texts()), (3, "a b " * 20), (None, "n " * 9), (4, texts()[4])]
    table = docs_of(rows).withColumnsRenamed({"lang": "runs", "source": "k1", "n_chars": "fragments"}).repartition(4)
    got = sorted(((r.doc_id, tuple(r[c] for c in COLUMNS)) for r in periods.run_digests(table).collect()), key=str)
    assert got == sorted(((i, digests(t)) for i, t in rows), key=str)


def test_collapsed_texts(docs_of):
    rows = list(enumerate(texts()))
    table = docs_of(rows).withColumnsRenamed({"lang": "k2", "source": "k1", "n_chars": "fragments"})
    got = periods.collapse_runs(table)
    assert got.columns == ["doc_id", "k2", "k1", "fragments", "text", "runs"]
    for r in got.collect():
        raw = (rows[r.doc_id][1] or "").encode().split()
        runs = brute_force(raw)
        assert [tuple(x) for x in r.runs or []] == runs
        gone = {i for s, p, n in runs for i in range(s + p, s + n)}
        assert r.text == (None if rows[r.doc_id][1] is None else b" ".join(w for i, w in enumerate(raw) if i not in gone).decode())


def test_empty_table(docs_of):
    assert periods.run_digests(docs_of([])).count() == 0
    assert periods.collapse_runs(docs_of([])).count() == 0


def planted(doc_id, text):
    words = (text or "").encode().split()
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if h % 10 == 0 and n:
        a = (h // 10) % n
        p = 1 + (n - a) // (3 + (h // 10) % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    return b" ".join(words).decode()


@pytest.mark.parametrize("longest", [2500])
def test_table(spark, sf_dir, longest):
    """Texts of up to ``longest`` words against brute force; the others through the tiles in plain Python."""
    got = {r.doc_id: tuple(r[c] for c in COLUMNS) for r in QUERIES["op11_periods"](spark, sf_dir).collect()}
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    assert len(got) == len(docs)
    for d in docs:
        text = planted(d.doc_id, d.text)
        words = text.encode().split()
        if len(words) <= longest:
            assert got[d.doc_id] == digests(text)
        else:
            assert got[d.doc_id][0] == len(through_tiles(words))
