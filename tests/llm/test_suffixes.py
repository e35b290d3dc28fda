import collections
import hashlib
import random

import pytest

from stormledger.llm import suffixes
from stormledger.llm.suffixes import LENGTH


def brute_force(texts):
    raws = [(t or "").encode() for t in texts]
    count = collections.Counter(b[i : i + LENGTH] for b in raws for i in range(len(b) - LENGTH + 1))
    out = []
    for b in raws:
        gone = bytearray(len(b))
        for i in range(len(b) - LENGTH + 1):
            if count[b[i : i + LENGTH]] > 1:
                gone[i : i + LENGTH] = b"\1" * LENGTH
        kept = bytes(c for c, g in zip(b, gone) if not g)
        spans = sum(1 for i in range(len(b)) if gone[i] and (i == 0 or not gone[i - 1]))
        out.append((len(b), len(b) - len(kept), spans, hashlib.sha256(kept).hexdigest()))
    return out


def texts():
    rng = random.Random(3)
    word = lambda: "".join(rng.choices("abcdefgé ", k=rng.randint(2, 9)))
    some = lambda n: " ".join(word() for _ in range(n))
    passage, long = some(90), some(200)
    odd = list(passage)
    odd[len(odd) // 2] = "#"
    return [
        None, "", "short", "a" * 399, "a" * 400, "b" * 401, "ab" * 500, "abc" * 300,
        some(50) + passage + some(50), passage + some(9), some(70) + passage, some(5) + "".join(odd) + some(5),
        long, long, long[:500] + some(60) + long[100:700], long[-450:] + some(20) + long[:420],
        some(300), passage[: 399], passage[1:401] + some(10), "é" * 300, "x" + "é" * 300,
    ]


@pytest.mark.parametrize("most, classes", [(suffixes.MOST_SEGMENTS, suffixes.CLASSES), (1, suffixes.CLASSES), (2, (100, 7, 1)), (1, (1,))])
def test_against_brute_force(docs_of, monkeypatch, most, classes):
    """Collections as they are, and split by place until they fit a task."""
    monkeypatch.setattr(suffixes, "MOST_SEGMENTS", most)
    monkeypatch.setattr(suffixes, "CLASSES", classes)
    monkeypatch.setattr(suffixes, "BLOCK_SEGMENTS", 5)
    rows = list(enumerate(texts()))
    got = {r.doc_id: tuple(r)[1:] for r in suffixes.removal_digests(docs_of(rows).withColumnRenamed("lang", "k1")).collect()}
    assert [got[i] for i, _ in rows] == brute_force([t for _, t in rows])


def test_table_against_brute_force(documents):
    rows = documents.limit(120).collect()
    got = {r.doc_id: tuple(r)[1:] for r in suffixes.removal_digests(documents.limit(120)).collect()}
    assert [got[r.doc_id] for r in rows] == brute_force([r.text for r in rows])


def test_one_anchor_of_many_segments_meets_in_no_single_task(docs_of, monkeypatch):
    """A passage in many near copies: the largest collection that is built stays within the bound."""
    monkeypatch.setattr(suffixes, "MOST_SEGMENTS", 40)
    rng = random.Random(4)
    passage = "".join(rng.choices("abcdefgh ", k=600))
    rows = []
    for i in range(260):
        near = list(passage)
        for _ in range(rng.randint(0, 2)):
            near[rng.randrange(len(near))] = "#"
        rows.append((i, f"{rng.random()} " * 4 + "".join(near) + f" {rng.random()}" * 3))
    built = []
    real = suffixes.shared_windows
    monkeypatch.setattr(suffixes, "shared_windows", lambda segments: built.append(segments) or real(segments))
    got = {r.doc_id: tuple(r)[1:] for r in suffixes.removal_digests(docs_of(rows)).collect()}
    assert [got[i] for i, _ in rows] == brute_force([t for _, t in rows])
    largest = [s.groupBy("coll").count().agg({"count": "max"}).first()[0] for s in built]
    assert len(built) > 1 and max(n or 0 for n in largest) <= 40


def test_repeated_rows_null_ids_and_empty_table(docs_of):
    t = "".join(random.Random(1).choices("abcdef", k=700))
    got = suffixes.removal_digests(docs_of([(1, t), (1, t), (None, t), (2, "z")])).collect()
    assert sorted(r.n_removed for r in got) == [0, 700, 700, 700]
    assert suffixes.removal_digests(docs_of([])).count() == 0
    kept = suffixes.remove_duplicates(docs_of([(1, t), (2, t + "é"), (3, None)]))
    assert kept.columns == docs_of([]).columns
    assert sorted((r.text or "-") for r in kept.collect()) == ["-", "-", "é"]
