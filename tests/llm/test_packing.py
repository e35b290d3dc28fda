import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from stormledger.llm import packing
from stormledger.llm.queries import QUERIES


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(packing.vocabulary_path())


def with_sources(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, source string, ids string, start int")


def corpus(seed=3, n=400):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices("abcdeé <|\n", k=rng.randint(1, 9)))
    text = lambda k: " ".join(word() for _ in range(k))
    source = lambda: rng.choice(["hot"] * 4 + ["b", "c", "d", None])
    rows = [(i, text(rng.randint(1, 80)), source(), "x", 1) for i in range(n)]
    rows += [(n, None, "b", "x", 1), (n + 1, "", "c", "x", 1), (None, "a <|endoftext|> b", "c", "x", 1), (5, "again", "hot", "x", 1)]
    return rows + [(n + 2, text(20_000), "c", "x", 1), (n + 3, " \n" * 12_000 + "a" * 30_000, "tiny", "x", 1)]


def check(pieces, rows, library, length):
    """Each id in exactly one piece, sequences gapless and either full or powers of two. Returns ids per sequence."""
    want = Counter()
    for doc, text, *_ in rows:
        want[(doc, tuple([*library.encode(text or "", add_special_tokens=False).ids, 1]))] += 1
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for p in pieces:
        ids = np.frombuffer(p.ids, "<u4").tolist()
        assert len(ids) == p.length > 0
        by_doc[(p.doc_id, p.doc_tokens)].append((p.start, ids))
        by_sequence[p.sequence_id].append((p.offset, ids))
    for doc, ids in want:
        if want[(doc, ids)] == 1 and sum(d == doc for d, _ in want) == 1:
            found = sorted(by_doc[(doc, len(ids))])
            assert [s for s, _ in found] == np.cumsum([0, *(len(x) for _, x in found[:-1])]).tolist()
            assert tuple(i for _, x in found for i in x) == ids
    assert sum(p.length for p in pieces) == sum(len(ids) * k for (_, ids), k in want.items())
    sizes = []
    assert sorted(by_sequence) == list(range(len(by_sequence)))
    for s in sorted(by_sequence):
        at = 0
        for offset, ids in sorted(by_sequence[s]):
            assert offset == at
            at += len(ids)
        sizes.append(at)
    tail = [n for n in sizes if n != length]
    assert sizes == [length] * (len(sizes) - len(tail)) + sorted(set(tail), reverse=True)
    assert all(n & (n - 1) == 0 for n in tail)
    return sizes


@pytest.mark.parametrize("targets", [None, {"hot": 1, "b": 1, "c": 2, "": 0.5}, {"b": 3.0}])
def test_pieces_and_mixture(spark, library, targets):
    rows = corpus()
    length, window = 64, 4
    pieces = packing.pack(with_sources(spark, rows).repartition(6), targets, length, window).collect()
    check(pieces, rows, library, length)
    size, totals, mix = length * window, Counter(), defaultdict(Counter)
    for p in pieces:
        totals[p.source] += p.length
        at = p.sequence_id * length + p.offset
        for i in range(at, at + p.length):
            mix[i // size][p.source] += 1
    wanted = targets or totals
    whole, slack = sum(w for q, w in wanted.items() if q in totals), 2 * len(totals)  # windows begin a few tokens early
    for w in range(sum(totals.values()) // size if targets is None else 1):
        for q in totals:
            assert abs(mix[w][q] - wanted.get(q, 0) * size / whole) <= slack


@settings(max_examples=150, deadline=None)
@given(
    st.dictionaries(st.sampled_from("abcdefgh"), st.integers(0, 300), min_size=1),
    st.none() | st.dictionaries(st.sampled_from("abcdefgh"), st.floats(0, 5) | st.integers(0, 3), min_size=1),
    st.sampled_from([1, 2, 7, 32]),
)
def test_schedule_covers_every_token_once(totals, targets, size):
    """Against a queue-by-queue loop over all tokens."""
    phases = packing.schedule(totals, size, targets)
    seen = []
    for queue, n in totals.items():
        at = 0
        for i, phase in enumerate(p for p in phases if queue in p.own):
            assert phase.taken[queue] == at
            stop = phase.head(queue, phase.windows)
            got = list(phase.stretches(queue, 0, stop))
            assert sum(k for _, k in got) == stop
            for start in range(0, stop, 5):
                part = [p + j for p, k in phase.stretches(queue, start, min(start + 3, stop)) for j in range(k)]
                assert part == [p + j for p, k in got for j in range(k)][start : start + 3]
            seen += [p + j for p, k in got for j in range(k)]
            at += stop
        assert at == n
    assert sorted(seen) == list(range(sum(totals.values())))


def test_deficit_round_robin_as_a_loop():
    """The closed form takes what a loop with deficits takes, window by window and queue by queue."""
    totals, size = {"a": 1000, "b": 333, "c": 2667, "d": 2}, 100
    (phase, *_) = packing.schedule(totals, size)
    whole, deficit, given, position = sum(totals.values()), Counter(), Counter(), 0
    assert phase.windows == whole // size
    for w in range(phase.windows):
        for q, n in totals.items():
            deficit[q] += n * size
            take, deficit[q] = divmod(deficit[q], whole)
            assert phase.begin(q, w) == position
            position += take
            given[q] += take
            assert phase.head(q, w + 1) == given[q]


def test_more_sources_than_allowed_and_empty_table(spark, monkeypatch):
    empty = packing.pack(with_sources(spark, []))
    assert empty.count() == 0 and empty.columns[0] == "doc_id"
    monkeypatch.setattr(packing, "MOST_QUEUES", 3)
    with pytest.raises(ValueError, match="sources"):
        packing.pack(with_sources(spark, corpus(n=60)))


def test_sequences(spark, library):
    rows = corpus(8, 60)
    pieces = packing.pack(with_sources(spark, rows), length=32, window=2)
    sizes = check(pieces.collect(), rows, library, 32)
    got = {r.sequence_id: len(r.ids) // 4 for r in packing.sequences(pieces).collect()}
    assert [got[i] for i in range(len(got))] == sizes


def test_table(spark, sf_dir, library):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    got = QUERIES["op12_packing"](spark, sf_dir).collect()
    ids = {d.doc_id: np.array([*library.encode(d.text or "", add_special_tokens=False).ids, 1], "<u4") for d in docs}
    covered = Counter()
    for p in got:
        x = ids[p.doc_id]
        assert p.doc_tokens == len(x) and p.ids_crc32 == zlib.crc32(x[p.start : p.start + p.length].tobytes())
        covered[p.doc_id] += p.length
    assert covered == {d: len(x) for d, x in ids.items()}
    assert len({(p.sequence_id, p.offset) for p in got}) == len(got)
