"""Held-out accuracy on the given tables; defined results for odd input."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from stormledger.llm import langid, quality, toxicity
from stormledger.llm.common import held_out
from stormledger.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"
ODD = [(1, None), (2, ""), (3, "12 !? 😀"), (4, "the and " * 20000), (5, "x\n\n\ny"), (5, "x\n\n\ny"), (None, "é")]


def test_held_out_matches_crc32(spark):
    import zlib

    got = spark.range(50).select("id", held_out(F.col("id"), 3, 1).alias("h")).collect()
    assert all(r.h == (zlib.crc32(str(r.id).encode()) % 3 == 1) for r in got)


@pytest.fixture(scope="module")
def labelled(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang")
    return docs.join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id", "left")


def test_language(spark, labelled):
    got = QUERIES["op3_langid"](spark, SF).join(labelled, "doc_id").where("held_out").toPandas()
    assert len(got) > 250 and (got.lang == got.lang_pred).mean() > 0.97
    assert got.score.between(0, 1).all()


def test_quality(spark, labelled):
    got = QUERIES["op4_quality"](spark, SF).join(labelled.where("quality is not null"), "doc_id").where("held_out").toPandas()
    assert (got.quality == got.predicted).mean() > 0.95 and got.score.between(0, 1).all()


def test_toxicity(spark, labelled):
    got = QUERIES["op5_toxicity"](spark, SF).join(labelled.where("toxic is not null"), "doc_id").where("held_out").toPandas()
    assert (got.toxic == got.predicted).mean() > 0.9 and got.score.between(0, 1).all()


def test_language_of_odd_texts(docs_of):
    sample = docs_of([(i, t, lang) for i, (t, lang) in enumerate([("the cat and the dog", "en"), ("der hund und die katze", "de")] * 5)])
    model = langid.train(sample)
    got = {r.doc_id: r for r in langid.classify(docs_of(ODD).withColumnRenamed("source", "score"), model).collect()}
    assert [got[i].lang_pred for i in (1, 2, 3, 4)] == ["und", "und", "und", "en"]
    assert got[1].score == 0 and got[None].lang_pred in ("de", "en")
    assert {r.lang_pred for r in langid.classify(docs_of(ODD), langid.train(docs_of([]))).collect()} == {"und"}
    assert langid.classify(docs_of([]), model).count() == 0
    assert sorted(r.doc_id or 0 for r in langid.keep_identified(docs_of(ODD), model).collect()) == [0, 4, 5, 5]
    assert langid.keep_identified(docs_of(ODD), None).count() == len(ODD)


def test_language_of_a_long_text_is_that_of_all_of_it(docs_of):
    """Grams that cross the inner blocks of a long text count, and both halves do."""
    flags, classes = langid.new_flags(), langid.letter_classes(["abcdefg"])
    text = "ab" * (langid.LONG // 2) + "cd"
    langid.presence(text, classes, flags)
    a, b, c, d = (int(classes[ord(x)]) for x in "abcd")
    assert flags[1][b << 6 | c] and flags[1][c << 6 | d] and flags[2][a << 12 | b << 6 | c]


def test_language_scoring_of_a_block_is_bounded_in_memory():
    """A model over all grams scores a block of texts in a bounded share of its dense features, with the same results."""
    import tracemalloc

    classes = langid.letter_classes(["abcdefg"])
    columns = [np.arange(1 << (langid.BITS * n)) for n in langid.ORDERS]
    width = sum(map(len, columns))
    weights = np.random.default_rng(3).normal(size=(width, 2)).astype(np.float32)
    model = langid.Model(["de", "en"], classes, columns, weights, np.zeros(2, np.float32), 0.0)
    texts = ["abcdefg gfedcba"[i % 7 :] for i in range(langid.BLOCK)] + [None, ""]
    tracemalloc.start()
    names, scores, _ = langid.predict(texts, model, langid.new_flags())
    _, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert peak < 64 << 20 < langid.BLOCK * width * 4
    x, _, _ = langid.features(texts[:1], classes, columns, langid.new_flags())
    margins = (x @ weights).astype(np.float64)[0]
    assert names[0] == ["de", "en"][int(margins.argmax())] and names[-2:] == ["und", "und"]


def test_forward_backward_against_enumeration():
    rng = np.random.default_rng(1)
    e, model = rng.normal(size=5), quality.Model(np.zeros(1), 1.3, 0.4)
    left, right = quality.forward_backward(e, np.array([0, 5]), model)
    odds = np.zeros((5, 2))
    for y in np.ndindex(*(2,) * 5):
        y = np.array(y)
        w = np.exp((e * y).sum() + 1.3 * (y[1:] * y[:-1]).sum() + 0.4 * ((1 - y[1:]) * (1 - y[:-1])).sum())
        for t in range(5):
            odds[t, y[t]] += w
    assert np.allclose(left + right, np.log(odds[:, 1] / odds[:, 0]))


def test_quality_of_odd_texts(docs_of):
    model = quality.fit_model(["plain words here\nand more of them", "$$$ %%% ###\n$$$ %%%"] * 10, [1, 0] * 10)
    got = {r.doc_id: r.score for r in quality.score(docs_of(ODD).withColumnRenamed("source", "score"), model).collect()}
    assert got[1] == got[2] and all(0 <= s <= 1 for s in got.values())
    assert [r.score for r in quality.score(docs_of([(1, "a")]), None).collect()] == [0.5]
    assert quality.score(docs_of([]), model).count() == 0
    assert quality.fit_model([], []) is None


WORDS = {"idiot": 7.0, "clown": 7.0, "stupid": 7.0}


@pytest.mark.parametrize(
    ("text", "word"),
    [("you 1d10t", "idiot"), ("an i d i o t !", "idiot"), ("c1own", "clown"), ("STUUUPID!!", "stupid"), ("s-t-u-p-1-d", "stupid"),
     ("$tupid", "stupid"), ("a s t u p i d b", "stupid"), ("plain", None), ("a b c d e", None), ("ciown", None)],
)
def test_restored_words(text, word):
    restorer = toxicity.Restorer(toxicity.Model(toxicity.char_model(np.ones((60, 60))), WORDS, -4.0))
    assert restorer.words([text, None]) == [{word} - {None}, set()]
    assert (word in restorer.restore(text)) if word else restorer.restore(text) == text


@pytest.mark.parametrize(
    ("text", "words"),
    [("an i d i o t.", {"idiot"}), ("an i d i o t, yes", {"idiot"}), ("i d i o t!", {"idiot"}), ("i  d  i  o  t", {"idiot"}), ('"i d i o t"', {"idiot"}),
     ("i\nd\ni\n\no\nt\nx", {"idiot"}), ("stupid,idiot", {"stupid", "idiot"}), ("1d10t/moron", {"idiot"}), ("a clown!stup1d b", {"clown", "stupid"}),
     ("an id iot here", {"idiot"}), ("you stu pi d.", {"stupid"}), ("a plain text, in parts/pieces id est", set())],
)
def test_words_torn_or_joined(text, words):
    restorer = toxicity.Restorer(toxicity.Model(toxicity.char_model(np.ones((60, 60))), WORDS, -4.0))
    assert restorer.words([text, None]) == [words, set()]
    assert all(w in toxicity.Restorer(restorer.model).restore(text) for w in words)


def test_viterbi_against_enumeration():
    rng = np.random.default_rng(3)
    language = np.log(rng.dirichlet(np.ones(toxicity.SYMBOLS), toxicity.SYMBOLS))

    def paths(token, last=None, word="", cost=0.0):
        if not token:
            yield word, cost + language[toxicity.symbol(word[-1]) if word else 0, 0]
            return
        c, rest = token[0], token[1:]
        price = 0.0 if c.isalpha() else toxicity.COST_IMITATE
        for x in toxicity.options(c):
            yield from paths(rest, x, word + x, cost + price + language[toxicity.symbol(last) if last else 0, toxicity.symbol(x)])
            if x == last:
                yield from paths(rest, last, word, cost + price + toxicity.COST_REPEAT)
        if not c.isalpha():
            yield from paths(rest, last, word, cost + toxicity.COST_DROP)

    tokens = ["1d10t", "aab", "b00k1", "x-y", "11", "s5s"]
    for token, (word, score) in zip(tokens, toxicity.viterbi(tokens, language)):
        best = max(paths(token), key=lambda p: p[1])
        assert word == best[0] and score == pytest.approx(best[1])


def test_score_finds_what_any_path_of_the_lattice_spells():
    """Symbols as noise: a word is found wherever its path is likelier than the free one."""
    model = toxicity.Model(toxicity.char_model(np.ones((60, 60))), WORDS, -4.0)
    tokens = ["idiot1", "stu+pid", "i|d|i|o|t", "+idiot", "c$lown", "1d1o0t", "st0upid", "$tup1d5", "cl0wn3", "idi", "1990", "€100", "1d"]
    for token in tokens:
        free = toxicity.viterbi([token], model.language)[0][1]
        want = {w for w in WORDS if toxicity.WORD_PRIOR + toxicity.path_cost(token, w) > free}
        assert toxicity.Restorer(model).words([f"you {token}"]) == [want]
        assert bool(want) == (token not in tokens[-4:])


def test_long_tokens_and_runs_are_decoded():
    restorer = toxicity.Restorer(toxicity.Model(toxicity.char_model(np.ones((60, 60))), WORDS, -4.0))
    long = ["idi" + "o" * 200 + "t", "1d1" + "0" * 40 + "t" * 60, "s t u u u u u u u u u u u u u u p i d", "x " + "c l o o " + "o " * 500 + "w n"]
    assert restorer.words(long) == [{"idiot"}, {"idiot"}, {"stupid"}, {"clown"}]
    assert restorer.restore(long[0]) == "idiot"


def test_spelled_against_path_cost():
    rng = np.random.default_rng(5)
    words = ["aba", "abb", "bia", "ala"]
    for _ in range(200):
        chars = "".join(rng.choice(list("abl1!-"), 9))
        stretches = [chars[i:j] for i in range(9) for j in range(i + 1, 10)]
        assert toxicity.spelled(chars, words) == {w for w in words if any(toxicity.path_cost(x, w) > -np.inf for x in stretches)}


def test_toxicity_of_odd_texts(docs_of):
    model = toxicity.Model(toxicity.char_model(np.ones((60, 60))), WORDS, -4.0)
    got = {r.doc_id: r.score for r in toxicity.score(docs_of([*ODD, (9, "idiot")]).withColumnRenamed("lang", "score"), model).collect()}
    assert got[1] == got[2] == got[4] and got[1] < 0.3 < got[9]
    assert toxicity.score(docs_of([]), model).count() == 0
    labels = docs_of([]).sparkSession.createDataFrame([], "doc_id long, toxic int")
    bare = toxicity.train(docs_of(ODD), labels)
    assert {r.score for r in toxicity.score(docs_of(ODD), bare).collect()} == {0.0}
    restored = {r.doc_id: r.restored for r in toxicity.restore(docs_of([(1, "An 1D10T  here"), (2, None)]), model).collect()}
    assert restored == {1: "an idiot  here", 2: None}


UNLEARNED = [
    "日本語の文章は漢字と仮名で書かれており、句読点を使って区切られます。今日はとても良い天気です。",
    "Сегодня хорошая погода, и мы пошли гулять в парк вместе с друзьями и собакой.",
    "Wczoraj wieczorem poszliśmy do kina, żeby obejrzeć nowy film, który wszystkim bardzo się spodobał.",
    " ".join("".join(random.Random(i).choices("bcdfghjklmnpqrstvwxz", k=3 + i % 7)) for i in range(60)),
]


def test_unlearned_languages_are_rejected(spark, docs_of):
    """Texts of other languages and random letters go; texts of learned languages stay."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = langid.train(docs)
    assert langid.keep_identified(docs_of(list(enumerate(UNLEARNED))), model).count() == 0
    lettered = docs.where("text rlike '\\\\p{L}'")
    assert langid.keep_identified(lettered, model).count() >= 0.99 * lettered.count()


def test_margins_against_the_kernel_computed_directly():
    """Kernels as sums over common grams, Nyström features by eigenvectors, ridge regression with weights: no folding."""
    rng = random.Random(6)
    base = {"x": "aeioulmn", "y": "krstvaeu", "z": "bdgpoaiz"}
    text = lambda lang: " ".join("".join(rng.choices(base[lang], k=rng.randint(2, 6))) for _ in range(rng.randint(3, 25)))
    sample = [(lang, text(lang)) for _ in range(40) for lang in base]
    model = langid.fit_model(sample)

    def grams(t):
        c = [ch if ch.isalpha() else "." for ch in t.lower()]
        return [{"".join(c[i : i + n]) for i in range(len(c) - n + 1)} for n in (1, 2, 3)]

    def kernel(a, b):
        return sum(len(x & y) / np.sqrt(len(x) * len(y)) for x, y in zip(a, b)) / 3

    each = langid.LANDMARKS // 3
    marks = [grams(t) for lang in sorted(base) for t in [t for x, t in sample if x == lang][:each]]
    texts = [grams(t) for _, t in sample]
    own = np.array([[kernel(a, b) for b in marks] for a in marks])
    values, vectors = np.linalg.eigh(own)
    good = values > 1e-6 * values.max()
    to_features = vectors[:, good] / np.sqrt(values[good])
    phi = np.hstack([np.array([[kernel(a, b) for b in marks] for a in texts]) @ to_features, np.ones((len(texts), 1))])
    y = np.array([[1.0 if lang == other else -1.0 for other in sorted(base)] for lang, _ in sample])
    w = np.full((len(texts), 1), 1 / 40)
    beta = np.linalg.solve(phi.T @ (w * phi) + langid.RIDGE * np.eye(phi.shape[1]) / len(texts), phi.T @ (w * y))
    fresh = [text(lang) for lang in base for _ in range(10)]
    direct = np.hstack([np.array([[kernel(grams(t), b) for b in marks] for t in fresh]) @ to_features, np.ones((30, 1))]) @ beta
    x, _, _ = langid.features(fresh, model.classes, model.columns, langid.new_flags())
    assert np.allclose(x @ model.weights + model.bias, direct, atol=2e-3)
    assert langid.predict(fresh, model, langid.new_flags())[0] == [lang for lang in base for _ in range(10)]
