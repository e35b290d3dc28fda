import random

import pyarrow as pa
import pytest

from stormledger.llm import decontam


def edit_distance_within(pattern, text):
    """Least edit distance of pattern to any substring of text, by the plain table."""
    row = list(range(len(pattern) + 1))
    best = row[-1]
    for c in text:
        last, row = row, [0]
        for i, p in enumerate(pattern):
            row.append(min(last[i] + (p != c), last[i + 1] + 1, row[i] + 1))
        best = min(best, row[-1])
    return best


def test_exact_verification_against_the_plain_table():
    rng = random.Random(2)
    for _ in range(60):
        p = bytes(rng.choices(b"abc ", k=rng.randint(1, 80)))
        t = bytes(rng.choices(b"abc ", k=rng.randint(0, 90)))
        true = edit_distance_within(p, t)
        got, _ = decontam.best_match(p, t, len(p))
        assert got == true or true == len(p)  # nothing but the empty substring
        assert decontam.best_match(p, t, true - 1)[0] == true if true else True


@pytest.fixture(scope="module")
def items(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/benchmark.parquet")


def edited(text, rate, rng):
    s = list(text)
    for _ in range(int(rate * len(s))):
        p, kind = rng.randrange(len(s)), rng.random()
        if kind < 0.34:
            s[p] = rng.choice("abcdefgh ")
        elif kind < 0.67:
            del s[p]
        else:
            s.insert(p, rng.choice("abcdefgh "))
    return "".join(s)


@pytest.mark.parametrize(("rate", "least"), [(0, 1.0), (0.03, 0.99), (0.1, 0.95)])
def test_planted_items_are_found(items, documents, rate, least):
    rng = random.Random(7)
    rows = [(r.item_id, r.text) for r in items.collect()]
    filler = [r.text for r in documents.limit(len(rows)).collect()]
    texts = [f"{f[:400]}\n{edited(t, rate, rng).upper()}!\n{f[:300]}" for f, (_, t) in zip(filler, rows)]
    prepared = decontam.prepare(rows)
    data, ends = decontam.text_bytes(pa.array(texts))
    found = decontam.leaks_of(data, ends, prepared)
    hits = {prepared.ids[i] for d, i, *_ in found if rows[d][0] == prepared.ids[i]}
    assert len(hits) >= least * len(rows)
    form, stop, _ = decontam.plain(data, ends)
    raw, begin = form.tobytes(), [0, *stop.tolist()]
    for d, i, distance, *_ in found[:10]:
        assert distance == edit_distance_within(prepared.forms[i], raw[begin[d] : begin[d + 1]])


def test_table_against_substrings(spark, documents, items):
    def form(text):
        data, ends = decontam.text_bytes(pa.array([text], pa.string()))
        return decontam.plain(data, ends)[0].tobytes().strip()

    pairs = {(r.doc_id, r.item_id) for r in decontam.find_leaks(documents, items).where("distance = 0").collect()}
    texts = {r.doc_id: form(r.text) for r in documents.collect()}
    wanted = {r.item_id: form(r.text) for r in items.collect()}
    assert pairs == {(d, i) for i, w in wanted.items() for d, t in texts.items() if w in t}
    kept = {r.doc_id for r in decontam.drop_contaminated(documents, items).collect()}
    assert kept == set(texts) - {r.doc_id for r in decontam.find_leaks(documents, items).collect()}


def test_odd_input_and_several_parts(spark, docs_of, items, monkeypatch):
    text = items.where("item_id = 0").first().text
    docs = docs_of([(1, None), (2, ""), (3, "!?"), (4, text), (4, text), (None, "x " + text), (5, "b " * 30000)])
    monkeypatch.setattr(decontam, "PART_BYTES", 1000)
    odd = spark.createDataFrame([(90, None, 1), (91, "", 1), (92, "..", 1), (93, text, 1)], "item_id long, text string, doc_id int")
    both = items.withColumn("doc_id", items.item_id.cast("int")).unionByName(odd)
    got = sorted(((r.doc_id, r.item_id) for r in decontam.find_leaks(docs, both).collect()), key=str)
    assert got == [(4, 0), (4, 0), (4, 93), (4, 93), (None, 0), (None, 93)]
    assert decontam.find_leaks(docs_of([]), both).count() == 0
    assert decontam.find_leaks(docs, odd.limit(0)).count() == 0
    assert decontam.drop_contaminated(docs, odd.limit(0)).count() == 7


def leaks(texts, rows):
    prepared = decontam.prepare(rows)
    data, ends = decontam.text_bytes(pa.array(texts))
    return {(d, prepared.ids[i]): (n, *span) for d, i, n, *span in decontam.leaks_of(data, ends, prepared)}


@pytest.mark.parametrize("rate", [0.13, 0.15, 0.2])
def test_recall_up_to_the_limit(items, documents, rate):
    """Of the planted items that are within EDITS by the exact distance, the target recall of the docstring is found."""
    rng = random.Random(11)
    rows = [(r.item_id, r.text) for r in items.collect()]
    filler = [r.text for r in documents.limit(len(rows)).collect()]
    texts = [f"{f[:400]}\n{edited(t, rate, rng)}!\n{f[:300]}" for f, (_, t) in zip(filler, rows)]
    prepared = decontam.prepare(rows)
    data, ends = decontam.text_bytes(pa.array(texts))
    form, stop, _ = decontam.plain(data, ends)
    begin = [0, *stop.tolist()]
    true = set()
    for d, p in enumerate(prepared.forms):
        most = int(decontam.EDITS * len(p))
        if decontam.best_match(p, form.tobytes()[begin[d] : begin[d + 1]], most)[0] <= most:
            true.add((d, rows[d][0]))
    assert len(true) > 0.9 * len(rows) and len(true & leaks(texts, rows).keys()) >= 0.97 * len(true)


def test_short_items_are_found_with_edits():
    assert leaks(["they say the quick brwn fox jumqs here"], [(1, "the quick brown fox jumps"), (2, "wholly other words")]) == {
        (0, 1): (2, 9, 33)
    }


CJK = "机器学习模型的训练数据必须经过清洗否则评测结果就会失去意义因此我们需要检查每一段文字是否含有测试题目"
THAI = "ข้อมูลสำหรับฝึกแบบจำลองต้องสะอาดไม่เช่นนั้นผลการทดสอบจะไม่มีความหมายและเชื่อถือไม่ได้"


@pytest.mark.parametrize("item", [CJK, CJK[:20], THAI, "supercalifragilisticexpialidocious" * 3])
def test_items_inside_unspaced_runs(item):
    before, after = ("zq" * 40, "kv" * 40) if item.isascii() else ("我昨天在街上看见了一只猫" * 3, "然后它就跑掉了再也没回来" * 3)
    found = leaks([before + item + after, before + after], [(1, item)])
    start = len(before.encode())
    assert found == {(0, 1): (0, start, start + len(item.encode()))}


def test_other_punctuation_and_spaces_are_blanks():
    item = "the \"quick\" brown fox - as they say - jumps over the lazy dog, and runs; nobody saw it again that day"
    other = item.replace('"', "“").replace(" - ", "—").replace("lazy dog", "lazy dog").replace(", and", "、and")
    assert {k: v[0] for k, v in leaks(["Well:" + other + "…"], [(1, item)]).items()} == {(0, 1): 0}
    data, ends = decontam.text_bytes(pa.array(["Ünï ª あ้é—　x", "’"]))
    form, stop, _ = decontam.plain(data, ends)
    assert form.tobytes().decode() == "ünï ª あ้é x " and stop.tolist() == [len(form) - 1, len(form)]


def test_items_in_parts(spark, docs_of, monkeypatch):
    """Each part has a pass of its own; a plan holds the items of one part, and the results are the same."""
    texts = ["the quick brown fox jumps over the lazy dog number %d and sleeps until noon" % (i * 7919) for i in range(12)]
    items = spark.createDataFrame(list(enumerate(texts)), "item_id long, text string")
    docs = docs_of([(i, f"before {t} after") for i, t in enumerate(texts[:8])] + [(90, "nothing of the kind"), (91, None)])
    find = lambda: sorted(map(tuple, decontam.find_leaks(docs, items).collect()))
    keep = lambda: sorted(r.doc_id for r in decontam.drop_contaminated(docs, items).collect())
    whole, kept = find(), keep()
    assert kept == [90, 91] and {r[0] for r in whole} == set(range(8))
    monkeypatch.setattr(decontam, "PART_BYTES", 200)
    assert decontam.count_parts(items) > 3
    assert find() == whole and keep() == kept
    plan = decontam.drop_contaminated(docs, items)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1
