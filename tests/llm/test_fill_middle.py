"""Fill-in-middle against plain Python, and its inverse."""

import hashlib
import random
import re

import pytest

from spanfeat.llm.fill_middle import digests, fill_in_middle, restore

SCHEMA = "doc_id long, text string, output string, form string, n long"
ALPHABET = ["a", "B", "cd", " ", "\n", "é", "日", "😀", "<", "P", ">", "S", "M", "1", "-", "<P>"]


def plain_form(doc_id, text):
    text = text or ""
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    h = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(h[8 * k : 8 * k + 8], 16) for k in range(4)]
    a, b = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return doc_id, len(units), "plain", None, None, text
    if h[3] % 100 < 20:
        return doc_id, len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return doc_id, len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


@pytest.fixture(scope="module")
def rows_in():
    random.seed(7)
    texts = [None, "", "a", "<P>", "x<S>y", "word " * 300_000, "é\n" * 400_000]
    texts += ["".join(random.choices(ALPHABET, k=random.randint(0, 30))) for _ in range(600)]
    made = [(k, t, "clash", "clash", 1) for k, t in enumerate(texts)]
    return made + [made[2], made[40], (None, "no id here", "c", "c", 1), (None, None, "c", "c", 1)]


def test_against_plain_python(spark, rows, rows_in):
    docs = spark.createDataFrame(rows_in, SCHEMA)
    made = fill_in_middle(docs)
    want = [plain_form(r[0], r[1]) for r in rows_in]
    key = lambda r: (r[0] is None, r[0] or 0, r[5])
    assert sorted((tuple(r) for r in made.collect()), key=key) == sorted(want, key=key)
    assert {r[2] for r in want} == {"plain", "psm", "spm"}
    back = restore(made).select("doc_id", "text")
    assert rows(back) == rows(docs.selectExpr("doc_id", "coalesce(text, '')"))


def test_digests(spark, rows):
    docs = spark.createDataFrame([(5, "one two three"), (6, None)], "doc_id long, text string")
    got = {r["doc_id"]: r for r in digests(docs).collect()}
    for d, t in ((5, "one two three"), (6, "")):
        assert got[d]["output_sha256"] == hashlib.sha256(plain_form(d, t)[5].encode()).hexdigest()
        assert got[d]["restored_sha256"] == hashlib.sha256(t.encode()).hexdigest()


def test_empty_table(spark):
    assert digests(spark.createDataFrame([], SCHEMA)).count() == 0


def test_damaged_output_is_refused(spark):
    made = spark.createDataFrame([("psm", "<P>a<S>b")], "form string, output string")
    with pytest.raises(Exception, match="three marks"):
        restore(made).collect()
    turned = spark.createDataFrame([("spm", "<P>a<S>b<M>c")], "form string, output string")
    with pytest.raises(Exception, match="order of its form"):
        restore(turned).collect()


def test_rows_without_output(spark, rows):
    made = spark.createDataFrame([(None, "x"), ("plain", None), ("plain", "x")], "form string, output string")
    assert [r["text"] for r in restore(made).collect()] == [None, None, "x"]


def test_rates(spark):
    docs = spark.range(2000).selectExpr("id AS doc_id", "concat('some words ', id) AS text")
    count = {r[0]: r[1] for r in fill_in_middle(docs).groupBy("form").count().collect()}
    assert 130 < count["plain"] < 270 and 280 < count["spm"] < 450
    assert {r[0] for r in fill_in_middle(docs, rate=0).select("form").distinct().collect()} == {"plain"}
