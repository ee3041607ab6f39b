"""Cards inside longer runs of digits."""

import re

import pytest

from spanfeat.llm.pseudonyms import pseudonymize

CARD = "4111111111111111"
SPACED = "4111 1111 1111 1111"
CASES = [
    (f"{SPACED} 12/25", "card"), (f"{CARD} 123", "card"), (f"room 7 {CARD}", "card"), (f"7 {SPACED} 12", "card"),
    (f"1 2 3 4 {SPACED}", "card"), (f"{SPACED} 5500-0000-0000-0004 9", "card,card"), (f"{CARD} 555-123-4567", "card,phone"),
    ("order 12345 2024-01-01", "date"), (f"{CARD}  12", "card"), ("4111111111111112 123", ""),
    ("1 12345678901234.a@x.org", "email"), ("3782 822463 10005 99", "card"),
    ("7 " * 3000, None),
]


@pytest.fixture(scope="module")
def made(spark):
    df = spark.createDataFrame([(k, t) for k, (t, _) in enumerate(CASES)], "doc_id long, text string")
    return {r.doc_id: r for r in pseudonymize(df, "key").collect()}


@pytest.mark.parametrize("k", range(len(CASES)))
def test_run(made, k):
    text, kinds = CASES[k]
    if kinds is None:
        assert len(made[k].text) == len(text)
        return
    want = [x for x in kinds.split(",") if x]
    assert made[k].n_replaced == len(want) and made[k].kinds == ",".join(sorted(set(want)))
    assert (made[k].text == text) == (not want)
    assert re.sub("[0-9a-z]", "0", made[k].text) == re.sub("[0-9a-z]", "0", text)
    for secret in (CARD, SPACED, "5500-0000-0000-0004", "3782 822463 10005"):
        assert secret not in made[k].text


def test_equal_cards_stay_equal(made):
    plain = made[1].text.split(" ")[0]
    assert plain in made[2].text and made[0].text[:19].replace(" ", "") == plain
