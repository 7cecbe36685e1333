"""Valid numbers beside other digits and capitals."""

import re

from helpers import docs_of
from test_llm_methods import luhn, mod97

from clickwatch.llm import pii

CARD = "4111 1111 1111 1111"
CASES = [
    ("{} 123", CARD), ("{} 12/26", CARD.replace(" ", "")), ("order 7 {}", CARD), ("1234 5678 {} 99", CARD), ("12  {}-2", CARD),
    ("{} EUR", "AT61 1904 3002 3457 3201"), ("{} BIC", "ES91 2100 0418 4502 0005 1332"), ("{} DEUTDEFF", "DE89370400440532013000"),
    ("AB12 CDEF 3456 {} EUR 12", "DE89 3704 0044 0532 0130 00"),
]


def test_numbers_are_found_beside_digits_and_capitals(spark):
    rows = pii.pseudonymised(docs_of(spark, [a.format(n) for a, n in CASES])).orderBy("doc_id").collect()
    alone = pii.pseudonymised(docs_of(spark, [n for _, n in CASES])).orderBy("doc_id").collect()
    for (around, number), row, single in zip(CASES, rows, alone):
        assert row.text == around.format(single.text) and single.text != number
        assert luhn(re.sub("[ -]", "", single.text)) if number[0] == "4" else mod97(single.text) == 1
        assert row.n_card + row.n_iban == 1


def test_the_rest_is_searched_again(spark):
    text = f"7 {CARD} 123-45-6789 {CARD} 2023-01-02"
    (row,) = pii.pseudonymised(docs_of(spark, [text])).collect()
    assert (row.n_card, row.n_ssn, row.n_date) == (2, 1, 1) and row.text.startswith("7 ") and "123-45-6789" not in row.text
