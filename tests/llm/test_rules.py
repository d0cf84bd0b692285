"""Rules as the queries' contracts list them."""

from __future__ import annotations

import pytest

from quillmine.llm import urls


@pytest.mark.parametrize(
    ("url", "rule", "verdict"),
    [
        ("http://a.com/en/1", "com/en/", "block"), ("http://example.com/en/71", "example.com/en/7", "allow"), ("http://a.net/de/8", "net/de/", "allow"), ("http://example.net/de/7", "net/de/", "allow"),
        ("http://www.example.net/de/81", "example.net/de/8", "block"), ("http://a.org/es/1", "org/es/", "block"),
    ],
)
def test_url_rules_say_what_the_contract_says(spark, url, rule, verdict):
    row = urls.judged(spark.createDataFrame([(1, url)], "page_id long, url string")).first()
    assert (row.rule, row.verdict) == (rule, verdict)
