"""The trees add spans that the strict patterns miss."""

import random

import pytest

from clientele.llm import pii_boost
from clientele.llm.common import prepare

MISSED = [(1, "please call 1 (555) 201-4567 today", {"phone": "1 (555) 201-4567"}),
          (2, "mail to ann.lee (at) host (dot) com please", {"email": "ann.lee (at) host (dot) com"}),
          (3, "card 4111 1111 1111 1112 is wrong", {}), (4, "ip 300.1.1.1 is none", {})]


@pytest.fixture(scope="module")
def found(spark):
    prepare(spark)
    rng = random.Random(3)
    number = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    rows = [(100 + i, f"please call +1 ({number(3)}) {number(3)}-{number(4)} today or mail to "
                      f"u{i}.x@host{i % 7}.com please. card {number(4)} {number(4)} {number(4)} {number(4)} is wrong") for i in range(2000)]
    docs = spark.createDataFrame([r[:2] for r in MISSED] + rows, "doc_id long, text string")
    return {r["doc_id"]: r["spans"] for r in pii_boost.personal_data(docs).filter("doc_id < 100").collect()}


@pytest.mark.parametrize("case", MISSED)
def test_missed_spans_are_added(found, case):
    spans = [s.split(":") for s in found[case[0]].split(",") if s]
    assert {k: case[1][int(a):int(b)] for k, a, b in spans} == case[2]


def test_every_run_at_group_boundaries():
    text = "4111 1111 1111 1111 123 and 10.0.0.1"
    got = {(pii_boost.KINDS[k], text[a:b]) for k, a, b in pii_boost.candidates(text)}
    assert ("card", "4111 1111 1111 1111") in got and ("card", "4111 1111 1111 1111 123") in got
    assert ("ip", "10.0.0.1") in got and ("phone", "1111 1111") in got


def test_strict_patterns_decide():
    text = "+1 (555) 123-4567 or 1 (555) 123-4568, 4111 1111 1111 1112"
    strict = pii_boost.Strict(pii_boost.base_spans(text))
    says = {(k, text[a:b]): strict.decides(text, k, a, b) for k, a, b in pii_boost.candidates(text)}
    assert says[3, "+1 (555) 123-4567"] is True and says[3, "(555) 123-4567"] is False
    assert says[3, "1 (555) 123-4568"] is None and says[2, "4111 1111 1111 1112"] is False
