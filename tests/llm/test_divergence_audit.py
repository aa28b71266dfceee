"""The audit against DuckDB over the same rows; the transducer against a dict."""

import random

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from clientele.llm import divergence_audit
from clientele.llm.common import prepare
from clientele.llm.divergence_audit import Transducer
from clientele.llm.queries import ORACLE


def _rows(seed):
    rng = random.Random(seed)
    terms = ["The", "the", "of", "caf\u00e9", "\u00c9t\u00e9", "\u4f60\u597d", "a", "ab", "abc", "abd", "x" * 400] + [f"w{chr(97 + i)}{chr(97 + j)}" for i in range(6) for j in range(26)]
    rows = []
    for i in range(400):
        lang = rng.choice(["en", "en", "en", "fr", None, "", "e"])
        source = rng.choice(["s1", "s2", "s3", None, "\u00e9", "Z"])
        weights = [1 + (hash_of(lang, source, t) % 7) for t in range(len(terms))]
        text = rng.choice([" ", "\n", "-1"]).join(rng.choices(terms, weights, k=rng.randrange(0, 120)))
        rows.append((i, rng.choice([text, text, text, None]) if i % 9 == 0 else text, lang, source))
    rows += [rows[3]] * 12 + [(900, "zz zz zz", "rare", "s1"), (901, None, "rare", "s2"), (902, "1 2 3", "rare", None)]
    return rows


def hash_of(*parts):
    return sum(ord(c) * (i + 3) for i, c in enumerate(str(parts)))


@pytest.mark.parametrize("seed, shard, volume", [(1, 1 << 20, 1 << 26), (2, 16, 4000)])
def test_equals_duckdb(spark, monkeypatch, seed, shard, volume):
    prepare(spark)
    if shard == 16:
        monkeypatch.setattr(divergence_audit, "HELD", 50)
    rows = _rows(seed)
    docs = spark.createDataFrame([(*r, "clash", 1) for r in rows], "doc_id long, text string, lang string, source string, term string, n long")
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, lang VARCHAR, source VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?, ?)", rows)
    want = con.execute(ORACLE["op12_divergence_audit"]).fetchall()
    got = divergence_audit.audit(docs, shard=shard, volume=volume).select("lang", "source", "part", "item", "value", "rank").collect()
    assert sorted(map(tuple, got)) == sorted(want)
    assert sum(r[2] == "term" for r in want) > 50


def test_empty_and_null_only(spark):
    prepare(spark)
    schema = "text string, lang string, source string"
    assert divergence_audit.audit(spark.createDataFrame([], schema)).count() == 0
    got = divergence_audit.audit(spark.createDataFrame([(None, None, None), (None, None, "b")], schema)).collect()
    assert sorted(map(tuple, got)) == [("", "", "pair", "b", 0, 1), ("", "b", "pair", "", 0, 1)]


def test_transducer_is_minimal_and_gives_places():
    rng = random.Random(4)
    terms = sorted({bytes(rng.choice(b"abc\xc3\xa9") for _ in range(rng.randrange(1, 9))) for _ in range(3000)} | {b"q" * 500})
    fst = Transducer.from_bytes(Transducer.build(terms).to_bytes())
    asked = terms + [t + b"a" for t in terms] + [t[:-1] for t in terms if len(t) > 1]
    data = np.frombuffer(b"".join(asked), dtype=np.uint8)
    end = np.cumsum([len(t) for t in asked])
    start = end - [len(t) for t in asked]
    zero = np.zeros(len(asked), dtype=np.int64)
    place = {t: i for i, t in enumerate(terms)}
    assert fst.run(data, start, end, zero, zero).tolist() == [place.get(t, -1) for t in asked]
    # as many states as there are different sets of endings
    endings = {}
    for t in terms:
        for i in range(len(t) + 1):
            endings.setdefault(t[:i], set()).add(t[i:])
    assert len(fst.base) == len({frozenset(x) for x in endings.values()})
    assert Transducer.build([]).prefix(b"a") == (-1, 0)


def test_tasks_without_kept_terms_and_words_of_all_lengths():
    terms = sorted([b"en\x00ab", b"en\x00" + b"q" * 8, b"en\x00" + b"q" * 9])

    class Shared:
        value = {0: (Transducer.build(terms).to_bytes(), terms[0], terms[-1])}

    def rows(*texts):
        return pa.RecordBatch.from_pylist([{"lang": "en", "source": s, "text": t} for s, t in texts])

    count = divergence_audit._streamed(Shared)
    assert list(count(iter([rows(("s", "no kept term"), ("s", ""))]))) == []
    asked = [rows(("s", "AB ab abc"), ("t", "none")), rows(("s", "ab " + "q" * 8), ("t", "Q" * 9 + " ab a")), rows(("u", ""))]
    got = [tuple(r.values()) for batch in count(iter(asked)) for r in batch.to_pylist()]
    assert sorted(got) == [("en", "s", 0, 3), ("en", "s", 1, 1), ("en", "t", 0, 1), ("en", "t", 2, 1)]
