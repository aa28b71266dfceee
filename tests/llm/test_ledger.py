"""The kept ledger: what is scanned when, and the same digest from what is kept."""

from dataclasses import replace

from test_secret_spans import _brute, _texts

from clientele.llm import secret_ledger
from clientele.llm.common import prepare
from clientele.llm.secret_ledger import RULES, Ledger


def _digest(ledger, history, rules=RULES):
    rows = secret_ledger.digest(secret_ledger.findings(history, ledger.findings(rules)), rules).collect()
    return sorted((r["doc_id"], r["n_assign"], r["n_access"], r["n_hex"], r["base_sha256"]) for r in rows)


def test_second_run_scans_nothing_and_says_the_same(spark, scratch):
    prepare(spark)
    texts = _texts(60) * 2
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    history = secret_ledger.versions(docs)
    ledger = Ledger(spark, f"file://{scratch}/ledger")
    assert ledger.read().count() == 0
    ledger.update(history)
    blobs = len({t or "" for t in texts})
    assert ledger.read().count() == blobs * len(RULES)
    want = sorted((i, *_brute(t)) for i, t in enumerate(texts))
    assert _digest(ledger, history) == want
    assert ledger.update(history) is None and len(ledger.batches()) == 1
    assert _digest(ledger, history) == want
    # new documents: only blobs not seen before are scanned, old findings stay
    more = docs.unionByName(spark.createDataFrame([(900, "token=abcdef99"), (901, texts[5]), (902, None)], docs.schema))
    batch = ledger.update(secret_ledger.versions(more))
    assert spark.read.parquet(batch).select("blob").distinct().count() == 1
    got = _digest(ledger, secret_ledger.versions(more))
    assert got == sorted(want + [(900, *_brute("token=abcdef99")), (901, *_brute(texts[5])), (902, *_brute(None))])
    assert [r for r in got if r[0] == 900][0][1] == 1


def test_new_rule_version_scans_all_blobs_for_that_rule_only(spark, scratch):
    prepare(spark)
    docs = spark.createDataFrame([(1, "AKIA" + "A" * 20), (2, "password=secret1"), (3, None)], "doc_id long, text string")
    history = secret_ledger.versions(docs)
    ledger = Ledger(spark, f"file://{scratch}/ledger")
    ledger.update(history)
    newer = tuple(replace(r, version="2", least=30) if r.kind == "access" else r for r in RULES)
    batch = ledger.update(history, newer)
    rows = spark.read.parquet(batch).collect()
    assert {r["rule"] for r in rows} == {"access@2"} and len(rows) == 3
    assert [r[2] for r in _digest(ledger, history)] == [1, 0, 0]  # the old version's findings are kept
    assert [r[2] for r in _digest(ledger, history, newer)] == [0, 0, 0]


def test_a_scan_without_its_success_file_is_not_read(spark, scratch):
    prepare(spark)
    import os
    history = secret_ledger.versions(spark.createDataFrame([(1, "password=secret1")], "doc_id long, text string"))
    ledger = Ledger(spark, f"file://{scratch}/ledger")
    os.makedirs(f"{scratch}/ledger/batch-000000-broken")
    assert ledger.batches() == []
    assert ledger.update(history) is not None
    assert _digest(ledger, history)[0][1] == 1
