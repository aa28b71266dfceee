"""All stages of the pipeline over a table, each against a plain Python twin of
its own input, and run() against the stages."""

from collections import Counter

import pytest
from conftest import SF_SMALL
from test_jaccard_brute import _brute as components
from test_jaccard_brute import _shingles

import corpus_pipeline
from clientele.llm import mixing
from clientele.llm.common import prepare, staged, table


@pytest.fixture(scope="module")
def stages(spark):
    """The documents (some repeated, some without ids or texts) and every stage's rows."""
    prepare(spark)
    docs = table(spark, SF_SMALL, "documents")
    odd = docs.limit(6).selectExpr("cast(null as bigint) as doc_id", "concat(' ', text) as text", "lang", "source", "n_chars")
    docs = staged(docs.unionByName(odd).unionByName(docs.limit(3)))
    out = [docs]
    for _, stage in corpus_pipeline.STAGES:
        out.append(staged(stage(spark, out[-1], SF_SMALL)))
    return out


def _norm(t):
    return "".join(c for c in t or "" if c not in " \t\n\x0b\x0c\r")


def test_stages_keep_the_columns(stages):
    for df in stages[:-1]:
        assert df.columns == stages[0].columns


def test_language_id_only_drops(stages):
    before, after = (Counter(map(tuple, df.collect())) for df in stages[:2])
    assert not after - before and sum(after.values()) >= 0.95 * sum(before.values())


def test_exact_dedup_keeps_one_of_each_text(stages):
    before, after = (list(map(tuple, df.select("doc_id", "text").collect())) for df in stages[1:3])
    assert len(after) == len({_norm(t) for _, t in before}) == len({_norm(t) for _, t in after})
    best = {}
    for i, t in before:
        key = (-len(t or ""), i is None, i or 0)
        best[_norm(t)] = min(best.get(_norm(t), key), key)
    assert {_norm(t): (-len(t or ""), i is None, i or 0) for i, t in after} == best


def test_near_dedup_keeps_one_of_each_component(stages):
    before, after = (list(map(tuple, df.select("doc_id", "text").collect())) for df in stages[2:4])
    sets = [_shingles(t) for _, t in before]
    comp = components(sets)
    of = {(i, t): comp[n] for n, (i, t) in enumerate(before)}
    kept = Counter(of[r] for r in after)
    assert set(kept) == set(comp) and set(kept.values()) == {1}


def test_mix_draws_whole_rows_near_the_targets(stages):
    before, after = (list(map(tuple, df.select("doc_id", "source", "text").collect())) for df in stages[3:5])
    had, drawn = Counter(before), Counter(after)
    assert set(drawn) <= set(had) and all(n <= 2 * had[r] for r, n in drawn.items())
    goal = {r["source"]: r["target"] for r in mixing.targets(mixing.sized(stages[3], 1)).collect()}
    words, longest = Counter(), Counter()
    for (_, source, text), n in drawn.items():
        words[source] += n * len((text or "").split())
    for _, source, text in before:
        longest[source] = max(longest[source], len((text or "").split()))
    for source, target in goal.items():
        assert abs(words[source] - target) <= longest[source] / 2 + 1


def test_targets_equal_water_filling(stages):
    sizes = Counter()
    for r in stages[3].select("source", "text").collect():
        sizes[r["source"]] += len([w for w in (r["text"] or "").replace("\x0b", " ").split() if w])
    order = sorted(sizes)
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    left, open_, target = 1.5 * sum(sizes.values()), set(order), {}
    while open_:
        level = left / sum(weight[s] for s in open_)
        over = {s for s in open_ if level * weight[s] >= 2 * sizes[s]}
        if not over:
            target |= {s: level * weight[s] for s in open_}
            break
        for s in over:
            target[s] = 2.0 * sizes[s]
            left -= target[s]
        open_ -= over
    got = {r["source"]: r["target"] for r in mixing.targets(mixing.sized(stages[3], 1)).collect()}
    assert got == pytest.approx(target)


def test_pack_holds_every_token_once(stages):
    from tokenizers import Tokenizer
    import public_tokenizers
    tok = Tokenizer.from_file(str(public_tokenizers.path("byte_bpe_50k.json")))
    want = Counter((r["doc_id"], len(tok.encode(r["text"] or "", add_special_tokens=False).ids) + 1) for r in stages[4].collect())
    pieces = stages[5].collect()
    got = Counter()
    for r in pieces:
        got[r["doc_id"]] += r["length"]
    per_doc = Counter()
    for (doc, n), times in want.items():
        per_doc[doc] += n * times
    assert got == per_doc
    places = {}
    for r in pieces:
        places.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for runs in places.values():
        at = 0
        for offset, length in sorted(runs):
            assert offset == at
            at += length
        assert at <= 2048


def test_run_equals_the_stages(spark):
    docs = table(spark, SF_SMALL, "documents")
    for _, stage in corpus_pipeline.STAGES:
        docs = staged(stage(spark, docs, SF_SMALL))
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    run = corpus_pipeline.run(spark, SF_SMALL).select(*columns).collect()
    assert Counter(map(tuple, run)) == Counter(map(tuple, docs.select(*columns).collect()))
