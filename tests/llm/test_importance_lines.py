"""Importance resampling by lines against a plain count of every document."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

from clientele.llm import importance_lines
from clientele.llm.common import prepare

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def _features(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = WORD.findall(lower)
    return [" ".join(w[i:i + n]) for n in (1, 2, 3) for i in range(len(w) - n + 1)], len(w)


def _bucket(f):
    return zlib.crc32(f.encode()) % 10000


def _brute(rows, target):
    s, t = Counter(), Counter()
    for _, text in rows:
        s.update(map(_bucket, _features(text)[0]))
    for text in target:
        t.update(map(_bucket, _features(text)[0]))
    S, T = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (S + 10000) / ((s[b] + 1) * (T + 10000)))) for b in range(10000)]
    out, able = [], []
    for doc_id, text in rows:
        f, n = _features(text)
        h = int(hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[_bucket(x)] for x in f)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([doc_id, len(f), weight, score, None])
        if n >= 20:
            able.append(out[-1])
    able.sort(key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for i, r in enumerate(able[:5 * len(able) // 100]):
        r[4] = i + 1
    return out


def _key(r):
    return tuple((x is None, x or 0) for x in r)


def test_equals_brute_force(spark):
    prepare(spark)
    rng = random.Random(11)
    vocab = ["The", "of", "café", "ÉTÉ", "x1", "42", "你好", "a" * 90, "b" * 300, "it's"] + [f"w{i}" for i in range(60)]
    line = lambda: " ".join(rng.choice(vocab) for _ in range(rng.randrange(0, 9)))
    common = [line() for _ in range(12)]
    texts = [None, "", "\n\n", " .,", "one", "A\nb", "a\n\nb\nc", "a b\nc", "a\r\nb c d\n"]
    for _ in range(260):
        texts.append("\n".join(rng.choice(common) if rng.random() < 0.6 else line() for _ in range(rng.randrange(1, 14))))
    texts += [texts[30]] * 20 + ["z " * 5000 + "\n" + "y " * 5000]
    rows = [(None if i % 41 == 7 else i // 2 if i % 29 == 0 else i, t) for i, t in enumerate(texts)]
    target = [line() + "\n" + line() for _ in range(20)] + [None, ""]
    docs = spark.createDataFrame([(*r, "clash", "clash") for r in rows], "doc_id long, text string, row string, words string")
    aim = spark.createDataFrame(list(enumerate(target)), "item_id long, text string").withColumnRenamed("item_id", "doc_id")
    got = importance_lines.resample(docs, aim).select("doc_id", "n_features", "weight", "score", "rank").collect()
    assert sorted(map(_key, got)) == sorted(map(_key, _brute(rows, target)))
    assert sum(r["rank"] is not None for r in got) > 5


def test_empty_tables(spark):
    prepare(spark)
    none = spark.createDataFrame([], "doc_id long, text string")
    some = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    assert importance_lines.resample(none, some).count() == 0
    got = {r["doc_id"]: r for r in importance_lines.resample(some, none).collect()}
    assert got[1]["n_features"] == 3 and got[2]["weight"] == 0 and got[1]["rank"] is None
