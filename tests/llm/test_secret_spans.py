"""Every column of the secret scan against Python's re."""

import hashlib
import random
import re

from clientele.llm import secret_ledger
from clientele.llm.common import prepare

# The patterns of the contract, in its order.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")


def _brute(text):
    text = text or ""
    spans = [(m.start(), 0, m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    spans += [(m.start(), 1, m.end(), "access") for m in ACCESS.finditer(text) if len(m[0]) >= 20]
    spans += [(m.start(), 2, m.end(), "hex") for m in HEX.finditer(text) if len(m[0]) >= 24]
    joined = ",".join(f"{kind}:{start}:{end}" for start, _, end, kind in sorted(spans))
    return (*[sum(s[1] == i for s in spans) for i in range(3)],
            hashlib.sha256(joined.encode()).hexdigest())


def _texts(n, seed=5):
    rng = random.Random(seed)
    parts = ["password=hunter22", "Api_Key: 'abcDEF123'", "token = short", "secret", "AKIA" + "Q7" * 9, "AKIA12",
             "0123456789abcdef" * 2, "deadbeef", "caf\u00e9", "\U0001F600", "\n", "passwd:", "=", "x" * 30, "TOKEN=" + "a1" * 14]
    return [None, ""] + [" ".join(rng.choice(parts) for _ in range(rng.randrange(12))) for _ in range(n)]


def test_counts_hash_and_spans_equal_re(spark):
    prepare(spark)
    texts = _texts(300)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    history = secret_ledger.versions(docs)
    got = {r["doc_id"]: (r["n_assign"], r["n_access"], r["n_hex"], r["base_sha256"])
           for r in secret_ledger.digest(secret_ledger.findings(history, secret_ledger.scan(history))).collect()}
    assert got == {i: _brute(t) for i, t in enumerate(texts)}
    assert len({row[:3] for row in got.values()}) > 10
