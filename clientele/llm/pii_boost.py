"""Personal data by candidate gradient boosting.

Method.  High-recall generators propose overlapping spans (emails, ip
addresses, card and phone numbers, with looser separators than the strict
patterns); boosted trees score each candidate from its format and its context;
per kind a threshold selects redactions.  It is calibrated on all labelled
candidates, each scored by trees that did not see its text (folds by a hash).
Spans of the strict patterns always stay; a selected candidate is added where
it overlaps no span chosen before it.

The trees learn from the corpus itself, from the candidates that the strict
patterns decide: those they accept are positive; those they reject (a failed
Luhn digit, a part over 255, a plus sign before too few or too many digits) and
those with other bounds or of another kind than an accepted span are negative.
All others are unlabelled: they train and calibrate nothing, and only they can
be added.  The features say nothing of the strict patterns' deciding marks (the
plus sign of phones, the Luhn digit, the at sign's exact spelling), so a
positive looks as it would where the strict patterns miss it.  Every labelled
candidate of every text trains and calibrates; a text counts once, however many
rows hold it.

Candidates of equal kind, fold, label and features are one row with a count.
All trees of a round, of every kind and fold, grow together: one Spark job a
level adds up the histograms of gradients that tasks take of their rows, and the
driver receives those histograms only, whose size is fixed.  Gradients are
rounded to multiples of 1 / ``UNITS``, so sums do not depend on their order.
Thresholds come from prefix sums over the distinct scores, sorted by range.

Defined cases: null text counts as empty and has no spans; repeated rows are
all reported; an empty table gives an empty result; without positive and
negative candidates of a kind nothing of that kind is added (cards need no
negatives: a corpus with other long numbers has them, as nine of ten fail the
Luhn digit); extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from clientele.llm.common import discard, least_hashes, staged

# Kinds and patterns of the contract, in its order.
KINDS = ("email", "ip", "card", "phone")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL_SET = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

# Generators: wider than the patterns above.
_LOOSE_EMAIL = re.compile(r"(?i)[A-Za-z0-9._%+-]{1,64}\x20?(?:@|\(at\)|\[at\])\x20?[A-Za-z0-9-]{1,63}"
                          r"(?:\x20?(?:\.|\(dot\)|\[dot\])\x20?[A-Za-z0-9-]{1,63}){1,4}")
_LABEL = re.compile(r"(?i)\x20?(?:\.|\(dot\)|\[dot\])\x20?[A-Za-z0-9-]{1,63}")
_SIGN = re.compile(r"(?i)\x20?(?:@|\(at\)|\[at\])\x20?[A-Za-z0-9-]{1,63}")
_DIGITS = re.compile(r"[0-9]+")
#: What may stand between two groups of digits.
_LINK = re.compile(r"[\x20().\-]{1,2}")
#: Spelt-out marks of addresses, which count as the marks themselves.
_SPELT = ((re.compile(r"(?i)\x20?(?:\(at\)|\[at\])\x20?"), "@"), (re.compile(r"(?i)\x20?(?:\(dot\)|\[dot\])\x20?"), "."))
_AT = re.compile(r"(?i)@|\(at\)|\[at\]")

TREES, DEPTH, RATE, BINS = 40, 3, 0.3, 16
#: Parts of a gradient, rows of a task, rows of a block, most partial rows that
#: the driver receives a level, and trees after which scores are stored.
UNITS, TASK, BLOCK, FAN_IN, STORED = 1 << 24, 50_000, 8192, 16, 10
#: Held-out precision that a kind's threshold must reach.
PRECISION = 0.995
#: Parts of the labelled candidates, by a hash of the text, for calibration.
FOLDS = 4
#: Characters of context on either side.
AROUND = 24

# Words near personal data in the corpus's languages.
CUES = {
    "email": ("mail", "contact", "kontakt", "correo", "courriel"),
    "ip": ("ip", "host", "server", "address", "addr"),
    "card": ("card", "visa", "credit", "karte", "carte", "tarjeta"),
    "phone": ("phone", "call", "tel", "fax", "mobile", "cell"),
}


def luhn(digits: str) -> bool:
    total = 0
    for i, ch in enumerate(reversed(digits)):
        d = int(ch) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost non-overlapping matches, found from each at sign: a local part
    cannot hold one, so it is the run of its characters up to the sign."""
    end = 0
    at = text.find("@")
    while at >= 0:
        a = at
        while a > end and text[a - 1] in _LOCAL_SET:
            a -= 1
        m = _DOMAIN.match(text, at + 1) if a < at else None
        if m:
            yield a, m.end()
            end = m.end()
        at = text.find("@", max(at + 1, end))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the strict patterns, by kind, then start."""
    out = [(0, a, b) for a, b in _emails(text)]
    for m in _IP.finditer(text):
        if all(int(p.lstrip("0")[:4] or "0") <= 255 for p in m.group().split(".")):
            out.append((1, m.start(), m.end()))
    for m in _CARD.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "")
        if 16 <= len(digits) <= 19 and luhn(digits):
            out.append((2, m.start(), m.end()))
    for m in _PHONE.finditer(text):
        if 8 <= sum(c.isdigit() for c in m.group()) <= 15:
            out.append((3, m.start(), m.end()))
    return out


def _address_candidates(text: str) -> Iterator[tuple[int, int, int]]:
    """Every address at group boundaries: from each part of the local part on,
    to each label of the domain."""
    for m in _LOOSE_EMAIL.finditer(text):
        sign = _SIGN.search(text, m.start(), m.end())
        starts = [m.start()] + [i for i in range(m.start() + 1, sign.start())
                                if text[i].isalnum() and not text[i - 1].isalnum()]
        at = sign.end()
        while (label := _LABEL.match(text, at, m.end())):
            at = label.end()
            for a in starts:
                yield 0, a, at


def _number_candidates(text: str) -> Iterator[tuple[int, int, int]]:
    """Every run of 4 to 19 digits that starts and ends at group boundaries."""
    groups = [m.span() for m in _DIGITS.finditer(text)]
    for i, (start, _) in enumerate(groups):
        n = 0
        for j in range(i, len(groups)):
            a, b = groups[j]
            n += b - a
            if n > 19 or (j > i and not _LINK.fullmatch(text, groups[j - 1][1], a)):
                break
            if n < 7 and j != i + 3:
                continue
            body, first = text[start:b], start
            if first and text[first - 1] == "(" and ")" in body:
                first -= 1
            if first and text[first - 1] == "+":
                first -= 1
            if j == i + 3 and n <= 12 and body.count(".") == 3:
                yield 1, first, b
            if n >= 13:
                yield 2, first, b
            if 7 <= n <= 15:
                yield 3, first, b


def candidates(text: str) -> list[tuple[int, int, int]]:
    """Overlapping proposals (kind, start, end)."""
    out = list(_address_candidates(text)) if _AT.search(text) else []
    return out + list(_number_candidates(text))


class Strict:
    """The strict spans of a text; those of one kind are in order and apart."""

    def __init__(self, spans: list[tuple[int, int, int]]) -> None:
        self.of = [[s[1:] for s in spans if s[0] == k] for k in range(len(KINDS))]
        self.ends = [[e for _, e in own] for own in self.of]

    def met(self, kind: int, start: int, end: int) -> tuple[int, int] | None:
        """The first strict span of the kind that overlaps."""
        i = bisect_right(self.ends[kind], start)
        return self.of[kind][i] if i < len(self.of[kind]) and self.of[kind][i][0] < end else None

    def decides(self, text: str, kind: int, start: int, end: int) -> bool | None:
        """Whether the strict patterns accept the candidate; None if they do
        not say."""
        own = self.met(kind, start, end)
        other = any(self.met(k, start, end) for k in range(len(KINDS)) if k != kind)
        if own:
            bare = [a + len(text[a:end]) - len(text[a:end].lstrip("+(")) for a in (own[0], start)]
            return bare[0] == bare[1] and own[1] == end and not (other and kind == 3)
        if other:
            return False
        body = text[start:end]
        if kind == 1 and any(int(p) > 255 for p in _DIGITS.findall(body)):
            return False
        if kind == 2 and not luhn("".join(_DIGITS.findall(body))):
            return False
        if kind == 3 and body[0] == "+":
            m = _PHONE.match(text, start)
            return False if m and m.end() == end else None
        return None


FEATURES = 20


def features(text: str, kind: int, start: int, end: int) -> list[float]:
    """Format and context of a candidate; nothing here is a strict pattern's
    own test."""
    body = text[start:end]
    for spelt, mark in _SPELT if kind == 0 else ():
        body = spelt.sub(mark, body)
    core = body.lstrip("+(")
    groups = [len(g) for g in re.split(r"[^0-9]+", core) if g]
    before, after = text[max(0, start - AROUND):start], text[end:end + AROUND]
    near = (before + " " + after).lower()
    words = re.findall(r"[^\W\d_]+", body)
    prev, nxt = before[-1:], after[:1]
    return [
        float(len(core)), float(sum(groups)), float(len(groups)),
        float(max(groups, default=0)), float(min(groups, default=0)),
        float(groups[0] if groups else 0), float(groups[-1] if groups else 0),
        float(core.count(" ")), float(core.count("-")), float(core.count(".")),
        float("(" in body) + float(")" in body), float(len(words)),
        float(max((len(w) for w in words), default=0)),
        float(prev.isalnum()), float(nxt.isalnum()), float(prev in "$€£#%.,-/" if prev else 0),
        float(nxt in "%.,-/" if nxt else 0),
        float(sum(c.isdigit() for c in before)), float(sum(c.isdigit() for c in after)),
        float(any(c in near for c in CUES[KINDS[kind]])),
    ]


@dataclass
class Boosted:
    """Gradient-boosted regression trees on the logistic loss, binned features."""

    edges: list[np.ndarray] = field(default_factory=list)
    start: float = 0.0
    trees: list[list[tuple[int, float, float]]] = field(default_factory=list)
    threshold: float = float("inf")

    def _bin(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(self.edges)], axis=1)

    def split(self, hist: np.ndarray, depth: int) -> None:
        """Grow the last tree by a level from its nodes' histograms (nodes,
        features, bins, gradient and hessian)."""
        tree = self.trees[-1]
        for i, k in enumerate(range(2 ** depth - 1, 2 ** (depth + 1) - 1)):
            g, h = hist[i, 0].sum(axis=0) / UNITS
            if not h:
                continue
            best, feature, cut, parts = 1e-6, -1, 0, None
            for j in range(FEATURES):
                cg, ch = (np.cumsum(hist[i, j, :len(self.edges[j]) + 1], axis=0)[:-1] / UNITS).T
                if not len(cg):
                    continue
                gain = cg ** 2 / (ch + 1) + (g - cg) ** 2 / (h - ch + 1) - g ** 2 / (h + 1)
                at = int(gain.argmax())
                if gain[at] > best:
                    best, feature, cut = gain[at], j, at
                    parts = ((cg[at], ch[at]), (g - cg[at], h - ch[at]))
            tree[k] = (feature, cut, float(RATE * g / (h + 1)))
            if parts and depth == DEPTH - 1:  # its leaves need no look of their own
                for side, (gs, hs) in enumerate(parts):
                    tree[2 * k + 1 + side] = (-1, 0, float(RATE * gs / (hs + 1)))

    @staticmethod
    def place(tree, b: np.ndarray) -> np.ndarray:
        """The node of each row."""
        node = np.zeros(len(b), dtype=int)
        feature = np.array([t[0] for t in tree])
        cut = np.array([t[1] for t in tree])
        for _ in range(DEPTH):
            f = feature[node]
            right = b[np.arange(len(b)), np.maximum(f, 0)] > cut[node]
            node = np.where(f >= 0, 2 * node + 1 + right, node)
        return node

    def raised(self, score: np.ndarray, b: np.ndarray, first: int, last: int) -> np.ndarray:
        """Scores with trees ``first`` to ``last`` added."""
        for tree in self.trees[first:last]:
            score = score + np.array([t[2] for t in tree])[self.place(tree, b)]
        return score

    def score(self, x: np.ndarray) -> np.ndarray:
        return self.raised(np.full(len(x), self.start), self._bin(x), 0, len(self.trees))


def calibrate(scored: DataFrame, precision: float = PRECISION) -> dict[int, float]:
    """kind -> the least threshold whose held-out precision, smoothed by one
    false candidate, reaches ``precision``; kinds without one are left out.

    ``scored`` has kind, s (score), y, n (count).  Prefix sums over the distinct
    scores: ranges of them are tasks, and ranges' totals are added up before.
    """
    counted = scored.groupBy("kind", "s").agg(F.sum("n").alias("n"), F.sum(F.when(F.col("y"), F.col("n")).otherwise(0)).alias("hits"))
    tagged = staged(counted.repartitionByRange("kind", F.desc("s")).withColumn("pid", F.spark_partition_id()))
    totals = tagged.groupBy("pid", "kind").agg(F.sum("n").alias("n"), F.sum("hits").alias("hits"))  # ranges, and one more a kind
    earlier = W.partitionBy("kind").orderBy("pid").rowsBetween(W.unboundedPreceding, -1)
    offsets = totals.select("pid", "kind", *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"{c}_before") for c in ("n", "hits")])
    upto = W.partitionBy("pid", "kind").orderBy(F.desc("s")).rowsBetween(W.unboundedPreceding, W.currentRow)
    sums = (tagged.withColumns({f"{c}_upto": F.sum(c).over(upto) for c in ("n", "hits")})
            .join(F.broadcast(offsets), ["pid", "kind"]))
    reached = (F.col("hits_before") + F.col("hits_upto")) / (F.col("n_before") + F.col("n_upto") + 1) >= precision
    found = {r["kind"]: r["s"] for r in sums.filter(reached).groupBy("kind").agg(F.min("s").alias("s")).collect()}
    discard(tagged)
    return found


def labelled(docs: DataFrame, sample: int | None = None, seed: int = 17, most: int | None = None) -> DataFrame:
    """kind, x, y, fold of the labelled candidates, once a text: all of them, or
    those of ``sample`` texts, or ``most`` a kind."""
    drawn = docs.select("text", F.xxhash64(F.lit(seed), "text").alias("h"))
    if sample is not None:
        texts = staged(drawn.select("h").distinct().withColumn("all", F.lit(0)))
        drawn = drawn.join(F.broadcast(staged(least_hashes(texts, "all", sample)).select("h")), "h")  # ``sample`` hashes

    def collect(batches: Iterator) -> Iterator:
        import pyarrow as pa
        done: set[int] = set()  # a task proposes each text's candidates once
        for batch in batches:
            out = []
            for t, h in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if h in done:
                    continue
                done.add(h)
                t = t or ""
                strict = Strict(base_spans(t))
                part = hashlib.sha256(t.encode("utf-8", "replace")).digest()[0] % FOLDS
                for k, a, b in candidates(t):
                    accepted = strict.decides(t, k, a, b)
                    if accepted is not None:
                        out.append((h, a, b, k, features(t, k, a, b), accepted, part))
            kinds = (pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.list_(pa.float64()), pa.bool_(), pa.int32())
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate(kinds)],
                                             ["t", "a", "b", "kind", "x", "y", "fold"])

    found = drawn.select("text", "h").mapInArrow(
        collect, "t long, a int, b int, kind int, x array<double>, y boolean, fold int").dropDuplicates(["t", "a", "b", "kind"])
    if most is not None:
        found = least_hashes(staged(found.withColumn("h", F.xxhash64(F.lit(seed), "t", "a", "b", "kind"))), "kind", most)
    return found.select("kind", "x", "y", "fold")


def _edges(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The bins' edges: distinct quantiles of sorted values with counts."""
    ends = np.cumsum(counts)
    place = np.linspace(0, 1, BINS + 1)[1:-1] * (ends[-1] - 1)
    low, high = (values[np.searchsorted(ends, f(place).astype(np.int64), side="right")] for f in (np.floor, np.ceil))
    return np.unique(low + (place - np.floor(place)) * (high - low))


def _prepared(found: DataFrame) -> dict[int, list[Boosted]]:
    """kind -> models without trees, one for each fold, which leaves it out, and
    one of all candidates; kinds with too few candidates are left out."""
    # a feature is a count or a mark within a candidate of bounded length, so it has few values
    rows = (found.select("kind", "fold", "y", "n", F.posexplode("x").alias("j", "v"))
            .groupBy("kind", "fold", "y", "j", "v").agg(F.sum("n").alias("n")).toArrow())
    kind, fold, y, j, v, n = (rows.column(c).to_numpy() for c in ("kind", "fold", "y", "j", "v", "n"))
    out: dict[int, list[Boosted]] = {}
    for k in range(len(KINDS)):
        own = (kind == k) & (j == 0)
        held = [[int(n[own & (fold == f) & (y == label)].sum()) for f in range(FOLDS)] for label in (True, False)]
        if any(sum(h) < 20 or sum(h) - max(h) < 10 for h in (held[:1] if KINDS[k] == "card" else held)):
            continue
        out[k] = []
        for m in range(FOLDS + 1):
            edges = []
            for f in range(FEATURES):
                at = (kind == k) & (fold != m) & (j == f)
                values, place = np.unique(v[at], return_inverse=True)
                edges.append(_edges(values, np.bincount(place, weights=n[at])))
            yes, no = (sum(c for f, c in enumerate(h) if f != m) for h in held)
            rate = np.clip(yes / (yes + no), 1e-3, 1 - 1e-3)
            out[k].append(Boosted(edges, float(np.log(rate / (1 - rate)))))
    return out


#: Columns of a block's rows: features, label, fold, count, scores by each model.
_Y, _FOLD, _N, _SCORES, _WIDTH = FEATURES, FEATURES + 1, FEATURES + 2, FEATURES + 3, FEATURES + 4 + FOLDS


def _blocks_of(batch) -> Iterator[tuple[int, np.ndarray]]:
    for i, kind in enumerate(batch.column(0).to_pylist()):
        yield kind, np.frombuffer(batch.column(1)[i].as_buffer(), dtype=np.float64).reshape(-1, _WIDTH)


def _packed(found: DataFrame, models: dict[int, list[Boosted]]) -> DataFrame:
    """kind, rows: the candidates in blocks of doubles."""
    def pack(batches: Iterator) -> Iterator:
        import pyarrow as pa
        for batch in batches:
            kind = batch.column(0).to_numpy(zero_copy_only=False)
            rows = np.empty((len(kind), _WIDTH))
            rows[:, :FEATURES] = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, FEATURES)
            for i, at in enumerate((_Y, _FOLD, _N), 2):
                rows[:, at] = batch.column(i).to_numpy(zero_copy_only=False)
            kinds, parts = [], []
            for k in sorted(models):
                own = rows[kind == k]
                own[:, _SCORES:] = [m.start for m in models[k]]
                for lo in range(0, len(own), BLOCK):
                    kinds.append(k)
                    parts.append(own[lo:lo + BLOCK].tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(kinds, pa.int32()), pa.array(parts, pa.binary())], ["kind", "rows"])

    tasks = max(1, -(-found.count() // TASK))
    return staged(found.select("kind", "x", "y", "fold", "n").repartition(tasks).mapInArrow(pack, "kind int, rows binary"))


def _stored(blocks: DataFrame, models: dict[int, list[Boosted]], first: int) -> DataFrame:
    """The blocks with the scores by all trees so far, of which ``first`` are in."""
    def add(batches: Iterator) -> Iterator:
        import pyarrow as pa
        for batch in batches:
            kinds, parts = [], []
            for k, rows in _blocks_of(batch):
                rows = rows.copy()
                for m, model in enumerate(models[k]):
                    b = model._bin(rows[:, :FEATURES])
                    rows[:, _SCORES + m] = model.raised(rows[:, _SCORES + m], b, first, len(model.trees))
                kinds.append(k)
                parts.append(rows.tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(kinds, pa.int32()), pa.array(parts, pa.binary())], ["kind", "rows"])

    return staged(blocks.mapInArrow(add, "kind int, rows binary"))


def _histograms(blocks: DataFrame, models: dict[int, list[Boosted]], first: int, depth: int) -> dict[int, np.ndarray]:
    """kind -> models x nodes x features x bins x (gradient, hessian), in UNITS, of
    the last trees' nodes of a depth; scores hold ``first`` trees."""
    at, nodes = sorted(models), 2 ** depth
    shape = (len(at), FOLDS + 1, nodes, FEATURES, BINS, 2)

    def partial(batches: Iterator) -> Iterator:
        import pyarrow as pa
        out = np.zeros(shape)
        for batch in batches:
            for k, rows in _blocks_of(batch):
                for m, model in enumerate(models[k]):
                    own = rows[rows[:, _FOLD] != m]
                    b = model._bin(own[:, :FEATURES])
                    p = 1 / (1 + np.exp(-model.raised(own[:, _SCORES + m], b, first, len(model.trees) - 1)))
                    node = model.place(model.trees[-1], b) - (nodes - 1)
                    here = node >= 0
                    weights = [np.rint(v * UNITS)[here] * own[here, _N] for v in (own[:, _Y] - p, p * (1 - p))]
                    for j in range(FEATURES):
                        bins = node[here] * BINS + b[here, j]
                        for i, w in enumerate(weights):
                            out[at.index(k), m, :, j, :, i] += np.bincount(bins, weights=w, minlength=nodes * BINS).reshape(nodes, BINS)
        yield pa.RecordBatch.from_arrays([pa.array([out.tobytes()], pa.binary())], ["sums"])

    def added(batches: Iterator) -> Iterator:
        import pyarrow as pa
        out = np.zeros(shape)
        for batch in batches:
            for raw in batch.column(0).to_pylist():
                out += np.frombuffer(raw).reshape(shape)
        yield pa.RecordBatch.from_arrays([pa.array([out.tobytes()], pa.binary())], ["sums"])

    parts = blocks.mapInArrow(partial, "sums binary")
    if blocks.rdd.getNumPartitions() > FAN_IN:
        parts = parts.repartition(FAN_IN).mapInArrow(added, "sums binary")
    total = sum(np.frombuffer(bytes(r["sums"])).reshape(shape) for r in parts.collect())  # FAN_IN rows at most
    return {k: total[i] for i, k in enumerate(at)}


def _held_out(blocks: DataFrame) -> DataFrame:
    """kind, s, y, n: each candidate's score by the trees that left its fold out."""
    def scores(batches: Iterator) -> Iterator:
        import pyarrow as pa
        for batch in batches:
            for k, rows in _blocks_of(batch):
                s = rows[np.arange(len(rows)), _SCORES + rows[:, _FOLD].astype(int)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(rows), k, np.int32)), pa.array(s), pa.array(rows[:, _Y] > 0),
                     pa.array(rows[:, _N].astype(np.int64))], ["kind", "s", "y", "n"])

    return blocks.mapInArrow(scores, "kind int, s double, y boolean, n long")


def fit(docs: DataFrame, sample: int | None = None, seed: int = 17) -> list[Boosted | None]:
    """One model per kind, from all labelled candidates (or of ``sample`` texts)."""
    found = staged(labelled(docs.select("text"), sample, seed).groupBy("kind", "x", "y", "fold").agg(F.count("*").alias("n")))
    models = _prepared(found)
    if models:
        blocks, first = _packed(found, models), 0
        for tree in range(TREES):
            for own in models.values():
                for model in own:
                    model.trees.append([(-1, 0, 0.0)] * (2 ** (DEPTH + 1) - 1))
            for depth in range(DEPTH):
                for k, hist in _histograms(blocks, models, first, depth).items():
                    for model, own in zip(models[k], hist):
                        model.split(own, depth)
            if (tree + 1) % STORED == 0 or tree + 1 == TREES:
                before, blocks, first = blocks, _stored(blocks, models, first), tree + 1
                discard(before)
        for k, threshold in calibrate(_held_out(blocks)).items():
            models[k][FOLDS].threshold = threshold
        discard(blocks)
    discard(found)
    return [models[k][FOLDS] if k in models else None for k in range(len(KINDS))]


def select(text: str, models: list[Boosted | None]) -> tuple[list, list]:
    """(strict spans, all spans), each by kind, then start."""
    strict = base_spans(text)
    known = Strict(strict)
    scored = []
    by_kind: dict[int, list] = {}
    for k, a, b in candidates(text):
        if (models[k] is not None and not any(known.met(j, a, b) for j in range(len(KINDS)))
                and known.decides(text, k, a, b) is None):
            by_kind.setdefault(k, []).append((a, b))
    for k, spans in by_kind.items():
        score = models[k].score(np.array([features(text, k, a, b) for a, b in spans]))
        scored += [(-(s - models[k].threshold), k, a, b) for s, (a, b) in zip(score, spans) if s >= models[k].threshold]
    added: list[tuple[int, int, int]] = []  # (start, end, kind), apart and in order
    # of equal scores the longer span
    for _, k, a, b in sorted(scored, key=lambda s: (s[0], s[2] - s[3], s)):
        at = bisect_left(added, (a, b, k))
        if (at == 0 or added[at - 1][1] <= a) and (at == len(added) or added[at][0] >= b):
            added.insert(at, (a, b, k))
    return strict, sorted(strict + [(k, a, b) for a, b, k in added])


def _text_of(spans: list) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in spans)


def find(docs: DataFrame, models: list[Boosted | None]) -> DataFrame:
    """doc_id, n_<kind>, base_sha256, spans for every row of (doc_id, text)."""
    shared = docs.sparkSession.sparkContext.broadcast(models)  # TREES small trees a kind

    def local(batches: Iterator) -> Iterator:
        import pyarrow as pa
        for batch in batches:
            n: list[list[int]] = [[] for _ in KINDS]
            sha, spans = [], []
            for t in batch.column(1).to_pylist():
                strict, chosen = select(t or "", shared.value)
                for k in range(len(KINDS)):
                    n[k].append(sum(s[0] == k for s in strict))
                sha.append(hashlib.sha256(_text_of(strict).encode()).hexdigest())
                spans.append(_text_of(chosen))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(c, pa.int64()) for c in n], pa.array(sha, pa.string()), pa.array(spans, pa.string())],
                ["doc_id", *[f"n_{k}" for k in KINDS], "base_sha256", "spans"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        local, f"doc_id {kind}, " + ", ".join(f"n_{k} long" for k in KINDS) + ", base_sha256 string, spans string")


def redact(text: str, models: list[Boosted | None]) -> str:
    """The text with every selected span replaced by its kind in brackets."""
    out, at = [], 0
    for k, a, b in sorted(select(text, models)[1], key=lambda s: s[1]):
        if a >= at:
            out += [text[at:a], f"[{KINDS[k]}]"]
            at = b
    return "".join(out) + text[at:]


def personal_data(docs: DataFrame, sample: int | None = None) -> DataFrame:
    return find(docs, fit(docs, sample))
