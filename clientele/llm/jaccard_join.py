"""Jaccard join of word shingles by multiple-global-order filtering.

Method.  A document is its set of distinct word 5-grams (64-bit hashes).  Two
sets of Jaccard similarity t or more must share a token among the first
n - ceil(t n) + 1 tokens of each, under any one global order of all tokens;
so under several orders they must share such a token in each.  Orders here
put tokens that are frequent in the corpus last, and arrange the rest by
hashes of different seeds.  The first order finds candidates through Spark:
prefix tokens meet in a shuffle.  Its prefixes are ``EXTRA`` percent of n
longer than needed, so linked sets share that many more tokens there, and sets
and pairs that share fewer are dropped.  A pair then meets with its sets' tokens
counted in hash buckets, an upper bound of what they share, and only what may
link by that is sent the whole sets.  There the other orders have to agree, and
pairs that pass all are verified.  Sets are written where their documents are
read, and those that a round's pairs need are sent from there.

Equal sets are one node throughout, named by the set's hash.  Components need
no list of all pairs: in each of ``STARS`` rounds the sets of a token are
compared with a few pivots, and what links joins a component.  A frequent
token's sets are dealt to parts anew each round, each with a pivot of its own
out of the largest component there; these rounds look at one token in ``THINNED`` only,
as they need not find all.  From the third on the sets of a frequent token are
compared by the token before it: sets that lack the same tokens of a passage
have the same one there, and the pivot is the set with least of its own.  A last round then verifies every
remaining candidate pair whose sets lie in different components, so no link
between components is missed; pairs within one component need no further look.
There a large group of sets that share a passage and differ from each other
would meet in all its pairs.  So at a token of ``CROWD`` sets or more, sets meet
with a parity sketch, whose differing bits are no more than the tokens in which
the sets differ, and only pairs that may link by that become rows.
Tables of a round are deleted when the next one has been written.

The exactness rests on 64-bit hashes of shingles and of sets being distinct.

Defined cases: null, empty or wordless text has an empty set, links with
nothing and is its own component; texts of fewer than five words are one
shingle; repeated rows are linked as equal sets; an empty table gives an empty
result; extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from clientele.llm.common import components, counted, discard, mix, staged, word_hashes

#: Words of a shingle and percent of the union that a link's intersection reaches.
SHINGLE, PERCENT = 5, 80
#: Percent of a set by which its prefixes are longer than one shared token needs.
EXTRA = 5
#: Seeds of the global orders; the first one finds the candidates.
ORDERS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)
#: A token that a run of so many tokens holds so often is counted as frequent.
RUN, OFTEN = 1 << 22, 4
#: Bound of the list of frequent tokens, which tasks receive.  It only shapes
#: the orders; any list gives the same links.
FREQUENT = 1 << 17
#: Parts into which a frequent token's sets are dealt when pivots are chosen.
SALTS = 16
#: Rounds of comparing with pivots, pivots a set is compared with in a round, and
#: members compared in one group.
STARS, PIVOTS, GROUP = 3, 3, 512
#: One token in so many is looked at in the rounds of pivots (a power of two).
THINNED = 4
#: Sets of a token from which on they meet with sketches, and the sketch's 64-bit words.
CROWD, WORDS = 64, 8
#: Bits of the filter that tells which sets are needed (4 MB, whatever the input).
FILTER_BITS = 1 << 25


def shingles(text: str | None) -> np.ndarray:
    """The text's distinct shingles, as sorted 64-bit hashes."""
    h = word_hashes(text)
    if not len(h):
        return h
    k = min(SHINGLE, len(h))
    out = np.full(len(h) - k + 1, k, dtype=np.uint64)
    for i in range(k):
        out = out * np.uint64(0x2545F4914F6CDD1D) + h[i:len(h) - k + 1 + i]
        out ^= out >> np.uint64(29)
    return counted(mix(out))[0]


def set_key(tokens: np.ndarray) -> int:
    import xxhash
    return int(np.uint64(xxhash.xxh3_64_intdigest(tokens.tobytes())).astype(np.int64))


def prefix_size(n, percent: int = PERCENT):
    """n - ceil(percent n / 100) + 1 + floor(EXTRA n / 100).

    With k = 1 + floor(EXTRA n / 100) a set's prefix holds the first k tokens,
    at least, that it shares with a set it links to; so linked sets share the
    smaller k of the two.
    """
    return min(n, n - -(-percent * n // 100) + 1 + EXTRA * n // 100)


def _shared(n, percent: int = 100):
    """The least that linked sets share in their prefixes: for sets of ``n`` at
    least, or (``percent`` of the link) for partners of a set of n."""
    return F.lit(1) + F.floor(n * F.lit(EXTRA * percent) / F.lit(10000))


class Orders:
    """Global orders: frequent tokens last by rising count, the rest by hash."""

    def __init__(self, tokens: np.ndarray, counts: np.ndarray) -> None:
        by = np.argsort(tokens)
        self.tokens = tokens[by]
        self.weight = (np.floor(np.log2(np.maximum(counts[by], 1))).astype(np.uint64) + np.uint64(1)) << np.uint64(56)

    def frequent(self, tokens: np.ndarray) -> np.ndarray:
        if not len(self.tokens):
            return np.zeros(len(tokens), dtype=bool)
        at = np.minimum(np.searchsorted(self.tokens, tokens), len(self.tokens) - 1)
        return self.tokens[at] == tokens

    def prefix(self, tokens: np.ndarray, order: int, percent: int = PERCENT) -> np.ndarray:
        """The first tokens of a sorted set under an order, in that order."""
        place = mix(tokens ^ np.uint64(ORDERS[order])) >> np.uint64(8)
        if len(self.tokens):
            at = np.minimum(np.searchsorted(self.tokens, tokens), len(self.tokens) - 1)
            place = place + np.where(self.tokens[at] == tokens, self.weight[at], np.uint64(0))
        size = prefix_size(len(tokens), percent)
        first = np.flatnonzero(place <= np.partition(place, size - 1)[size - 1])
        return tokens[first[np.argsort(place[first], kind="stable")[:size]]]  # ties by token


def _member(a: np.ndarray, b: np.ndarray) -> int:
    """How many values of the sorted set a are in the sorted set b."""
    at = np.minimum(np.searchsorted(b, a), len(b) - 1)
    return int((b[at] == a).sum())


def linked(a: np.ndarray, b: np.ndarray, percent: int = PERCENT) -> bool:
    both = _member(a, b) if len(a) <= len(b) else _member(b, a)
    return 100 * both >= percent * (len(a) + len(b) - both)


def profile(docs: DataFrame) -> DataFrame:
    """kind 0: (doc_id, set key, set size); kind 1: (token, -, count) of tokens
    that a run of this task's distinct sets holds often."""
    def local(batches: Iterator) -> Iterator:
        import pyarrow as pa
        held: list[np.ndarray] = []
        keys: set[int] = set()
        total = 0

        def often():
            found, n = counted(np.concatenate(held))
            found, n = found[n >= OFTEN], n[n >= OFTEN]
            held.clear()
            keys.clear()
            size = len(found)
            return pa.RecordBatch.from_arrays(
                [pa.array(np.ones(size, np.int32)), pa.array(found.view(np.int64)),
                 pa.array(np.zeros(size, np.int64)), pa.array(n.astype(np.int64))], ["kind", "a", "b", "n"])

        for batch in batches:
            key, size = [], []
            for t in batch.column(1).to_pylist():
                s = shingles(t)
                k = set_key(s) if len(s) else 0
                key.append(k)
                size.append(len(s))
                if len(s) and k not in keys:
                    keys.add(k)
                    held.append(s)
                    total += len(s)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.zeros(len(key), np.int32)), batch.column(0), pa.array(key, pa.int64()), pa.array(size, pa.int64())],
                ["kind", "a", "b", "n"])
            if total >= RUN:
                yield often()
                total = 0
        if held:
            yield often()

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(local, "kind int, a long, b long, n long")


def frequent_tokens(profiled: DataFrame) -> Orders:
    rows = (profiled.filter("kind = 1").groupBy("a").agg(F.sum("n").alias("n"))
            .orderBy(F.col("n").desc(), "a").limit(FREQUENT).toArrow())
    return Orders(rows.column("a").to_numpy().view(np.uint64), rows.column("n").to_numpy())


def postings(docs: DataFrame, orders: Orders, percent: int = PERCENT) -> DataFrame:
    """token, salt, key, n, at: first-order prefix tokens of a task's distinct
    sets and each one's place in its set (from 0)."""
    shared = docs.sparkSession.sparkContext.broadcast(orders)  # FREQUENT tokens at most

    def local(batches: Iterator) -> Iterator:
        import pyarrow as pa
        seen: set[int] = set()
        for batch in batches:
            tokens, keys, sizes, counts = [], [], [], []
            for t in batch.column(0).to_pylist():
                s = shingles(t)
                if not len(s) or (k := set_key(s)) in seen:
                    continue
                seen.add(k)
                tokens.append(shared.value.prefix(s, 0, percent))
                keys.append(k)
                sizes.append(len(s))
                counts.append(len(tokens[-1]))
            if not tokens:
                continue
            token, key = np.concatenate(tokens), np.repeat(np.array(keys, np.int64), counts)
            at = np.concatenate([np.arange(c, dtype=np.int32) for c in counts])
            salt = np.where(shared.value.frequent(token), 1 + key % SALTS, 0).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.array(token.view(np.int64)), pa.array(salt), pa.array(key),
                 pa.array(np.repeat(np.array(sizes, np.int32), counts)), pa.array(at)],
                ["token", "salt", "key", "n", "at"])

    return docs.select("text").mapInArrow(local, "token long, salt int, key long, n int, at int")


def meeting(posted: DataFrame) -> DataFrame:
    """The postings whose (token, salt) at least two different sets hold.

    A frequent token whose part holds one set only is kept: its other parts
    may hold more.
    """
    w = W.partitionBy("token", "salt").orderBy("key")
    first = F.first("key").over(w.rowsBetween(W.unboundedPreceding, W.currentRow))
    rows = posted.withColumns({"first": first, "prior": F.lag("key").over(w), "next": F.lead("key").over(w)})
    other = (F.col("key") != F.col("first")) & (F.col("key") != F.col("prior"))
    leads = (F.col("key") == F.col("first")) & F.col("next").isNotNull() & (F.col("next") != F.col("key"))
    alone = (F.col("salt") != 0) & F.col("next").isNull() & (F.col("key") == F.col("first"))
    return rows.filter(other | leads | alone).select("token", "salt", "key", "n", "at")


def sharing(met: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The meeting postings of sets that share with others as many tokens as a
    link needs, and ``prev``, the token before each (the first has itself).

    ``prev`` is null if no other set holds the token before, which differs then
    from what any other set has there.  A set has no more rows than its prefix.
    """
    w = W.partitionBy("key").orderBy("at")
    prev = F.when(F.col("at") == 0, F.col("token")).when(F.lag("at").over(w) == F.col("at") - 1, F.lag("token").over(w))
    whole = w.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    return (met.withColumns({"prev": prev, "met": F.count("*").over(whole)})
            .filter(F.col("met") >= _shared(F.col("n"), percent)).drop("met"))


#: Shifts that take the filter's bit numbers out of a set key, itself a hash.
_PIECES = (0, 20, 39)


def key_filter(keys: DataFrame) -> np.ndarray:
    """A Bloom filter of set keys: FILTER_BITS bits as 64-bit words."""
    bits = keys.select(F.explode(F.array(*[
        F.shiftrightunsigned("key", p).bitwiseAND(FILTER_BITS - 1) for p in _PIECES])).alias("bit"))
    words = (bits.groupBy(F.shiftright("bit", 6).alias("word"))
             .agg(F.bit_or(F.expr("shiftleft(1L, cast(bit & 63 as int))")).alias("mask")).toArrow())
    out = np.zeros(FILTER_BITS // 64, dtype=np.uint64)
    out[words.column("word").to_numpy()] = words.column("mask").to_numpy().view(np.uint64)
    return out


def may_hold(mask: np.ndarray, key: int) -> bool:
    u = key & 0xFFFFFFFFFFFFFFFF
    bits = [(u >> p) & (FILTER_BITS - 1) for p in _PIECES]
    return all((int(mask[b >> 6]) >> (b & 63)) & 1 for b in bits)


def among(values: DataFrame, keys: DataFrame) -> DataFrame:
    """``values`` (key, value) of ``keys``, once each.

    Rows that the keys' filter excludes stay where they are; its size is fixed,
    and what it lets through needlessly a join with the keys has to drop.
    """
    shared = values.sparkSession.sparkContext.broadcast(key_filter(keys))

    @F.pandas_udf("boolean")
    def held(key: pd.Series) -> pd.Series:
        u, may = key.to_numpy().view(np.uint64), np.ones(len(key), dtype=bool)
        for p in _PIECES:
            bit = (u >> np.uint64(p)) & np.uint64(FILTER_BITS - 1)
            may &= (shared.value[bit >> np.uint64(6)] >> (bit & np.uint64(63))) & np.uint64(1) == 1
        return pd.Series(may)

    return values.filter(held("key")).dropDuplicates(["key"])


def sets_of(docs: DataFrame, keys: DataFrame) -> DataFrame:
    """key, tokens, counts (binary), sketch: the sets of ``keys``, their
    ``bucket_counts`` and their ``parities``.

    Each task makes its own: a set comes once for every task that has it, and
    sets that the filter lets through needlessly come too.  Readers take those
    they need ``among`` them.
    """
    shared = docs.sparkSession.sparkContext.broadcast(key_filter(keys))

    def local(batches: Iterator) -> Iterator:
        import pyarrow as pa
        mask, seen = shared.value, set()
        for batch in batches:
            out_key, out, counts, sketch = [], [], [], []
            for t in batch.column(0).to_pylist():
                s = shingles(t)
                if not len(s) or (k := set_key(s)) in seen or not may_hold(mask, k):
                    continue
                seen.add(k)
                out_key.append(k)
                out.append(s.tobytes())
                counts.append(bucket_counts(s).tobytes())
                sketch.append(parities(s))
            yield pa.RecordBatch.from_arrays([pa.array(out_key, pa.int64()), pa.array(out, pa.binary()), pa.array(counts, pa.binary()),
                                              pa.array(sketch, pa.list_(pa.int64()))], ["key", "tokens", "counts", "sketch"])

    return docs.select("text").mapInArrow(local, "key long, tokens binary, counts binary, sketch array<long>")


def bucket_counts(s: np.ndarray) -> np.ndarray:
    """How many tokens of a set fall into each of as many buckets as the largest
    power of two up to its size, 255 standing for that and more."""
    buckets = 1 << (len(s).bit_length() - 1)
    counts = np.bincount((s & np.uint64(buckets - 1)).astype(np.int64), minlength=buckets)
    return np.minimum(counts, 255).astype(np.uint8)


def parities(s: np.ndarray) -> np.ndarray:
    """For each of 64 * WORDS buckets whether a set has an odd number of tokens
    there, as bits of WORDS integers.

    A token that only one of two sets has changes one bit, so the bits in which
    two sketches differ are at most the tokens in which the sets differ.
    """
    odd = np.bincount((s >> np.uint64(32)).astype(np.int64) & (64 * WORDS - 1), minlength=64 * WORDS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _near(percent: int):
    """Whether the sketches differ in no more bits than linked sets in tokens."""
    bits = reduce(lambda x, y: x + y, [F.bit_count(F.col("sketch_a")[i].bitwiseXOR(F.col("sketch_b")[i])) for i in range(WORDS)])
    return bits * (100 + percent) <= (F.col("n_a") + F.col("n_b")) * (100 - percent)


def may_link(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether sets of these bucket counts may link: they share at most the
    smaller count of each bucket."""
    if a.max() == 255 or b.max() == 255:
        return True
    a, b = a.astype(np.int64), b.astype(np.int64)
    total = int(a.sum() + b.sum())
    while len(a) != len(b):  # low bits name the buckets, so halves add up
        if len(a) > len(b):
            a = a.reshape(2, -1).sum(axis=0)
        else:
            b = b.reshape(2, -1).sum(axis=0)
    return int(np.minimum(a, b).sum()) * (100 + percent) >= percent * total


def _agreeing(pairs: DataFrame, values: DataFrame, compare) -> DataFrame:
    """The pairs (a, b) for which ``compare``, given the value of a, returns a
    function that is true of the value of b; ``values`` has key and value.

    Pairs meet at a: its value and those of its partners go to groups of at most
    about GROUP partners, however many partners it has.
    """
    parts = pairs.groupBy("a").agg(F.greatest(F.lit(1), F.ceil(F.count("*") / F.lit(GROUP))).cast("int").alias("parts"))
    partners = (pairs.join(parts, "a")
                .select("a", F.pmod(F.xxhash64("a", "b"), F.col("parts")).cast("int").alias("part"), F.col("b").alias("key")))
    centres = parts.select("a", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.col("a").alias("key"))
    held = among(values, pairs.select(F.explode(F.array("a", "b")).alias("key")))
    wanted = partners.unionByName(centres).join(held, "key")

    def check(key, table):
        import pyarrow as pa
        a = key[0].as_py()
        keys, held = table.column("key").to_pylist(), table.column("value").to_pylist()
        found = []
        if a in keys:
            agrees = compare(held[keys.index(a)])
            found = [k for k, value in zip(keys, held) if k != a and agrees(value)]
        return pa.table([pa.array([a] * len(found), pa.int64()), pa.array(found, pa.int64())], names=["a", "b"])

    return wanted.groupBy("a", "part").applyInArrow(check, "a long, b long")


def bounded(pairs: DataFrame, sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The pairs (a, b) that may link by their sets' bucket counts."""
    def compare(raw):
        own = np.frombuffer(raw, dtype=np.uint8)
        return lambda other: may_link(own, np.frombuffer(other, dtype=np.uint8), percent)

    return _agreeing(pairs, sets.select("key", F.col("counts").alias("value")), compare)


def verified(pairs: DataFrame, sets: DataFrame, orders: Orders, percent: int = PERCENT) -> DataFrame:
    """The pairs (a, b) that every order lets pass and whose whole sets link."""
    shared = pairs.sparkSession.sparkContext.broadcast(orders)

    def compare(raw):
        own = np.frombuffer(raw, dtype=np.uint64)
        later = [np.sort(shared.value.prefix(own, j, percent)) for j in range(1, len(ORDERS))]

        def agrees(raw):
            other = np.frombuffer(raw, dtype=np.uint64)
            if 100 * min(len(own), len(other)) < percent * max(len(own), len(other)):
                return False
            return all(_member(shared.value.prefix(other, j, percent), later[j - 1]) for j in range(1, len(ORDERS))) \
                and linked(own, other, percent)

        return agrees

    return _agreeing(pairs, sets.select("key", F.col("tokens").alias("value")), compare)


def _may_reach(percent: int):
    """Whether sets that share a token, and none before it in the order, may
    link: they share at most what each holds from there on."""
    most = F.least(F.col("n_a") - F.col("at_a"), F.col("n_b") - F.col("at_b"))
    return most * (100 + percent) >= (F.col("n_a") + F.col("n_b")) * percent


def closing_pairs(live: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(a, b), once each: every pair of sets of different components that may
    link.

    Only the first token that two sets share has to bring them together.  It
    passes ``_may_reach``, and the tokens before it differ (or it is the first
    of both), so a passage that many sets share makes about one row a pair.  If
    ``live`` has sketches, it is a row only if they are ``_near``.
    """
    columns = [c for c in ("key", "n", "at", "prev", "comp", "sketch") if c in live.columns]
    left, right = (live.select("token", *[F.col(c).alias(f"{c}_{s}") for c in columns]) for s in "ab")
    differ = F.coalesce(F.col("prev_a") != F.col("prev_b"), F.lit(True))  # null: no other set has it
    first = differ | ((F.col("at_a") == 0) & (F.col("at_b") == 0))
    may = (F.col("comp_a") < F.col("comp_b")) & first & _may_reach(percent)
    if "sketch" in columns:
        may = may & _near(percent)
    return (left.join(right, "token").filter(may)
            .select(F.least("key_a", "key_b").alias("a"), F.greatest("key_a", "key_b").alias("b")).distinct())


def joined(docs: DataFrame, percent: int = PERCENT, stars: int = STARS) -> tuple[DataFrame, DataFrame]:
    """(doc_id, key, n) of every row, and (key, comp) of the sets that are
    linked to others."""
    profiled = staged(profile(docs))
    members = profiled.filter("kind = 0").select(F.col("a").alias("doc_id"), F.col("b").alias("key"), "n")
    orders = frequent_tokens(profiled)
    met = staged(sharing(meeting(postings(docs, orders, percent)), percent))  # every round reads it
    sets = staged(sets_of(docs, met.select("key").distinct()))

    comp: DataFrame | None = None
    tried: list[DataFrame] = []
    for r in range(stars + 1):
        if r == stars:  # the first token that sets share comes early in both
            now = met.filter((F.col("n") - F.col("at")) * 100 >= F.col("n") * percent)
        elif r < 2:
            now = met.filter(F.col("token").bitwiseAND(F.lit(THINNED - 1)) == 0)
        else:
            now = met.filter("salt != 0")
        if comp is None:
            now = now.withColumns({"comp": F.col("key"), "size": F.lit(1).cast("long")})
        else:
            held = comp.groupBy("comp").agg(F.count("*").alias("size"))
            now = (now.join(comp.join(held, "comp"), "key", "left")
                   .withColumns({"comp": F.coalesce("comp", "key"), "size": F.coalesce("size", F.lit(1).cast("long"))}))
        # tokens that sets of at least two components hold
        split = (now.groupBy("token").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count("*").alias("held"))
                 .filter("lo != hi").select("token", "held"))
        if r < stars:
            live = now.join(split, "token", "left_semi") if r else now
            # at first the pivot has the least of its own before the token, so it links
            # to most; then it is a set of like size out of the largest component there,
            # so that a group whose members seldom share their first tokens hangs together
            if r == 1:
                order = [F.col("size").desc(), F.xxhash64("key", F.lit(r)), "key"]
                like = F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * percent
                sizes = F.floor(F.log("n") / F.lit(math.log(100 / percent)) + F.lit(r / 2))
            else:
                order = [F.col("at") / F.col("n"), F.xxhash64("key", F.lit(r)), "key"]
                like, sizes = _may_reach(percent), F.lit(0)
            pivot = {"a": "key", "n_a": "n", "at_a": "at", "comp_a": "comp"}
            if r < 2:
                # dealt anew each round: the parts of a token become components of their own
                part = F.when(F.col("salt") == 0, F.lit(0)).otherwise(1 + F.pmod(F.xxhash64("key", F.lit(r)), F.lit(SALTS)).cast("int"))
                by = W.partitionBy("token", part, sizes).orderBy(*order).rowsBetween(W.unboundedPreceding, W.currentRow)
                met_by = live.withColumns({to: F.first(c).over(by) for to, c in pivot.items()})
            else:  # sums up before the shuffle, as a passage's sets mostly have the same token before
                first = F.min(F.struct(*order[:2], *[F.col(c).alias(to) for to, c in pivot.items()]))
                met_by = live.join(live.groupBy("token", "prev").agg(first.alias("first")), ["token", "prev"]).select("*", "first.*")
                met_by = met_by.select("key", "n", "at", "comp", *pivot)
            pairs = (met_by.withColumnsRenamed({"key": "b", "n": "n_b", "at": "at_b"})
                     .filter((F.col("comp") != F.col("comp_a")) & like))
            # each set is compared with the pivots it meets most often; it has no more than prefix tokens
            most = F.slice(F.sort_array(F.collect_list(F.struct("times", "a")), asc=False), 1, PIVOTS)
            pairs = (pairs.groupBy("a", "b").agg(F.count("*").alias("times"))
                     .groupBy("b").agg(most.alias("most")).select(F.explode("most.a").alias("a"), "b"))
        else:
            live = staged(now.join(split, "token").select("token", "key", "n", "at", "prev", "comp", "held"))
            crowd = live.filter(F.col("held") >= CROWD).join(sets.select("key", "sketch").dropDuplicates(["key"]), "key")
            pairs = closing_pairs(live.filter(F.col("held") < CROWD), percent).unionByName(closing_pairs(crowd, percent)).distinct()
        if tried:
            before = reduce(DataFrame.unionByName, tried)
            pairs = pairs.join(before.unionByName(before.select(F.col("b").alias("a"), F.col("a").alias("b"))),
                               ["a", "b"], "left_anti")
        tried.append(staged(pairs))
        discard(live)
        likely = staged(bounded(tried[-1], sets, percent))
        found = staged(verified(likely, sets, orders, percent))
        discard(likely)
        links = found if comp is None else found.unionByName(comp.select(F.col("key").alias("a"), F.col("comp").alias("b")))
        last, comp = comp, components(links)
        discard(last, found)
    discard(met, sets, *tried)
    return members, comp


def cluster(docs: DataFrame, percent: int = PERCENT, stars: int = STARS) -> DataFrame:
    """doc_id, n_shingles, component_id, key for every row."""
    members, comp = joined(docs, percent, stars)
    # Components are named by their smallest document.
    named = (members.filter("n > 0").groupBy("key").agg(F.min("doc_id").alias("least"))
             .join(comp, "key", "left").withColumn("comp", F.coalesce("comp", "key")))
    names = named.groupBy("comp").agg(F.min("least").alias("component_id"))
    of_key = named.join(names, "comp").select("key", "component_id")
    return (members.join(of_key, "key", "left")
            .select("doc_id", F.col("n").alias("n_shingles"),
                    F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"), "key"))


def keep_one(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """``docs`` with one document of each component, by the smallest doc_id
    (null last), then the smallest hash of the row; columns unchanged.

    Rows are told apart by doc_id and text, so null and reused ids are rows of
    their own.  Wordless rows are components of their own; rows equal in doc_id
    and set of shingles stay one.
    """
    marked = docs.withColumn("__row", F.xxhash64("doc_id", "text"))
    members, comp = joined(marked.select(F.col("__row").alias("doc_id"), "text"), percent)
    ids = marked.select("__row", "doc_id")
    found = (members.withColumnRenamed("doc_id", "__row").join(comp, "key", "left")
             .join(ids.groupBy("__row").agg(F.first("doc_id").alias("doc_id")), "__row"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "__row"))
    of_sets = found.filter("n > 0").groupBy(F.coalesce("comp", "key")).agg(first.alias("best"))
    wordless = found.filter("n = 0").groupBy("doc_id").agg(first.alias("best"))
    keep = staged(of_sets.select("best.__row").unionByName(wordless.select("best.__row")))
    # a row and its repetitions share a hash
    return marked.join(keep, "__row", "left_semi").dropDuplicates(["__row"]).select(*docs.columns)
