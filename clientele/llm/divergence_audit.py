"""Source divergence audit over a minimal acyclic transducer vocabulary.

Method.  A language keeps the terms that enough of its documents hold.  The
kept terms of all languages, each behind its language's name, are sorted once;
a term's place in that order is its ordinal.  Runs of at most ``SHARD``
neighbouring terms become one minimal acyclic transducer each: equal suffix
states are merged while sorted terms are added, and the numbers on a term's
transitions add up to its ordinal.  Texts are then streamed through the
transducers byte by byte, all words of a batch at once, to recount the kept
terms by source; a word that the transducer does not accept is not counted.
Ordinals name terms from then on and break ties, as their order is the terms'
byte order; only reported terms become strings again.

Tasks receive transducers of at most ``VOLUME`` bytes at a time, and the texts
of a language are streamed once for each volume that holds terms of it.

The divergence of two sources is summed over the terms that occur in either;
the terms that occur in neither add one product.  Counts that two terms of a
source share are combined first, and terms that both sources hold are added up
inside the tasks, one row a pair and task.  All arithmetic is in integers.

Defined cases: null text, lang and source count as empty strings; a group
without terms has count 0 everywhere; a language without kept terms has pairs
of value 0 and no terms; texts of any length are read whole; repeated rows
count as often as they occur, each as a document of its own; an empty table
gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from clientele.functions.ranking import global_row_number
from clientele.llm.common import counted, discard, staged

#: Documents of a language that a kept term occurs in, and terms reported.
LEAST, TOP = 10, 10
#: Scale of the probabilities, and what is added to every count.
SCALE, ADDED = 1_000_000_000, 2
#: Terms of one transducer, bytes of transducers that tasks receive at a time.
SHARD, VOLUME = 1 << 16, 64 << 20
#: Distinct terms or pairs that a task holds before it passes them on.
HELD = 1 << 19
#: Bits of an ordinal in a number that names a group, too.
PLACE = 40

_TERM = re.compile(rb"[a-z\x80-\xff]+")
_IS_TERM = np.zeros(256, dtype=bool)
_IS_TERM[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def plain(docs: DataFrame) -> DataFrame:
    return docs.select(*[F.coalesce(c, F.lit("")).alias(c) for c in ("lang", "source", "text")])


def kept_terms(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """lang, term of the terms that at least so many documents of lang hold."""
    def local(batches: Iterator) -> Iterator:
        import pyarrow as pa
        found: defaultdict[str, Counter] = defaultdict(Counter)  # by language: terms and their documents

        def out():
            langs = np.repeat(np.arange(len(found)), [len(c) for c in found.values()])
            rows = pa.RecordBatch.from_arrays(
                [pa.array(list(found), pa.string()).take(pa.array(langs)), pa.array([t for c in found.values() for t in c], pa.string()),
                 pa.array([n for c in found.values() for n in c.values()], pa.int64())], ["lang", "term", "docs"])
            found.clear()
            return rows

        for batch in batches:
            data, bounds = _bytes(batch.column(1))
            raw, bounds, size = data.tobytes(), bounds.tolist(), sum(map(len, found.values()))
            for i, lang in enumerate(batch.column(0).to_pylist()):
                of_lang = found[lang]
                size -= len(of_lang)
                of_lang.update(set(_TERM.findall(raw, bounds[i], bounds[i + 1])))
                size += len(of_lang)
                if size >= HELD:
                    yield out()
                    size = 0
        if found:
            yield out()

    return (docs.select("lang", "text").mapInArrow(local, "lang string, term string, docs long")
            .groupBy("lang", "term").agg(F.sum("docs").alias("docs")).filter(F.col("docs") >= least).select("lang", "term"))


class Transducer:
    """A minimal acyclic transducer from sorted strings to their places.

    Transitions share one table: state s reads byte b at place base[s] + b,
    which belongs to s if owner says so; to is the next state and add what the
    transition adds to the place.
    """

    def __init__(self, base: np.ndarray, final: np.ndarray, owner: np.ndarray, to: np.ndarray, add: np.ndarray) -> None:
        self.base, self.final, self.owner, self.to, self.add = base, final, owner, to, add

    @classmethod
    def build(cls, terms: list[bytes]) -> Transducer:
        """From distinct strings in byte order."""
        known: dict[tuple, int] = {}
        states: list[tuple] = []  # (final, ((byte, state), ...)), without equals

        def frozen(final: bool, arcs: list) -> int:
            state = (final, tuple(arcs))
            if state not in known:
                known[state] = len(states)
                states.append(state)
            return known[state]

        path: list[list] = [[False, []]]  # the open states of the last string
        last = b""
        for term in [*terms, None]:
            shared = 0
            if term is not None:
                most = min(len(term), len(last))
                while shared < most and term[shared] == last[shared]:
                    shared += 1
            for depth in range(len(last), shared, -1):
                final, arcs = path.pop()
                path[-1][1].append((last[depth - 1], frozen(final, arcs)))
            if term is None:
                break
            path += [[False, []] for _ in range(len(term) - shared)]
            path[-1][0] = True
            last = term
        root = frozen(*path[0])
        return cls._packed(states, root)

    @classmethod
    def _packed(cls, states: list[tuple], root: int) -> Transducer:
        """First-fit placement of every state's transitions in one table."""
        accepted = [0] * len(states)  # strings below a state; targets come first
        for s, (final, arcs) in enumerate(states):
            accepted[s] = final + sum(accepted[t] for _, t in arcs)
        size = 1024 + 2 * sum(len(a) for _, a in states)
        taken = bytearray(size)
        base = np.zeros(len(states), dtype=np.int32)
        owner = np.full(size, -1, dtype=np.int32)
        to = np.zeros(size, dtype=np.int32)
        add = np.zeros(size, dtype=np.int32)
        top = 0
        number = {s: i for i, s in enumerate([root, *[s for s in range(len(states)) if s != root]])}
        starts = {}  # by number of transitions: where the search for a place begins
        for s in sorted(range(len(states)), key=lambda s: -len(states[s][1])):
            final, arcs = states[s]
            if not arcs:
                continue
            low = arcs[0][0]
            steps = [b - low for b, _ in arcs[1:]]
            at, tries = taken.find(0, starts.get(len(arcs), 256)), 0
            while any(taken[at + d] for d in steps):
                at, tries = taken.find(0, at + 1), tries + 1
            if tries > 32 or not steps:  # places before it are nearly full for so many
                starts[len(arcs)] = at
            if at + 512 >= len(taken):
                grow = len(taken)
                taken += bytearray(grow)
                owner, to, add = (np.concatenate([x, np.full(grow, v, dtype=np.int32)]) for x, v in ((owner, -1), (to, 0), (add, 0)))
            base[number[s]] = at - low
            before = int(final)
            for b, t in arcs:
                place = at - low + b
                taken[place] = 1
                owner[place], to[place], add[place] = number[s], number[t], before
                before += accepted[t]
                top = max(top, place)
        final = np.zeros(len(states), dtype=np.uint8)
        for s, (f, _) in enumerate(states):
            final[number[s]] = f
        top += 257
        pad = max(0, top - len(owner))
        owner, to, add = (np.concatenate([x, np.full(pad, v, dtype=np.int32)])[:top] for x, v in ((owner, -1), (to, 0), (add, 0)))
        return cls(base, final, owner, to, add)

    def to_bytes(self) -> bytes:
        head = np.array([len(self.base), len(self.owner)], dtype=np.int64)
        return b"".join(x.tobytes() for x in (head, self.base, self.owner, self.to, self.add, self.final))

    @classmethod
    def from_bytes(cls, raw: bytes) -> Transducer:
        states, places = np.frombuffer(raw, np.int64, 2)
        at, parts = 16, []
        for n in (states, places, places, places):
            parts.append(np.frombuffer(raw, np.int32, int(n), at))
            at += 4 * int(n)
        return cls(parts[0], np.frombuffer(raw, np.uint8, int(states), at), *parts[1:])

    def prefix(self, text: bytes) -> tuple[int, int]:
        """State after the bytes (-1: none) and the sum of what they add."""
        state, total = 0, 0
        for b in text:
            place = int(self.base[state]) + b
            if place < 0 or self.owner[place] != state:
                return -1, 0
            state, total = int(self.to[place]), total + int(self.add[place])
        return state, total

    def run(self, data: np.ndarray, start: np.ndarray, end: np.ndarray, state: np.ndarray, total: np.ndarray) -> np.ndarray:
        """The places of the strings data[start:end] read from given states, -1
        for those not accepted; all strings advance a byte at a time."""
        out = np.full(len(start), -1, dtype=np.int64)
        on = np.flatnonzero(state >= 0)
        state, total, at, end = state[on], total[on], start[on], end[on]
        while len(on):
            done = at == end
            if done.any():
                good = done & (self.final[state] != 0)
                out[on[good]] = total[good]
                on, state, total, at, end = (x[~done] for x in (on, state, total, at, end))
            place = self.base[state] + data[at]
            ok = (place >= 0) & (self.owner[place] == state)
            on, place, at, end, total = (x[ok] for x in (on, place, at, end, total))
            state, total, at = self.to[place], total + self.add[place], at + 1
        return out


def _named(lang: Column, term: Column | str) -> Column:
    return F.concat(lang, F.lit("\x00"), term)


def transducers(vocabulary: DataFrame, shard: int = SHARD) -> DataFrame:
    """shard, lo, hi (languages), first, last (names), fst of ``vocabulary``
    (lang, term, ord): runs of ``shard`` neighbouring terms, each a group of a
    task."""
    def build(table):
        import pyarrow as pa
        langs = table.column("lang").to_pylist()
        terms = [lang.encode() + b"\x00" + t.encode() for lang, t in zip(langs, table.column("term").to_pylist())]
        order = sorted(range(len(terms)), key=terms.__getitem__)
        fst = Transducer.build([terms[i] for i in order])
        ends = [langs[order[0]], langs[order[-1]]]
        return pa.table([pa.array([table.column("shard")[0].as_py()], pa.int64()), pa.array([ends[0]]), pa.array([ends[1]]),
                         *[pa.array([terms[order[i]]], pa.binary()) for i in (0, -1)],
                         pa.array([fst.to_bytes()], pa.binary())], ["shard", "lo", "hi", "first", "last", "fst"])

    return (vocabulary.withColumn("shard", F.floor(F.col("ord") / F.lit(shard)).cast("long"))
            .groupBy("shard").applyInArrow(build, "shard long, lo string, hi string, first binary, last binary, fst binary"))


def recount(docs: DataFrame, shards: DataFrame, shard: int = SHARD, volume: int = VOLUME) -> DataFrame:
    """lang, source, ord, n: occurrences of every kept term, by its ordinal."""
    sizes = shards.select("shard", "lo", "hi", F.length("fst").alias("size")).orderBy("shard").collect()  # one row a SHARD terms
    volumes: list[list] = []
    for r in sizes:
        if volumes and sum(x["size"] for x in volumes[-1]) + r["size"] <= volume:
            volumes[-1].append(r)
        else:
            volumes.append([r])
    schema = "lang string, source string, ord long, n long"
    out = docs.sparkSession.createDataFrame([], schema)
    for part in volumes:
        rows = shards.filter(F.col("shard").between(part[0]["shard"], part[-1]["shard"])).select("shard", "fst", "first", "last").collect()
        shared = docs.sparkSession.sparkContext.broadcast(
            {r["shard"] * shard: (bytes(r["fst"]), bytes(r["first"]), bytes(r["last"])) for r in rows})
        texts = docs.filter(F.col("lang").between(part[0]["lo"], part[-1]["hi"]))
        out = out.unionByName(texts.mapInArrow(_streamed(shared), schema))
    return out.groupBy("lang", "source", "ord").agg(F.sum("n").alias("n"))


def _streamed(shared):
    """A function for mapInArrow: kept terms of (lang, source, text) batches."""
    def local(batches: Iterator) -> Iterator:
        import pyarrow as pa
        fsts = {at: (Transducer.from_bytes(raw), first, last) for at, (raw, first, last) in shared.value.items()}
        starts: dict[tuple[int, str], tuple[int, int]] = {}
        groups: dict[tuple[str, str], int] = {}
        held: list[tuple[np.ndarray, np.ndarray]] = []  # (group << PLACE) + ordinal, occurrences

        def merged():
            name, n = (np.concatenate(x) for x in zip(*held))
            by = np.argsort(name)
            name, n = name[by], n[by]
            first = np.flatnonzero(np.r_[True, name[1:] != name[:-1]])
            held[:] = [(name[first], np.add.reduceat(n, first))]
            return len(first)

        def out():
            names = list(groups)
            name, n = held.pop()
            columns = [pa.array([x[i] for x in names]).take(pa.array(name >> PLACE)) for i in (0, 1)]
            held.clear()
            groups.clear()
            return pa.RecordBatch.from_arrays([*columns, pa.array(name & ((1 << PLACE) - 1)), pa.array(n)], ["lang", "source", "ord", "n"])

        for batch in batches:
            langs = batch.column(0).to_pylist()
            of_row = np.array([groups.setdefault(g, len(groups)) for g in zip(langs, batch.column(1).to_pylist())], dtype=np.int64)
            data, bounds = _bytes(batch.column(2))
            start, end = _runs(data, bounds)
            row = np.searchsorted(bounds, start, "right") - 1
            head, seen = _head(data, start, end), []
            for number, (fst, first, last) in fsts.items():
                for lang in set(langs):
                    if (number, lang) not in starts:
                        starts[number, lang] = (*fst.prefix(lang.encode() + b"\x00"), *_bounds(lang.encode() + b"\x00", first, last))
                begin = [starts[number, lang] for lang in langs]
                state, total = (np.array([x[i] for x in begin], dtype=np.int64) for i in (0, 1))
                least, most = (np.array([x[i] for x in begin], dtype=np.uint64) for i in (2, 3))
                some = np.flatnonzero((state[row] >= 0) & (head >= least[row]) & (head <= most[row]))
                place = fst.run(data, start[some], end[some], state[row[some]], total[row[some]])
                good = place >= 0
                seen.append((of_row[row[some[good]]] << PLACE) + place[good] + number)
            of_batch = counted(np.concatenate(seen))
            if len(of_batch[0]):
                held.append(of_batch)
            starts.clear() if len(starts) > HELD else None
            full = sum(len(x[0]) for x in held) >= 4 * HELD and merged() >= HELD
            if held and (full or len(groups) >= HELD and merged()):
                yield out()
            groups.clear() if not held else None
        if held and merged():
            yield out()

    return local


def _head(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The first eight bytes of strings as numbers of the same order."""
    padded = np.r_[data, np.zeros(8, dtype=np.uint8)]
    eight = np.ndarray(len(data) + 1, dtype=">u8", buffer=padded, strides=(1,))  # the eight bytes from every place on
    past = np.maximum(8 - (end - start), 0).astype(np.uint64) * np.uint64(8)
    return eight[start].astype(np.uint64) >> past << past


def _bounds(name: bytes, first: bytes, last: bytes) -> tuple[int, int]:
    """Between which heads a language's terms of a run from first to last lie."""
    number = lambda term: int.from_bytes(term[:8].ljust(8, b"\x00"), "big")
    own = lambda term: term.startswith(name) and 0 not in term[len(name):]
    return (number(first[len(name):]) if own(first) else 0,
            number(last[len(name):]) if own(last) else (1 << 64) - 1)


def _bytes(column) -> tuple[np.ndarray, np.ndarray]:
    """The lower-cased bytes of a string column and the places between rows."""
    raw = np.frombuffer(column.buffers()[1], dtype=np.int64 if str(column.type) == "large_string" else np.int32)
    bounds = raw[column.offset:column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(column.buffers()[2] or b"", dtype=np.uint8)[bounds[0]:bounds[-1]]
    return _LOWER[data], bounds - bounds[0]


def _runs(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of term bytes, cut at the places between rows."""
    inside = _IS_TERM[data]
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    cuts = bounds[(bounds > 0) & (bounds < len(data))]
    begins[cuts] = inside[cuts]
    ends[cuts - 1] = inside[cuts - 1]
    return np.flatnonzero(begins), np.flatnonzero(ends) + 1


def _probability(n: Column | str, total: str, kept: str) -> Column:
    """1 + floor(SCALE (n + ADDED) / (total + ADDED kept)), exactly."""
    return F.expr(f"1 + cast((cast({SCALE} as decimal(10,0)) * cast({n} + {ADDED} as decimal(19,0))) "
                  f"div cast({total} + {ADDED} * {kept} as decimal(19,0)) as bigint)")


def _divergence(p: str, q: str) -> Column:
    """floor((p - q)^2 / (p + q)): both are at most SCALE + 1, so longs hold it."""
    return F.expr(f"(({p} - {q}) * ({p} - {q})) div ({p} + {q})")


def _shared_terms(by_term: DataFrame) -> DataFrame:
    """lang, a, b, value (a < b): over the terms that both sources hold, what
    f(p_a, p_b) differs from the sum that ``audit`` adds for the two alone.

    ``by_term`` has lang and held, an array of (source, p, zero) of a term.
    """
    def f(p, q):
        return (p - q) * (p - q) // (p + q)

    def local(batches: Iterator) -> Iterator:
        import pyarrow as pa
        import pyarrow.compute as pc
        found: Counter = Counter()

        def out():
            rows = pa.RecordBatch.from_arrays(
                [*[pa.array([k[i] for k in found], pa.string()) for i in range(3)], pa.array(list(found.values()), pa.int64())],
                ["lang", "a", "b", "value"])
            found.clear()
            return rows

        for batch in batches:
            held = batch.column(1)
            size = np.diff(held.offsets.to_numpy()).astype(np.int64)
            flat = held.flatten()
            names = pc.dictionary_encode(flat.field(0))
            source, p, zero = names.indices.to_numpy().astype(np.int64), flat.field(1).to_numpy(), flat.field(2).to_numpy()
            lang = pc.dictionary_encode(batch.column(0))
            of_row = lang.indices.to_numpy().astype(np.int64)
            label, langs = names.dictionary.to_pylist(), lang.dictionary.to_pylist()
            order = np.argsort(np.argsort(np.array(label, dtype=object))) if label else np.empty(0, np.int64)
            first = np.cumsum(np.r_[0, size])
            # as many terms at a time as make about HELD pairs
            chunk = np.cumsum(size * size) // HELD
            for c in np.unique(chunk):
                rows = np.flatnonzero(chunk == c)
                k = np.repeat(size[rows], size[rows])  # partners of every entry
                entry = np.concatenate([np.arange(first[r], first[r + 1]) for r in rows]) if len(rows) else np.empty(0, np.int64)
                row = np.repeat(rows, size[rows])
                x = np.repeat(entry, k)
                y = np.arange(len(x)) - np.repeat(np.cumsum(k) - k, k) + np.repeat(first[row], k)
                keep = order[source[x]] < order[source[y]]
                x, y, at = x[keep], y[keep], of_row[np.repeat(row, k)[keep]]
                value = f(p[x], p[y]) - f(p[x], zero[y]) - f(zero[x], p[y]) + f(zero[x], zero[y])
                pair = (at * len(label) + source[x]) * len(label) + source[y]
                which, of = np.unique(pair, return_inverse=True)
                total = np.zeros(len(which), dtype=np.int64)
                np.add.at(total, of, value)
                for w, v in zip(which.tolist(), total.tolist()):
                    rest, b = divmod(w, len(label))
                    at_lang, a = divmod(rest, len(label))
                    found[langs[at_lang], label[a], label[b]] += v
                if len(found) >= HELD:
                    yield out()
        if found:
            yield out()

    return by_term.select("lang", "held").mapInArrow(local, "lang string, a string, b string, value long")


def audit(docs: DataFrame, least: int = LEAST, top: int = TOP, shard: int = SHARD, volume: int = VOLUME) -> DataFrame:
    """lang, source, part, item, value, rank."""
    docs = plain(docs)
    groups = staged(docs.select("lang", "source").distinct())
    terms = staged(kept_terms(docs, least))
    ordered = global_row_number(terms.withColumn("name", _named(F.col("lang"), "term")), ["name"], out="ord")
    vocabulary = staged(ordered.select("lang", "term", (F.col("ord") - 1).alias("ord")))
    discard(terms)
    shards = staged(transducers(vocabulary, shard))
    counts = staged(recount(docs, shards, shard, volume))
    discard(shards)

    kept = vocabulary.groupBy("lang").agg(F.count("*").alias("kept"))
    sums = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    # one row a source of a language, with its probability of a count of 0
    stats = staged(groups.join(sums, ["lang", "source"], "left").join(kept, "lang", "left").fillna(0, ["total", "kept"])
                   .withColumn("zero", F.when(F.col("kept") > 0, _probability("0L", "total", "kept"))))
    langs = stats.groupBy("lang").agg(F.sum("total").alias("lang_total"), F.first("kept").alias("kept"))

    # every kept term that occurs in a group, with p of the group and q of the language
    seen = counts.join(stats, ["lang", "source"]).withColumn("p", _probability("n", "total", "kept"))
    by_term = staged(seen.groupBy("lang", "ord").agg(
        F.sum("n").alias("n"), F.collect_list(F.struct("source", "p", "zero")).alias("held")))  # one entry a source
    above = (by_term.join(langs, "lang").withColumn("q", _probability("n", "lang_total", "kept"))
             .select("lang", "ord", "q", F.explode("held").alias("h")).select("lang", "ord", "q", "h.source", "h.p")
             .filter("p > q").withColumn("value", _divergence("p", "q")))
    best = W.partitionBy("lang", "source").orderBy(F.col("value").desc(), "ord")
    reported = above.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= top)
    of_terms = (reported.join(vocabulary.select("ord", "term"), "ord")
                .select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), "value", "rank"))

    one, other = (stats.select("lang", *[F.col(c).alias(f"{c}_{s}") for c in ("source", "zero", "kept")]) for s in "ab")
    pairs = one.join(other, "lang").filter("source_a != source_b")
    base = pairs.select("lang", F.col("source_a").alias("a"), F.col("source_b").alias("b"), F.when(
        F.col("kept_a") > 0, F.col("kept_a") * _divergence("zero_a", "zero_b")).otherwise(F.lit(0).cast("long")).alias("value"))
    # terms of a alone: equal counts are equal probabilities
    levels = staged(seen.groupBy("lang", "source", "p", "zero").agg(F.count("*").alias("times")))
    near = stats.select("lang", F.col("source").alias("b"), F.col("zero").alias("q"))
    alone = (levels.join(near, "lang").filter("source != b")
             .select("lang", F.col("source").alias("a"), "b", (F.col("times") * (_divergence("p", "q") - _divergence("zero", "q"))).alias("value")))
    flipped = alone.select("lang", F.col("b").alias("a"), F.col("a").alias("b"), "value")
    both = staged(_shared_terms(by_term))
    value = (base.unionByName(alone).unionByName(flipped).unionByName(both)
             .unionByName(both.select("lang", F.col("b").alias("a"), F.col("a").alias("b"), "value"))
             .groupBy("lang", "a", "b").agg(F.sum("value").cast("long").alias("value")))
    rank = F.row_number().over(W.partitionBy("lang", "a").orderBy(F.col("value").desc(), "b"))
    of_pairs = value.select("lang", F.col("a").alias("source"), F.lit("pair").alias("part"), F.col("b").alias("item"), "value", rank.alias("rank"))
    return of_pairs.unionByName(of_terms)
