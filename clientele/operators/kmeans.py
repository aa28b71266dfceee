"""k-means over many starts at once: Lloyd steps, then Hartigan-Wong transfers.

All restarts of all k advance together, one Spark job a step.  The rows are
packed once into blocks of doubles, checkpointed and cached, so a step has no
plan to speak of: each task reads its blocks with numpy and returns one row of
partial sums for all unfinished runs.  Beyond ``FAN_IN`` tasks a second stage
adds the partial rows down to FAN_IN, so the driver never sees more than that.

Lloyd's steps end when a run's centres stand still.  Transfers then use the
criterion of Hartigan and Wong (1979): moving a row from its cluster of n_a
rows to one of n_b changes the total cost by d_b n_b/(n_b+1) - d_a n_a/(n_a-1)
(d: squared distance to the centre), so a row moves where that is negative.  A
round moves all such rows at once; if the total cost would not fall, only those
with the largest gains move, at last the single best one, whose move always
lowers it.  So no run ends above its Lloyd cost.

Few rows can move in a round.  Before a run's first round its blocks are settled
(``Anchor``): a row so much nearer to its centre than to the others that it stays
while no centre has gone further than the anchor's reach and no cluster has lost
half its rows is only counted in its cluster's sums; the other rows are kept with
their labels, beside the blocks, and rounds work on them alone.  Their labels
after later rounds are repeated by the tasks.  A run whose centres leave the
reach, or that has REPLAYED rounds to repeat, waits until it is settled anew
together with others; runs do not depend on each other, so waiting changes nothing.

The state of a step is the centres on the driver and the latest kept rows;
what a lost executor held is read again from the checkpoint folder.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clientele.session import cut_lineage, discard, staged

#: Rows of a block (65,536 at most), and most partial rows that the driver receives a step.
BLOCK, FAN_IN = 16384, 16
#: Rows of a block that are worked on at once, so that their distances to all
#: centres stay in a core's cache; of one run alone.
CHUNK, CHUNK_OF_ONE = 384, 4096
#: Rounds of a run that tasks repeat before it is settled anew.
REPLAYED = 8
#: An anchor's reach as a multiple of the centres' last way, and at least as a part
#: of the rows' root mean square.
SPAN, LEAST_REACH = 3.0, 1e-3
#: Steps that all runs together may wait, as a number of whole steps, before those
#: that wait are settled.
WAIT = 2.0
#: Rounding of a distance that settling allows for, as a part of the norms.
SLACK = 1e-6
#: Types of kept labels and of rows' places in their block.
LABEL, PLACE = np.uint16, np.uint16
#: Least gain of a transfer, as a part of the total sum of squares.
LEAST_GAIN = 1e-12
#: Shares of the best gain that a row's gain must exceed, tried in turn before
#: the single best transfer.
SHARES = (0.0, 0.5, 0.9, 0.99)


@dataclass
class Round:
    """One round of transfers: the centres and sizes before it, the gain that a
    move must exceed, and the only row (block, row) that moves, if any."""

    centers: np.ndarray
    sizes: np.ndarray
    above: float
    only: tuple[int, int] | None = None


@dataclass
class Anchor:
    """Where a run was settled: rows that are not kept stay in their clusters, those
    of the nearest of ``centers``, while the anchor covers the rounds that are tried."""

    centers: np.ndarray
    sizes: np.ndarray
    reach: float

    def covers(self, trial: Round) -> bool:
        way = np.sqrt(((trial.centers - self.centers) ** 2).sum(axis=1))
        return bool(way.max() <= self.reach and (2 * trial.sizes >= self.sizes).all())


@dataclass
class Run:
    """One start.  ``rounds`` is None while Lloyd's steps go on; then it holds the
    rounds since the run was settled, by ``anchor``, whose kept rows are in
    ``column``, or since Lloyd's steps."""

    centers: np.ndarray
    rounds: list[Round] | None = None
    column: int | None = None
    anchor: Anchor | None = None
    sizes: np.ndarray | None = None
    sums: np.ndarray | None = None
    cost: float = np.inf
    share: int = 0
    best: tuple[float, int, int] = (0.0, -1, -1)
    steps: int = 0
    done: bool = False
    trial: Round | None = field(default=None, repr=False)
    last: np.ndarray | None = None

    def before(self) -> np.ndarray:
        """The centres before the latest round, which empty clusters keep."""
        if self.rounds:
            return self.rounds[-1].centers
        return self.centers if self.last is None else self.last

    def ready(self) -> bool:
        """Whether the next step can work on what is kept."""
        if self.rounds is None:
            return True
        return self.anchor is not None and len(self.rounds) < REPLAYED and self.anchor.covers(self.trial)

    def next_anchor(self, squares: float, span: float) -> Anchor:
        way = np.sqrt(((self.trial.centers - self.before()) ** 2).sum(axis=1)).max()
        return Anchor(self.trial.centers, self.trial.sizes,
                      max(span * way, LEAST_REACH * np.sqrt(squares / max(self.sizes.sum(), 1))))


# In tasks, rows are columns: distances are k x runs x rows, labels runs x rows.

def _near(x: np.ndarray, norms: np.ndarray, centers: np.ndarray) -> np.ndarray:
    """k x runs x rows: squared distances to the centres (runs x k x columns)."""
    runs, k, dim = centers.shape
    c = centers.transpose(1, 0, 2).reshape(k * runs, dim)
    d = c @ x.T
    d *= -2.0
    d += norms[None, :]
    d += (c ** 2).sum(axis=1)[:, None]
    return np.maximum(d, 0.0, out=d).reshape(k, runs, len(x))


def _least(d: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The least of each row's k values in every run, and its first place."""
    best, at = d[0].copy(), np.zeros(d.shape[1:], dtype=LABEL)
    for j in range(1, len(d)):
        np.copyto(at, LABEL(j), where=d[j] < best)
        np.minimum(best, d[j], out=best)
    return best, at


def _gains(x: np.ndarray, norms: np.ndarray, label: np.ndarray, rounds: list[Round]) -> tuple[np.ndarray, np.ndarray]:
    """What each row's best transfer lowers the cost by in every run, and where
    it leads."""
    d = _near(x, norms, np.stack([r.centers for r in rounds]))
    sizes = np.stack([r.sizes for r in rounds]).T
    leave = np.where(sizes > 1, sizes / np.maximum(sizes - 1, 1), 0.0)
    enter = sizes / (sizes + 1)
    own = np.take_along_axis(d, label[None], axis=0)[0] * leave[label, np.arange(len(rounds))[:, None]]
    d *= enter[:, :, None]
    np.put_along_axis(d, label[None], np.inf, axis=0)
    best, to = _least(d)
    return own - best, to


def _moves(gain: np.ndarray, rounds: list[Round], block: int, places: np.ndarray) -> np.ndarray:
    """runs x rows: which rows move; ``places`` are the rows' places in their block."""
    move = gain > np.array([r.above for r in rounds])[:, None]
    for i, r in enumerate(rounds):
        if r.only is not None:
            move[i] = (places == r.only[1]) & (r.only[0] == block)
    return move


def _labels(x, norms, runs: list[Run], kept: np.ndarray | None, block: int, places: np.ndarray) -> np.ndarray:
    """runs x rows: labels after the rounds so far, from the kept ones or the
    nearest of the starting centres.  All runs have one k."""
    label = _least(_near(x, norms, np.stack([r.centers for r in runs])))[1] if kept is None else kept.copy()
    for n in range(max(len(r.rounds or ()) for r in runs)):
        at = [i for i, r in enumerate(runs) if r.rounds and len(r.rounds) > n]
        rounds = [runs[i].rounds[n] for i in at]
        own = label[at]
        gain, to = _gains(x, norms, own, rounds)
        label[at] = np.where(_moves(gain, rounds, block, places), to, own)
    return label


def _norms(x: np.ndarray) -> np.ndarray:
    return np.einsum("ij,ij->i", x, x)


def _with_ones(x: np.ndarray) -> np.ndarray:
    return np.concatenate([x, np.ones((len(x), 1))], axis=1)


def _grouped(member: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """k x runs x (columns and the count): sums over the rows that are members."""
    k, runs, rows = member.shape
    return (member.reshape(k * runs, rows).astype(np.float64) @ ones).reshape(k, runs, -1)


def _members(label: np.ndarray, k: int) -> np.ndarray:
    return label[None] == np.arange(k, dtype=LABEL)[:, None, None]


def _chunks(n: int, size: int) -> list[slice]:
    return [slice(i, i + size) for i in range(0, n, size)]


class Nearest:
    """Sums of the rows by nearest centre, for Lloyd's steps of runs of one k.  What
    is the same for all centres is left out of the distances."""

    def __init__(self, runs: list[Run]) -> None:
        self.k, self.runs = len(runs[0].centers), len(runs)
        c = np.stack([r.centers for r in runs]).transpose(1, 0, 2).reshape(self.k * self.runs, -1)
        self.coefs = np.concatenate([-2.0 * c, (c ** 2).sum(axis=1)[:, None]], axis=1)
        self.room: list[np.ndarray] = []  # reused, as new memory costs more than the work on it

    def sums(self, ones: np.ndarray) -> np.ndarray:
        k, runs, rows = self.k, self.runs, len(ones)
        if not self.room or self.room[0].shape[1] != rows:
            self.room = [np.empty((k * runs, rows)), np.empty((runs, rows)), np.empty((k, runs, rows), dtype=bool)]
        flat, best, member = self.room
        d = np.matmul(self.coefs, ones.T, out=flat).reshape(k, runs, rows)
        np.equal(d, np.minimum.reduce(d, axis=0, out=best), out=member)
        ties = np.count_nonzero(member) != runs * rows
        if ties:  # the first of the nearest
            member = _members(_least(d)[1], k)
        flat[...] = member.reshape(k * runs, rows)
        return (flat @ ones).reshape(k, runs, -1)


@dataclass
class Kept:
    """Of a run in a block: the sums of its settled rows (k x columns and the count),
    and places and labels of the others."""

    sums: np.ndarray
    places: np.ndarray
    labels: np.ndarray

    def to_bytes(self) -> bytes:
        return self.sums.tobytes() + self.places.astype(PLACE).tobytes() + self.labels.astype(LABEL).tobytes()

    @staticmethod
    def read(raw, k: int, dim: int) -> Kept:
        end = 8 * k * (dim + 1)
        n = (len(raw) - end) // (PLACE().itemsize + LABEL().itemsize)
        return Kept(np.frombuffer(raw, dtype=np.float64, count=end // 8).reshape(k, dim + 1),
                    np.frombuffer(raw, dtype=PLACE, count=n, offset=end),
                    np.frombuffer(raw, dtype=LABEL, count=n, offset=end + n * PLACE().itemsize))


def _settled(block: int, x: np.ndarray, norms: np.ndarray, run: Run, to: Anchor, kept: Kept | None) -> Kept:
    """The block's rows by the anchor ``to``, from what an earlier one kept of them."""
    k, places = len(to.centers), np.arange(len(x))
    was = np.empty((1, len(x)), dtype=LABEL)
    for part in _chunks(len(x), CHUNK_OF_ONE):
        was[:, part] = (_labels(x[part], norms[part], [run], None, block, places[part]) if kept is None
                        else _least(_near(x[part], norms[part], run.anchor.centers[None]))[1])
    if kept is not None:
        own = kept.places
        was[:, own] = _labels(x[own], norms[own], [run], kept.labels[None], block, own)
    half = to.sizes / 2  # the fewest rows of a covered cluster
    with np.errstate(divide="ignore", invalid="ignore"):
        leave = np.sqrt(np.where(half > 1, half / (half - 1), np.inf))[:, None]
    enter = np.sqrt(half / (half + 1))[:, None]
    far = np.sqrt((to.centers ** 2).sum(axis=1).max())
    sums, free = np.zeros((k, x.shape[1] + 1)), []
    for part in _chunks(len(x), CHUNK_OF_ONE):
        label = was[:, part]
        d = np.sqrt(_near(x[part], norms[part], to.centers[None]))[:, 0]
        reach = to.reach + SLACK * (np.sqrt(norms[part].max()) + far)
        # the most that its own centre and the least that another one can weigh
        own = np.take_along_axis((d + reach) * leave, label, axis=0)[0]
        d = (d - reach) * enter
        np.put_along_axis(d, label, np.inf, axis=0)
        stays = own < d.min(axis=0)
        sums += _grouped(_members(label, k) & stays, _with_ones(x[part]))[:, 0]
        free.append(part.start + np.flatnonzero(~stays))
    free = np.concatenate(free)
    return Kept(sums, free, was[0, free])


def _alike(runs: list[Run]) -> list[list[int]]:
    """Places of the runs of one k and phase, with or without an anchor."""
    found: dict[tuple, list[int]] = {}
    for i, r in enumerate(runs):
        found.setdefault((len(r.centers), r.rounds is None, r.column is None), []).append(i)
    return list(found.values())


class Sums:
    """Partial sums of a step for some runs, as one vector of doubles."""

    def __init__(self, ks: list[int], dim: int, raw: np.ndarray | None = None) -> None:
        self.ks, self.dim, total = ks, dim, sum(ks)
        self.raw = np.zeros(total * (1 + dim) + 4 * len(ks) + 1) if raw is None else raw
        at = total * (1 + dim)
        self.sizes = self.raw[:total]
        self.sums = self.raw[total:at].reshape(total, dim)
        #: gain, block and row of the best transfer, and the number of moves
        self.best = self.raw[at:at + 4 * len(ks)].reshape(len(ks), 4)
        if raw is None:
            self.best[:, 1:3] = -1

    def add(self, other: Sums) -> None:
        self.sizes += other.sizes
        self.sums += other.sums
        self.best[:, 3] += other.best[:, 3]
        self.raw[-1] += other.raw[-1]
        self._improve(np.arange(len(self.ks)), other.best[:, :3])

    def _improve(self, at: np.ndarray, theirs: np.ndarray) -> None:
        mine = self.best[at]
        # the larger gain, then the first place; (0, -1, -1) is no transfer
        better = (theirs[:, 1] >= 0) & ((mine[:, 1] < 0) | (theirs[:, 0] > mine[:, 0]) | (
            (theirs[:, 0] == mine[:, 0]) & ((theirs[:, 1] < mine[:, 1]) | (
                (theirs[:, 1] == mine[:, 1]) & (theirs[:, 2] < mine[:, 2])))))
        self.best[at[better], :3] = theirs[better]

    def _take(self, at: list[int], found: np.ndarray) -> None:
        """Add sums by cluster and run (k x runs x columns and the count)."""
        ends = np.cumsum(self.ks)
        for j, i in enumerate(at):
            own = slice(ends[i] - self.ks[i], ends[i])
            self.sizes[own] += found[:, j, -1]
            self.sums[own] += found[:, j, :-1]

    def of_block(self, block: int, x: np.ndarray, runs: list[Run], held: list | None = None) -> None:
        norms, places = _norms(x), np.arange(len(x))
        ones = _with_ones(x) if any(r.rounds is None for r in runs) else None
        self.raw[-1] += norms.sum()
        for at in _alike(runs):
            own = [runs[i] for i in at]
            if own[0].rounds is None:
                nearest = Nearest(own)
                self._take(at, sum(nearest.sums(ones[part]) for part in _chunks(len(x), CHUNK)))
            elif own[0].column is None:
                for part in _chunks(len(x), CHUNK):
                    self._tried(block, x[part], norms[part], places[part], at, own)
            else:
                for i in at:
                    kept = Kept.read(held[runs[i].column], self.ks[i], self.dim)
                    self._take([i], kept.sums[:, None])
                    for part in _chunks(len(kept.places), CHUNK_OF_ONE):
                        free = kept.places[part]
                        self._tried(block, x[free], norms[free], free, [i], [runs[i]], kept.labels[None, part])

    def _tried(self, block: int, x, norms, places: np.ndarray, at: list[int], runs: list[Run], kept: np.ndarray | None = None) -> None:
        """Add the rows as the runs' next rounds would move them."""
        label = _labels(x, norms, runs, kept, block, places)
        trials = [r.trial for r in runs]
        gain, to = _gains(x, norms, label, trials)
        move = _moves(gain, trials, block, places)
        row = gain.argmax(axis=1)
        for j, i in enumerate(at):
            if trials[j].only is None and gain[j, row[j]] > 0:
                self._improve(np.array([i]), np.array([[gain[j, row[j]], block, places[row[j]]]]))
        self.best[at, 3] += move.sum(axis=1)
        self._take(at, _grouped(_members(np.where(move, to, label), self.ks[at[0]]), _with_ones(x)))


def packed(rows: DataFrame, cols: list[str]) -> DataFrame:
    """block, x: the rows' doubles in blocks, checkpointed; a block's number
    and its order of rows are fixed by that.  The rows are dealt evenly to tasks that
    fill all cores, since each step waits for its last task."""
    def pack(batches: Iterator) -> Iterator:
        import pyarrow as pa

        def block(x: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([np.ascontiguousarray(x).tobytes()], pa.binary())], ["x"])

        rest = np.empty((0, len(cols)))
        for batch in batches:
            rest = np.concatenate([rest, np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns])])
            full = len(rest) - len(rest) % BLOCK
            yield from (block(rest[i:i + BLOCK]) for i in range(0, full, BLOCK))
            rest = rest[full:]
        if len(rest):
            yield block(rest)

    rows = rows.select(*cols)
    tasks, cores = rows.rdd.getNumPartitions(), rows.sparkSession.sparkContext.defaultParallelism
    even = -(-tasks // cores) * cores
    blocks = (rows if even == tasks else rows.repartition(even)).mapInArrow(pack, "x binary")
    return cut_lineage(blocks.select(F.monotonically_increasing_id().alias("block"), "x"))


def _held(blocks, dim: int) -> Iterator[tuple[int, np.ndarray, list]]:
    """block, rows, and the kept rows of each column, of an Arrow batch's blocks."""
    for i, block in enumerate(blocks.column(0).to_pylist()):
        x = np.frombuffer(blocks.column(1)[i].as_buffer(), dtype=np.float64).reshape(-1, dim)
        held = [v.as_buffer() for v in blocks.column(2)[i].values] if blocks.num_columns > 2 else []
        if len(x):
            yield block, x, held


def _step(blocks: DataFrame, runs: list[Run], dim: int) -> Sums:
    ks = [len(r.centers) for r in runs]

    def partial(batches: Iterator) -> Iterator:
        import pyarrow as pa
        out = Sums(ks, dim)
        for batch in batches:
            for block, rows, held in _held(batch, dim):
                out.of_block(block, rows, runs, held)
        yield pa.RecordBatch.from_arrays([pa.array([out.raw.tobytes()], pa.binary())], ["sums"])

    def added(batches: Iterator) -> Iterator:
        import pyarrow as pa
        out = Sums(ks, dim)
        for batch in batches:
            for raw in batch.column(0).to_pylist():
                out.add(Sums(ks, dim, np.frombuffer(raw, dtype=np.float64)))
        yield pa.RecordBatch.from_arrays([pa.array([out.raw.tobytes()], pa.binary())], ["sums"])

    parts = blocks.mapInArrow(partial, "sums binary")
    if blocks.rdd.getNumPartitions() > FAN_IN:
        parts = parts.repartition(FAN_IN).mapInArrow(added, "sums binary")
    total = Sums(ks, dim)
    for r in sorted(bytes(r["sums"]) for r in parts.collect()):  # FAN_IN rows at most, in a fixed order
        total.add(Sums(ks, dim, np.frombuffer(r, dtype=np.float64)))
    return total


def _kept(blocks: DataFrame, runs: list[Run], anchors: list[Anchor | None], dim: int) -> DataFrame:
    """The blocks with what is kept of each run by its new anchor, or as before where
    it has no new one, written to the checkpoint folder."""
    def keep(batches: Iterator) -> Iterator:
        import pyarrow as pa
        for batch in batches:
            for block, x, held in _held(batch, dim):
                norms, out = _norms(x), []
                for run, to in zip(runs, anchors):
                    raw = None if run.column is None else held[run.column]
                    if to is not None:
                        old = None if raw is None else Kept.read(raw, len(to.centers), dim)
                        raw = _settled(block, x, norms, run, to, old).to_bytes()
                    out.append(raw)
                yield pa.RecordBatch.from_arrays([
                    pa.array([block], pa.int64()), pa.array([x.tobytes()], pa.binary()),
                    pa.array([[bytes(raw) for raw in out]], pa.list_(pa.binary()))], ["block", "x", "kept"])

    return staged(blocks.mapInArrow(keep, "block long, x binary, kept array<binary>"))


def _centers(sizes: np.ndarray, sums: np.ndarray, before: np.ndarray) -> np.ndarray:
    """Means of the clusters; an empty one keeps its centre."""
    out = before.copy()
    some = sizes > 0
    out[some] = sums[some] / sizes[some][:, None]
    return out


def _cost(sizes: np.ndarray, sums: np.ndarray, squares: float) -> float:
    some = sizes > 0
    return float(squares - ((sums[some] ** 2).sum(axis=1) / sizes[some]).sum())


def advance(run: Run, sizes: np.ndarray, sums: np.ndarray, best: np.ndarray, squares: float, max_iter: int) -> None:
    """Take one step's sums into a run and set up its next step."""
    if run.rounds is None:
        new = _centers(sizes, sums, run.centers)
        run.steps += 1
        still = np.allclose(new, run.centers, rtol=0, atol=1e-10)
        if not still and run.steps <= max_iter:
            run.centers = new
            return
        run.sizes, run.sums, run.cost = sizes.copy(), sums.copy(), _cost(sizes, sums, squares)
        run.rounds, run.steps, run.share = [], 0, 0
    else:
        cost = _cost(sizes, sums, squares)
        trial = run.trial
        if trial.only is None and trial.above <= LEAST_GAIN * squares:
            run.best = (best[0], int(best[1]), int(best[2]))
        if best[3] == 0:
            run.done = True
            return
        if cost < run.cost:
            run.rounds.append(trial)
            run.sizes, run.sums, run.cost = sizes.copy(), sums.copy(), cost
            run.steps, run.share = run.steps + 1, 0
        elif trial.only is not None:
            run.done = True  # the best transfer's gain is lost in rounding
            return
        else:
            run.share += 1
    if run.steps >= max_iter:
        run.done = True
        return
    mean = _centers(run.sizes, run.sums, run.before())
    least = LEAST_GAIN * squares
    if run.share < len(SHARES):
        run.trial = Round(mean, run.sizes, max(least, SHARES[run.share] * run.best[0]) if run.share else least)
    else:
        run.trial = Round(mean, run.sizes, least, run.best[1:])


def lloyd(blocks: DataFrame, centers: np.ndarray, steps: int) -> np.ndarray:
    """The centres after ``steps`` of Lloyd's steps from given ones."""
    run = Run(np.array(centers, dtype=np.float64))
    for _ in range(steps):
        total = _step(blocks, [run], run.centers.shape[1])
        run.centers = _centers(total.sizes, total.sums, run.centers)
    return run.centers


def fit(blocks: DataFrame, starts: list[np.ndarray], max_iter: int) -> list[Run]:
    """All runs, finished: ``max_iter`` Lloyd steps and transfer rounds at most."""
    runs = [Run(np.array(s, dtype=np.float64)) for s in starts]
    dim, state, waited, squares = runs[0].centers.shape[1], blocks, 0.0, 0.0
    while active := [r for r in runs if not r.done]:
        ready = [r for r in active if r.ready()]
        waited += 1 - len(ready) / len(active)
        if not ready or waited >= WAIT:
            keep = [r for r in active if r.rounds is not None]
            span = SPAN * np.sqrt(len(runs) / len(active))  # few runs can afford more rows
            anchors = [None if r.ready() else r.next_anchor(squares, span) for r in keep]
            before, state = state, _kept(state, keep, anchors, dim).persist()
            for i, (r, to) in enumerate(zip(keep, anchors)):
                r.column = i
                if to is not None:
                    r.anchor, r.last, r.rounds = to, r.before(), []
            if before is not blocks:
                before.unpersist()
                discard(before)
            ready, waited = active, 0.0
        total = _step(state, ready, dim)
        lo, squares = 0, total.raw[-1]
        for i, r in enumerate(ready):
            hi = lo + len(r.centers)
            advance(r, total.sizes[lo:hi], total.sums[lo:hi], total.best[i], squares, max_iter)
            lo = hi
    if state is not blocks:
        state.unpersist()
        discard(state)
    for r in runs:
        r.centers = _centers(r.sizes, r.sums, r.before())
    return runs
