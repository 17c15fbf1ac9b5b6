"""Job states as a checked state machine over event rows."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.operators.skew import ordered_slices

#: Job states as they are stored; the first is a job that does not exist yet.
STATES = ["", "MENUNGGU", "BERJALAN", "DIJEDA", "SELESAI", "GAGAL"]
#: Legal moves: event, state before, state after.
MOVES = [
    ("create", "", "MENUNGGU"), ("start", "MENUNGGU", "BERJALAN"), ("pause", "BERJALAN", "DIJEDA"), ("resume", "DIJEDA", "BERJALAN"),
    ("finish", "BERJALAN", "SELESAI"), ("fail", "MENUNGGU", "GAGAL"), ("fail", "BERJALAN", "GAGAL"), ("fail", "DIJEDA", "GAGAL"),
    ("request_pause", "MENUNGGU", "MENUNGGU"), ("request_pause", "BERJALAN", "BERJALAN"), ("request_pause", "DIJEDA", "DIJEDA"),
]


def _tables() -> tuple[dict[str, int], np.ndarray, np.ndarray]:
    """Number of each event; for each event the state after each state, and whether the move is legal.  Event 0 is any other."""
    names = ["", *dict.fromkeys(m[0] for m in MOVES)]
    after = np.tile(np.arange(len(STATES), dtype=np.int8), (len(names), 1))
    legal = np.zeros(after.shape, bool)
    for event, a, b in MOVES:
        e, i = names.index(event), STATES.index(a)
        after[e, i], legal[e, i] = STATES.index(b), True
    return {n: i for i, n in enumerate(names)}, after, legal


EVENTS, AFTER, LEGAL = _tables()


def composed(moves: np.ndarray) -> np.ndarray:
    """For each row the effect of all rows up to it: prefix composition of maps, doubling the reach each step."""
    out, reach = moves.copy(), 1
    while reach < len(out):
        out[reach:] = np.take_along_axis(out[reach:], out[:-reach].astype(np.int64), axis=1)
        reach *= 2
    return out


def _slice_rows(b: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Event numbers, maps and first rows of jobs of a slice in order; a job's first row forgets what was before."""
    kinds = b["event"].combine_chunks().dictionary_encode()
    number = np.array([EVENTS.get(k, 0) for k in kinds.dictionary.to_pylist()] or [0], np.int64)
    event = np.where(kinds.indices.is_null().to_numpy(zero_copy_only=False), 0, number[kinds.indices.fill_null(0).to_numpy()])
    job = b["job"].combine_chunks().dictionary_encode().indices.to_numpy()
    first = np.append(True, job[1:] != job[:-1])
    moves = AFTER[event].copy()
    begins = first.copy()
    begins[:1] = False  # whether the slice's first row begins a job, only the slice before knows
    moves[begins] = AFTER[event[begins], 0][:, None]
    return event, moves, begins


def _effect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows = list(batches)
    t = pa.Table.from_batches(rows) if rows else None
    if t is None or not t.num_rows:
        return
    _, moves, _ = _slice_rows(t)
    jobs = t["job"]
    yield pa.RecordBatch.from_arrays(
        [pa.array([t["__slice"][0].as_py()], pa.int32()), pa.array([jobs[0].as_py()], pa.string()), pa.array([jobs[-1].as_py()], pa.string()), pa.array([composed(moves)[-1].tolist()], pa.list_(pa.int32()))],
        names=["slice", "first", "last", "effect"])


def _judged(key, left: pa.Table, start: pa.Table) -> pa.Table:
    t = left.sort_by([("job", "ascending"), ("seq", "ascending")])
    event, moves, begins = _slice_rows(t)
    entered = int(start["state"][0].as_py())
    after = composed(moves)[:, entered]
    before = np.append(entered, after[:-1])
    before[begins] = 0
    names = pa.array(STATES)
    return pa.table({
        "job": t["job"], "seq": t["seq"], "event": t["event"], "sebelum": names.take(pa.array(before)), "sesudah": names.take(pa.array(after)), "sah": pa.array(LEGAL[event, before])})


def job_transitions(events: DataFrame, job: str, seq: str, event: str) -> DataFrame:
    """(job, seq, event, sebelum, sesudah, sah): state of a job before and after each of its events, and whether the move is legal.

    Events are taken in the order of ``seq``, which does not repeat in a job.  An illegal move (also an unknown or
    null event) is reported and leaves the state as it is; the first event of a job meets the empty state.

    Effects of events are maps between states, and maps compose.  So the rows are cut into slices of about equal
    size whatever the jobs are; each slice sends the one map it amounts to, slices learn from these in which state they begin
    (one row of six numbers a slice passes the driver), and all slices are judged at once.
    """
    d = events.select(F.col(job).cast("string").alias("job"), F.col(seq).cast("long").alias("seq"), F.col(event).cast("string").alias("event"))
    d = ordered_slices(d.filter("job is not null"), ["job"], [F.col("seq")])
    # a slice is one task: it was written by one
    sorted_rows = d.repartition("__slice").sortWithinPartitions("__slice", "job", "seq")
    effects = sorted_rows.mapInArrow(_per_slice, "slice int, first string, last string, effect array<int>")
    state, last, starts = 0, None, []
    for r in effects.orderBy("slice").toLocalIterator():
        state = state if r["first"] == last else 0
        starts.append((r["slice"], state))
        state, last = r["effect"][state], r["last"]
    begin = events.sparkSession.createDataFrame(starts, "__slice int, state int")
    out = "job string, seq long, event string, sebelum string, sesudah string, sah boolean"
    return d.groupBy("__slice").cogroup(begin.groupBy("__slice")).applyInArrow(_judged, out)


def _per_slice(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Slices of a partition one after the other."""
    held: list[pa.RecordBatch] = []
    for b in batches:
        slices = b.column(b.schema.get_field_index("__slice")).to_numpy()
        cuts = [0, *(np.flatnonzero(slices[1:] != slices[:-1]) + 1).tolist(), len(slices)]
        for a, z in zip(cuts, cuts[1:]):
            part = b.slice(a, z - a)
            if held and z > a and held[-1]["__slice"][-1].as_py() != part["__slice"][0].as_py():
                yield from _effect(iter(held))
                held = []
            if z > a:
                held.append(part)
    if held:
        yield from _effect(iter(held))
