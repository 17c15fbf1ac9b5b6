"""Suffix arrays by induced sorting, and permuted common prefixes, in numpy.

Suffixes are S-type (smaller than the next suffix) or L-type.  Leftmost S-type places are sorted by the
substrings between them, recursively if two of these are equal; all other suffixes follow by two scans,
each of which places a suffix when the next longer text position is known.  A scan handles many suffixes
at once: those of one bucket (one first symbol), or of neighbouring small buckets that do not lead into
one another.  No step looks at a single suffix, and each suffix is placed once a scan.
"""

from __future__ import annotations

import numpy as np


def _types(t: np.ndarray) -> np.ndarray:
    """True where the suffix is S-type; the end of the text is smaller than any symbol."""
    n = len(t)
    change = np.flatnonzero(t[1:] != t[:-1])  # last places of runs that another run follows
    rising = t[change + 1] > t[change]
    lengths = np.diff(np.append(change, n - 1), prepend=-1)
    return np.repeat(np.append(rising, False), lengths)


_COUNTING = np.arange(1 << 14)
STEP = 1.5  # suffixes of a step, times the root of the length


def _spread(entries: np.ndarray, symbol: np.ndarray, sa: np.ndarray, at: np.ndarray, back: bool) -> None:
    """Append entries to the buckets of their symbols, in order; ``at`` holds the next free place of each."""
    if not len(entries):
        return
    by = symbol.argsort(kind="stable")
    entries, symbol = entries[by], symbol[by]
    new = np.empty(len(symbol), bool)
    new[0] = True
    np.not_equal(symbol[1:], symbol[:-1], out=new[1:])
    first = new.nonzero()[0]
    count = np.empty_like(first)
    np.subtract(first[1:], first[:-1], out=count[:-1])
    count[-1] = len(symbol) - first[-1]
    which, rank = symbol[first], _COUNTING[: len(symbol)] if len(symbol) <= len(_COUNTING) else np.arange(len(symbol))
    if back:
        sa[(at[which] + first).repeat(count) - rank] = entries
        at[which] -= count
    else:
        sa[(at[which] - first).repeat(count) + rank] = entries
        at[which] += count


def _chains(last: np.ndarray, run: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """From last places of runs: all places of the runs, nearest to the end first; and which start a run."""
    lengths = run[last]
    if not len(lengths) or lengths.max() == 1:
        return last, np.ones(len(last), bool)
    step = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    by = np.argsort(step, kind="stable")
    return (np.repeat(last, lengths) - step)[by], (step == np.repeat(lengths, lengths) - 1)[by]


def _places(begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """All places of the ranges ``begin`` to ``end``, range by range."""
    count = end - begin
    ends = count.cumsum()
    total = int(ends[-1])
    return (_COUNTING[:total] if total <= len(_COUNTING) else np.arange(total)) + (begin - ends + count).repeat(count)


def _induce(t: np.ndarray, s_type: np.ndarray, seeds: np.ndarray, k: int) -> np.ndarray:
    """All suffixes in order, from ``seeds``: leftmost S-type places, bucket by bucket and in order inside each.

    A step takes neighbouring buckets of about 1.5 sqrt(n) suffixes.  Should one of them lead into a bucket of the
    same step, the step ends before that bucket; runs of one symbol lead into their own bucket and are
    written out from their lengths.
    """
    n, seeds = len(t), seeds.astype(np.int32)
    starts = np.flatnonzero(np.append(True, t[1:] != t[:-1]))
    run = np.arange(n, dtype=np.int32) - np.repeat(starts, np.diff(np.append(starts, n))).astype(np.int32) + 1
    begin = np.concatenate([[0], np.cumsum(np.bincount(t, minlength=k))])
    l_end = begin[:-1] + np.bincount(t[~s_type], minlength=k)
    step = max(64, int(STEP * n**0.5))
    # by place: the bucket that the suffix before it goes to in the first and in the second scan, -1 for none
    to_l, to_s = np.full(n, -1, np.int32), np.full(n, -1, np.int32)
    to_l[1:] = np.where(s_type[:-1], -1, t[:-1])
    to_s[1:] = np.where(s_type[:-1], t[:-1], -1)
    sa = np.empty(n, np.int32)
    seed_at = np.searchsorted(t[seeds], np.arange(k + 1))
    head = begin[:-1].copy()
    _spread(np.array([n - 1], np.int32), t[n - 1 :], sa, head, False)
    c = 0
    while c < k:
        z = max(c + 1, int(begin.searchsorted(begin[c] + step, side="right")) - 1)  # buckets c to z - 1
        if z > c + 1:
            both = np.concatenate([sa[_places(begin[c:z], head[c:z])], seeds[seed_at[c] : seed_at[z]]])
            own = t[both]
            by = own.argsort(kind="stable")
            both = both[by]
            to = to_l[both]
            go = (to >= 0).nonzero()[0]
            to = to[go]
            stop = int(to.min()) if len(go) else z
            if stop > c:
                if stop < z:
                    short = own[by[go]] < stop
                    go, to = go[short], to[short]
                _spread(both[go] - 1, to, sa, head, False)
                c = min(stop, z)
                continue
        lo = begin[c]
        chain, first = _chains(sa[lo : head[c]], run)
        sa[lo : lo + len(chain)] = chain
        head[c] = lo + len(chain)
        both = np.concatenate([chain[first], seeds[seed_at[c] : seed_at[c + 1]]])
        to = to_l[both]
        go = to >= 0
        _spread(both[go] - 1, to[go], sa, head, False)
        c += 1
    tail = begin[1:] - 1
    c = k - 1
    while c >= 0:
        z = min(c - 1, int(begin.searchsorted(begin[c + 1] - step, side="left")) - 1)  # buckets c down to z + 1
        if z < c - 1:
            # from the back: S-type places of a bucket, then its L-type ones
            edges = np.empty((2, c - z, 2), np.int64)
            edges[0, :, 0], edges[1, :, 0] = begin[z + 1 : c + 1], l_end[z + 1 : c + 1]
            edges[0, :, 1], edges[1, :, 1] = tail[z + 1 : c + 1] + 1, begin[z + 2 : c + 2]
            both = sa[_places(edges[0].ravel(), edges[1].ravel())[::-1]]
            to = to_s[both]
            go = (to >= 0).nonzero()[0]
            both, to = both[go], to[go]
            stop = int(to.max()) if len(go) else z
            if stop < c:
                if stop > z:
                    short = t[both] > stop
                    both, to = both[short], to[short]
                _spread(both - 1, to, sa, tail, True)
                c = max(stop, z)
                continue
        hi = begin[c + 1] - 1
        chain, first = _chains(sa[tail[c] + 1 : hi + 1][::-1], run)
        sa[hi + 1 - len(chain) : hi + 1] = chain[::-1]
        tail[c] = hi - len(chain)
        both = np.concatenate([chain[first], sa[begin[c] : l_end[c]][::-1]])
        to = to_s[both]
        # runs of the bucket's own symbol are written out already
        go = (to >= 0) & (to < c)
        _spread(both[go] - 1, to[go], sa, tail, True)
        c -= 1
    return sa


def _same_next(t: np.ndarray, a: np.ndarray, b: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Whether the ``length`` symbols at ``a`` and ``b`` agree, pair by pair."""
    same = np.ones(len(a), bool)
    live, done, step = np.arange(len(a)), 0, 4
    while len(live):
        offset = done + np.arange(step)
        inside = offset[None, :] < length[live, None]
        x = np.where(inside, a[live, None] + offset, 0)
        y = np.where(inside, b[live, None] + offset, 0)
        equal = (t[x] == t[y]).all(axis=1)
        same[live[~equal]] = False
        done += step
        live = live[equal & (length[live] > done)]
        step = max(4, min(2 * step, (1 << 20) // max(1, len(live))))
    return same


def suffix_array(t: np.ndarray, k: int) -> np.ndarray:
    """Starts of the suffixes of ``t`` (symbols 0 to ``k`` - 1) in order."""
    n = len(t)
    t = t.astype(np.int32)
    if n < 2:
        return np.zeros(n, np.int32)
    s_type = _types(t)
    lms = np.flatnonzero(s_type[1:] & ~s_type[:-1]) + 1
    if not len(lms):
        return _induce(t, s_type, lms, k)
    sa = _induce(t, s_type, lms[np.argsort(t[lms], kind="stable")], k)
    number = np.full(n, -1, np.int32)
    number[lms] = np.arange(len(lms))
    order = number[sa]
    order = order[order >= 0]  # leftmost S-type places by their substrings
    length = np.append(np.diff(lms) + 1, n)  # the last one runs into the end and equals no other
    a, b = order[:-1], order[1:]
    new = np.ones(len(lms), bool)
    alike = np.flatnonzero(length[a] == length[b])
    new[1:][alike] = ~_same_next(t, lms[a[alike]], lms[b[alike]], length[a[alike]])
    name = np.cumsum(new) - 1
    if name[-1] + 1 < len(lms):
        reduced = np.empty(len(lms), np.int32)
        reduced[order] = name
        order = suffix_array(reduced, int(name[-1]) + 1)
    return _induce(t, s_type, lms[order], k)


def permuted_common_prefixes(text: np.ndarray, sa: np.ndarray) -> np.ndarray:
    """By text place: symbols (bytes) that the suffix shares with the one before it in ``sa``; 0 for the first.

    A value is one less than that of the place before wherever the two preceding bytes agree; only the
    others are compared, eight bytes at a time.
    """
    n = len(text)
    if not n:
        return np.zeros(0, np.int32)
    before = np.full(n, -1, np.int32)
    before[sa[1:]] = sa[:-1]
    i = np.arange(n, dtype=np.int32)
    told = (i > 0) & (before > 0)
    told[told] = text[i[told] - 1] == text[before[told] - 1]
    told[1:] &= before[:-1] >= 0
    wide = np.zeros(n + 16, np.uint8)
    wide[:n] = text
    eight = np.lib.stride_tricks.sliding_window_view(wide, 8)
    out = np.zeros(n, np.int32)
    todo = np.flatnonzero(~told & (before >= 0))
    x, y = todo.copy(), before[todo].astype(np.int64)
    while len(todo):
        left = np.ascontiguousarray(eight[x]).view("<u8").ravel() ^ np.ascontiguousarray(eight[y]).view("<u8").ravel()
        # lowest set byte: trailing zero bits over eight
        same = np.where(left == 0, 8, np.bitwise_count((left & (~left + np.uint64(1))) - np.uint64(1)) >> 3).astype(np.int64)
        same = np.minimum(same, n - np.maximum(x, y))
        out[todo] += same
        go = (same == 8) & (np.maximum(x, y) + 8 < n)
        todo, x, y = todo[go], x[go] + 8, y[go] + 8
    last = np.maximum.accumulate(np.where(told, np.int32(-1), i))
    return np.maximum(out[last] - (i - last), 0)
