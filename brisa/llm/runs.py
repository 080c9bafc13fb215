"""Periodic runs of words, found through a grammar of every text.

Re-Pair replaces a pair of neighbouring symbols that occurs twice or more by a new
symbol, the most frequent pair first, until every pair is single. Pairs that touch no
more frequent one are replaced in the same round; equally frequent ones go by a hash,
so that a repeated passage is halved by every round. The texts of a batch share no
symbol, so their grammars grow side by side in the same arrays.

A run lies in a lowest symbol of the grammar that holds it whole, and crosses the
boundary between that symbol's two halves. Runs across a boundary are therefore looked
for once for every symbol, and moved to all places where the symbol stands. What no
symbol spans is left to the top sequence, whose boundaries are the middles of aligned
blocks of its symbols. A run that a symbol's edge cuts off is part of a longer one of
the same period found elsewhere; only maximal intervals stay.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from brisa.llm.text import trim

#: Fewest words of a run.
LEAST = 12
#: Words whose grammars grow together, and boundary candidates looked at together.
TOGETHER = 120_000
_CANDIDATES = 1 << 20
#: Words by which all candidates are first extended at once.
_STEPS = 16
_MIX = np.uint64(0x9E3779B97F4A7C15)

RUNS = T.ArrayType(
    T.StructType([T.StructField(c, T.LongType(), False) for c in ("start", "length", "period")]), False
)


@dataclass
class Grammar:
    """Rules of the symbols from ``words`` on, and the top sequence with its places."""

    words: int
    left: np.ndarray
    right: np.ndarray
    size: np.ndarray  # words of every symbol
    first: np.ndarray  # a place of every rule
    top: np.ndarray
    at: np.ndarray


def _scrambled(x: np.ndarray) -> np.ndarray:
    h = x.astype(np.uint64) * _MIX
    h ^= h >> np.uint64(29)
    return h * _MIX


def _odd_overlaps(same: np.ndarray) -> np.ndarray:
    """Of pairs (a, a) in a row, every second one overlaps the pair before it."""
    place = np.arange(len(same))
    begin = same.copy()
    begin[1:] &= ~same[:-1]
    begun = np.maximum.accumulate(np.where(begin, place, -1))
    return same & ((place - begun) % 2 == 1)


def re_pair(ids: np.ndarray, words: int) -> Grammar:
    """Grammar of a sequence of symbols below ``words``."""
    sym, at = ids.astype(np.int64), np.arange(len(ids))
    live = np.ones(max(0, len(ids) - 1), bool)  # pairs that may occur twice
    size, n = [np.ones(words, np.int64)], words
    lefts, rights, firsts = [], [], []
    while live.any():
        a, b = sym[:-1], sym[1:]
        places = np.flatnonzero(live & ~_odd_overlaps(a == b))
        kinds, kind, count = np.unique(a[places] * n + b[places], return_inverse=True, return_counts=True)
        often = count >= 2
        live[:] = False
        live[places[often[kind]]] = True
        if not often.any():
            break
        live |= (a == b) & np.isin(a, kinds[often] // n)
        # Every kind's place in the order: most frequent last, ties by a hash.
        order = np.empty(len(kinds), np.int64)
        order[np.lexsort((_scrambled(kinds), count))] = np.arange(len(kinds))
        rank = np.full(len(live) + 2, -1)
        rank[places + 1] = np.where(often[kind], order[kind], -1)
        beaten = np.maximum(rank[places], rank[places + 2]) > rank[places + 1]
        chosen = often & (np.bincount(kind, beaten, len(kinds)) == 0)
        new = np.cumsum(chosen) - 1 + n
        done = chosen[kind]
        here, what = places[done], new[kind[done]]
        # Symbols of the new rules, by the first place that each has.
        rules, one = np.unique(what, return_index=True)
        i = here[one]
        known = np.concatenate(size)
        lefts.append(sym[i])
        rights.append(sym[i + 1])
        firsts.append(at[i])
        size = [known, known[sym[i]] + known[sym[i + 1]]]
        n += len(rules)
        sym[here] = what
        keep = np.ones(len(sym), bool)
        keep[here + 1] = False
        fresh = np.zeros(len(sym), bool)
        fresh[here] = True
        alive = np.append(live, False)[keep]
        sym, at, fresh = sym[keep], at[keep], fresh[keep]
        # A replaced pair's place now stands for the pair after it.
        live = alive[:-1] & ~fresh[:-1] | fresh[:-1] | fresh[1:]
    none = [np.empty(0, np.int64)]
    left, right, first = (np.concatenate(x or none) for x in (lefts, rights, firsts))
    return Grammar(words, left, right, np.concatenate(size), first, sym, at)


def _blocks(at: np.ndarray, starts: np.ndarray, total: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(low, middle, high) word numbers of aligned blocks of 2, 4, 8, ... top symbols of
    each text. ``at``: places of the symbols; ``starts``: where the texts begin."""
    head = np.searchsorted(at, starts)
    tail = np.append(head[1:], len(at))
    ends = np.append(at, total)
    out = []
    width = 2
    while width // 2 < (tail - head).max(initial=0):
        blocks = -(-(tail - head - width // 2) // width)  # those that have a second half
        blocks = np.maximum(blocks, 0)
        text = np.repeat(np.arange(len(head)), blocks)
        nth = np.arange(len(text)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
        low = head[text] + nth * width
        out.append((ends[low], ends[low + width // 2], ends[np.minimum(low + width, tail[text])]))
        width *= 2
    if not out:
        return (np.empty(0, np.int64),) * 3
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def _reach(ids: np.ndarray, i: np.ndarray, q: np.ndarray, bound: np.ndarray, step: int) -> np.ndarray:
    """How many of the first ``_STEPS`` words from i on (or back) equal the one q later."""
    reach = np.zeros(len(i), np.int64)
    active = np.arange(len(i))
    for _ in range(_STEPS):
        here = i[active] + step * reach[active]
        inside = here < bound[active] if step > 0 else here >= bound[active]
        active, here = active[inside], here[inside]
        active = active[ids[here] == ids[here + q[active]]]
        if not len(active):
            break
        reach[active] += 1
    return reach


def _far(ids: np.ndarray, i: int, q: int, bound: int, step: int) -> int:
    """How many words from i on (or back) equal the one q later, up to the bound."""
    done, width = 0, 4 * _STEPS
    while True:
        if step > 0:
            low, high = i + done, min(i + done + width, bound)
            same = ids[low:high] == ids[low + q : high + q]
        else:
            low, high = max(i - done - width + 1, bound), i - done + 1
            same = (ids[low:high] == ids[low + q : high + q])[::-1]
        if not same.all():
            return done + int(same.argmin())
        done += len(same)
        if len(same) < width:
            return done
        width *= 2


def _crossing(ids: np.ndarray, low: np.ndarray, mid: np.ndarray, high: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
    """(node, start, end, period) of the runs inside [low, high) that cross ``mid``.

    Such a run has a whole period on one side of the boundary, so the word at ``mid``
    equals the one a period before, or the word before ``mid`` the one a period after.
    """
    half = (high - low) // 2
    back, ahead = np.minimum(mid - low, half), np.minimum(high - mid, half)
    load = np.cumsum(back + ahead)
    cuts = np.searchsorted(load, np.arange(_CANDIDATES, load[-1] + _CANDIDATES, _CANDIDATES)) if len(load) else []
    begin = 0
    for end in [int(c) + 1 for c in cuts]:
        part = np.arange(begin, min(end, len(low)))
        begin = end
        if not len(part):
            continue
        nodes, ks, qs = [], [], []
        for most, forward in ((back[part], False), (ahead[part], True)):
            node = np.repeat(part, most)
            q = np.arange(len(node)) - np.repeat(np.cumsum(most) - most, most) + 1
            k = mid[node] - 1 if forward else mid[node] - q
            same = ids[k] == ids[k + q]
            nodes.append(node[same])
            ks.append(k[same])
            qs.append(q[same])
        node, k, q = (np.concatenate(x) for x in (nodes, ks, qs))
        more = _reach(ids, k, q, high[node] - q, 1)
        less = _reach(ids, k - 1, q, low[node], -1)
        need = np.maximum(LEAST - q, q)
        open_ = (more == _STEPS) | (less == _STEPS)
        sure = ~open_ & (more + less >= need)
        yield node[sure], (k - less)[sure], (k + more + q)[sure], q[sure]
        rest = np.flatnonzero(open_)
        rest = rest[np.lexsort((q[rest], node[rest]))]
        last, found, out = -1, [], []
        for j in rest.tolist():
            v, p, i = int(node[j]), int(q[j]), int(k[j])
            if v != last:
                last, found = v, []
            if any(p % f == 0 and s <= i and i + p < e and e - s >= 2 * p for f, s, e in found):
                continue  # the same stretch, by a multiple of its period
            r = _far(ids, i, p, int(high[v]) - p, 1)
            s, e = i - _far(ids, i - 1, p, int(low[v]), -1), i + r + p
            if e - s >= max(LEAST, 2 * p):
                found.append((p, s, e))
                out.append((v, s, e, p))
        if out:
            yield tuple(np.array(x) for x in zip(*out, strict=True))


def _least_periods(node, start, end, period) -> tuple[np.ndarray, ...]:
    """Of candidates with the same stretch, the one with the smallest period."""
    order = np.lexsort((period, end, start, node))
    node, start, end, period = (x[order] for x in (node, start, end, period))
    new = np.ones(len(node), bool)
    new[1:] = (node[1:] != node[:-1]) | (start[1:] != start[:-1]) | (end[1:] != end[:-1])
    return node[new], start[new], end[new], period[new]


def _occurrences(g: Grammar, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(rule, place) of every derived occurrence of the wanted rules."""
    rules, places = [], []
    sym, at = g.top, g.at
    while True:
        big = (sym >= g.words) & (g.size[sym] >= LEAST)
        rule, at = sym[big] - g.words, at[big]
        if not len(rule):
            break
        hit = wanted[rule]
        rules.append(rule[hit])
        places.append(at[hit])
        left, right = g.left[rule], g.right[rule]
        sym, at = np.concatenate((left, right)), np.concatenate((at, at + g.size[left]))
    none = [np.empty(0, np.int64)]
    return np.concatenate(rules or none), np.concatenate(places or none)


def all_runs(ids: np.ndarray, starts: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, period) of every run of the texts that begin at ``starts`` and share
    no symbol, by start, then period."""
    g = re_pair(ids, words)
    low = g.first
    mid, high = low + g.size[g.left], low + g.size[words:]
    rule = np.flatnonzero(high - low >= LEAST)
    top_low, top_mid, top_high = _blocks(g.at, starts, len(ids))
    wide = top_high - top_low >= LEAST
    # Nodes: rules, then blocks of the top sequence.
    lows = np.concatenate((low[rule], top_low[wide]))
    mids = np.concatenate((mid[rule], top_mid[wide]))
    highs = np.concatenate((high[rule], top_high[wide]))
    found = list(_crossing(ids, lows, mids, highs))
    if not found:
        return (np.empty(0, np.int64),) * 3
    node, start, end, period = _least_periods(*(np.concatenate(x) for x in zip(*found, strict=True)))
    own = node < len(rule)
    of, s, e, q = rule[node[own]], start[own], end[own], period[own]  # sorted by rule
    first = np.searchsorted(of, np.arange(len(low)))
    count = np.searchsorted(of, np.arange(len(low)), side="right") - first
    placed, at = _occurrences(g, count > 0)
    each = np.repeat(np.arange(len(placed)), count[placed])
    nth = np.arange(len(each)) - np.repeat(np.cumsum(count[placed]) - count[placed], count[placed])
    run = first[placed[each]] + nth
    move = at[each] - low[placed[each]]
    start = np.concatenate((s[run] + move, start[~own]))
    end = np.concatenate((e[run] + move, end[~own]))
    period = np.concatenate((q[run], period[~own]))
    # Maximal intervals of every period.
    order = np.lexsort((-end, start, period))
    start, end, period = start[order], end[order], period[order]
    reach = np.maximum.accumulate(end + period * (len(ids) + 1))
    keep = np.ones(len(start), bool)
    keep[1:] = (period[1:] != period[:-1]) | (end[1:] + period[1:] * (len(ids) + 1) > reach[:-1])
    start, end, period = start[keep], end[keep], period[keep]
    order = np.lexsort((period, start))
    return start[order], end[order], period[order]


def _collapsed(words: list[bytes], start: np.ndarray, end: np.ndarray, period: np.ndarray) -> bytes:
    if not len(start):
        return b" ".join(words)
    edge = np.zeros(len(words) + 1, np.int64)
    np.add.at(edge, start + period, 1)
    np.add.at(edge, end, -1)
    keep = np.cumsum(edge[:-1]) == 0
    return b" ".join([w for w, k in zip(words, keep.tolist(), strict=True) if k])


def analysed(texts: list[bytes]) -> Iterator[tuple[int, list[tuple[int, int, int]], bytes]]:
    """(number of words, runs, collapsed text) of UTF-8 texts, one after the other."""
    at = 0
    while at < len(texts):
        split, ids, starts, known, n = [], [], [], 0, 0
        while at < len(texts) and (not split or n < TOGETHER):
            words = texts[at].split()  # at \x20 and \x09-\x0D
            number: dict[bytes, int] = {}
            ids.extend([number.setdefault(w, known + len(number)) for w in words])
            known += len(number)
            starts.append(n)
            n += len(words)
            split.append(words)
            at += 1
        begins = np.array(starts)
        start, end, period = all_runs(np.array(ids, np.int64), begins, known)
        cut = np.searchsorted(start, np.append(begins, n))
        for i, words in enumerate(split):
            own = slice(cut[i], cut[i + 1])
            s, e, q = start[own] - starts[i], end[own] - starts[i], period[own]
            runs = list(zip(s.tolist(), (e - s).tolist(), q.tolist(), strict=True))
            yield len(words), runs, _collapsed(words, s, e, q)


def periodic_runs(df: DataFrame, text: str = "text") -> DataFrame:
    """Add ``n_words`` (long), ``runs`` (array of start, length, period in words, by start,
    then period) and ``collapsed``: the words joined by one space, of every run only its
    first period.

    A run is a stretch of words with a smallest period q, at least 12 and 2 q words long,
    that no neighbouring word extends. A null text counts as empty: no words, no runs, an
    empty collapsed text. Texts are handled one by one, so ties and repeated rows matter
    to nobody else. Other columns stay; columns of the three names are replaced. An empty
    table stays empty. A task holds the words of about ``TOGETHER`` words of texts, or of
    one longer text.
    """
    added = {"n_words": T.LongType(), "runs": RUNS, "collapsed": T.StringType()}
    kept = [c for c in df.columns if c not in added]
    schema = T.StructType([*[df.schema[c] for c in kept], *[T.StructField(c, t, False) for c, t in added.items()]])
    run = pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "period")]))

    def found(batches):
        for batch in batches:
            texts = [t.encode() if t else b"" for t in batch.column("__text").to_pylist()]
            rows = list(analysed(texts))
            n, runs, collapsed = zip(*rows, strict=True) if rows else ((), (), ())
            runs = [[dict(zip(("start", "length", "period"), r, strict=True)) for r in x] for x in runs]
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch.column(i) for i in range(len(kept))],
                    pa.array(n, pa.int64()),
                    pa.array(runs, run),
                    pa.array([c.decode() for c in collapsed], pa.string()),
                ],
                [*kept, *added],
            )
        trim()

    quoted = [F.col(f"`{c}`") for c in kept]
    return df.select(*quoted, F.col(f"`{text}`").alias("__text")).mapInArrow(found, schema)
