"""Periodic runs of words by block convolution (operator 11).

A run of period q repeats at least `max(q, LEAST - q)` words at distance q, so it holds a whole aligned block of B words, for the dyadic scale
B with 2B - 1 <= q <= 4B - 2, that occurs again q words on. At every scale the sequence is cut into blocks, and the sum of squared
differences between a block and each place of the window behind it is computed for all places at once: sums of squares less twice a
correlation, which number-theoretic transforms give in exact integers. Where it is zero, nothing mismatches. Each such distance is a
seed: it is compared word by word and extended to both sides as far as its period holds.

Words enter the sums as labels so small that no sum reaches the modulus; two words may share a label, which costs a comparison and never a
run. Blocks longer than `LONGEST` are probed by their first words. Transforms are products with the matrices of a radix of up to 64, in doubles that
hold every integer met (below 2 ** 53).
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from functools import cache
from hashlib import sha256
from itertools import count

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import SPACES, table

#: Least length of a run in words, and in periods.
LEAST = 12
LONGEST = 1024
#: 7 * 2 ** 20 + 1 is a prime with root 3, so transforms of up to 2 ** 20 places exist.
MODULUS, ROOT = 7 * (1 << 20) + 1, 3
#: Words of the documents that are searched together, and places that are transformed together.
WORDS = 1 << 17
PLACES = 1 << 16
#: Transforms of up to this many places are one product with a matrix.
DENSE = 128

_P = float(MODULUS)


def _mod(x: np.ndarray) -> np.ndarray:
    """The residues of `x` that are nearest to zero, for integers within 2 ** 53; in place."""
    times = x * (1.0 / _P)
    np.rint(times, out=times)
    times *= _P
    x -= times
    return x


@cache
def _powers(n: int, inverse: bool) -> np.ndarray:
    w = pow(ROOT, (MODULUS - 1) // n, MODULUS)
    w = pow(w, MODULUS - 2, MODULUS) if inverse else w
    out = np.ones(n)
    for i in range(1, n):
        out[i] = int(out[i - 1]) * w % MODULUS
    return _mod(out)


@cache
def _radix(n: int) -> tuple[int, int]:
    bits = n.bit_length() - 1
    return 1 << bits // 2, 1 << bits - bits // 2


@cache
def _matrix(n: int, inverse: bool) -> np.ndarray:
    at = np.arange(n)
    return _powers(n, inverse)[at[:, None] * at % n]


@cache
def _twiddles(n: int, inverse: bool) -> np.ndarray:
    a, b = _radix(n)
    return _powers(n, inverse)[np.arange(a)[:, None] * np.arange(b) % n]


def ntt(x: np.ndarray, n: int, inverse: bool = False, take: slice = slice(None)) -> np.ndarray:
    """Transform of `n` places of every row of `x`, of residues (rows shorter than n count as zero behind), not divided by n; `take` says which places are told."""
    if n <= DENSE:
        return _mod(x @ _matrix(n, inverse)[: x.shape[1], take])
    a, b = _radix(n)  # place b * i + j becomes frequency f + a * g
    rows = -(-x.shape[1] // b)
    if rows * b != x.shape[1]:
        x = np.pad(x, ((0, 0), (0, rows * b - x.shape[1])))
    y = _mod(np.matmul(_matrix(a, inverse)[:, :rows], x.reshape(len(x), rows, b)))
    y = _mod(y * _twiddles(n, inverse))
    y = _mod(y.reshape(-1, b) @ _matrix(b, inverse)).reshape(len(x), a, b)
    return y.transpose(0, 2, 1).reshape(len(x), n)[:, take]


def _labels(ids: np.ndarray, block: int) -> np.ndarray:
    """Labels whose squared differences, summed over a block, stay below the modulus."""
    most = int(((MODULUS - 1) // block) ** 0.5)
    return ((ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)).astype(np.int64) % (most + 1)


def occurrences(ids: np.ndarray, scale: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places, distances) of blocks of `scale` words, or their first `LONGEST`, that occur again, by their labels, at a distance of the scale.

    The distances of a scale are 2 * scale - 1 to 4 * scale - 2; those of the least scale, 2, are 1 to 6.
    """
    block = min(scale, LONGEST)
    n = 4 * block
    low, high = (1, 6) if scale == 2 else (2 * scale - 1, 4 * scale - 2)
    windows = range(0 if scale == 2 else low // block * block, high + 1, 3 * block + 1)  # each tells 3 * block + 1 distances
    blocks = max(0, len(ids) - low) // scale + 1
    label = np.zeros(blocks * scale + windows[-1] + n + scale)
    label[: len(ids)] = _labels(ids, block)
    squares = np.concatenate(([0.0], np.cumsum(label * label)))
    squares = squares[block:] - squares[:-block]  # of the block from every place on
    own_rows, rows = (np.lib.stride_tricks.sliding_window_view(label, k) for k in (block, n))
    reverse = -np.arange(n) % n
    over_n = _mod(np.full(1, float(pow(n, MODULUS - 2, MODULUS))))
    step = max(1, PLACES // n)
    for first in range(0, blocks, step):
        last = min(blocks, first + step)
        own = _mod(ntt(own_rows[first * scale : (last - 1) * scale + 1 : scale], n)[:, reverse] * over_n)
        norm = squares[first * scale : (last - 1) * scale + 1 : scale, None]
        for at in windows:
            offset, end = max(0, low - at), min(3 * block, high - at) + 1
            begin = first * scale + at
            both = ntt(_mod(own * ntt(rows[begin : begin + (last - first - 1) * scale + 1 : scale], n)), n, True, slice(offset, end))
            behind = np.lib.stride_tricks.sliding_window_view(squares, end - offset)[begin + offset : begin + offset + (last - first - 1) * scale + 1 : scale]
            squared = norm + behind
            squared -= 2 * both  # up to a multiple of the modulus, the sum itself: it is below the modulus
            row, place = np.nonzero((squared == 0) | (squared == 2 * _P))
            yield (first + row) * scale, at + offset + place


class _Runs:
    """Runs (start, end, period) of a sequence, found from the small periods up."""

    def __init__(self, ids: np.ndarray, ends: np.ndarray):
        self.ids, self.ends = ids, ends  # ends: by word, the end of its document
        self.found = np.empty((0, 3), np.int64)

    def _implied(self, at: np.ndarray, distance: np.ndarray, block: int, scale: int) -> np.ndarray:
        """Whether a seed lies in a known run of at most half its distance that divides it: that run is the one it would give."""
        known = self.found[2 * self.found[:, 2] <= 2 * scale - 1]
        if not len(known):
            return np.zeros(len(at), bool)
        known = known[np.argsort(known[:, 0], kind="stable")]
        reach = np.maximum.accumulate(known[:, 1])
        which = np.maximum.accumulate(np.where(known[:, 1] == reach, np.arange(len(known)), 0))
        i = np.searchsorted(known[:, 0], at, side="right") - 1
        run = known[which[np.maximum(i, 0)]]
        return (i >= 0) & (run[:, 1] >= at + distance + block) & (distance % run[:, 2] == 0)

    def add(self, at: np.ndarray, distance: np.ndarray, block: int, scale: int) -> None:
        ids, ends = self.ids, self.ends
        good = at + distance + block <= len(ids)
        at, distance = at[good], distance[good]
        good = ends[at] >= at + distance + block
        at, distance = at[good], distance[good]
        good = ~self._implied(at, distance, block, scale)
        at, distance = at[good], distance[good]
        for offset in range(block):
            good = ids[at + offset] == ids[at + distance + offset]
            if not good.all():
                at, distance = at[good], distance[good]
        if not len(at):
            return
        # blocks in a row that match at one distance are one seed
        order = np.lexsort((at, distance))
        at, distance = at[order], distance[order]
        new = np.ones(len(at), bool)
        new[1:] = (distance[1:] != distance[:-1]) | (at[1:] != at[:-1] + scale) if block == scale else True
        begin = np.flatnonzero(new)
        right = np.append(begin[1:], len(at)) - 1
        start, stop, period = at[begin], at[right] + block, distance[begin]
        start, stop = self._left(start, period), self._right(stop, period)
        end = stop + period
        long = end - start >= np.maximum(LEAST, 2 * period)
        got = np.unique(np.stack([start[long], end[long], period[long]], axis=1), axis=0)
        both = np.concatenate((self.found, got))
        both = both[np.lexsort((both[:, 2], both[:, 1], both[:, 0]))]
        least = np.ones(len(both), bool)
        least[1:] = (both[1:, :2] != both[:-1, :2]).any(axis=1)  # of equal stretches the least period is the run's
        self.found = both[least]

    def _right(self, stop: np.ndarray, period: np.ndarray) -> np.ndarray:
        """The first place from `stop` on whose word differs from the one a period later, or whose partner is in another document."""
        stop, going, step = stop.copy(), np.arange(len(stop)), 16
        while len(going):
            places = stop[going, None] + np.arange(step)
            partner = places + period[going, None]
            limit = self.ends[np.maximum(stop[going] - 1, 0)]
            same = (partner < limit[:, None]) & (self.ids[np.minimum(places, len(self.ids) - 1)] == self.ids[np.minimum(partner, len(self.ids) - 1)])
            length = np.where(same.all(axis=1), step, same.argmin(axis=1))
            stop[going] += length
            going = going[length == step]
            step = min(2 * step, max(16, PLACES // max(1, len(going))))
        return stop

    def _left(self, start: np.ndarray, period: np.ndarray) -> np.ndarray:
        start, going, step = start.copy(), np.arange(len(start)), 16
        while len(going):
            places = start[going, None] - 1 - np.arange(step)
            limit = self.ends[start[going]]
            safe = np.maximum(places, 0)
            same = (places >= 0) & (self.ends[safe] == limit[:, None]) & (self.ids[safe] == self.ids[np.minimum(places + period[going, None], len(self.ids) - 1)])
            length = np.where(same.all(axis=1), step, same.argmin(axis=1))
            start[going] -= length
            going = going[length == step]
            step = min(2 * step, max(16, PLACES // max(1, len(going))))
        return start


def find_runs(docs: list[np.ndarray]) -> list[np.ndarray]:
    """For every sequence of word numbers its runs (start, length, period), by start, then period."""
    sizes = np.array([len(d) for d in docs], np.int64)
    found: list[np.ndarray] = [np.empty((0, 3), np.int64)] * len(docs)
    live = [i for i in np.argsort(-sizes, kind="stable") if sizes[i] >= LEAST]  # long ones first: each scale takes a prefix
    if not live:
        return found
    ids = np.concatenate([docs[i] for i in live])
    firsts = np.concatenate(([0], np.cumsum(sizes[live])))
    own = _Runs(ids, np.repeat(firsts[1:], sizes[live]))
    scale = 2
    while True:
        least = 1 if scale == 2 else 2 * scale - 1
        members = int(np.searchsorted(-sizes[live], -2 * least, side="right"))
        if not members:
            break
        for at, distance in occurrences(ids[: firsts[members]], scale):
            own.add(at, distance, min(scale, LONGEST), scale)
        scale *= 2
    doc = np.searchsorted(firsts, own.found[:, 0], side="right") - 1
    cuts = np.searchsorted(doc, np.arange(len(live) + 1))
    for j, i in enumerate(live):
        runs = own.found[cuts[j] : cuts[j + 1]]
        runs = np.stack([runs[:, 0] - firsts[j], runs[:, 1] - runs[:, 0], runs[:, 2]], axis=1)
        found[i] = runs[np.lexsort((runs[:, 2], runs[:, 0]))]
    return found


def _groups(texts: Iterator[list[bytes]]) -> Iterator[list[list[bytes]]]:
    """Documents by the lists that are searched together; a long one stands alone, whole."""
    group, size = [], 0
    for words in texts:
        if group and size + len(words) > WORDS:
            yield group
            group, size = [], 0
        group.append(words)
        size += len(words)
    if group:
        yield group


def _described(words: list[bytes], runs: np.ndarray) -> dict:
    drop = np.zeros(len(words) + 1, np.int64)
    np.add.at(drop, runs[:, 0] + runs[:, 2], 1)
    np.add.at(drop, runs[:, 0] + runs[:, 1], -1)
    dropped = np.cumsum(drop[:-1]) > 0
    kept = [w for w, d in zip(words, dropped.tolist(), strict=True) if not d] if len(runs) else words
    longest = runs[np.lexsort((runs[:, 2], runs[:, 0], -runs[:, 1]))[0]].tolist() if len(runs) else None
    return {
        "n_runs": len(runs),
        "longest": longest,
        "runs_sha256": sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs.tolist()).encode()).hexdigest(),
        "collapsed": b" ".join(kept),
        "runs": runs,
    }


_COLUMNS = "n_runs bigint, start bigint, length bigint, period bigint, exponent_milli bigint, runs_sha256 string, collapsed_sha256 string"


def periodic_runs(docs: DataFrame, text: Column | None = None, whole: bool = False) -> DataFrame:
    """(doc_id, n_runs, start, length, period, exponent_milli, runs_sha256, collapsed_sha256) of every row of `docs`, and with
    `whole` also runs (start, length, period) and collapsed, the text without what a run repeats. `text` is the text where it is not the column.

    Words are separated by ASCII white space. A null or empty text has no runs; the longest run's columns are null where there is none,
    and of equally long runs the first, then the one of the least period is told. Repeated rows are described each, a null doc_id is returned as it is, other
    columns are ignored. Texts take part whole: work grows with n log^2 n words, memory with a few hundred bytes a word of the longest text.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = "key string, " + _COLUMNS + (", runs array<struct<start: bigint, length: bigint, period: bigint>>, collapsed string" if whole else "")

    def describe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for df in batches:
            keys, at = df["key"].tolist(), 0
            for group in _groups((t or "").encode("utf-8", "surrogatepass").split() for t in df["text"]):
                numbers = defaultdict(count().__next__)
                ids = [np.fromiter(map(numbers.__getitem__, words), np.int64, len(words)) for words in group]
                out = []
                for words, runs in zip(group, find_runs(ids), strict=True):
                    x = _described(words, runs)
                    start, length, period = x["longest"] or (None, None, None)
                    milli = 1000 * length // period if length else None
                    row = (keys[at], x["n_runs"], start, length, period, milli, x["runs_sha256"], sha256(x["collapsed"]).hexdigest())
                    if whole:
                        row += ([dict(zip(("start", "length", "period"), r, strict=True)) for r in runs.tolist()], x["collapsed"].decode("utf-8", "surrogatepass"))
                    out.append(row)
                    at += 1
                got = pd.DataFrame(out, columns=columns)
                yield got.astype(dict.fromkeys(("start", "length", "period", "exponent_milli"), "Int64"))

    columns = ["key", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"] + ["runs", "collapsed"] * whole
    own = docs.select(F.col("doc_id").cast("string").alias("key"), (F.col("text") if text is None else text).alias("text"))
    got = own.mapInPandas(describe, schema)
    return got.select(F.col("key").cast(kind).alias("doc_id"), *columns[1:])


def planted(text: Column, doc_id: Column) -> Column:
    """The text with its words, joined by one space; in one document of ten (crc32 of the decimal doc_id) they repeat from some word on.

    With h the crc32, g = floor(h / 10) and n words, where 10 divides h each word i from a = g % n on becomes word a + (i - a) % p
    for p = 1 + floor((n - a) / (3 + g % 8)).
    """
    h = F.crc32(doc_id.cast("string"))
    g = F.floor(h / 10)
    ws = F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACES), "")
    n = F.size(ws)
    a = (g % n).cast("int")
    p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
    times = (F.ceil((n - a) / p)).cast("int")
    repeated = F.slice(F.flatten(F.array_repeat(F.slice(ws, a + 1, p), times)), 1, n - a)
    return F.when((h % 10 == 0) & (n > 0), F.concat_ws(" ", F.slice(ws, 1, a), repeated)).otherwise(text)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs(table(spark, sf_dir, "documents"), planted(F.col("text"), F.col("doc_id")))
