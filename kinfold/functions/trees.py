"""Edit distance of ordered labelled trees, for semi-structured values.

A JSON text becomes a tree: an object's members in the order of their keys, a list's items in their own. A node's label is its key and its kind. The cost is the
least number of nodes put in, taken out or exchanged that turns one tree into the other; numbers and strings under one key may count for less than a whole
exchange. A bound from counted labels and values spares most pairs the dynamic programme, and is exact where both trees have one shape and equal values under all labels that stand twice.
"""

from __future__ import annotations

import json
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Numbers are held between these ends, so that a difference is a number.
_END = 8e307


class How(NamedTuple):
    """How values under one key are compared. `scale`: the difference of two numbers that counts as a whole exchange; `nominal_numbers`: unequal numbers always do;
    `nominal_strings`: unequal strings do, otherwise they count by their edit distance over the longer length."""

    scale: float = 1.0
    nominal_numbers: bool = False
    nominal_strings: bool = True

    def nominal(self, label: str) -> bool:
        return label[0] == "n" and self.nominal_numbers or label[0] == "s" and self.nominal_strings


class Tree(NamedTuple):
    """Nodes in post-order: label (the first character tells the kind), place of the first leaf below, value (None but for numbers and strings)."""

    text: str
    labels: tuple
    first: tuple
    values: tuple


def tree_of(text: str | None) -> Tree | None:
    """The tree of a JSON text; of a text that is no JSON, or is nested too deep to be read, the list of its words; None of a null."""
    if text is None:
        return None
    try:
        x = json.loads(text, parse_constant=str)
    except (ValueError, RecursionError):
        x = text.split()
    labels, first, values = [], [], []
    todo: list[tuple] = [("", x, -1)]
    while todo:
        key, x, at = todo.pop()
        if at < 0 and isinstance(x, (dict, list)):
            todo.append((key, x, len(labels)))
            below = sorted(x.items()) if isinstance(x, dict) else [("", v) for v in x]
            todo += [(k, v, -1) for k, v in reversed(below)]
            continue
        value = None
        if isinstance(x, (dict, list)):
            label = ("{" if isinstance(x, dict) else "[") + key
        elif isinstance(x, bool) or x is None:
            label = f"c{x}:{key}"
        elif isinstance(x, str):
            label, value = "s" + key, x
        else:
            label, value = "n" + key, float(max(-_END, min(_END, x)))
        first.append(at if at >= 0 else len(labels))
        labels.append(label)
        values.append(value)
    return Tree(text, tuple(labels), tuple(first), tuple(values))


def common(a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
    """How many elements each set of `a` shares with each set of `b`."""
    sides = (a, b)
    rows = [np.repeat(np.arange(len(side)), [len(x) for x in side]) for side in sides]
    flat = [np.concatenate([np.zeros(0, np.int64), *side]) for side in sides]
    both = np.zeros((len(a), len(b)))
    order = [np.argsort(x, kind="stable") for x in flat]
    known = np.intersect1d(*flat)
    lo, hi = ([np.searchsorted(x[o], known, end) for x, o in zip(flat, order, strict=True)] for end in ("left", "right"))
    for i in range(len(known)):  # once an element that both sides have
        both[np.ix_(*(r[o[x[i] : y[i]]] for r, o, x, y in zip(rows, order, lo, hi, strict=True)))] += 1
    return both


def _string_cost(a: str, b: str) -> float:
    """Edit distance over the longer length; 0 for two empty strings."""
    if a == b:
        return 0.0
    x, y = (np.frombuffer(s.encode("utf-32-le", "surrogatepass"), np.uint32) for s in (a, b))
    steps = np.arange(len(y) + 1)
    row = steps
    for i, v in enumerate(x):
        row = np.minimum.accumulate(np.append(i + 1, np.minimum(row[1:] + 1, row[:-1] + (y != v))) - steps) + steps
    return float(row[-1]) / max(len(x), len(y))


def _value_costs(kind: str, a: list, b: list, how: How) -> np.ndarray:
    """Costs of exchanging values of one kind under one key, at most 1."""
    if kind == "n":
        x, y = np.array(a)[:, None], np.array(b)[None, :]
        return (x != y).astype(float) if how.nominal_numbers else np.minimum(1.0, np.abs(x - y) / how.scale)
    if how.nominal_strings:
        return np.array([[float(x != y) for y in b] for x in a]).reshape(len(a), len(b))
    known: dict = {}
    for x in set(a):
        for y in set(b):
            known[x, y] = _string_cost(x, y)
    return np.array([[known[x, y] for y in b] for x in a]).reshape(len(a), len(b))


def edit_cost(a: Tree, b: Tree, how: How) -> float:
    """Least cost of turning one tree into the other: the dynamic programme over pairs of key roots (Zhang and Shasha), a row of a forest table at a time."""
    places: dict[str, tuple[list[int], list[int]]] = {}
    for side, t in enumerate((a, b)):
        for i, label in enumerate(t.labels):
            places.setdefault(label, ([], []))[side].append(i)
    exchange = np.ones((len(a.labels), len(b.labels)))
    for label, (x, y) in places.items():
        if x and y:
            exchange[np.ix_(x, y)] = _value_costs(label[0], [a.values[i] for i in x], [b.values[j] for j in y], how) if label[0] in "ns" else 0.0
    first_a, first_b = np.array(a.first), np.array(b.first)
    roots_a, roots_b = (sorted({f: i for i, f in enumerate(t.first)}.values()) for t in (a, b))
    leaves = [np.flatnonzero(f == np.arange(len(f))) for f in (first_a, first_b)]
    cost = np.zeros(exchange.shape)
    for i, f in enumerate(a.first):  # of a tree and a leaf one node is exchanged for the leaf, and the others go
        cost[i, leaves[1]] = i - f + exchange[f : i + 1, leaves[1]].min(axis=0)
    for j, f in enumerate(b.first):
        cost[leaves[0], j] = j - f + exchange[leaves[0], f : j + 1].min(axis=1)
    for i in roots_a:
        for j in roots_b:
            if first_a[i] == i or first_b[j] == j:
                continue
            li, lj = first_a[i], first_b[j]
            cols = np.arange(lj, j + 1)
            whole = first_b[cols] == lj
            steps = np.arange(float(len(cols) + 1))
            table = np.zeros((i - li + 2, len(cols) + 1))
            table[0] = steps
            for x in range(li, i + 1):
                above = table[x - li]
                moved = table[first_a[x] - li, first_b[cols] - lj] + cost[x, cols]
                if first_a[x] == li:
                    moved = np.where(whole, above[:-1] + exchange[x, cols], moved)
                row = table[x - li + 1]
                row[0] = x - li + 1
                np.minimum(above[1:] + 1, moved, out=row[1:])
                row -= steps
                np.minimum.accumulate(row, out=row)
                row += steps
                if first_a[x] == li:
                    cost[x, cols[whole]] = row[1:][whole]
    return round(float(cost[-1, -1]), 12)


class Side(NamedTuple):
    """What bounds are told from, of a list of trees: nodes, what can be matched (row, number), the values of labels that stand once, and numbers of frames and texts (-1 of a null).
    A frame is all of a tree but the values of labels that stand once in it."""

    sizes: np.ndarray
    rows: np.ndarray
    parts: np.ndarray
    once: dict[str, tuple[np.ndarray, list]]
    frame: np.ndarray
    text: np.ndarray

    def at(self, lo: int, hi: int) -> Side:
        """Of the trees from `lo` to before `hi`."""
        cut = lambda rows: slice(*np.searchsorted(rows, (lo, hi)))
        once = {label: (rows[cut(rows)] - lo, values[cut(rows)]) for label, (rows, values) in self.once.items()}
        return Side(self.sizes[lo:hi], self.rows[cut(self.rows)] - lo, self.parts[cut(self.rows)], once, self.frame[lo:hi], self.text[lo:hi])


def sides(a: list[Tree | None], b: list[Tree | None], how: How) -> tuple[Side, Side]:
    """Both lists, numbered alike."""
    number: dict = {}
    frames: dict = {}
    texts: dict = {}

    def side(trees: list[Tree | None]) -> Side:
        rows, parts, once = [], [], {}
        frame, text = (np.full(len(trees), -1, np.int64) for _ in range(2))
        for i, t in enumerate(trees):
            if t is None:
                continue
            count = Counter(t.labels)
            seen: Counter = Counter()
            for label, value in zip(t.labels, t.values, strict=True):
                part = (label, value) if how.nominal(label) else (label,)
                rows.append(i)
                parts.append(number.setdefault((part, seen[part]), len(number)))
                seen[part] += 1
                if value is not None and count[label] == 1 and not how.nominal(label):
                    held = once.setdefault(label, ([], []))
                    held[0].append(i)
                    held[1].append(value)
            repeated = tuple(None if count[label] == 1 else value for label, value in zip(t.labels, t.values, strict=True))
            frame[i] = frames.setdefault((t.labels, t.first, repeated), len(frames))
            text[i] = texts.setdefault(t.text, len(texts))
        sizes = np.array([0 if t is None else len(t.labels) for t in trees], np.int64)
        return Side(sizes, np.array(rows, np.int64), np.array(parts, np.int64), {x: (np.array(r, np.int64), v) for x, (r, v) in once.items()}, frame, text)

    return side(a), side(b)


def _matched(a: Side, b: Side) -> np.ndarray:
    """How many parts each tree of `a` shares with each of `b`: those that many trees have by products of matrices, others one by one."""
    shape = len(a.sizes), len(b.sizes)
    known = 1 + int(max(a.parts.max(initial=-1), b.parts.max(initial=-1)))
    times = [np.bincount(x.parts, minlength=known) for x in (a, b)]
    pairs = times[0] * times[1]
    often = np.flatnonzero(pairs * 16 > shape[0] * shape[1])
    out = np.zeros(shape, np.float32)
    for lo in range(0, len(often), 256):
        place = np.full(known, -1)
        place[often[lo : lo + 256]] = np.arange(len(often[lo : lo + 256]))
        held = []
        for x in (a, b):
            one = np.zeros((len(x.sizes), min(256, len(often) - lo)), np.float32)
            ok = place[x.parts] >= 0
            one[x.rows[ok], place[x.parts[ok]]] = 1
            held.append(one)
        out += held[0] @ held[1].T
    rest = np.setdiff1d(np.flatnonzero(pairs), often)
    if len(rest):
        order = [np.argsort(x.parts, kind="stable") for x in (a, b)]
        ends = [[np.searchsorted(x.parts[o], rest, end) for end in ("left", "right")] for x, o in zip((a, b), order, strict=True)]
        for i in range(len(rest)):
            out[np.ix_(*(x.rows[o[lo[i] : hi[i]]] for x, o, (lo, hi) in zip((a, b), order, ends, strict=True)))] += 1
    return out


def bounds(a: list[Tree | None], b: list[Tree | None], how: How, spread: float = 1.0) -> tuple[np.ndarray, np.ndarray]:
    """(costs, exact): for each pair a cost that is not above the true one, and whether it is the true one. Two nulls are at 0, a null and a tree at `spread`.

    Every exchange across labels and every node without a partner costs 1, so the cost is at least the nodes of the larger tree less the labels that both have;
    then what those labels cost at least: where unequal values are a whole exchange, labels less equal values, and where a label stands once on both sides, its values' cost.
    Trees of one frame cost no more than that, node by node.
    """
    return bounds_of(*sides(a, b, how), how, spread)


def bounds_of(a: Side, b: Side, how: How, spread: float = 1.0) -> tuple[np.ndarray, np.ndarray]:
    """`bounds` of two sides that are numbered alike."""
    low = np.maximum(a.sizes[:, None], b.sizes[None, :]) - _matched(a, b).astype(float)
    for label in a.once.keys() & b.once.keys():
        (x, left), (y, right) = a.once[label], b.once[label]
        if len(x) and len(y):
            low[np.ix_(x, y)] += _value_costs(label[0], left, right, how)
    null = a.text[:, None] < 0, b.text[None, :] < 0
    equal = a.text[:, None] == b.text[None, :]  # two nulls are, too
    exact = equal | (a.frame[:, None] == b.frame[None, :]) | null[0] | null[1]
    low[equal] = 0.0
    low[(null[0] | null[1]) & ~equal] = spread
    return np.round(low, 12), exact


def costs(a: list[Tree | None], b: list[Tree | None], how: How, spread: float = 1.0, memo: dict | None = None) -> np.ndarray:
    """Edit costs of all pairs. `memo` keeps the costs of texts over several calls, so a group of copies is compared once."""
    got, exact = bounds(a, b, how, spread)
    memo = {} if memo is None else memo
    for i, j in zip(*np.nonzero(~exact), strict=True):
        x, y = a[i], b[j]
        if (x.text, y.text) not in memo:
            memo[x.text, y.text] = edit_cost(x, y, how)
        got[i, j] = memo[x.text, y.text]
    return got


def tree_distance(a: Column, b: Column, how: How = How(), spread: float = 1.0) -> Column:
    """Edit cost of two columns of JSON texts."""

    def run(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for x, y in batches:
            yield pd.Series([costs([tree_of(s)], [tree_of(t)], how, spread)[0, 0] for s, t in zip(x, y, strict=True)], dtype=float)

    return F.pandas_udf(run, "double")(a, b)
