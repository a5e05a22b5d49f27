"""Character n-grams packed into 64 bits, and Kneser-Ney models kept in sorted arrays.

A gram is a UTF-16 unit with up to three units before it, 16 bits each, so up to
four characters fit one integer exactly. Contexts end at the blank before the
word, so a gram never spans two words.

The counts of a model are tables dealt out by gram; only the finished model is
collected, in slices of bounded size. It holds every gram and context under its
exact key, so it grows with the distinct grams of the corpus (12 bytes a gram, 16
a context) and an unseen gram has no counts.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.llm.common import materialize

ORDER = 4
BLANK = 32
SLICE = 1 << 22     # rows of a model's table that are collected at once


def pack_grams(units: np.ndarray) -> np.ndarray:
    """Grams of a sequence of UTF-16 units (uint64) whose words are separated by blanks."""
    keys = units.copy()
    inside = np.ones(len(units), bool)
    for back in range(1, ORDER):
        before = np.where(inside[back:], units[:-back], 0)
        keys[back:] |= before << np.uint64(16 * back)
        inside[back:] &= before != BLANK
    return keys


def merge_counts(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Add up (grams, counts) lists."""
    keys = np.concatenate([k for k, _ in parts])
    counts = np.concatenate([c for _, c in parts])
    if not len(keys):
        return keys, counts
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], np.add.reduceat(counts, first)


def low(column: str, order: int) -> Column:
    """The last ``order`` characters of a packed gram."""
    return F.col(column).bitwiseAND(F.lit((1 << 16 * order) - 1)) if order < ORDER else F.col(column)


def count_tables(counts: DataFrame, by: list[str], name: str) -> dict[int, DataFrame]:
    """Per order a table (by, gram, n): the counts at the top, continuation counts below.

    A continuation count says how many different characters stand before a gram.
    """
    tables = {ORDER: counts}
    for order in range(ORDER - 1, 0, -1):
        shorter = tables[order + 1].groupBy(*by, low("gram", order).alias("gram")).agg(F.count("*").alias("n"))
        tables[order] = materialize(shorter, name)
    return tables


def discounts(grams: DataFrame) -> tuple[float, float, float]:
    """Modified Kneser-Ney discounts of an order, for grams counted once, twice and more often."""
    seen = dict(grams.where("n <= 4").groupBy("n").count().collect())
    t = [float(seen.get(i, 0)) for i in range(1, 5)]
    if not t[0] or not t[1]:
        return 0.5, 0.5, 0.5
    y = t[0] / (t[0] + 2 * t[1])
    found = [k + 1 - (k + 2) * y * t[k + 1] / t[k] if t[k] else k + 1.0 for k in range(3)]
    return tuple(min(max(d, 0.05), k + 0.95) for k, d in enumerate(found))


def held_back(d: tuple[float, float, float]) -> Column:
    """The discount of a gram from its count ``n``."""
    return F.when(F.col("n") == 1, d[0]).when(F.col("n") == 2, d[1]).otherwise(d[2])


@dataclass
class GramArray:
    """Sorted packed grams with their values; a gram that is missing has the value 0."""

    at: np.ndarray
    values: np.ndarray

    def get(self, wanted: np.ndarray) -> np.ndarray:
        if not len(self.at):
            return np.zeros((len(wanted), self.values.shape[1]))
        i = np.minimum(np.searchsorted(self.at, wanted), len(self.at) - 1)
        return np.where((self.at[i] == wanted)[:, None], self.values[i], 0.0)


@dataclass
class CharModel:
    """Interpolated Kneser-Ney model of one group: per order its grams and contexts."""

    grams: dict[int, GramArray]
    contexts: dict[int, GramArray]
    size: int

    def logp(self, keys: np.ndarray) -> np.ndarray:
        """Log-probability of each gram's last character after the others."""
        p = np.full(len(keys), 1.0 / (self.size + 1))
        for order in range(1, ORDER + 1):
            tail = keys & np.uint64((1 << 16 * order) - 1) if order < ORDER else keys
            above = self.grams[order].get(tail)[:, 0]
            context = self.contexts[order].get(tail >> np.uint64(16))
            total = np.maximum(context[:, 0], 1e-9)
            p = np.where(context[:, 0] > 0, above / total + context[:, 1] / total * p, p)
        return np.log(np.clip(p, 1e-12, 1.0))


def _collected(rows: DataFrame, by: str, values: list[str], slices: int) -> dict[object, GramArray]:
    """Sorted arrays of the groups of ``by`` from (by, gram, values), collected slice by slice."""
    parts: dict[object, list] = {}
    for i in range(slices):
        some = rows.where(F.pmod(F.xxhash64("gram"), F.lit(slices)) == i) if slices > 1 else rows
        for group, mine in some.toPandas().groupby(by, sort=False):
            parts.setdefault(group, []).append((mine["gram"].to_numpy(np.int64).view(np.uint64),
                                                mine[values].to_numpy(np.float32)))
    out = {}
    for group in list(parts):
        held = parts.pop(group)
        at, told = np.concatenate([a for a, _ in held]), np.concatenate([v for _, v in held])
        order = np.argsort(at)
        out[group] = GramArray(at[order], told[order])
    return out


def collect_models(counts: DataFrame, by: str, name: str) -> dict[object, CharModel]:
    """Models of the groups of ``by`` from (by, gram, n)."""
    tables = count_tables(counts, [by], name)
    found: dict[object, CharModel] = {}

    def model(group) -> CharModel:
        none = GramArray(np.zeros(0, np.uint64), np.zeros((0, 2), np.float32))
        return found.setdefault(group, CharModel(dict.fromkeys(range(1, ORDER + 1), none),
                                                 dict.fromkeys(range(1, ORDER + 1), none), 0))

    for order, table in tables.items():
        cut = held_back(discounts(table))
        slices = max(1, math.ceil(table.count() / SLICE))
        grams = table.select(by, "gram", (F.col("n") - cut).cast("float").alias("x"))
        contexts = table.groupBy(by, F.shiftrightunsigned("gram", 16).alias("gram")).agg(
            F.sum("n").cast("float").alias("x"), F.sum(cut).cast("float").alias("y"))
        for group, array in _collected(grams, by, ["x"], slices).items():
            model(group).grams[order] = array
            if order == 1:
                found[group].size = len(array.at)
        for group, array in _collected(contexts, by, ["x", "y"], slices).items():
            model(group).contexts[order] = array
    return found
