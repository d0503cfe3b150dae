r"""Filter interaction audit by count-weighted decision diagrams.

Which of several filters removes what depends on their order.  Every document is reduced to
the set of filters it fails; documents are counted per part and set (at most 2^k rows for a
part and k filters).  Per part a decision diagram of these counts is built once: a node
tests one filter, equal subdiagrams are shared, and a terminal holds counts.  Swapping
adjacent levels turns it into the diagram of every other order, one swap per order.  In
each order the path on which all filters pass gives the steps: what a node's failing branch
weighs is removed there, what its passing branch weighs is kept.

``failure_masks`` makes the counts for the five corpus filters: A fewer than 100 words, B
fewer than 80 % distinct words, C over 10 % capitals among the characters, D any of
``#$%&*|``, E a text that a smaller id has too.

E needs no row of a hot text to meet the others: rows are counted per text, part and
labels with their least id and the number of rows that have it, before and after the
shuffle.

Defined results: a null text is empty, a null part the empty string; rows without an id
are no earlier copies and never fail E, nor have they labels; rows that agree in id and
text are copies of each other, and none of them is earlier; several label rows of an id
count as one that holds any of them; parts without documents give no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from siltworks.llm.tables import digest, quoted

FILTERS = "ABCDE"
_SPACE = r"[\x20\x09-\x0D]+"

Counts = tuple[int, ...]


def failure_masks(
    docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", part: str = "lang", label_id: str = "doc_id"
) -> DataFrame:
    """(part, mask, n, good, toxic): documents per part and set of failed filters, bit i for filter i.

    ``labels`` has columns ``quality`` and ``toxic``; other columns of either table do not matter.
    """
    words = "words"
    rows = docs.select(quoted(id).alias("id"), F.coalesce(quoted(part), F.lit("")).alias("part"), F.coalesce(quoted(text), F.lit("")).alias("text"))
    split = rows.withColumn(words, F.array_remove(F.split("text", _SPACE, -1), ""))
    capitals = F.size(F.split("text", "[A-Z]", -1)) - 1
    fails = [
        F.size(words) < 100,
        100 * F.size(F.array_distinct(words)) < 80 * F.size(words),
        100 * capitals.cast("long") > 10 * F.char_length("text").cast("long"),
        F.col("text").rlike("[#$%&*|]"),
    ]
    judged = split.select("id", "part", *digest("text"), _bits(fails).alias("mask"))
    # repeated rows first become one, with their number
    once = judged.groupBy("id", "part", "h1", "h2", "mask").agg(F.count(F.lit(1)).alias("c"))
    good, toxic = (F.max((F.col(c) == 1).cast("int")) for c in ("quality", "toxic"))
    told = labels.filter("quality = 1 OR toxic = 1").groupBy(quoted(label_id).alias("id")).agg(good.alias("good"), toxic.alias("toxic"))
    # rows without an id match no label and are spread by their text
    salt = F.when(F.col("id").isNull(), F.col("h1")).otherwise(F.lit(0).cast("long"))
    known = once.withColumn("salt", salt).join(told.withColumn("salt", F.lit(0).cast("long")), ["id", "salt"], "left")
    known = known.withColumns({c: F.coalesce(c, F.lit(0)) for c in ("good", "toxic")})
    texts = known.groupBy("h1", "h2", "part", "mask", "good", "toxic").agg(
        F.sum("c").alias("n"),
        F.min("id").alias("first"),
        F.min_by("c", "id").alias("at"),
        F.sum(F.when(F.col("id").isNull(), F.col("c")).otherwise(0)).alias("nameless"),
    )
    least = F.min("first").over(W.partitionBy("h1", "h2"))
    own = F.when(F.col("first") == least, F.col("at")).otherwise(0) + F.col("nameless")
    counted = texts.withColumn("own", F.coalesce(own, F.col("nameless")))
    later = F.col("n") - F.col("own")
    both = F.array(F.struct(F.col("mask").alias("mask"), F.col("own").alias("n")), F.struct((F.col("mask") + 16).alias("mask"), later.alias("n")))
    halves = counted.select("part", "good", "toxic", F.explode(both).alias("h")).select("part", "good", "toxic", "h.mask", "h.n").filter("n > 0")
    return halves.groupBy("part", "mask").agg(
        F.sum("n").alias("n"), F.sum(F.col("n") * F.col("good")).alias("good"), F.sum(F.col("n") * F.col("toxic")).alias("toxic")
    )


def _bits(fails: list[Column]) -> Column:
    value = F.lit(0)
    for i, failed in enumerate(fails):
        value = value + F.when(failed, 1 << i).otherwise(0)
    return value


class Diagram:
    """A reduced ordered decision diagram from sets of failed filters to counts.

    Nodes are (filter, passing child, failing child), terminals (-1, counts, None).
    """

    def __init__(self, k: int, counts: dict[int, Counts], width: int):
        self.order = list(range(k))
        self.nodes: list[tuple] = []
        self.index: dict[tuple, int] = {}
        zero = (0,) * width
        layer = [self._node(-1, counts.get(mask, zero), None) for mask in range(1 << k)]
        # bit k-1 of a mask is tested last, so neighbours in the upper half pair up first
        for var in reversed(range(k)):
            half = 1 << var
            layer = [self._node(var, layer[m], layer[m + half]) for m in range(half)]
        self.root = layer[0]

    def _node(self, var: int, passing, failing) -> int:
        if var >= 0 and passing == failing:
            return passing
        key = (var, passing, failing)
        if key not in self.index:
            self.index[key] = len(self.nodes)
            self.nodes.append(key)
        return self.index[key]

    def _branches(self, node: int, var: int) -> tuple[int, int]:
        held, passing, failing = self.nodes[node]
        return (passing, failing) if held == var else (node, node)

    def swap(self, level: int) -> None:
        """Exchange the filters of ``level`` and the next one; only nodes of the upper one change, in place."""
        upper, lower = self.order[level : level + 2]
        for node in self._reachable():
            var, passing, failing = self.nodes[node]
            if var != upper or lower not in (self.nodes[passing][0], self.nodes[failing][0]):
                continue
            pp, pf = self._branches(passing, lower)
            fp, ff = self._branches(failing, lower)
            del self.index[self.nodes[node]]
            moved = (lower, self._node(upper, pp, fp), self._node(upper, pf, ff))
            self.nodes[node], self.index[moved] = moved, node
        self.order[level : level + 2] = [lower, upper]
        self._drop_unreachable()

    def _reachable(self) -> list[int]:
        found, todo = {self.root}, [self.root]
        while todo:
            var, passing, failing = self.nodes[todo.pop()]
            for child in (passing, failing) if var >= 0 else ():
                if child not in found:
                    found.add(child)
                    todo.append(child)
        return sorted(found)

    def _drop_unreachable(self) -> None:
        kept = self._reachable()
        place = {old: new for new, old in enumerate(kept)}
        nodes = [self.nodes[old] for old in kept]
        self.nodes = [(v, place[p], place[f]) if v >= 0 else (v, p, f) for v, p, f in nodes]
        self.index = {node: i for i, node in enumerate(self.nodes)}
        self.root = place[self.root]

    def steps(self) -> list[tuple[Counts, Counts]]:
        """(kept, removed) after each filter of the present order, from the all-pass path."""
        k = len(self.order)
        level = {var: i for i, var in enumerate(self.order)} | {-1: k}
        weights: dict[int, Counts] = {}

        def weight(node: int, at: int) -> Counts:
            """Counts of all sets below ``at``; a level that is skipped doubles them."""
            var, passing, failing = self.nodes[node]
            if node not in weights:
                if var < 0:
                    weights[node] = passing
                else:
                    below = level[var] + 1
                    weights[node] = tuple(a + b for a, b in zip(weight(passing, below), weight(failing, below)))
            return tuple(w << (level[var] - at) for w in weights[node])

        out, node = [], self.root
        for at, var in enumerate(self.order):
            node, failing = self._branches(node, var)
            out.append((weight(node, at + 1), weight(failing, at + 1)))
        return out


def adjacent_changes(k: int) -> Iterator[int]:
    """Levels to swap with the next one, so that all k! orders are met, each once."""
    if k < 2:
        return
    down = True
    for inner in [*adjacent_changes(k - 1), None]:
        yield from range(k - 2, -1, -1) if down else range(k - 1)
        if inner is not None:
            # the item that travels now lies at one end, the others beside it
            yield inner + 1 if down else inner
        down = not down


def part_rows(part: str, masks: pd.DataFrame, filters: str) -> pd.DataFrame:
    """All orders and steps of one part, from its at most 2^k counts."""
    k = len(filters)
    counts = {int(r.mask): (int(r.n), int(r.good), int(r.toxic)) for r in masks.itertuples()}
    diagram = Diagram(k, counts, 3)
    found = [(tuple(diagram.order), diagram.steps())]
    for level in adjacent_changes(k):
        diagram.swap(level)
        found.append((tuple(diagram.order), diagram.steps()))
    failing, alone, shapley = [0] * k, [0] * k, [0] * k
    for order, steps in found:
        failing[order[0]] = steps[0][1][0]  # nothing was removed before
        alone[order[-1]] = steps[-1][1][0]  # all others passed
        for var, (_, removed) in zip(order, steps):
            shapley[var] += removed[0]
    rows = [
        (part, "".join(filters[v] for v in order), at + 1, kept[0], gone[0], failing[v] - gone[0], alone[v], gone[1], gone[2], shapley[v])
        for order, steps in found
        for at, (v, (kept, gone)) in enumerate(zip(order, steps))
    ]
    assert len({r[1] for r in rows}) == math.factorial(k)
    return pd.DataFrame(rows, columns=[c.split()[0] for c in ROWS.split(", ")])


ROWS = (
    "part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, good_lost long, toxic_lost long, shapley long"
)


def interaction_audit(masks: DataFrame, filters: str = FILTERS) -> DataFrame:
    """One row per part, order of ``filters`` and step, from (part, mask, n, good, toxic) with one row per part and mask."""

    def one(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        return part_rows(key[0], rows, filters)

    return masks.groupBy("part").applyInPandas(one, ROWS)
