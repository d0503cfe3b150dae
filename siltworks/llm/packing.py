"""Best-fit packing by exact complements.

Documents become pieces of at most ``capacity`` tokens.  Only the counts of pieces by
length decide the packing, and there are at most ``capacity`` lengths, so the plan is made
on the driver from a table of bounded size: for every length, longest first, a single
length, a pair or a triple that fills the rest of the sequence exactly is looked up among
the lengths still available and used as often as the counts allow; what has no exact
complement is placed by best fit.  Pieces then find their place by their rank among the
pieces of their length.

Defined results: null and empty texts are pieces of the end id alone; repeated rows are
packed one by one; null ids are kept; an empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from siltworks.llm.tables import quoted, store

CAPACITY = 2048
#: pieces of one length are ranked in buckets, at least so many, and then offset
BUCKETS, BUCKET_ROWS = 64, 50_000


def cut_pieces(df: DataFrame, tokenizer: str, end: int, capacity: int = CAPACITY, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, text_hash): a row per piece.

    Documents of more than ``capacity`` ids are cut so that only the first piece is shorter.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from siltworks.llm.tokens import encoder

        encode, tail = encoder(tokenizer).encode, np.uint32(end).astype("<u4").tobytes()
        for batch in batches:
            rows = []
            for k, text in enumerate(batch["text"]):
                ids = encode(text) + tail
                total = len(ids) // 4
                cuts = [0, *range(total % capacity or capacity, total + 1, capacity)] if total > capacity else [0, total]
                for piece, (a, b) in enumerate(zip(cuts, cuts[1:])):
                    rows.append((k, piece, a, b - a, zlib.crc32(ids[4 * a : 4 * b])))
            out = pd.DataFrame(rows, columns=["k", "piece", "start", "length", "ids_crc32"])
            for name in ("doc", "h"):
                out[name] = batch[name].take(out["k"]).array
            yield out.drop(columns="k")

    rows = df.select(quoted(id).cast("string").alias("doc"), quoted(text).alias("text"), F.xxhash64(quoted(text)).alias("h"))
    schema = "piece int, start long, length long, ids_crc32 long, doc string, h long"
    kind = df.schema[id].dataType
    return rows.mapInPandas(run, schema).select(
        F.col("doc").cast(kind).alias("doc_id"), "piece", "start", "length", "ids_crc32", F.col("h").alias("text_hash")
    )


class _Complements:
    """Which single lengths, pairs and triples of available lengths have a given sum."""

    def __init__(self, counts: np.ndarray):
        self.counts = counts

    def fill(self, gap: int) -> list[int] | None:
        """The lengths of an exact fill, the largest first length preferred."""
        have = self.counts
        if have[gap]:
            return [gap]
        single = have[1:gap] > 0  # lengths 1 .. gap-1
        pairs = single & single[::-1]
        if gap % 2 == 0 and have[gap // 2] < 2:
            pairs[gap // 2 - 1] = False
        if pairs.any():
            a = int(np.flatnonzero(pairs)[-1]) + 1
            return [a, gap - a]
        for a in (np.flatnonzero(single)[::-1] + 1).tolist():
            if 3 * a < gap:  # the largest of three is at least a third
                return None
            have[a] -= 1
            rest = gap - a
            inner = have[1:rest] > 0
            both = inner & inner[::-1]
            if rest % 2 == 0 and have[rest // 2] < 2:
                both[rest // 2 - 1] = False
            have[a] += 1
            if both.any():
                b = int(np.flatnonzero(both)[-1]) + 1
                return [a, b, rest - b]
        return None


def plan_packing(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, list[tuple[int, int]]]]:
    """Patterns as (how many sequences, [(length, how often in each), ...])."""
    have = np.zeros(capacity + 1, np.int64)
    for length, n in counts.items():
        have[length] = n
    index, patterns = _Complements(have), []
    residual: dict[int, int] = {}
    for length in range(capacity, 0, -1):
        while have[length]:
            have[length] -= 1
            rest = [] if length == capacity else index.fill(capacity - length)
            have[length] += 1
            if rest is None:
                residual[length] = int(have[length])
                have[length] = 0
                break
            used = Counter([length, *rest])
            times = min(int(have[x]) // n for x, n in used.items())
            for x, n in used.items():
                have[x] -= times * n
            patterns.append((times, list(used.items())))
    bins: dict[int, list[tuple[int, list[tuple[int, int]]]]] = defaultdict(list)  # by what is free
    for length, left in residual.items():  # longest first
        while left:
            gap = min((g for g in bins if g >= length), default=None)
            if gap is None:
                rep = min(capacity // length, left)
                times = left // rep
                bins[capacity - rep * length].append((times, [(length, rep)]))
                left -= times * rep
                continue
            times, slots = bins[gap].pop()
            rep = min(gap // length, left)
            used = min(times, left // rep)
            if times > used:
                bins[gap].append((times - used, slots))
            if not bins[gap]:
                del bins[gap]
            bins[gap - rep * length].append((used, [*slots, (length, rep)]))
            left -= used * rep
    return patterns + [pattern for group in bins.values() for pattern in group]


def _slots(patterns: list[tuple[int, list[tuple[int, int]]]]) -> dict[int, np.ndarray]:
    """By length: rows (first rank, repeats per sequence, first sequence, offset of the first)."""
    rows, taken, sequence = defaultdict(list), Counter(), 0
    for times, slots in patterns:
        offset = 0
        for length, rep in slots:
            rows[length].append((taken[length], rep, sequence, offset))
            taken[length] += times * rep
            offset += rep * length
        sequence += times
    return {length: np.array(r, np.int64) for length, r in rows.items()}


def _placer(slots: dict[int, np.ndarray]) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sequence, offset = np.zeros(len(batch), np.int64), np.zeros(len(batch), np.int64)
            ranks, lengths = batch["rank"].to_numpy(), batch["length"].to_numpy()
            for length in np.unique(lengths).tolist():
                at = np.flatnonzero(lengths == length)
                table = slots[length]
                row = table[np.searchsorted(table[:, 0], ranks[at], side="right") - 1]
                inside = ranks[at] - row[:, 0]
                sequence[at] = row[:, 2] + inside // row[:, 1]
                offset[at] = row[:, 3] + inside % row[:, 1] * length
            yield batch.drop(columns="rank").assign(sequence_id=sequence, offset=offset)

    return run


def pack_pieces(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to stored pieces (see ``cut_pieces``)."""
    counts = pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n"))
    found = {int(r["length"]): int(r["n"]) for r in counts.collect()}  # at most one row per length
    slots = _slots(plan_packing(found, capacity))
    n_buckets = max(BUCKETS, -(-sum(found.values()) // BUCKET_ROWS))
    spread = pieces.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "piece", "text_hash"), F.lit(n_buckets)))
    sizes = spread.groupBy("length", "bucket").agg(F.count(F.lit(1)).alias("n"))
    earlier = W.partitionBy("length").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    bases = sizes.select("length", "bucket", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    inside = W.partitionBy("length", "bucket").orderBy("doc_id", "piece", "text_hash")
    ranked = (
        spread.withColumn("_r", F.row_number().over(inside) - 1)
        .join(bases, ["length", "bucket"])
        .select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("_r") + F.col("base")).cast("long").alias("rank"))
    )
    kind = dict(ranked.dtypes)["doc_id"]
    text_id = ranked.withColumn("doc_id", F.col("doc_id").cast("string"))
    placed = text_id.mapInPandas(
        _placer(slots), "doc_id string, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    )
    return placed.withColumn("doc_id", F.col("doc_id").cast(kind))


def pack_documents(df: DataFrame, tokenizer: str, end: int, capacity: int = CAPACITY, id: str = "doc_id", text: str = "text") -> DataFrame:
    """A row per piece with its sequence and its place there, sequences filled without gaps."""
    return pack_pieces(store(cut_pieces(df, tokenizer, end, capacity, id, text), "pieces"), capacity)
