"""Token ids in word-aligned binary shards (Simple-8b).

Each 64-bit word holds a selector in its top four bits and as many equally wide ids as the
selector says in the other sixty.  Ids are cut into blocks of ``BLOCK`` ids; every block
starts at a word of its own whose number is stored, so that blocks can be decoded apart
and words of one selector together.  Values of 2**60 and more go to a list of exceptions;
an escape word holds the place in it.

A shard is one little-endian file::

    magic "S8BT", uint32 version, then int64: part, seq, n_docs, n_ids, n_blocks, n_words, n_exceptions
    int64  doc ids, uint8 null flags, int64 id counts      (one each per document)
    uint64 first word of every block, and the number of words
    uint64 words, uint64 exceptions, and a newline that the writer adds

Shards are written by Spark in ascending document order; ``part`` and ``seq`` give that
order, so nothing depends on file names.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltworks.llm.tables import quoted, running_offsets, store

#: (ids per word, bits per id) by selector, fixed values of the format; 14 is an escape
LAYOUTS = [(60, 1), (30, 2), (20, 3), (15, 4), (12, 5), (10, 6), (8, 7), (7, 8), (6, 10), (5, 12), (4, 15), (3, 20), (2, 30), (1, 60)]
ESCAPE = 14
BLOCK = 256
SHARD_IDS = 2_000_000
#: ids packed together, whole blocks
SLICE = 1024 * BLOCK
_MAGIC = b"S8BT"


def pack(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(words, first word of every block and the total, exceptions).

    Blocks are independent; as many are packed together as the processor's cache holds.
    """
    words, first, exceptions = [np.zeros(0, np.uint64)], [np.zeros(1, np.uint64)], [np.zeros(0, np.uint64)]
    n_words = n_exceptions = 0
    for at in range(0, len(ids), SLICE):
        w, f, e = _pack_blocks(ids[at : at + SLICE], n_exceptions)
        words.append(w)
        first.append(f[1:] + np.uint64(n_words))
        exceptions.append(e)
        n_words, n_exceptions = n_words + len(w), n_exceptions + len(e)
    return np.concatenate(words), np.concatenate(first), np.concatenate(exceptions)


def _pack_blocks(ids: np.ndarray, n_exceptions: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``pack`` after so many exceptions; words are counted from 0."""
    ids = np.asarray(ids, np.uint64)
    n_blocks = -(-len(ids) // BLOCK)
    grid = np.zeros(n_blocks * BLOCK, np.uint64)
    grid[: len(ids)] = ids
    over = grid >= np.uint64(1 << 60)
    exceptions = grid[over]
    grid[over] = np.arange(n_exceptions, n_exceptions + len(exceptions), dtype=np.uint64)
    grid = grid.reshape(n_blocks, BLOCK)
    over = over.reshape(n_blocks, BLOCK)
    width = np.zeros(grid.shape, np.int8)
    for _, bits in LAYOUTS:
        width[grid >= np.uint64(1) << np.uint64(bits)] = bits  # the widest layout that is too narrow
    width[over] = 61
    # widest value among the next k positions of the block, for the layouts from many to few ids
    choice = np.full(grid.shape, ESCAPE, np.int8)
    for selector in reversed(range(len(LAYOUTS))):
        count, bits = LAYOUTS[selector]
        padded = np.concatenate([width, np.zeros((n_blocks, count), np.int8)], axis=1)
        reach, span = padded, 1
        while span * 2 <= count:
            reach = np.maximum(reach[:, :-span], reach[:, span:])
            span *= 2
        if span < count:
            reach = np.maximum(reach[:, : reach.shape[1] - (count - span)], reach[:, count - span :])
        choice[reach[:, :BLOCK] < bits] = selector
    counts = np.array([c for c, _ in LAYOUTS] + [1])
    length = np.minimum(BLOCK, len(ids) - np.arange(n_blocks) * BLOCK)
    place, row = np.zeros(n_blocks, np.int64), np.arange(n_blocks)
    taken_row, taken_place = [], []
    while len(row):  # one step takes the next word of every block that has ids left
        taken_row.append(row)
        taken_place.append(place)
        place = place + counts[choice[row, place]]
        left = place < length[row]
        row, place = row[left], place[left]
    rows = np.concatenate(taken_row) if taken_row else np.zeros(0, np.int64)
    places = np.concatenate(taken_place) if taken_place else np.zeros(0, np.int64)
    order = np.lexsort((places, rows))
    rows, places = rows[order], places[order]
    chosen = choice[rows, places]
    words = chosen.astype(np.uint64) << np.uint64(60)
    padded = np.concatenate([grid, np.zeros((n_blocks, 60), np.uint64)], axis=1).ravel()
    start = rows * (BLOCK + 60) + places
    for selector in np.unique(chosen):
        count, bits = (1, 60) if selector == ESCAPE else LAYOUTS[selector]
        at = np.flatnonzero(chosen == selector)
        for j in range(count):
            words[at] |= padded[start[at] + j] << np.uint64(j * bits)
    first = np.zeros(n_blocks + 1, np.uint64)
    first[1:] = np.cumsum(np.bincount(rows, minlength=n_blocks))
    return words, first, exceptions


def unpack(words: np.ndarray, first: np.ndarray, exceptions: np.ndarray, n_ids: int) -> np.ndarray:
    """The ids again; words of one selector are decoded together."""
    selector = (words >> np.uint64(60)).astype(np.int64)
    counts = np.array([c for c, _ in LAYOUTS] + [1, 0])[selector]
    before = np.cumsum(counts) - counts
    first = first.astype(np.int64)
    block = np.repeat(np.arange(len(first) - 1), np.diff(first))
    place = block * BLOCK + before - (before[first[:-1]][block] if len(words) else 0)
    out = np.zeros((len(first) - 1) * BLOCK + 60, np.uint64)
    end = (block + 1) * BLOCK
    body = words & np.uint64((1 << 60) - 1)
    for s in np.unique(selector):
        at = np.flatnonzero(selector == s)
        if s == ESCAPE:
            out[place[at]] = exceptions[body[at].astype(np.int64)]
            continue
        count, bits = LAYOUTS[s]
        mask = np.uint64((1 << bits) - 1)
        for j in range(count):
            keep = place[at] + j < end[at]
            out[place[at][keep] + j] = (body[at][keep] >> np.uint64(j * bits)) & mask
    return out[:n_ids]


def _file(part: int, seq: int, docs: list, lengths: list[int], ids: bytes) -> bytes:
    values = np.frombuffer(ids, "<u4")
    words, first, exceptions = pack(values)
    head = np.array([part, seq, len(docs), len(values), len(first) - 1, len(words), len(exceptions)], "<i8")
    return b"".join(
        [
            _MAGIC,
            np.uint32(1).astype("<u4").tobytes(),
            head.tobytes(),
            np.array([0 if d is None else d for d in docs], "<i8").tobytes(),
            np.array([d is None for d in docs], "u1").tobytes(),
            np.array(lengths, "<i8").tobytes(),
            first.astype("<u8").tobytes(),
            words.astype("<u8").tobytes(),
            exceptions.astype("<u8").tobytes(),
        ]
    )


def read_shard(content: bytes) -> tuple[int, int, list, np.ndarray, np.ndarray]:
    """(part, seq, doc ids, id counts, all ids) of one shard."""
    if content[:4] != _MAGIC:
        raise ValueError("not a token shard")
    part, seq, n_docs, n_ids, n_blocks, n_words, n_exceptions = np.frombuffer(content, "<i8", 7, 8).tolist()
    at = 64
    docs = np.frombuffer(content, "<i8", n_docs, at)
    null = np.frombuffer(content, "u1", n_docs, at + 8 * n_docs)
    lengths = np.frombuffer(content, "<i8", n_docs, at + 9 * n_docs)
    at += 17 * n_docs
    first = np.frombuffer(content, "<u8", n_blocks + 1, at)
    at += 8 * (n_blocks + 1)
    words = np.frombuffer(content, "<u8", n_words, at)
    exceptions = np.frombuffer(content, "<u8", n_exceptions, at + 8 * n_words)
    ids = unpack(words, first, exceptions, n_ids)
    return part, seq, [None if x else int(d) for d, x in zip(docs, null)], lengths, ids


def _shards(path: str, end: int, limit: int) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        from siltworks.llm.tokens import encoder

        encode, tail = encoder(path).encode, np.uint32(end).astype("<u4").tobytes()
        part, seq, held = TaskContext.get().partitionId(), 0, 0
        docs, lengths, ids = [], [], []
        for batch in batches:
            for doc, text in zip(batch["doc"].array, batch["text"]):
                one = encode(text) + tail
                docs.append(None if doc is pd.NA else int(doc))
                lengths.append(len(one) // 4)
                ids.append(one)
                held += lengths[-1]
                if held >= limit:
                    yield pd.DataFrame({"shard": [_file(part, seq, docs, lengths, b"".join(ids))]})
                    seq, held, docs, lengths, ids = seq + 1, 0, [], [], []
        if docs:
            yield pd.DataFrame({"shard": [_file(part, seq, docs, lengths, b"".join(ids))]})

    def typed(batches: Iterator) -> Iterator:
        import pyarrow as pa

        frames = (b.to_pandas(types_mapper={pa.int64(): pd.Int64Dtype()}.get) for b in batches)
        for frame in run(frames):
            yield pa.RecordBatch.from_pandas(frame, schema=pa.schema([("shard", pa.binary())]), preserve_index=False)

    return typed


def write_token_shards(df: DataFrame, path: str, tokenizer: str, end: int, id: str = "doc_id", text: str = "text", shard_ids: int = SHARD_IDS) -> None:
    """Encode every whole text and write shards in ascending (id, text hash) order.

    Null texts are empty, null ids come first, repeated rows are all written.  A shard
    closes with the document that reaches ``shard_ids`` ids.  An empty table writes none.
    """
    rows = df.select(quoted(id).cast("long").alias("doc"), quoted(text).alias("text")).withColumn("h", F.xxhash64("text"))
    ordered = rows.repartitionByRange("doc", "h").sortWithinPartitions("doc", "h", "text")
    shards = ordered.select("doc", "text").mapInArrow(_shards(tokenizer, end, shard_ids), "shard binary")
    # a string keeps the bytes as they are, so the text writer can commit them on any file system
    shards.select(F.col("shard").cast("string").alias("value")).write.option("maxRecordsPerFile", 1).text(path)


def read_token_shards(spark: SparkSession, path: str) -> DataFrame:
    """(part, seq, doc_id, local_start, n_tokens, ids_crc32, ids) of every document in the shards."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for content in batch["content"]:
                if not content:
                    continue
                part, seq, docs, lengths, ids = read_shard(content)
                ends = np.cumsum(lengths)
                raw = ids.astype("<u4").tobytes()
                parts = [raw[4 * (e - n) : 4 * e] for e, n in zip(ends.tolist(), lengths.tolist())]
                yield pd.DataFrame(
                    {
                        "part": part,
                        "seq": seq,
                        "doc_id": pd.array(docs, "Int64"),
                        "local_start": ends - lengths,
                        "n_tokens": lengths,
                        "ids_crc32": [zlib.crc32(p) for p in parts],
                        "ids": parts,
                    }
                )

    files = spark.read.format("binaryFile").load(path).select("content")
    return files.mapInPandas(run, "part long, seq long, doc_id long, local_start long, n_tokens long, ids_crc32 long, ids binary")


def token_index(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32): where every document's ids lie in the whole sequence."""
    found = store(read_token_shards(spark, path).drop("ids"), "shard-docs")
    sizes = found.groupBy("part", "seq").agg(F.sum("n_tokens").alias("size"))
    before = running_offsets(sizes, "part", "seq", "size").select("part", "seq", "before")
    return found.join(before, ["part", "seq"]).select(
        "doc_id", (F.col("before") + F.col("local_start")).cast("long").alias("start"), "n_tokens", "ids_crc32"
    )
