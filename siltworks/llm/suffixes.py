"""Removal of passages that occur earlier, by bucket refinement of byte strings.

Every byte covered by a ``WINDOW``-byte string that also starts earlier (in a document
before it, or further ahead in the same one) is removed; strings are judged on the input.
The strings are put into ever finer buckets as in suffix sorting:

* The identifier of the string of 2k bytes at an offset is made from the identifiers of
  the k-byte strings there and k further on, so each length reuses the one before it.
* Every ``WINDOW``-byte string is filed under one of its q-grams of ``GRAM`` bytes, the one
  whose identifier is smallest.  Equal strings choose the same q-gram at the same place, so
  only q-gram buckets with several entries can hold repeated strings, and consecutive
  strings mostly share an entry: one entry per some forty bytes is shuffled, not every
  offset.
* Entries of a bucket with equal surroundings are collapsed to the earliest.  Of the others
  the bytes are fetched and refined: their strings are sorted by bucket and the identifiers of later offsets up
  to the full length, and in each final bucket everything but the earliest is repeated.

Copies of whole texts are collapsed before that.  Defined results: a null text is empty;
documents are ordered by id, null ids first, then by a hash of the text; rows that agree in
id and text are one document and get one result; texts shorter than ``WINDOW`` bytes stay
whole; other columns do not matter.  Strings are identified by 64-bit values inside
64-bit buckets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from siltworks.llm.minhash import mixed
from siltworks.llm.tables import digest, discard, fresh, positional, quoted, running_offsets, store

WINDOW, GRAM = 100, 16
#: bytes of text worked on at a time inside a task
CHUNK = 1 << 20
#: bytes of surroundings refined together
BUCKET_BYTES = 8 << 20
#: buckets with more unequal entries are refined window by window over all tasks
HOT_ENTRIES = 50_000
_STEP = np.uint64(0x9E3779B97F4A7C15)
_PLACE = np.uint64((1 << 22) - 1)


def _joined(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Identifiers of strings twice as long from those of their halves."""
    out = first * _STEP
    out ^= out >> np.uint64(29)
    out += second
    out *= np.uint64(0xBF58476D1CE4E5B9)
    out ^= out >> np.uint64(32)
    return out


def identifiers(data: np.ndarray, size: int, known: tuple[int, np.ndarray] | None = None) -> np.ndarray:
    """Identifiers of the strings of ``size`` bytes at every offset, from shorter ones."""
    have, ids = known or (1, mixed(data.astype(np.uint64) + _STEP))
    while 2 * have <= size:
        ids = _joined(ids[: len(ids) - have], ids[have:])
        have *= 2
    if have < size:  # two overlapping halves
        ids = _joined(ids[: len(ids) - (size - have)], ids[size - have :])
    return ids


def _smallest(values: np.ndarray, span: int) -> np.ndarray:
    """The least of every ``span`` consecutive values."""
    have = 1
    while 2 * have <= span:
        values = np.minimum(values[: len(values) - have], values[have:])
        have *= 2
    return np.minimum(values[: len(values) - (span - have)], values[span - have :]) if have < span else values


def _pieces(texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Texts as joined pieces of about ``CHUNK`` bytes: (bytes, row, offset in the text, end) per piece.

    Every window of a text lies whole in exactly one piece.
    """
    held, size = [], 0
    for row, text in enumerate(texts):
        for offset in range(0, max(len(text) - WINDOW + 1, 0), CHUNK):
            held.append((row, offset, text[offset : offset + CHUNK + WINDOW - 1]))
            size += len(held[-1][2])
            if size >= CHUNK:
                yield _together(held)
                held, size = [], 0
    if held:
        yield _together(held)


def _together(held):
    rows, offsets, parts = zip(*held)
    ends = np.cumsum([len(p) for p in parts])
    return np.frombuffer(b"".join(parts), np.uint8), np.array(rows), np.array(offsets), ends


def entries(texts: list[bytes]) -> Iterator[tuple[np.ndarray, ...]]:
    """Per joined piece: its bytes and arrays (bucket, row, place of the first window in the
    text, place in the bytes, number of windows) of its entries."""
    grams = WINDOW - GRAM + 1
    for data, rows, offsets, ends in _pieces(texts):
        ids = identifiers(data, GRAM)
        keyed = (ids & ~_PLACE) | np.arange(len(ids), dtype=np.uint64)
        chosen = (_smallest(keyed, grams) & _PLACE).astype(np.int64)  # by the window's first byte
        piece = np.searchsorted(ends, np.arange(len(chosen)), side="right")
        inside = np.arange(len(chosen)) + WINDOW <= ends[piece]
        starts = np.flatnonzero(inside & np.concatenate([[True], (chosen[1:] != chosen[:-1]) | ~inside[:-1]]))
        stops = np.flatnonzero(inside & np.concatenate([(chosen[1:] != chosen[:-1]) | ~inside[1:], [True]]))
        piece = piece[starts]
        begin = ends - np.diff(ends, prepend=0)
        yield data, ids[chosen[starts]], rows[piece], offsets[piece] + starts - begin[piece], starts, stops - starts + 1


def _signed(ids: np.ndarray) -> np.ndarray:
    return ids.view(np.int64)


def _buckets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(bucket, rid): the entries of every text, one of a text's equal buckets marked twice at most."""
    for batch in batches:
        rid = batch["rid"].to_numpy()
        parts = [(_signed(ids), rid[rows]) for _, ids, rows, *_ in entries(batch["body"].tolist())]
        if parts:
            found = pd.DataFrame({"bucket": np.concatenate([p[0] for p in parts]), "rid": np.concatenate([p[1] for p in parts])})
            found["n"] = 1
            yield found.groupby(["bucket", "rid"], as_index=False, sort=False)["n"].sum()


def _surroundings(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(bucket, rid, place, size, same): the entries whose bucket occurs elsewhere too, with
    the extent of their windows in the text and a hash of those bytes."""
    import xxhash

    for batch in batches:
        rid = batch["rid"].to_numpy()
        lists = [np.asarray(x, np.int64) for x in batch["buckets"]]
        salt = mixed(rid.astype(np.uint64))
        wanted = np.sort(np.concatenate([mixed(x.view(np.uint64) + s) for x, s in zip(lists, salt)]))
        for data, ids, rows, place, at, n in entries(batch["body"].tolist()):
            mine = mixed(ids + salt[rows])
            hit = np.flatnonzero(wanted[np.minimum(np.searchsorted(wanted, mine), len(wanted) - 1)] == mine)
            raw, size = data.tobytes(), n[hit] + WINDOW - 1
            same = [xxhash.xxh64_intdigest(raw[a : a + k]) for a, k in zip(at[hit].tolist(), size.tolist())]
            yield pd.DataFrame(
                {"bucket": _signed(ids[hit]), "rid": rid[rows[hit]], "place": place[hit], "size": size, "same": np.array(same, np.uint64).view(np.int64)}
            )


def _windows(rows: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(entry, place in it, identifier) of every window of the rows' surroundings."""
    around = rows["around"].tolist()
    sizes = np.array([len(x) for x in around])
    ids = identifiers(np.frombuffer(b"".join(around), np.uint8), WINDOW)
    windows = sizes - WINDOW + 1
    entry = np.repeat(np.arange(len(rows)), windows)
    inside = np.arange(len(entry)) - np.repeat(np.cumsum(windows) - windows, windows)
    full = ids[np.repeat(np.cumsum(sizes) - sizes, windows) + inside]
    return entry, inside, mixed(full + mixed(rows["bucket"].to_numpy().view(np.uint64))[entry])


def _single_windows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for start in range(0, len(batch), 2000):
            rows = batch.iloc[start : start + 2000]
            entry, inside, full = _windows(rows)
            place = rows["place"].to_numpy()[entry] + inside
            yield pd.DataFrame({"bucket": rows["bucket"].to_numpy()[entry], "full": _signed(full), "rid": rows["rid"].to_numpy()[entry], "start": place})


def _spread(rest: DataFrame) -> DataFrame:
    """(rid, start, stop) like ``_refined``, with the windows of a bucket dealt over all tasks."""
    rows = store(rest.mapInPandas(_single_windows, "bucket long, full long, rid long, start long"), "windows")
    heads = rows.groupBy("bucket", "full").agg(F.min(F.struct("rid", "start")).alias("head"))
    again = rows.join(heads, ["bucket", "full"]).filter(F.struct("rid", "start") != F.col("head"))
    return again.select("rid", "start", (F.col("start") + WINDOW).alias("stop"))


def _refined(group: pd.DataFrame) -> pd.DataFrame:
    """(rid, start, stop): bytes of windows that equal an earlier window of the same bucket."""
    group = group.sort_values(["rid", "place"], kind="stable")
    entry, inside, full = _windows(group)
    order = np.argsort(full, kind="stable")  # windows of a final bucket stay in corpus order
    again = np.zeros(len(full), bool)
    again[order[1:]] = full[order[1:]] == full[order[:-1]]
    edge = np.concatenate([[True], entry[1:] != entry[:-1]])
    first = np.flatnonzero(again & (edge | ~np.concatenate([[False], again[:-1]])))
    last = np.flatnonzero(again & np.concatenate([edge[1:] | ~again[1:], [True]]))
    rid, place = group["rid"].to_numpy()[entry[first]], group["place"].to_numpy()[entry[first]]
    return pd.DataFrame({"rid": rid, "start": place + inside[first], "stop": place + inside[last] + WINDOW})


def first_copies(df: DataFrame, id: str, text: str) -> DataFrame:
    """(doc, th, rid): the first copy of every text of ``WINDOW`` bytes or more, numbered in corpus order."""
    body = F.coalesce(quoted(text), F.lit(""))
    rows = df.select(quoted(id).alias("doc"), *digest(body), F.octet_length(body).alias("size")).filter(F.col("size") >= WINDOW)
    first = rows.groupBy("h1", "h2").agg(F.min("doc").alias("doc")).select("doc", F.col("h1").alias("th"))
    placed = store(
        first.repartitionByRange("doc", "th").withColumn("part", F.spark_partition_id()), "first-copies"
    )
    counts = placed.groupBy("part").agg(F.count(F.lit(1)).alias("n")).withColumn("item", F.lit(0))
    base = running_offsets(counts, "part", "item", "n").select("part", "before")
    rank = F.row_number().over(W.partitionBy("part").orderBy("doc", "th"))
    return placed.withColumn("_r", rank).join(base, "part").select("doc", "th", (F.col("before") + F.col("_r")).alias("rid"))


def _texts(df: DataFrame, wanted: DataFrame, id: str, text: str, *columns: str) -> DataFrame:
    """The wanted documents' bytes; one row where id and text repeat is as good as several."""
    body = F.coalesce(quoted(text), F.lit(""))
    rows = df.select(quoted(id).alias("doc"), F.xxhash64(body).alias("th"), body.cast("binary").alias("body"))
    same = rows["doc"].eqNullSafe(wanted["doc"]) & (rows["th"] == wanted["th"])
    return rows.join(wanted, same).select("rid", "body", *columns)


def repeated_spans(df: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc, th, rid, spans): for every first copy, the byte ranges that occur earlier, null if none.

    Ranges may overlap.  Documents that are not listed are shorter than ``WINDOW`` bytes or
    copies of a listed one.
    """
    firsts = store(first_copies(df, id, text), "documents")
    found = store(_texts(df, firsts, id, text).mapInPandas(_buckets, "bucket long, rid long, n long"), "buckets", sweep=True)
    shared = found.groupBy("bucket").agg(F.sum("n").alias("n")).filter("n > 1").select("bucket")
    lists = found.join(shared, "bucket", "left_semi").groupBy("rid").agg(F.collect_set("bucket").alias("buckets"))
    wanted = store(firsts.join(lists, "rid"), "bucket-lists")
    discard(found)
    rows = _texts(df, wanted, id, text, "buckets")
    around = rows.mapInPandas(_surroundings, "bucket long, rid long, place long, size long, same long")
    around = store(around, "surroundings", sweep=True)
    discard(wanted)
    # equal surroundings: all but the earliest are repeated from end to end
    at = F.struct("rid", "place")
    heads = store(around.groupBy("bucket", "same").agg(F.min(F.struct("rid", "place", "size")).alias("head")), "heads")
    whole = around.join(heads, ["bucket", "same"]).filter(at != F.struct("head.rid", "head.place"))
    whole = store(whole.select("rid", F.col("place").alias("start"), (F.col("place") + F.col("size")).alias("stop")), "whole-spans")
    discard(around)
    # only now the bytes of the others are fetched
    several = heads.groupBy("bucket").count().filter("count > 1").select("bucket")
    unequal = heads.join(several, "bucket", "left_semi").select("bucket", "head.*")
    lists = unequal.groupBy("rid").agg(F.collect_list(F.struct("bucket", "place", "size")).alias("entries"))
    texts = _texts(df, store(firsts.join(lists, "rid"), "unequal"), id, text, "entries")
    parts = texts.select("rid", "body", F.explode("entries").alias("e"))
    bytes_at = F.substr("body", (F.col("e.place") + 1).cast("int"), F.col("e.size").cast("int"))
    rest = parts.select(F.col("e.bucket").alias("bucket"), "rid", F.col("e.place").alias("place"), bytes_at.alias("around"))
    rest = store(rest, "unequal-bytes", sweep=True)
    size = rest.agg(F.sum(F.octet_length("around"))).first()[0] or 0
    groups = max(1, -(-size // BUCKET_BYTES))
    hot = store(rest.groupBy("bucket").count().filter(F.col("count") > HOT_ENTRIES).select("bucket"), "hot-buckets")
    if not hot.isEmpty():
        whole = whole.union(_spread(rest.join(hot, "bucket", "left_semi")))
        rest = rest.join(hot, "bucket", "left_anti")
    parts = rest.withColumn("part", F.pmod(F.xxhash64("bucket"), F.lit(groups))).groupBy("part")
    refined = parts.applyInPandas(_refined, "rid long, start long, stop long")
    spans = whole.union(refined).groupBy("rid").agg(F.collect_list(F.struct("start", "stop")).alias("spans"))
    return firsts.join(spans, "rid", "left").select("doc", "th", "rid", "spans")


def _cut(body: bytes, spans, copy: bool) -> tuple[int, int, int, bytes]:
    body = body or b""
    if copy and len(body) >= WINDOW:
        return len(body), len(body), 1, b""
    if spans is None or not len(spans):
        return len(body), 0, 0, body
    kept, at, removed, runs, stop = [], 0, 0, 0, -1
    for a, b in sorted((s["start"], s["stop"]) for s in spans):
        if a > stop:
            runs += 1
            kept.append(body[at:a])
            removed += b - a
            stop = b
        elif b > stop:
            removed += b - stop
            stop = b
        at = stop
    kept.append(body[at:])
    return len(body), removed, runs, b"".join(kept)


def remove_repeated(df: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``df`` with ``n_bytes``, ``n_removed``, ``n_spans`` and ``kept`` (the remaining bytes) added.

    Existing columns with those names are replaced.
    """
    from pyspark.sql.functions import pandas_udf

    added = ["n_bytes", "n_removed", "n_spans", "kept"]
    base = df.drop(*[c for c in df.columns if c.lower() in added])
    doc, th, rid, spans = (fresh(c, base.columns) for c in ("_doc", "_th", "_rid", "_spans"))
    listed = store(repeated_spans(df, id, text), "spans", sweep=True).toDF(doc, th, rid, spans)
    body = F.coalesce(quoted(text), F.lit(""))
    out = base.join(listed, quoted(id).eqNullSafe(F.col(doc)) & (F.xxhash64(body) == F.col(th)), "left")

    @pandas_udf("n_bytes long, n_removed long, n_spans long, kept binary")
    def cut(bodies: pd.Series, ranges: pd.Series, copies: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([_cut(*row) for row in zip(bodies, ranges, copies)], columns=["n_bytes", "n_removed", "n_spans", "kept"])

    held = fresh("_cut", out.columns)
    done = out.withColumn(held, cut(body.cast("binary"), F.col(spans), F.col(rid).isNull()))
    return done.select(*[quoted(c) for c in base.columns], *[F.col(held)[c].alias(c) for c in added])


def drop_repeated(df: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``df`` with the repeated bytes taken out of its text, all its columns kept.

    A character that loses some of its bytes goes as a whole.  A null text stays null.
    """
    from pyspark.sql.functions import pandas_udf

    @pandas_udf("string")
    def readable(kept: pd.Series) -> pd.Series:
        return pd.Series([raw.decode("utf-8", "ignore") for raw in kept], dtype=object)

    plain, renamed = positional(df)
    out = remove_repeated(plain, renamed[id], renamed[text])
    body = F.col(renamed[text])
    left = F.when(body.isNotNull() & (F.col("n_removed") > 0), readable("kept")).otherwise(body)
    return out.select(*[(left if c == text else F.col(n)).alias(c) for c, n in renamed.items()])
