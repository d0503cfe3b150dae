"""Near-duplicate documents by ProbMinHash, banding and exact verification.

Texts become sets of five-word shingles (lower case, words split at white space; a text of
one to four words is one shingle).  Every shingle of a text has the same weight however often
it occurs, so registers estimate the set similarity that is verified.
Every shingle is a Poisson process whose rate is its weight; each arrival falls into one of
``REGISTERS`` registers, and a register keeps the shingle that arrived first.  Elements
stop as soon as their next arrival is later than the latest register.  Two texts agree in a
register with the probability Jaccard similarity of their weighted sets.

Copies (equal word sequences) are collapsed before anything is joined.  The others share a
bucket when all registers of one of ``BANDS`` bands agree; pairs in a bucket whose sizes and
register bits allow it are verified on their whole shingle sets: Jaccard similarity of
``SIMILARITY`` or more links them.  Classes are the connected components of the links.
What a comparison with the central row leaves open in a bucket is compared slice by slice;
a pair of slices gives back the links that join components, never its pairs.

Defined results: null and empty texts and texts of white space only are copies of each
other; rows with null ids take part; a class is called by its least id, null if it has
none; of rows that agree in id and text one is kept; an empty table gives no rows; other
columns do not matter.  Word sequences are identified by a 64-bit hash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltworks.functions.joins import join_spread
from siltworks.llm.components import bucket_links, components
from siltworks.llm.tables import discard, fresh, quoted, store

WORDS, SIMILARITY = 5, 0.8
BANDS, ROWS = 32, 6
REGISTERS = BANDS * ROWS
#: registers that may differ in their two bits: 28.8 of 192 are expected at similarity 0.8
DIFFERING = 49
_PLANES = [f"s{k}" for k in range(6)]
#: rows and shingles in a slice of a bucket, on average
SLICE_ROWS, SLICE_SHINGLES = 1000, 1_000_000

_C = [np.uint64(c) for c in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB)]  # fixed mixing constants
_S27, _S30, _S31 = np.uint64(27), np.uint64(30), np.uint64(31)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    x = (x ^ (x >> _S30)) * _C[1]
    x = (x ^ (x >> _S27)) * _C[2]
    return x ^ (x >> _S31)


def shingles(words: np.ndarray) -> np.ndarray:
    """A 64-bit value per run of ``WORDS`` word hashes, in order; shorter texts have one."""
    size = min(WORDS, len(words))
    if not size:
        return np.zeros(0, np.uint64)
    out = np.full(len(words) - size + 1, size, np.uint64)
    for k in range(size):
        out = mixed(out * _C[0] + words[k : k + len(out)])
    return out


def signature(elements: np.ndarray, weights: np.ndarray, registers: int = REGISTERS) -> np.ndarray:
    """The element that arrives first in each register (ProbMinHash)."""
    first, winner = np.full(registers, np.inf), np.zeros(registers, np.uint64)
    active, rates, clock, step = elements, weights.astype(float), np.zeros(len(elements)), 0
    while len(active):
        ahead = max(1, min(4096 // len(active), 2048))
        count = np.arange(step + 1, step + ahead + 1, dtype=np.uint64)
        drawn = mixed(active[:, None] + count * _C[0])
        waits = -np.log(((drawn >> np.uint64(11)).astype(float) + 0.5) / (1 << 53))
        times = clock[:, None] + np.cumsum(waits, axis=1) / rates[:, None]
        place = (mixed(drawn + _C[0]) % np.uint64(registers)).astype(np.int64)
        row, column = np.nonzero(times < first[place])
        when, where = times[row, column], place[row, column]
        order = np.argsort(-when, kind="stable")  # the earliest arrival is written last
        first[where[order]] = when[order]
        winner[where[order]] = active[row[order]]
        clock, step = times[:, -1], step + ahead
        going = clock < first.max()  # the others have no arrival left that matters
        active, rates, clock = active[going], rates[going], clock[going]
    return winner


def bands(winner: np.ndarray) -> np.ndarray:
    grid = mixed(winner).reshape(BANDS, ROWS)
    key = mixed(np.arange(1, BANDS + 1, dtype=np.uint64))
    for k in range(ROWS):
        key = mixed(key * _C[0] + grid[:, k])
    return key.view(np.int64)


def register_bits(winner: np.ndarray) -> np.ndarray:
    """Two bits of every register: three words of first bits, then three of second bits."""
    scrambled = mixed(winner + _C[1])
    planes = [((scrambled >> np.uint64(k)) & np.uint64(1)).astype(np.uint8) for k in range(2)]
    return np.packbits(np.concatenate(planes)).view(np.int64)


def _words(known, text: str | None) -> tuple[list[str], np.ndarray]:
    words = (text or "").lower().split()
    return words, np.fromiter(map(known.__getitem__, words), np.uint64, len(words))


def _known():
    import xxhash

    from siltworks.llm.tokens import Remembered

    return Remembered(lambda word: xxhash.xxh64_intdigest(word.encode()))


def signatures(df: DataFrame, id: str, text: str) -> DataFrame:
    """(doc, th, content, n, keys, s0 ... s5) per row; ``doc`` is the id as text."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import xxhash

        known = _known()
        for batch in batches:
            content, sizes, keys, bits = [], [], [], []
            for value in batch["text"]:
                words, hashed = _words(known, value)
                content.append(xxhash.xxh64_intdigest(" ".join(words).encode()) - (1 << 63))
                elements = np.unique(shingles(hashed))
                sizes.append(len(elements))
                winner = signature(elements, np.ones(len(elements)))
                keys.append(bands(winner) if len(elements) else [])
                bits.append(register_bits(winner))
            out = batch[["doc", "th"]].assign(content=content, n=sizes, keys=keys)
            for k, plane in enumerate(_PLANES):
                out[plane] = [b[k] for b in bits]
            yield out

    rows = df.select(quoted(id).cast("string").alias("doc"), F.xxhash64(quoted(text)).alias("th"), quoted(text).alias("text"))
    return rows.mapInPandas(run, "doc string, th long, content long, n long, keys array<long>, " + ", ".join(f"{p} long" for p in _PLANES))


def _shingle_sets(df: DataFrame, wanted: DataFrame, id: str, text: str) -> DataFrame:
    """(content, set): the distinct shingles of one text per wanted content."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = _known()
        for batch in batches:
            sets = [np.unique(shingles(_words(known, value)[1])).view(np.int64) for value in batch["text"]]
            yield pd.DataFrame({"content": batch["content"], "set": sets})

    rows = df.select(quoted(id).cast("string").alias("doc"), F.xxhash64(quoted(text)).alias("th"), quoted(text).alias("text"))
    same = rows["doc"].eqNullSafe(wanted["doc"]) & (rows["th"] == wanted["th"])
    # one plan at every size: texts are shuffled once, whatever the number of wanted ones
    found = rows.join(wanted.hint("merge"), same).select("content", "text").groupBy("content").agg(F.first("text").alias("text"))
    return found.mapInPandas(run, "content long, set array<long>")


def _plausible(a: str, b: str) -> Column:
    small, large = F.least(a + "n", b + "n"), F.greatest(a + "n", b + "n")
    apart = [F.col(a + p).bitwiseXOR(F.col(b + p)) for p in _PLANES]
    differing = sum((F.bit_count(apart[k].bitwiseOR(apart[k + 3])) for k in range(3)), F.lit(0))
    return (small >= SIMILARITY * large) & (differing <= DIFFERING)


def _groups(batches: Iterator[pd.DataFrame], keys: list[str]) -> Iterator[pd.DataFrame]:
    """The groups of rows sorted by ``keys``, each whole, also where batches cut them."""
    held = None
    for batch in batches:
        if held is not None:
            batch = pd.concat([held, batch], ignore_index=True)
        if not len(batch):
            continue
        values = batch[keys].to_numpy()
        cuts = np.flatnonzero((values[1:] != values[:-1]).any(axis=1)) + 1
        for a, b in zip([0, *cuts], cuts):
            yield batch.iloc[a:b]
        held = batch.iloc[cuts[-1] if len(cuts) else 0 :]
    if held is not None:
        yield held


def _open_pairs(group: pd.DataFrame) -> Iterator[tuple[int, np.ndarray]]:
    """(a, later rows that may be near it and have another root) of two slices, or of one."""
    n, root, part = (group[c].to_numpy() for c in ("n", "root", "part"))
    planes = np.ascontiguousarray(group[_PLANES].to_numpy()).view(np.uint64)
    two = group["low"].iat[0] != group["high"].iat[0]
    for a in range(len(group) - 1):
        size = n[a + 1 :]
        apart = planes[a + 1 :] ^ planes[a]
        differing = np.bitwise_count(apart[:, :3] | apart[:, 3:]).sum(axis=1)
        near = (np.minimum(size, n[a]) >= SIMILARITY * np.maximum(size, n[a])) & (differing <= DIFFERING)
        near &= root[a + 1 :] != root[a]
        if two:
            near &= part[a + 1 :] != part[a]
        if near.any():
            yield a, np.flatnonzero(near) + a + 1


def _spanning(group: pd.DataFrame) -> list[tuple[int, int]]:
    """Verified links that join what other links of the group have not joined yet."""
    id, root = group["id"].tolist(), group["root"].tolist()
    sizes = group["set"].map(len).to_numpy()
    ends = np.cumsum(sizes)
    values, codes = np.unique(np.concatenate(group["set"].tolist()), return_inverse=True)
    sets = [codes[e - k : e] for e, k in zip(ends, sizes)]
    parent = {r: r for r in root}

    def top(r):
        while parent[r] != r:
            parent[r] = r = parent[parent[r]]
        return r

    links, present = [], np.zeros(len(values), bool)
    for a, others in _open_pairs(group):
        present[sets[a]] = True
        for b in others.tolist():
            x, y = top(root[a]), top(root[b])
            if x != y:
                common = np.count_nonzero(present[sets[b]])
                if common >= SIMILARITY * (sizes[a] + sizes[b] - common):
                    links.append((id[a], id[b]))
                    parent[x] = y
        present[sets[a]] = False
    return links


def _links_between(rows: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b): links between rows of one bucket with different roots, fewer than rows per pair of slices.

    ``rows`` is a stored table.  Buckets are cut into slices by a hash of the id, and a task holds two
    slices at a time.  Shingle sets travel only with rows that have a possible partner there.
    """
    held = rows.groupBy("key").agg(F.greatest(F.count(F.lit(1)) / SLICE_ROWS, F.sum("n") / SLICE_SHINGLES).alias("slices"))
    held = held.select("key", F.ceil("slices").cast("int").alias("slices"))
    cut = join_spread(rows.select("key", "id", "root", "n", *_PLANES), held, ["key"], "inner")
    cut = cut.withColumn("part", F.pmod(F.xxhash64(F.lit(3), "id"), "slices").cast("int"))
    # a row meets its own slice and, in pairs, every other one
    cut = cut.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("slices") - 1))).drop("slices")
    cut = cut.select(F.least("part", "other").alias("low"), F.greatest("part", "other").alias("high"), "*").drop("other")
    place = ["key", "low", "high"]

    def possible(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for group in _groups(batches, place):
            alive = np.zeros(len(group), bool)
            for a, others in _open_pairs(group):
                alive[a] = True
                alive[others] = True
            if alive.any():
                yield group[alive]

    def spanning(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for group in _groups(batches, place):
            yield pd.DataFrame(_spanning(group), columns=["a", "b"], dtype="int64")

    together = lambda df: df.repartition(*[F.col(c) for c in place]).sortWithinPartitions(*place)
    alive = store(together(cut).mapInPandas(possible, cut.schema), "open-rows", sweep=True)
    whole = alive.join(sets.withColumnRenamed("content", "id"), "id")
    return together(whole).mapInPandas(spanning, "a long, b long")


def classes(df: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc, th, class_id, first): a row per row of ``df``.

    ``doc`` is the id as text and ``th`` the hash of the text; ``first`` tells whether the
    row is the one of its class that stays (the least id, null first, then the least text hash).
    """
    kind = df.schema[id].dataType
    signed = store(signatures(df, id, text), "signatures", sweep=True)
    texts = signed.groupBy("content").agg(
        F.min(F.struct(F.col("doc").cast(kind).alias("doc"), "th")).alias("at"),
        *[F.first(c).alias(c) for c in ("n", *_PLANES, "keys")],
    )
    texts = store(texts, "distinct-texts", sweep=True)
    keyed = texts.select(F.explode("keys").alias("key"), F.col("content").alias("id"))
    shared = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("members")).filter("members > 1")
    narrow = store(keyed.join(shared, "key"), "shared-keys")
    # the text that others were copied from shares most buckets with most texts
    central = narrow.groupBy("id").agg((-F.sum("members")).alias("rank"))
    about = texts.select(F.col("content").alias("id"), "n", *_PLANES).join(central, "id")
    rows = store(narrow.drop("members").join(about, "id"), "bucket-rows", sweep=True)
    wanted = narrow.select(F.col("id").alias("content")).distinct().join(texts.select("content", "at"), "content")
    wanted = wanted.select("content", F.col("at.doc").cast("string").alias("doc"), F.col("at.th").alias("th"))
    sets = store(_shingle_sets(df, store(wanted, "bucket-texts"), id, text), "shingle-sets", sweep=True)
    discard(narrow)

    def verified(pairs: DataFrame) -> DataFrame:
        side = lambda p: sets.select(F.col("content").alias(p), F.col("set").alias(f"{p}_set"))
        both = pairs.join(side("a"), "a").join(side("b"), "b")
        common = F.size(F.array_intersect("a_set", "b_set"))
        return both.filter(common >= SIMILARITY * (F.size("a_set") + F.size("b_set") - common)).select("a", "b")

    between = lambda left: _links_between(left, sets)
    roots = components(bucket_links(rows, ["key"], "id", _plausible, verified, "rank", between), "a", "b")
    linked = signed.select(F.col("doc").cast(kind).alias("doc"), "th", "content").join(
        roots.withColumnRenamed("id", "content"), "content", "left"
    )
    grouped = store(linked.select("doc", "th", F.coalesce("root", "content").alias("root")), "document-roots")
    heads = grouped.groupBy("root").agg(F.min("doc").alias("class_id"), F.min(F.struct("doc", "th")).alias("head"))
    placed = join_spread(grouped, heads, ["root"], "inner")
    return placed.select("doc", "th", "class_id", (F.struct("doc", "th") == F.col("head")).alias("first"))


def drop_near_duplicates(df: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``df`` without near copies: one row of every class stays."""
    found = classes(df, id, text).filter("first").groupBy("doc", "th").agg(F.count(F.lit(1)).alias("copies"))
    doc, th, copies = (fresh(c, df.columns) for c in ("_doc", "_th", "_copies"))
    kept = store(found, "kept-documents").toDF(doc, th, copies)
    same = quoted(id).eqNullSafe(F.col(doc)) & (F.xxhash64(quoted(text)) == F.col(th))
    joined = df.join(kept, same)
    columns = [quoted(c) for c in df.columns]
    single = joined.filter(F.col(copies) == 1).select(*columns)
    repeated = joined.filter(F.col(copies) > 1).dropDuplicates([doc, th]).select(*columns)
    return single.unionByName(repeated)
