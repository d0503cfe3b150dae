"""WARC archives, the Merkle audit, Hilbert neighbours, and the registered queries together."""

import glob
import gzip
import hashlib
import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from siltworks.functions.scratch import new_path
from siltworks.llm import neighbours, warc
from siltworks.llm.catalog import ORACLES, QUERIES
from siltworks.llm.tables import store

PAGES = "page_id long, url string, html string, archive string, name string"


def pages(n=300, seed=1):
    rng = random.Random(seed)
    rows = [(i, f"http://x.example/{i}", f"<p>{'ü' * rng.randint(0, 40)}\r\n\r\n{rng.random()}</p>", "x", "y") for i in range(n)]
    return rows + [(None, None, None, None, None), (5, "a\r\nb", "", "x", "y"), (7, "same", "same", "x", "y"), (7, "same", "same", "x", "y"), (8, "long", "z" * 300000, "x", "y")]


def replica(spark, records):
    path = new_path(spark, "replica")
    warc.write_archives(records, path)
    return path, store(warc.read_archives(spark, path), "leaves")


def test_archives_round_trip(spark):
    rows = pages()
    records = warc.records(spark.createDataFrame(rows, PAGES), archive_bytes=4000)
    path, leaves = replica(spark, records)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.gz").load(path).collect()
    found = []
    for f in files:
        data = gzip.decompress(bytes(f["content"]))
        assert data.endswith(b"\r\n\r\n") or not data
        for at, size, name, block in warc.parse(data):
            head = data[at : at + size].split(b"\r\n\r\n")[0].decode()
            assert head.startswith("WARC/1.0\r\n") and f"sha256:{hashlib.sha256(block).hexdigest()}" in head
            found.append((name, block.decode()))
    assert sorted(found) == sorted((f"urn:page:{'null' if i is None else i}", h or "") for i, _, h, *_ in rows)
    ends = {}
    for r in sorted(leaves.collect(), key=lambda r: (r["archive"], r["seq"])):
        assert r["offset"] == ends.get(r["archive"], 0)
        ends[r["archive"]] = r["offset"] + r["length"]
    assert len(ends) > 20 and leaves.count() == len(rows)


@pytest.mark.parametrize("hit", [[], [3], [0, 17, 150, 299]])
def test_audit_finds_exactly_the_damage(spark, hit):
    records = store(warc.records(spark.createDataFrame(pages(), PAGES), archive_bytes=20000), "records")
    names = [f"urn:page:{i}" for i in hit]
    damaged = records.withColumn("record", F.when(F.col("name").isin(names), F.overlay("record", F.lit("X"), F.lit(12))).otherwise(F.col("record")))
    (_, a), (_, b) = replica(spark, records), replica(spark, damaged)
    got = warc.audit(a, b).collect()
    assert sorted(r["name"] for r in got) == sorted(names)
    assert {r["status"] for r in got} <= {"changed"}


def test_audit_lost_and_added_records(spark):
    a = store(spark.createDataFrame([(0, i, 10 * i, 10, f"n{i}", f"d{i}") for i in range(40)], "archive long, seq long, offset long, length long, name string, digest string"), "a")
    b = store(a.filter("seq < 38").union(spark.createDataFrame([(1, 0, 0, 5, "new", "d")], a.schema)), "b")
    got = {(r["archive"], r["seq"]): r["status"] for r in warc.audit(a, b).collect()}
    assert got == {(0, 38): "lost", (0, 39): "lost", (1, 0): "added"}
    moved = store(a.withColumn("offset", F.col("offset") + F.when(F.col("seq") >= 39, 1).otherwise(0)), "moved")
    assert [r["seq"] for r in warc.audit(a, moved).collect()] == [39]


def leaves_of(spark, data):
    """Stored leaves of one archive whose gzip file holds ``data``."""
    rows = [(0, seq, at, size, name, hashlib.sha256(data[at : at + size]).hexdigest()) for seq, (at, size, name, _) in enumerate(warc.parse(data))]
    return store(spark.createDataFrame(rows, "archive long, seq long, offset long, length long, name string, digest string"), "leaves")


def records_of(spark, n=60):
    rows = spark.createDataFrame([(i, f"http://h/{i}", f"<p>page {i}\r\n\r\n text {'x' * i}</p>", "x", "y") for i in range(n)], PAGES)
    return [r["record"].encode() + b"\r\n\r\n" for r in warc.records(rows).orderBy(F.length("name"), "name").collect()]


@pytest.mark.parametrize("kind, want", [
    ("lost", {30: "lost"}),
    ("length", {30: "changed"}),
    ("start", {30: "changed"}),
    ("longer", {30: "changed"}),
    ("name", {30: "unreadable"}),
    ("added", {}),
])
def test_damage_in_mid_archive_is_told_from_what_it_moves(spark, kind, want):
    parts = records_of(spark)
    other = list(parts)
    match kind:
        case "lost":
            del other[30]
        case "length":
            other[30] = other[30].replace(b"Content-Length", b"Content-Lenght")
        case "start":
            other[30] = b"X" + other[30][1:]
        case "longer":
            other[30] = other[30][:-4] + b" more" + other[30][-4:]
        case "name":
            other[30] = other[30].replace(b"Record-ID", b"Record-IX")
        case "added":
            other.insert(30, other[3].replace(b"urn:page:3", b"urn:page:new"))
    got = warc.audit(leaves_of(spark, b"".join(parts)), leaves_of(spark, b"".join(other))).collect()
    assert {r["seq"]: r["status"] for r in got if r["offset"] is not None and r["status"] != "moved"} == want
    assert [r["other_name"] for r in got if r["status"] == "added"] == (["urn:page:new"] if kind == "added" else [])
    assert all(r["name"] == r["other_name"] for r in got if r["status"] in ("moved", "changed"))


@pytest.mark.parametrize("cut", [True, False])
def test_a_broken_stream_is_part_of_the_result(spark, cut):
    records = store(warc.records(spark.createDataFrame(pages(), PAGES), archive_bytes=20000), "records")
    path, a = replica(spark, records)
    archive = sorted(glob.glob(f"{path.removeprefix('file:')}/archive=*"))[1]
    [file] = glob.glob(f"{archive}/*.gz")
    content = bytearray(open(file, "rb").read())
    data, whole = warc.unzipped(bytes(content))
    assert whole and data == gzip.decompress(content) and warc.unzipped(bytes(content) * 2) == (data * 2, True)
    content = content[: len(content) // 2] if cut else content[:1000] + bytes([content[1000] ^ 16]) + content[1001:]
    broken = new_path(spark, "broken").removeprefix("file:")
    os.makedirs(f"{broken}/{os.path.basename(archive)}")
    with open(f"{broken}/{os.path.basename(archive)}/part.gz", "wb") as out:
        out.write(content)
    number = int(archive.rpartition("=")[2])
    whole = store(a.filter(F.col("archive") == number), "whole")
    b = store(warc.read_archives(spark, broken), "leaves")
    found = warc.audit(whole, b).collect()
    assert [r for r in found if r["status"] == "unreadable" and r["offset"] is None]  # the stream itself
    got = {r["seq"]: r["status"] for r in found if r["offset"] is not None}
    assert got and set(got.values()) <= {"changed", "unreadable", "moved"}
    # what lies before the damage is intact
    assert min(got) > 0 and (not cut or set(range(min(got) + 1, whole.count())) == {k for k, v in got.items() if v == "unreadable"} - {min(got)})
    assert warc.unzipped(b"") == (b"", False) and warc.unzipped(b"no gzip at all") == (b"", False)


def test_no_pages(spark):
    records = warc.records(spark.createDataFrame([], PAGES))
    (_, a), (_, b) = replica(spark, records), replica(spark, records)
    assert warc.audit(a, b).count() == 0


@pytest.mark.parametrize("width, bits", [(2, 4), (3, 3), (4, 2)])
def test_hilbert_curve_visits_neighbouring_cells(width, bits):
    cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * width), -1).reshape(-1, width)
    keys = neighbours.hilbert_keys(cells, bits)
    assert sorted(keys) == list(range(len(cells)))
    path = cells[np.argsort(keys)]
    assert (np.abs(np.diff(path, axis=0)).sum(1) == 1).all()


def brute(rows, every, k):
    ok = [(i, np.asarray(v, float)) for i, v in rows if i is not None and v is not None and None not in v and np.isfinite(np.asarray(v, float)).all() and np.any(np.asarray(v, float))]
    out = {}
    for i, v in ok:
        if i % every == 0:
            scored = sorted((-float((v * w).sum()), j) for j, w in ok if j != i)
            out[i] = [(j, -s) for s, j in scored[:k]]
    return out


def vectors(n, width, seed=0):
    rng = np.random.default_rng(seed)
    return [(i, v.astype(np.float32).tolist()) for i, v in enumerate(rng.normal(size=(n, width)) * rng.uniform(0.5, 2, (n, 1)))]


def search(spark, rows, **options):
    df = spark.createDataFrame([(i, v, 1, 2) for i, v in rows], "vec_id long, embedding array<float>, point int, curve int")
    got = {}
    for r in sorted(neighbours.nearest(df, **options).collect(), key=lambda r: (r["query_id"], r["rank"])):
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(got[r["query_id"]])
    return got


def test_small_tables_are_searched_exactly(spark):
    rows = vectors(300, 8)
    same = rows[4][1]
    rows += [(400 + i, same) for i in range(70)]  # ties
    rows += [(500, None), (501, [0.0] * 8), (520, [float("nan")] + [1.0] * 7), (540, [None] + [1.0] * 7), (560, [float("inf")] * 8), (None, same), (580, [1.0] * 3)]
    got, want = search(spark, rows), brute([r for r in rows if r[0] != 580], 20, 20)
    assert got.keys() == want.keys()
    for q in want:
        assert [j for j, _ in got[q]] == [j for j, _ in want[q]]
        assert np.allclose([s for _, s in got[q]], [s for _, s in want[q]], rtol=1e-12)


def test_few_or_no_vectors(spark):
    rows = vectors(5, 4)
    assert {q: len(v) for q, v in search(spark, rows).items()} == {0: 4}
    assert search(spark, []) == {}
    assert search(spark, [(1, [1.0, 2.0])]) == {}


def test_recall_over_blocks(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "BLOCK", 256)
    monkeypatch.setattr(neighbours, "MARGIN", 128)
    rows = vectors(3000, 16, seed=2)
    got, want = search(spark, rows), brute(rows, 20, 20)
    hits = sum(len({j for j, _ in got[q]} & {j for j, _ in want[q]}) for q in want)
    assert hits >= 0.9 * 20 * len(want)


def test_queries_are_searched_exactly_where_curves_fall_short(spark, monkeypatch):
    for name, value in {"BLOCK": 256, "MARGIN": 0, "ASKED": 40}.items():
        monkeypatch.setattr(neighbours, name, value)
    for name in ("LEAST_CURVES", "MOST_CURVES"):
        monkeypatch.setattr(neighbours, name, 3, raising=False)
    rows = vectors(1500, 32, seed=3)
    got, want = search(spark, rows), brute(rows, 20, 20)
    assert {q: [j for j, _ in v] for q, v in got.items()} == {q: [j for j, _ in v] for q, v in want.items()}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_queries_match_sql(spark, sf, name):
    import check

    assert check.compare(check.database(sf), QUERIES[name](spark, sf), ORACLES[name]) is None


def test_pipeline_stages(spark, sf):
    import corpus_pipeline

    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns, rows = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = store(stage(spark, docs, sf), "stage")
        assert docs.columns == columns
        assert 0.7 * rows < docs.count() <= rows, name
        assert docs.filter("n_chars <> char_length(text)").count() == 0
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, sf)
    assert packed.select("doc_id").distinct().count() == docs.count()
    assert packed.groupBy("sequence_id").agg(F.sum("length").alias("n")).filter("n > 2048").count() == 0
