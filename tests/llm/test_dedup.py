"""Quality rules, fuzzy lines, near-duplicates, repeated passages and components."""

import hashlib
import random
import time
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from siltworks.llm import lines, minhash, quality, suffixes
from siltworks.llm.components import bucket_links, components
from siltworks.llm.tables import store

from .helpers import DOCUMENTS, awkward_texts, documents, prose, roots, sentence, words_of


@pytest.mark.parametrize("shape", ["chain", "star", "random", "none"])
def test_components(spark, shape):
    rng = random.Random(5)
    n = 120
    pairs = {
        "chain": [(i, i + 1) for i in range(n - 1) if i % 40],
        "star": [(0, i) for i in range(1, n, 2)] + [(3, 3)],
        "random": [(rng.randrange(n), rng.randrange(n)) for _ in range(70)] * 2,
        "none": [],
    }[shape]
    want = roots(n, pairs)
    got = components(spark.createDataFrame(pairs, "a long, b long"), "a", "b").collect()
    touched = {x for p in pairs if p[0] != p[1] for x in p}
    assert {r["id"]: r["root"] for r in got} == {i: want[i] for i in touched}


def test_bucket_links_lose_no_component(spark):
    """Groups whose first member is linked to some others only."""
    rng = random.Random(2)
    rows = [(b, i, rng.randrange(40)) for b in range(12) for i in rng.sample(range(60), 14)]
    value = {}
    rows = [(b, i, value.setdefault(i, v)) for b, i, v in rows]
    df = store(spark.createDataFrame(rows, "bucket long, id long, v long"), "rows")
    close = lambda a, b: F.abs(F.col(a + "v") - F.col(b + "v")) <= 2
    got = bucket_links(df, ["bucket"], "id", close).collect()
    members = defaultdict(list)
    for b, i, v in rows:
        members[b].append((i, v))
    pairs = [(i, j) for g in members.values() for i, v in g for j, w in g if i < j and abs(v - w) <= 2]
    assert all(abs(value[r["a"]] - value[r["b"]]) <= 2 for r in got)
    assert roots(60, [(r["a"], r["b"]) for r in got]) == roots(60, pairs)


def base_statistics(text):
    words = words_of(text)
    grams = Counter(zip(words, words[1:], words[2:]))
    covered = {i + k for i, g in enumerate(zip(words, words[1:], words[2:])) if grams[g] > 1 for k in range(3)}
    filled = [x for x in (text or "").split("\n") if words_of(x)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(filled) - len(set(filled)), len(covered))


def test_statistics(spark):
    extra = [(300, "a b c a b c a b c"), (301, "x\n\nx\n \n \nx y"), (302, "#*$%&|<>"), (303, "a a a a a a"), (304, "\x0b\x0c\r\x1c \x85")]
    rows = awkward_texts() + extra
    got = quality.statistics(documents(spark, rows)).collect()
    assert len(got) == len(rows)
    for r in got:
        assert tuple(r[c] for c in quality.STATISTICS) == base_statistics(r["text"]), r["text"]
        assert r["base_failed"] == (r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"])


def invented(rng, n=600):
    pool = [f"{a}{b}{c}" for a in "bdfgklm" for b in "aeiou" for c in ("n", "st", "r", "ld")]
    out = []
    for i in range(n):
        lines_ = [" ".join(rng.choice(pool) for _ in range(rng.randint(8, 14))).capitalize() + "." for _ in range(rng.randint(8, 30))]
        text = "\n".join(lines_)
        if i % 20 == 1:
            text = " ".join(w + rng.choice(["%%%", "***", "&&&"]) for w in text.split())
        if i % 20 == 2:
            text = " ".join(w.upper() + "!!" for w in text.split())
        if i % 20 == 3:
            text = text.replace(" ", " | ")
        out.append((i, text))
    return out


def test_outliers_go_and_clean_documents_stay(spark):
    rows = [(i, t, "en", "s1" if i % 3 else "s2", len(t), "x", i, "y", 0, "z") for i, t in invented(random.Random(4))]
    stats = store(quality.statistics(spark.createDataFrame(rows, DOCUMENTS)).drop("size"), "stats")
    kept = {r["doc_id"]: r["kept"] for r in quality.judge(stats).collect()}
    assert {i for i, k in kept.items() if not k} == {i for i in kept if i % 20 in (1, 2, 3)}


def test_repetition_alone_is_an_outlier(spark):
    """Documents that only repeat lines, or only words, go; each would pass the base rules."""
    clean = [(i, t) for i, t in invented(random.Random(8), 400) if i % 20 > 3]
    stats = quality.statistics(spark.createDataFrame([(i, t, "en", "s", len(t), "x", i, "y", 0, "z") for i, t in clean], DOCUMENTS)).drop("size")
    one = stats.filter("doc_id = 4")
    lines_only = one.withColumns({"doc_id": F.lit(-1).cast("long"), "n_lines": F.lit(20).cast("long"), "n_dup_lines": F.lit(15).cast("long")})
    words_only = one.withColumns({"doc_id": F.lit(-2).cast("long"), "n_repeat_words": F.floor(0.45 * F.col("n_words"))})
    kept = {r["doc_id"]: r["kept"] for r in quality.judge(store(stats.unionByName(lines_only).unionByName(words_only), "stats")).collect()}
    assert [i for i, k in kept.items() if not k and i < 0] == [i for i in kept if i < 0] and len(kept) == len(clean) + 2
    assert sum(not k for i, k in kept.items() if i >= 0) <= 0.01 * len(clean)


def test_leftovers_are_judged_by_their_language_or_the_whole_table(spark):
    texts = [t for i, t in invented(random.Random(9), 400) if i % 20 > 3]
    bad = " ".join(w + "%%%" for w in texts[0].split())
    small = [("en", "few", t) for t in texts[:5] + [bad]] + [("xx", None, t) for t in texts[5:8] + [bad]]
    rows = [("en", "s", t) for t in texts[10:]] + small
    data = [(i, t, lang, source, len(t), "x", i, "y", 0, "z") for i, (lang, source, t) in enumerate(rows)]
    stats = store(quality.statistics(spark.createDataFrame(data, DOCUMENTS)).drop("size"), "stats")
    got = quality.judge(stats).collect()
    assert len(got) == len(rows) and all(r["distance"] is not None for r in got)
    assert {r["doc_id"] for r in got if not r["kept"]} >= {i for i, (_, _, t) in enumerate(rows) if t == bad}
    assert sum(not r["kept"] for r in got) <= 2 + 0.01 * len(rows)


def test_concentration_matches_plain_steps(spark):
    """The estimate equals one computed row by row, with the same bins."""
    rng = np.random.default_rng(3)
    p = len(quality.FEATURES)
    values = np.round(rng.normal(size=(400, p)) @ rng.normal(size=(p, p)) * 300)
    values[:60] += 5000
    rows = store(spark.createDataFrame([("g", *map(float, v)) for v in values], "_group string, " + ", ".join(f"{n} double" for n in quality.FEATURES)), "rows")
    widen = quality._consistency(quality.SUPPORT, p)
    estimate = store(quality._factor(quality._start(rows), 1.0), "e")
    floor = np.diag([(s * quality.UNIT) ** 2 for s in quality.FEATURES.values()])
    q = np.percentile(values, [25, 50, 75], axis=0)
    mean, cov = q[1], np.diag(((q[2] - q[0]) / 1.349) ** 2) + floor
    for _ in range(3):
        estimate = store(quality._factor(quality._concentrate(rows, estimate), widen), "e")
        gap = values - mean
        d = (gap @ np.linalg.inv(cov) * gap).sum(1)
        bins = np.floor(np.log2(d + 1e-6) * 16)
        below = np.array([(bins < b).sum() for b in bins])
        inner = values[below < quality.SUPPORT * len(values)]
        mean = inner.mean(0)
        cov = np.cov(inner.T, bias=True) * widen + floor
    got = quality.with_distance(rows, estimate, "d").collect()
    gap = values - mean
    d = (gap @ np.linalg.inv(cov) * gap).sum(1)
    assert np.allclose(sorted(r["d"] for r in got), sorted(d), rtol=1e-6)
    assert d[:60].min() > d[60:].max()  # the planted rows do not pull the estimate


def test_quality_filter_keeps_columns_and_survives_little(spark):
    out = quality.quality_filter(documents(spark))
    assert out.columns == DOCUMENTS.fieldNames()
    want = Counter((i, t) for i, t in awkward_texts() if not (lambda s: s[0] < 50 or 100 * s[4] > 50 * s[0])(base_statistics(t)))
    assert Counter((r["doc_id"], r["text"]) for r in out.collect()) == want  # too few rows for an estimate
    assert quality.quality_filter(documents(spark, [])).count() == 0


def plain_norm(line):
    return "".join(c if c.isalpha() or c.isnumeric() else " " for c in line.lower()).split()


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def line_corpus(rng):
    pool = [sentence(rng, 14) for _ in range(12)]
    docs = []
    for i in range(40):
        chosen = [rng.choice(pool) for _ in range(3)] + [sentence(rng, 10)]
        chosen = [x.upper() if rng.random() < 0.2 else x + "!!" if rng.random() < 0.2 else x for x in chosen]
        chosen += ["short", "", rng.choice(pool)[:-4] + rng.choice("abc") + "x."]
        docs.append((i, "\n".join(chosen)))
    return docs


def test_lines_against_edit_similarity(spark):
    """Groups are those of edit similarity alone; hashes play no part in what is expected."""
    docs = line_corpus(random.Random(11))
    got = {r["doc_id"]: r for r in lines.dedup_lines(documents(spark, docs)).collect()}
    places = [(i, k, " ".join(plain_norm(x))) for i, t in docs for k, x in enumerate(t.split("\n"))]
    eligible = [(i, k, n) for i, k, n in places if len(n) >= lines.MIN_CHARS]
    texts = sorted({n for *_, n in eligible})
    pairs = [
        (a, b)
        for a in range(len(texts))
        for b in range(a + 1, len(texts))
        if abs(len(texts[a]) - len(texts[b])) <= 9
        and distance(texts[a], texts[b]) <= (1 - lines.SIMILARITY) * max(len(texts[a]), len(texts[b])) + 1e-9
    ]
    assert pairs
    group = dict(zip(texts, roots(len(texts), pairs)))
    first = {}
    for i, k, n in sorted(eligible):
        first.setdefault(group[n], (i, k))
    lost = {(i, k) for i, k, n in eligible if first[group[n]] != (i, k)}
    for i, t in docs:
        want = [x for k, x in enumerate(t.split("\n")) if (i, k) not in lost]
        assert got[i]["text"] == "\n".join(want)
        assert (got[i]["n_lines"], got[i]["n_removed"]) == (len(t.split("\n")), len(t.split("\n")) - len(want))


def typo(rng, line):
    at = rng.choice([k for k, c in enumerate(line) if c.isalpha()])
    return line[:at] + rng.choice("qxzj".replace(line[at], "")) + line[at + 1 :]


def near_lines(rng):
    """(kind, line, edited line): all with an edit similarity over 0.9."""
    words = ["".join(rng.choice("bcdfghklmnprst") + rng.choice("aeiou") for _ in range(rng.randint(1, 4))) for _ in range(2000)]
    pick = lambda n: " ".join(rng.choice(words) for _ in range(n))
    alone = lambda first, last, n: "".join(chr(rng.randrange(first, last)) for _ in range(n))
    out = []
    for n in (5, 7, 10, 14, 20, 50, 100):
        out += [(f"typo {n}", x, typo(rng, x)) for x in (pick(n) for _ in range(30)) if len(x) >= 20]
    for n in (10, 20, 50):
        for k, x in enumerate(pick(n) for _ in range(60)):
            at = x.index(" ", rng.randrange(len(x) // 2))
            out.append((f"word {n}", x, x[:at] + " new" + x[at:]) if k % 2 else (f"lost space {n}", x, x[:at] + x[at + 1 :]))
    for name, first, last in (("han", 0x4E00, 0x5E00), ("thai", 0x0E01, 0x0E2F)):
        for n in (40, 120):
            for x in (alone(first, last, n) for _ in range(30)):
                at = rng.randrange(n)
                out.append((f"{name} {n}", x, x[:at] + chr(ord(x[at]) + 1) + x[at + 1 :]))
    return out


def test_recall_of_lines_with_one_edit(spark):
    cases = near_lines(random.Random(5))
    docs = [(2 * k + side, case[1 + side]) for k, case in enumerate(cases) for side in (0, 1)]
    got = {r["doc_id"]: r["n_removed"] for r in lines.dedup_lines(documents(spark, docs)).collect()}
    assert not any(got[2 * k] for k in range(len(cases)))  # no line is removed for another family's sake
    total, found = Counter(c[0] for c in cases), Counter()
    for k, case in enumerate(cases):
        found[case[0]] += got[2 * k + 1]
    assert sum(found.values()) >= 0.95 * len(cases)
    assert {kind: (found[kind], n) for kind, n in total.items() if found[kind] < 0.85 * n} == {}


def test_blocks_are_majorities_of_their_groups(spark):
    rng = random.Random(8)
    rows = [(k, [f"w{rng.randrange(500)}" for _ in range(rng.choice([0, 1, 4, 30, 300]))]) for k in range(12)] + [(99, None)]
    frame = lines.with_blocks(spark.createDataFrame(rows, "k int, words array<string>"), ["k"], "words")
    got = {r["k"]: [r[f"b{g}"] for g in range(lines.GROUPS)] for r in frame.collect()}
    assert got[99] == [0] * lines.GROUPS
    for k, words in rows[:-1]:
        hashes = [xxhash.xxh64_intdigest(w.encode(), 42) for w in words]
        for g in range(lines.GROUPS):
            mine = [h for h in hashes if (h - (1 << 64) if h >> 63 else h) % lines.GROUPS == g]
            want = min(len(mine), 63) << 56
            for plane, shift in enumerate((0, 3, 6)):
                for lane in range(7):
                    if 2 * sum(h >> (8 * lane + shift) & 1 for h in mine) > len(mine):
                        want |= 1 << (8 * lane + 7 - plane)
            assert got[k][g] == want


def test_very_long_lines(spark):
    rng = random.Random(9)
    words = [f"w{rng.randrange(10**6)}" for _ in range(20_000)]
    texts = [" ".join(words), " ".join(words[:777] + ["new"] + words[778:]), " ".join(["same"] * 60_000), "x" * 100_000]
    out = lines.dedup_lines(documents(spark, list(enumerate(texts)))).collect()
    assert {r["doc_id"]: r["n_removed"] for r in out} == {0: 0, 1: 1, 2: 0, 3: 0}


def test_long_lines_are_compared_by_words(spark):
    rng = random.Random(4)
    words = [f"w{i}x{rng.randrange(1000)}" for i in range(300)]
    texts = [" ".join(words)]
    for changed in (1, 3):
        copy = list(words)
        for i in range(changed):
            copy[50 * i] = f"new{i}{changed}"
        texts.append(" ".join(copy))
    near = spark.createDataFrame([(texts[0], t) for t in texts], "a string, b string").select(
        lines.edit_similar(lines.word_letters(F.col("a")), lines.word_letters(F.col("b")), 0.995).alias("near")
    )
    assert [r["near"] for r in near.collect()] == [True, True, False]
    out = lines.dedup_lines(documents(spark, list(enumerate([texts[0], texts[0] + " !!", texts[0].upper()])))).collect()
    assert {r["doc_id"]: r["n_removed"] for r in out} == {0: 0, 1: 1, 2: 1}


def test_long_lines_are_compared_by_small_limits_first(spark):
    """The same verdicts as the distance with its whole limit, which alone took twice the time and more."""
    rng = random.Random(11)
    text = lambda n: " ".join("".join(rng.choice("abcdeé") for _ in range(rng.randint(2, 9))) for _ in range(n))

    def edited(a, k):
        words = a.split(" ")
        for _ in range(k):
            words[rng.randrange(len(words))] = text(1)
        return " ".join(words)

    pairs = [(a, edited(a, k)) for n in (2, 20, 60, 200) for k in (0, 1, 3, n // 9, n // 7, n // 6) for a in (text(n), text(n))]
    pairs += [(text(n), text(n)) for n in (5, 60, 200)] + [("", ""), ("", "a"), (None, "a"), ("a", None)]
    long = [(a, edited(a, 3)) for a in (text(700) for _ in range(300))]
    allowed = F.floor(0.1 * F.greatest(F.length("a"), F.length("b")) + 1e-9).cast("int")
    plain = (F.abs(F.length("a") - F.length("b")) <= allowed) & (F.call_function("levenshtein", F.col("a"), F.col("b"), allowed) >= 0)
    bounded, took = lines.edit_similar(F.col("a"), F.col("b")), {}
    for rows in (pairs, long):
        df = spark.createDataFrame(rows, "a string, b string").coalesce(1).persist()
        df.count()
        got = {}
        for name, verdict in (("plain", plain), ("bounded", bounded)):
            begun = time.monotonic()
            got[name] = [r[0] for r in df.select(verdict).collect()]
            took[name] = time.monotonic() - begun
        assert got["plain"] == got["bounded"]
        df.unpersist()
    assert took["bounded"] < took["plain"] / 2


def test_words_bound_the_edit_distance(spark):
    """Never below the distance; exact enough for replaced words and one more or one less; null for other numbers of words."""
    rng = random.Random(3)
    pick = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 6)))
    rows = []
    for k in range(120):
        a = [pick() for _ in range(rng.randint(1, 30))]
        b = [pick() if rng.random() < 0.2 else w for w in a]
        if k % 3:
            b.insert(rng.randint(0, len(b)), pick())
        rows.append((" ".join(a), " ".join(b)) if k % 2 else (" ".join(b), " ".join(a)))
    rows += [("", ""), ("", "a"), ("a  b ", "a b"), ("a b c", "a"), (None, "a")]
    got = spark.createDataFrame(rows, "a string, b string").select("a", "b", lines._by_words(F.col("a"), F.col("b")).alias("n")).collect()
    for r in got[:120]:
        assert r["n"] >= distance(r["a"], r["b"])
    assert [r["n"] for r in got[120:]] == [0, 1, None, None, None]
    long = [pick() + "x" for _ in range(60)]
    changed = [*long[:9], "new", *long[10:30], "more", *long[30:50], "other", *long[51:]]
    near = spark.createDataFrame([(" ".join(long), " ".join(changed))], "a string, b string").select(lines._by_words(F.col("a"), F.col("b"))).first()[0]
    assert distance(" ".join(long), " ".join(changed)) <= near <= 20


def test_keys_of_blocks_are_compiled(spark):
    """The keys are taken apart in compiled code, and no line is filed under a null."""
    blocks = ", ".join(f"{k}{g} long" for k in "wp" for g in range(lines.GROUPS))
    many = [3 << 56] * lines.GROUPS
    df = spark.createDataFrame([(0, 30, *many, *[0] * 5), (1, 30, *[1 << 56] * 5, *[0] * 5)], f"pos long, size int, {blocks}")
    rows = lines.block_rows(df)
    assert "array_compact" not in rows._jdf.queryExecution().toString() and "filter(" not in rows._jdf.queryExecution().optimizedPlan().toString()
    got = rows.collect()
    assert all(r["key"] is not None for r in got)
    assert {r["pos"] for r in got} == {0} and len({r["key"] for r in got}) == len(got) >= 10


def test_pivots_connect_what_all_pairs_connect(spark):
    """A bucket with more lines than pivots: a chain of edits, lines far from all, rows already of one component."""
    rng = random.Random(8)
    line = sentence(rng, 14)
    texts = [line]
    for k in range(30):
        words = texts[-1].split(" ")
        words[k % len(words)] = words[k % len(words)][::-1]
        texts.append(" ".join(words) if k % 11 else sentence(rng, 14))
    left = [(key, i, min(i, 3) if i < 6 else i) for key in (1, 2) for i in range(len(texts)) if key == 1 or i % 3]
    frame = spark.createDataFrame([(i, x, None) for i, x in enumerate(texts)], "pos long, norm string, words string")
    found = lines._found_between(spark.createDataFrame(left, "key long, pos long, root long"), frame, 0.9).collect()
    near = lambda x, y: distance(x, y) <= int(0.1 * max(len(x), len(y)) + 1e-9)
    pairs = {(a, b) for a in range(len(texts)) for b in range(a) if near(texts[a], texts[b])}
    assert {(r["b"], r["a"]) for r in found} <= pairs and found
    known = [(i, min(i, 3)) for i in range(6)]
    assert roots(len(texts), [(r["a"], r["b"]) for r in found] + known) == roots(len(texts), [*pairs, *known])


def test_lines_awkward(spark):
    out = lines.drop_repeated_lines(documents(spark))
    assert out.columns == DOCUMENTS.fieldNames()
    rows = {(r["doc_id"], r["rid"]): r["text"] for r in out.collect()}
    assert len(rows) == len(awkward_texts())
    assert rows[1, 0] == awkward_texts()[0][1] and rows[2, 1] == ""
    assert rows[4, 3] is None and rows[5, 4] == "" and rows[7, 6] == rows[8, 7] == "one"
    assert lines.dedup_lines(documents(spark, [])).count() == 0


def shingle_set(text):
    words = (text or "").lower().split()
    size = min(5, len(words))
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)} if size else set()


def near_corpus(rng):
    docs = []
    for family in range(12):
        base = prose(rng, 12).split(" ")
        for _ in range(rng.randint(1, 6)):
            words = list(base)
            for _ in range(rng.choice([0, 1, 2, 3, 12])):
                words[rng.randrange(len(words))] = rng.choice("alpha beta gamma delta".split())
            docs.append(" ".join(words))
    return list(enumerate(docs)) + [(500 + i, t) for i, t in enumerate(["", None, "  ", "one two", "One  two", "one"])]


def test_minhash_classes_against_all_pairs(spark):
    docs = near_corpus(random.Random(6))
    sets = [shingle_set(t) for _, t in docs]
    pairs = [
        (a, b)
        for a in range(len(docs))
        for b in range(a)
        if (len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]) if sets[a] and sets[b] else not sets[a] and not sets[b])
    ]
    want = roots(len(docs), pairs)
    got = {r["doc"]: r for r in minhash.classes(documents(spark, docs)).collect()}
    for k, (i, _) in enumerate(docs):
        assert got[i]["class_id"] == min(docs[j][0] for j in range(len(docs)) if want[j] == want[k])
        assert got[i]["first"] == (got[i]["class_id"] == i)


@pytest.mark.parametrize("rows", [1000, 7])
def test_open_buckets_are_compared_in_slices(spark, monkeypatch, rows):
    """One bucket of texts around the limit: the same components as all pairs give, and few links."""
    monkeypatch.setattr(minhash, "SLICE_ROWS", rows)
    rng = random.Random(21)
    base = [f"w{k}" for k in range(120)]
    texts = []
    for _ in range(60):
        words = list(base)
        for at in rng.sample(range(120), rng.choice([1, 2, 3, 4, 5])):
            words[at] = f"x{rng.randrange(10**6)}"
        texts.append(" ".join(words))
    sets = [shingle_set(t) for t in texts]
    pairs = [(a, b) for a in range(60) for b in range(a) if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])]
    signed = store(minhash.signatures(documents(spark, list(enumerate(texts))), "doc_id", "text"), "signed")
    number = {r["content"]: int(r["doc"]) for r in signed.collect()}
    bucket = signed.select(F.lit(5).cast("long").alias("key"), F.col("content").alias("id"), F.col("content").alias("root"), "n", *minhash._PLANES)
    wanted = signed.select("content", "doc", "th")
    found = minhash._shingle_sets(documents(spark, list(enumerate(texts))), wanted, "doc_id", "text")
    got = [(number[r["a"]], number[r["b"]]) for r in minhash._links_between(store(bucket, "bucket"), store(found, "sets")).collect()]
    assert {tuple(sorted(p)) for p in got} <= {tuple(sorted(p)) for p in pairs}
    assert roots(60, got) == roots(60, pairs) and len(set(roots(60, pairs))) > 1
    slices = -(-60 // rows)
    assert len(got) < 60 * slices


def test_a_line_repeated_many_times_does_not_hide_a_near_copy(spark):
    rng = random.Random(12)
    docs = []
    for i in range(20):
        words = [f"w{i}x{k}" for k in range(304)]
        at = rng.randrange(280)
        copy = words[:at] + words[at : at + 10] * 30 + words[at + 10 :]
        sets = [shingle_set(" ".join(w)) for w in (words, copy)]
        assert len(sets[0] & sets[1]) >= 0.95 * len(sets[0] | sets[1])
        docs += [(2 * i, " ".join(words)), (2 * i + 1, " ".join(copy))]
    got = {r["doc"]: r["class_id"] for r in minhash.classes(documents(spark, docs)).collect()}
    assert got == {i: i - i % 2 for i, _ in docs}


def test_probability_jaccard_is_estimated():
    rng = np.random.default_rng(1)
    agree = []
    for _ in range(60):
        elements = rng.integers(0, 2**63, 80).astype(np.uint64)
        a, b = rng.integers(1, 6, (2, 80))
        a[:15], b[-15:] = 0, 0
        x, y = (minhash.signature(elements[w > 0], w[w > 0]) for w in (a, b))
        both = (a > 0) & (b > 0)
        exact = sum(1 / np.maximum(a / a[i], np.divide(b, b[i])).sum() for i in np.flatnonzero(both))
        agree.append((x == y).mean() - exact)
    assert abs(np.mean(agree)) < 0.01


def test_near_duplicates_awkward(spark):
    out = minhash.drop_near_duplicates(documents(spark))
    assert out.columns == DOCUMENTS.fieldNames()
    got = Counter((r["doc_id"], r["text"]) for r in out.collect())
    assert max(got.values()) == 1
    assert (1, awkward_texts()[0][1]) in got and not {2, 3, 200, 8} & {i for i, _ in got}
    assert sum(not (t or "").split() for _, t in got) == 1  # empty texts are copies
    assert minhash.drop_near_duplicates(documents(spark, [])).count() == 0
    repeated = documents(spark, [(1, "some text of five words")] * 3)
    assert minhash.drop_near_duplicates(repeated).count() == 1


def plain_removal(docs):
    """docs in corpus order as bytes; (kept, runs) of each."""
    seen, out = set(), []
    for body in docs:
        covered = bytearray(len(body))
        for p in range(len(body) - 99):
            window = body[p : p + 100]
            if window in seen:
                covered[p : p + 100] = b"\1" * 100
            seen.add(window)
        runs = sum(c and not (i and covered[i - 1]) for i, c in enumerate(covered))
        out.append((bytes(x for x, c in zip(body, covered) if not c), runs))
    return out


def passage_corpus(rng):
    shared = [prose(rng, 3) for _ in range(4)]
    docs = []
    for i in range(40):
        parts = [prose(rng, rng.randint(0, 3)), rng.choice(shared)[rng.randint(0, 60) :], prose(rng, 1)]
        if i % 7 == 0:
            parts.append(parts[1])
        docs.append((i, "\n".join(parts)))
    docs += [(90, docs[3][1]), (91, "ü" * 400), (92, "x" * 99), (93, "x" * 100), (94, "x" * 100), (95, ""), (96, None), (97, "ab" * 300)]
    return docs


@pytest.mark.parametrize("hot", [2, 50_000])
def test_passages_against_plain_version(spark, monkeypatch, hot):
    monkeypatch.setattr(suffixes, "HOT_ENTRIES", hot)
    docs = passage_corpus(random.Random(9))
    got = {r["doc_id"]: r for r in suffixes.remove_repeated(documents(spark, docs)).collect()}
    bodies = [(t or "").encode() for _, t in docs]
    for (i, _), body, (kept, runs) in zip(docs, bodies, plain_removal(bodies)):
        r = got[i]
        assert (bytes(r["kept"]), r["n_spans"]) == (kept, runs), i
        assert (r["n_bytes"], r["n_removed"]) == (len(body), len(body) - len(kept))


def test_long_texts_are_worked_on_in_pieces(monkeypatch):
    monkeypatch.setattr(suffixes, "CHUNK", 300)
    rng = random.Random(3)
    texts = [prose(rng, 20).encode(), b"short", prose(rng, 6).encode() * 3]
    found = defaultdict(set)
    for data, ids, rows, place, at, n in suffixes.entries(texts):
        for row, p, a, k in zip(rows.tolist(), place.tolist(), at.tolist(), n.tolist()):
            for o in range(k):
                assert data[a + o : a + o + 100].tobytes() == texts[row][p + o : p + o + 100]
                found[row].add(p + o)
    assert {r: len(v) for r, v in found.items()} == {0: len(texts[0]) - 99, 2: len(texts[2]) - 99}


def test_passages_awkward(spark):
    out = suffixes.drop_repeated(documents(spark))
    assert out.columns == DOCUMENTS.fieldNames()
    rows = {r["rid"]: r["text"] for r in out.collect()}
    assert len(rows) == len(awkward_texts())
    assert rows[0] == awkward_texts()[0][1] and rows[1] == "" and rows[3] is None and rows[4] == ""
    assert suffixes.remove_repeated(documents(spark, [])).count() == 0


def test_hash_of_kept_bytes(spark):
    r = suffixes.remove_repeated(documents(spark, [(1, "é" * 120)])).select(F.sha2("kept", 256).alias("h"), "n_removed").first()
    kept = plain_removal([("é" * 120).encode()])[0][0]
    assert r["h"] == hashlib.sha256(kept).hexdigest()
