"""Chat formatting, token shards, packing and byte-pair encoding."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from siltworks.functions.scratch import new_path
from siltworks.llm import binary, bpe, chat, packing
from siltworks.llm.tokens import TextEncoder, packed

from .helpers import awkward_texts, documents

BYTES, WORDS = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "word_bpe_49k.json"))
ODD = "a|b| |  |\n| \n|\n |\t| |é|É|ß|'s|'LL|12|½|!|?!|<|endoftext|>|İ|Σ|́|日本|\r\n|\x1c|՘|😀|ª| The|ing|aaaa|====".split("|")


def fuzz(n, seed=3):
    rng = random.Random(seed)
    pool = ODD + ["<|endoftext|>", "<|startoftext|>", "<|"]
    return ["".join(rng.choice(pool) for _ in range(rng.randint(0, 20))) for _ in range(n)]


@pytest.mark.parametrize("path", [BYTES, WORDS])
def test_chunked_ids_are_the_librarys(path):
    encoder = TextEncoder(path)
    for text in fuzz(4000) + [t for _, t in awkward_texts() if t]:
        assert encoder.encode(text) == packed(encoder.library.encode(text, add_special_tokens=False).ids), repr(text)


@pytest.mark.parametrize("path", [BYTES, WORDS])
def test_plain_texts_are_cut_at_once(path):
    """Every distinct word took a place as chunk and as piece, which was most of the time and of a worker's memory."""
    encoder, rng = TextEncoder(path), random.Random(5)
    alphabet = [chr(c) for c in range(0x21, 0x250) if not 0x7E < c < 0xA1] + list(" \n" * 60) + list("'strvemld012" * 4)
    texts = ["".join(rng.choices(alphabet, k=rng.randint(1, 60))) for _ in range(3000)] + ["İİ Ⱥb ŐƜ", "it's 'tis '' 12 x²", "  a \n b  "]
    for text in texts:
        assert encoder.encode(text) == packed(encoder.library.encode(text, add_special_tokens=False).ids), repr(text)
    assert not encoder.chunks and not encoder.spaced


def test_forgotten_chunks_are_encoded_again():
    encoder = TextEncoder(BYTES)
    for memory in (encoder.pieces, encoder.chunks, encoder.spaced):
        memory.limit = 3
    for text in fuzz(500):
        assert encoder.encode(text) == packed(encoder.library.encode(text, add_special_tokens=False).ids)
        assert max(map(len, (encoder.pieces, encoder.chunks, encoder.spaced))) <= 3


def test_prefix_encoding_and_decoding():
    encoder, decode, library = bpe.text_encoder(BYTES), bpe.decoder(BYTES), Tokenizer.from_file(BYTES)
    assert all(encoder.merge_piece.whole[i] for i in encoder.merge_piece.length)
    for text in fuzz(4000) + ["a" * 5000, "ab" * 3000, "." * 999] + [t for _, t in awkward_texts() if t]:
        ids = library.encode(text, add_special_tokens=False).ids
        assert encoder.encode(text) == packed(ids), repr(text)
        assert decode(packed(ids)) == library.decode(ids, skip_special_tokens=False)


def test_bpe_tables(spark):
    df = documents(spark)
    encoded = bpe.encode_texts(df, BYTES)
    library = Tokenizer.from_file(BYTES)
    want = Counter((i, packed(library.encode(t or "", add_special_tokens=False).ids)) for i, t in awkward_texts())
    assert Counter((r["doc_id"], bytes(r["ids"])) for r in encoded.collect()) == want
    back = bpe.decode_texts(encoded, BYTES)
    assert Counter((r["doc_id"], r["text"]) for r in back.collect()) == Counter((i, t or "") for i, t in awkward_texts())
    assert bpe.decode_texts(bpe.encode_texts(documents(spark, []), BYTES), BYTES).count() == 0


@pytest.mark.parametrize("n", [0, 1, 255, 256, 257, 5000])
@pytest.mark.parametrize("high", [1, 2, 40, 49000, 2**40, 2**63])
def test_word_coding_round_trip(n, high):
    ids = np.random.default_rng(n).integers(0, high, n, dtype=np.uint64)
    if n > 10:
        ids[3], ids[7] = 2**60, 2**64 - 1  # escapes
    words, first, exceptions = binary.pack(ids)
    assert (binary.unpack(words, first, exceptions, n) == ids).all()
    assert len(first) == -(-n // binary.BLOCK) + 1 and first[-1] == len(words)


def test_blocks_packed_in_slices_are_the_same(monkeypatch):
    rng = np.random.default_rng(4)
    ids = rng.integers(0, 1 << 20, 5000).astype(np.uint64)
    ids[rng.integers(0, 5000, 40)] = np.uint64((1 << 60) + 5)
    whole = binary.pack(ids)
    monkeypatch.setattr(binary, "SLICE", 2 * binary.BLOCK)
    for a, b in zip(whole, binary.pack(ids)):
        assert (a == b).all() and a.dtype == b.dtype
    assert (binary.unpack(*binary.pack(ids), 5000) == ids).all()
    assert [len(x) for x in binary.pack(ids[:0])] == [0, 1, 0]


def test_small_ids_share_words():
    words, _, _ = binary.pack(np.zeros(2560, np.uint64))
    assert len(words) <= 2560 // 60 + 10


def test_token_shards(spark):
    rows = awkward_texts()
    path = new_path(spark, "shards")
    binary.write_token_shards(documents(spark), path, WORDS, end=2, shard_ids=500)
    library = Tokenizer.from_file(WORDS)
    got = sorted((r["start"], r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in binary.token_index(spark, path).collect())
    assert [r[1] for r in got] == sorted([i for i, _ in rows], key=lambda i: (i is not None, i))
    ids = [packed([*library.encode(t or "", add_special_tokens=False).ids, 2]) for _, t in rows]
    assert Counter((i, len(b) // 4, zlib.crc32(b)) for (i, _), b in zip(rows, ids)) == Counter(r[1:] for r in got)
    at = 0
    for start, _, n, _ in got:
        assert start == at
        at += n
    stored = binary.read_token_shards(spark, path).collect()
    assert Counter(bytes(r["ids"]) for r in stored) == Counter(ids)
    assert len({(r["part"], r["seq"]) for r in stored}) > 3


def test_no_documents_no_shards(spark):
    path = new_path(spark, "shards")
    binary.write_token_shards(documents(spark, []), path, WORDS, end=2)
    assert binary.token_index(spark, path).count() == 0


def check_packing(rows, capacity):
    places = defaultdict(list)
    for r in rows:
        places[r["sequence_id"]].append((r["offset"], r["length"]))
    for held in places.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= capacity
    return len(places)


def test_packing(spark):
    rows = awkward_texts()
    library = Tokenizer.from_file(BYTES)
    found = packing.pack_documents(documents(spark), BYTES, end=0, capacity=64).collect()
    n = check_packing(found, 64)
    ids = [[*library.encode(t or "", add_special_tokens=False).ids, 0] for _, t in rows]
    want = Counter()
    for (i, _), x in zip(rows, ids):
        cuts = [0, *range(len(x) % 64 or 64, len(x) + 1, 64)] if len(x) > 64 else [0, len(x)]
        want.update((i, k, a, b - a, zlib.crc32(packed(x[a:b]))) for k, (a, b) in enumerate(zip(cuts, cuts[1:])))
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in found) == want
    assert n <= -(-sum(map(len, ids)) // 64) + 6
    assert packing.pack_documents(documents(spark, []), BYTES, end=0).count() == 0


@pytest.mark.parametrize("seed", range(6))
def test_plan_uses_every_piece_once(seed):
    rng = np.random.default_rng(seed)
    lengths = np.concatenate([rng.integers(1, 2049, 400), np.minimum(2048, rng.lognormal(6, 1, 3000).astype(int) + 1), np.full(2000, 700 + seed)])
    counts, used, total = Counter(lengths.tolist()), Counter(), 0
    for times, slots in packing.plan_packing(counts):
        assert times > 0 and sum(a * b for a, b in slots) <= 2048
        total += times
        for length, rep in slots:
            used[length] += times * rep
    assert used == counts
    assert total <= 1.02 * lengths.sum() / 2048 + 2000 * (700 + seed > 682) * 0.15 + 2


def test_complements():
    assert packing._Complements(np.bincount([3, 5], minlength=20)).fill(5) == [5]
    assert sorted(packing._Complements(np.bincount([3, 5, 5], minlength=20)).fill(8)) == [3, 5]
    assert packing._Complements(np.bincount([4], minlength=20)).fill(8) is None  # one piece cannot be used twice
    assert sorted(packing._Complements(np.bincount([2, 4, 4], minlength=20)).fill(10)) == [2, 4, 4]


def chat_rows(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, turns string, slice int")


def read_chat(spark, rows):
    got = chat.parse(chat.format_chat(chat_rows(spark, rows))).collect()
    return {r["conv_id"]: r for r in got}


def test_chat_round_trip(spark):
    odd = ["\\### Assistant: </turn> ok", "### ", "#### x", "<turn/>", "</turn>\n", "\\s\\l\\h\\c", ": ", "", None, "日本 😀", "a" * 50000, "\\"]
    rng = random.Random(1)
    rows = [(c, t, rng.choice(["user", "assistant", "system", "a: b", "### x", None, ""]), rng.choice(odd), "x", 1) for c in range(30) for t in range(rng.randint(1, 150))]
    rows += [(None, 0, "user", "no conversation", None, None), (99, None, "assistant", "no turn", None, None), (99, 0, "user", "x", "x", 1)]
    rows += [(98, 1, "user", "tie", "x", 1)] * 2 + [(98, 1, "assistant", "tie", "x", 1)]
    rng.shuffle(rows)
    got = read_chat(spark, rows)
    want = defaultdict(list)
    for c, t, role, text, *_ in rows:
        want[c].append(((t is not None, t or 0), role or "", text or ""))
    assert got.keys() == want.keys()
    for c, turns in want.items():
        turns = [(role, text) for _, role, text in sorted(turns)]
        r = got[c]
        assert [(t["role"], t["text"]) for t in r["parsed"]] == turns
        assert r["learned"] == [text for role, text in turns if role == "assistant"]
        assert r["n_turns"] == len(turns)
        assert r["n_blocks"] == 1 + sum(a[0] != b[0] for a, b in zip(turns, turns[1:]))
        assert sum(x["chars"] for x in r["loss_runs"]) == len(r["formatted"])
        at = 0
        for x in r["loss_runs"]:
            part = r["formatted"][at : at + x["chars"]]
            at += x["chars"]
            assert not x["loss"] or ("</turn>" not in part and "### " not in part)


def test_chat_empty(spark):
    assert read_chat(spark, []) == {}


def test_chat_digest_of_planted(spark):
    text = "\\### Assistant: </turn> ok"
    r = read_chat(spark, [(-7, 0, "user", text, "", 0), (-7, 1, "assistant", text, "", 0)])[-7]
    assert hashlib.sha256("".join(r["learned"]).encode()).hexdigest() == hashlib.sha256(text.encode()).hexdigest()
    assert r["formatted"].count("</turn>") == 2 and r["formatted"].count("### ") == 2
