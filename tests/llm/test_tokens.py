"""Encoders against the libraries, token files and packing by round trip, lengths by brute force."""

import functools
import hashlib
import random
import time
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import public_tokenizers as P
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from vantle.llm import bpe, lengths, packing, queries, tokenio
from vantle.llm.common import UnitTable, cut_signs, file_bytes
from vantle.llm.vocabulary import LibraryEncoder

RANKS, BYTES, WORDS = (P.path(n) for n in ("byte_bpe_50k.tiktoken", "byte_bpe_50k.json", "word_bpe_49k.json"))
ODD = [
    "foo…. x", "foo“. y", "a²., b", "３. x", "Ⅷ., y", "の. z", "x.́ y", "≠. q", "-- x", "x -- \n-- y", "\n--", "foo'. bar", "foo's. bar", "a.' b", "ǅ. ß! É?", "ο. π ж! Й,", "a.b.c. (d) [e]; {f}!?",
    None, "", " ", "\n", "  ", "a  b", "\n\n a", "a\tb \t c", "it's he'll\r\n\r\nx", "aaaa" * 400, "　x\x1cy z", "Привет ΑΣ Σ. мир 日本語 😀😀 é", "  lead", "trail  ", "<|endoftext|> <|startoftext|>", "a\n", "\na",
    "Ünïcode, ÀÉÿ; über. µª", "word " * 3000, "Zeile eins.\nZeile zwei.", "\x00\x01 \x7f",
]


def texts():
    rng = random.Random(5)
    parts = [" ", "\n", "\t", "a", "b", "the", "ing", "1", "23", "!", "?", "é", "ß", "日", "'s", "'", "\xa0", "́", "ab", "LL", "Σ", ", ", ". ", " über"]
    return ODD + ["".join(rng.choice(parts) for _ in range(rng.randint(0, 40))) for _ in range(400)]


@pytest.fixture(scope="module")
def docs(spark):
    rows = list(enumerate(texts()))
    rows += [rows[20], rows[20]]  # repeated rows
    return spark.createDataFrame([(i, t, "x", t) for i, t in rows], "doc_id long, text string, ids string, length string")


@functools.cache
def tokenizer(path):
    t = Tokenizer.from_file(path)
    t.encode_special_tokens = True
    return t


def ids_of(path, text):
    return tokenizer(path).encode(text or "", add_special_tokens=False).ids


def test_merge_replay_equals_tiktoken(spark, docs):
    ranks = bpe.parse_ranks(file_bytes(RANKS))
    library = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = bpe.digests(bpe.decode(bpe.encode(docs, RANKS, P.PATTERN), RANKS)).collect()
    assert len(got) == docs.count()
    by = {r["doc_id"]: r for r in got}
    for i, text in enumerate(texts()):
        want = library.encode_ordinary(text or "")
        assert by[i]["n_tokens"] == len(want), repr(text)
        assert by[i]["ids_sha256"] == hashlib.sha256(" ".join(map(str, want)).encode()).hexdigest()
        assert by[i]["decoded_sha256"] == hashlib.sha256((text or "").encode()).hexdigest()


def test_replay_prefers_lower_ranks_that_arise_late():
    ranks = bpe.parse_ranks(file_bytes(RANKS))
    library = tiktoken.Encoding("own", pat_str=r"(?s).+", mergeable_ranks=ranks, special_tokens={})
    replay = bpe.MergeReplay(ranks)
    rng = random.Random(1)
    pieces = ["".join(rng.choice("abcsthe 0-\n") for _ in range(rng.randint(1, 300))) for _ in range(300)]
    for piece, got in zip(pieces, replay.encode([p.encode() for p in pieces]), strict=True):
        assert got.tolist() == library.encode_ordinary(piece)


@pytest.mark.parametrize("path", [BYTES, WORDS])
def test_units_equal_whole_texts(path):
    encoder = LibraryEncoder(file_bytes(path))
    for _ in range(2):  # cold and warm tables
        for text, got in zip(texts(), encoder.encode([t or "" for t in texts()]), strict=True):
            assert np.frombuffer(got, "<u4").tolist() == ids_of(path, text), repr(text)


def test_packing_contract(spark, docs):
    rows = packing.pack_documents(docs, BYTES, 256, 0).collect()
    pieces, bins = {}, {}
    for r in rows:
        pieces.setdefault(r["doc_id"], []).append(r)
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for spots in bins.values():
        end = 0
        for offset, length in sorted(spots):
            assert offset == end
            end += length
        assert end <= 256
    for i, text in enumerate(texts()):
        want = np.array([*ids_of(BYTES, text), 0], "<u4")
        mine = sorted({(r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in pieces[i]})
        assert [p for p, *_ in mine] == list(range(len(mine))) and all(n == 256 for _, _, n, _ in mine[1:])
        end = 0
        for _, start, length, crc in mine:
            assert start == end and crc == zlib.crc32(want[start : start + length].tobytes())
            end += length
        assert end == len(want)
    assert len(pieces[20]) == 3 * len({r["piece"] for r in pieces[20]})


def test_sequences_hold_their_pieces(spark, docs):
    cut = packing.cut_pieces(docs, BYTES, 256, 0).cache()
    placed = packing.place(cut.drop("ids"), 256)
    got = packing.sequences(cut, placed)
    total = cut.agg(F.sum("length")).first()[0]
    assert got.agg(F.sum("n_ids")).first()[0] == total and got.agg(F.max("n_ids")).first()[0] <= 256


def test_sum_of_squares_packs_tight():
    rng = np.random.default_rng(3)
    sizes = np.minimum(rng.geometric(1 / 600, 5000), 2047)
    bins, offsets = packing.sum_of_squares(sizes, 2048)
    least = -(-int(sizes.sum()) // 2048)
    assert bins.max() + 1 <= 1.005 * least
    fill = np.bincount(bins, sizes)
    assert fill.max() <= 2048 and (np.bincount(bins, sizes * 0 + 1) > 0).all()
    assert packing.sum_of_squares(np.array([5, 5, 5]), 5)[0].tolist() == [0, 1, 2]


def test_packing_in_groups(spark, docs):
    one = packing.pack_documents(docs, BYTES, 256, 0, group=50)
    assert one.count() == packing.pack_documents(docs, BYTES, 256, 0).count()
    assert one.select("doc_id", "piece", "sequence_id", "offset").distinct().count() == one.count()


@pytest.mark.parametrize("ids", [[], [1], [7, 7, 7, 7, 7] * 100, [5] * 1000, list(range(500)), [1, 2, 3] * 5000])
def test_repair_round_trip(ids):
    x = np.array(ids, np.uint32)
    symbols, left, right, free = tokenio.compress(x)
    assert (tokenio.expand(symbols, left, right, free) == x).all() and len(symbols) <= len(x)
    assert all(n == len(tokenio.expand(np.array([free + k], np.uint32), left, right, free)) for k, n in enumerate(tokenio.expansions(left, right, free)))


def test_random_access():
    rng = np.random.default_rng(2)
    docs = [rng.choice([3, 4, 5, 70_000], rng.integers(0, 60)).astype(np.uint32) for _ in range(400)]
    shard = tokenio.Shard(tokenio.payload(np.concatenate(docs), [(None if k == 3 else k, len(d)) for k, d in enumerate(docs)]))
    assert all((shard.document(k) == d).all() for k, d in enumerate(docs))
    assert shard.is_null[3] and not shard.is_null[4] and len(shard.left) > 0
    with pytest.raises(ValueError):
        tokenio.Shard(b"x" * 64)


def test_token_files(spark, docs):
    rows = sorted((r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) for r in tokenio.round_trip(docs.repartition(5), WORDS).collect())
    every = sorted([*enumerate(texts()), (20, texts()[20]), (20, texts()[20])], key=lambda x: x[0])
    start = 0
    for (i, text), got in zip(every, rows, strict=True):
        want = np.array([*ids_of(WORDS, text), 1], "<u4")
        assert got == (i, start, len(want), zlib.crc32(want.tobytes()))
        start += len(want)


def test_small_shards_keep_order(spark, docs, tmp_path):
    path = f"file://{tmp_path}/ids"
    tokenio.write_ids(docs, path, WORDS, shard_ids=100)
    back = tokenio.read_documents(spark, path).join(tokenio.starts(spark, path), ["shard", "block"])
    rows = back.select("doc_id", (F.col("base") + F.col("local_start")).alias("s"), (F.length("ids") / 4).alias("n")).orderBy("s").collect()
    assert [r["doc_id"] for r in rows] == sorted(r["doc_id"] for r in rows) and rows[-1]["s"] + rows[-1]["n"] == sum(r["n"] for r in rows)


def test_lengths(spark, docs):
    counts = [len(ids_of(BYTES, t)) for t in [*texts(), texts()[20], texts()[20]]]
    sums = lengths.suffix_sums(lengths.histogram(docs, BYTES)).cache()
    assert {(r["n_tokens"], r["n_docs"]) for r in sums.collect()} == {(c, counts.count(c)) for c in counts}
    for r in sums.collect():
        n = r["n_tokens"]
        assert r["docs_at_least"] == sum(c >= n for c in counts) and r["tokens_at_least"] == sum(c for c in counts if c >= n)
        assert r["truncated_tokens"] == sum(min(c, n) for c in counts) and r["fitting_share"] == pytest.approx(sum(c <= n for c in counts) / len(counts))
    for limit in (0, 1, 10, 77, 10**6):
        assert lengths.truncated_total(sums, limit) == sum(min(c, limit) for c in counts)
    for share in (0.1, 0.5, 0.9, 1.0):
        assert lengths.quantile(sums, share) == min(n for n in counts if sum(c <= n for c in counts) >= share * len(counts))


@pytest.mark.parametrize("name", ["op1_best_fit_packing", "op5_byte_bpe", "op6_token_counts", "op9_token_files"])
def test_queries_and_empty_tables(spark, sf, tmp_path, name):
    assert queries.QUERIES[name](spark, sf).count() > 0
    spark.createDataFrame([], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    assert queries.QUERIES[name](spark, str(tmp_path)).count() == 0


def apart(symbols):
    """Times that each pair occurs without overlap, leftmost first."""
    count, taken = {}, {}
    for k, pair in enumerate(zip(symbols[:-1].tolist(), symbols[1:].tolist(), strict=True)):
        if taken.get(pair, -2) < k - 1:
            count[pair] = count.get(pair, 0) + 1
            taken[pair] = k
    return count


def test_no_frequent_pair_stays(sf):
    encoder = LibraryEncoder(file_bytes(WORDS))
    documents = pq.read_table(f"{sf}/documents.parquet", columns=["text"])["text"].combine_chunks()
    rng = np.random.default_rng(7)
    pairs = np.arange(120_000, dtype=np.uint32).reshape(-1, 2)
    cases = [
        np.frombuffer(b"".join(encoder.encode(documents.fill_null(""))), "<u4"),
        np.concatenate([pairs[rng.permutation(len(pairs))].ravel() for _ in range(10)]),
        rng.integers(0, 6, 20_000), np.repeat(rng.integers(0, 50, 3000), rng.integers(1, 40, 3000)), np.zeros(10_001), np.tile([1, 2, 1, 1, 2], 3000),
    ]
    for ids in cases:
        ids = np.asarray(ids, np.uint32)
        symbols, left, right, first_free = tokenio.compress(ids)
        assert tokenio.expand(symbols, left, right, first_free).tolist() == ids.tolist()
        assert max(apart(symbols).values()) < tokenio.LEAST


def test_rules_that_each_save_little_are_kept():
    phrase = np.array([1, 2, 3, 4], np.uint32)
    parts = []
    for k in range(4000):  # a round saves one id of each phrase, some 4 %
        parts += [phrase, np.arange(100 + 21 * k, 121 + 21 * k, dtype=np.uint32)]
    ids = np.concatenate(parts)
    symbols, left, right, first_free = tokenio.compress(ids)
    assert tokenio.expand(symbols, left, right, first_free).tolist() == ids.tolist()
    assert not np.isin(symbols, phrase).any() and len(symbols) == len(ids) - 3 * 4000


def test_units_met_again_are_kept():
    made = []

    def encode(units):
        made.extend(units)
        return np.array([len(u) for u in units], np.uint32), np.ones(len(units), np.int64)

    table = UnitTable(encode, lambda text: b"whole", limit=40)
    for k in range(50):
        got = table.encode([f"often w{k} x{k}", "often  twice"])
        assert np.frombuffer(got[0], "<u4").tolist() == [5, 2 + len(str(k)), 2 + len(str(k))] and got[1] == b"whole"
    assert made.count("often") == 1 and made.count(" often") == 0 and len(made) == 102 and len(table.young.places) + len(table.old.places) <= 48
    assert table.counts(pa.array(["often w1", ""])).tolist()[0] == 2


def test_only_words_changed_by_lower_case_are_asked_for_again():
    encoder = LibraryEncoder(file_bytes(WORDS))
    asked, known = [], encoder.table.known
    encoder.table.known = lambda keys: asked.extend(keys) or known(keys)
    first, then = ["alpha Beta gamma", "beta Alpha \u00c9T\u00c9 \u00e9t\u00e9 alpha, <x> don't \u03a3", "", "12 \u4e2d\u6587"], ["BETA gamma Delta! \u00c9t\u00e9", "delta ALPHA\nGamma"]
    for texts, again in ((first, {"alpha", "beta", "\u00e9t\u00e9"}), (then, {"beta", "delta", "\u00e9t\u00e9", "alpha", "gamma"})):
        asked.clear()
        got = [np.frombuffer(x, "<u4").tolist() for x in encoder.encode(texts)]
        assert got == [encoder.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
        assert set(asked) == again


@pytest.mark.parametrize("part", ["abcdefgh", "日本語の文章", "a", "=-", "word"])
def test_long_unbroken_pieces(part):
    ranks = bpe.parse_ranks(file_bytes(RANKS))
    library = tiktoken.Encoding("own", pat_str=r"(?s).+", mergeable_ranks=ranks, special_tokens={})
    replay = bpe.MergeReplay(ranks)
    rng = random.Random(4)
    mixed = "".join(rng.choice("abcsthe0") for _ in range(50_000))
    pieces = [part * (1_000_000 // len(part.encode())), mixed, mixed[:255], mixed[:256], mixed[:257], part * 60]
    began = time.process_time()
    got = replay.encode([p.encode() for p in pieces])
    assert time.process_time() - began < 20
    assert [x.tolist() for x in got] == [library.encode_ordinary(p) for p in pieces]


def test_signs_are_cut_where_they_stand_alone():
    units = pa.array(["foo,", "foo", "", "--", "a.b.!", "é!", "…!", "foo'.", "の.", "x\t.", "9%", ","])
    for bare_alone, alone in ((True, ("", "--")), (False, ("--", ""))):
        bare, signs = cut_signs(units.slice(1, 11), bare_alone)
        assert list(zip(bare.to_pylist(), signs.to_pylist(), strict=True)) == [
            ("foo", ""), ("", ""), alone, ("a.b", ".!"), ("é", "!"), ("…!", ""), ("foo'.", ""), ("の.", ""), ("x\t.", ""), ("9", "%"), ("", ",") if bare_alone else (",", ""),
        ]


def test_other_patterns_are_split_whole():
    content = file_bytes(RANKS)
    encoder = bpe.PieceEncoder(content, r"\s+|[^\s]+")
    library = tiktoken.Encoding("own", pat_str=r"\s+|[^\s]+", mergeable_ranks=bpe.parse_ranks(content), special_tokens={})
    texts_ = ["foo, bar.\nbaz", "a  b", ""]
    assert [np.frombuffer(x, "<u4").tolist() for x in encoder.encode(texts_)] == [library.encode_ordinary(t) for t in texts_]
    assert bpe.KNOWN_PATTERN == P.PATTERN
