"""SimHash, packing and BPE against brute force, and odd inputs."""

import re
import zlib
from itertools import combinations

import numpy as np
import public_tokenizers
import tiktoken
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from pushback.llm import bpe, packing, queries, simhash
from pushback.llm.bpe import PerfectHash

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, fp long, length long, ids string"
ODD = ["", " ", "a", "a  b", "a \n b", "\n x", " a", "a ", "a\x1c b", "a \x1cb", "don't I'll 'S's x", "日本 語 　 ab",
       "a\n\n  b", "\t\ta", "x" * 3000, "é" * 5 + " 12ab34", "a b \n", "ß ß", "<|endoftext|> x"]


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", None, 7, 7, "x") for i, t in rows], SCHEMA)


def brute_fingerprint(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", low) if w]
    if not words:
        return 0
    grams = [" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))]
    hs = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_components(rows):
    fps = {i: brute_fingerprint(t) for i, t in rows}
    label = {i: i for i in fps}
    changed = True
    while changed:
        changed = False
        for a, b in combinations(fps, 2):
            if (fps[a] ^ fps[b]).bit_count() <= 4 and label[a] != label[b]:
                label[a] = label[b] = min(label[a], label[b])
                changed = True
    return fps, label


def near_copies():
    base = [f"w{i}" for i in range(300)]
    rows = [(i, t) for i, t in enumerate(ODD)]
    for k in range(40):
        words = list(base)
        words[(k * 7) % 300] = f"z{k % 9}"
        rows.append((100 + k, " ".join(words)))
    rows += [(200, None), (201, " ".join(base)), (202, " ".join(base).upper()), (203, "w1 w2 w3")]
    return rows


def test_simhash_matches_brute_force(spark):
    rows = near_copies()
    fps, label = brute_components(rows)
    got = {r[0]: (r["fp"] & (2 ** 64 - 1), r["component_id"])
           for r in simhash.near_duplicates(frame(spark, rows)).collect()}
    assert got == {i: (fps[i], label[i]) for i in fps}
    assert len(set(label.values())) < len(rows) - 30  # the copies do link


def test_simhash_blocks_lose_no_link():
    rng = np.random.default_rng(3)
    masks = simhash.block_masks()
    for _ in range(300):
        a = int(rng.integers(0, 2 ** 63))
        flips = rng.choice(64, 4, replace=False)
        b = a
        for x in flips:
            b ^= 1 << int(x)
        assert any((a & m & (2 ** 64 - 1)) == (b & m & (2 ** 64 - 1)) for m in masks)


def test_hot_block_is_dealt_out_without_loss(spark):
    fps = [(i,) for i in range(600)]  # all within ten low bits of each other
    edges = simhash.links(spark.createDataFrame(fps, "fp long"), block_rows=50)
    assert edges.count() < 100 * 600
    roots = {r["u"]: r["v"] for r in simhash.components(edges).collect()}
    assert set(roots.values()) == {0} and len(roots) == 599


def test_drop_near_duplicates_keeps_one_of_each(spark):
    docs = frame(spark, [*near_copies(), (201, " ".join(f"w{i}" for i in range(300))), (None, "only here one two"),
                         (5, "another text of that id")])
    _, label = brute_components(near_copies())
    kept = simhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    ids = sorted(r[0] for r in kept.collect() if r[0] is not None)
    assert ids == sorted([*set(label.values()), 5])
    assert kept.where("doc_id is null").count() == 1
    assert simhash.drop_near_duplicates(docs.limit(0)).count() == 0
    assert simhash.near_duplicates(docs.limit(0)).count() == 0


def test_perfect_hash_is_minimal():
    keys = [f"k{i}".encode() for i in range(2000)]
    table = PerfectHash(keys, list(range(2000)))
    assert [table.get(k) for k in keys] == list(range(2000)) and table.n == 2000
    assert table.get(b"other") is None


def test_bpe_matches_tiktoken_and_decodes(spark):
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.vocabulary(path).ranks,
                            special_tokens={})
    docs = frame(spark, [*enumerate(ODD), (90, None), (90, "again twice"), (None, "no id")])
    back = bpe.decode(bpe.encode(docs, path=path, pattern=public_tokenizers.PATTERN), path=path).collect()
    want = sorted((t or "", own.encode_ordinary(t or "")) for _, t in docs.select("doc_id", "text").collect())
    got = sorted((bytes(r["decoded"]).decode(), np.frombuffer(r["ids"], "<u4").tolist()) for r in back)
    assert got == want and all(r["n_tokens"] * 4 == len(r["ids"]) for r in back)
    assert bpe.encode(docs.limit(0), path=path, pattern=public_tokenizers.PATTERN).count() == 0


def test_packing_ids_offsets_and_padding(spark):
    path = public_tokenizers.path("byte_bpe_50k.json")
    lib = Tokenizer.from_file(path)
    lib.encode_special_tokens = True
    long = " ".join(f"word{i} and" for i in range(3000))
    rows = [*enumerate(ODD), (50, long), (51, None), (52, long), (52, long), (None, "no id")]
    rows += [(100 + i, "the cat sat on it " * (i % 40)) for i in range(400)]
    docs = frame(spark, rows)
    cut = packing.pieces(docs, path=path)
    whole = {}
    for r in cut.orderBy("start").collect():
        whole.setdefault((r["doc_id"], r["doc_tokens"]), []).append((r["start"], np.frombuffer(r["ids"], "<u4").tolist()))
    for (i, n), parts in whole.items():
        text = dict(rows)[i] or ""
        want = lib.encode(text, add_special_tokens=False).ids + [1]
        assert n == len(want)
        assert all(ids == want[s:s + len(ids)] for s, ids in parts)
    packed = packing.pack(cut.select("doc_id", "start", "length", F.crc32("ids").alias("c"), "doc_tokens"),
                          order=["doc_id", "start", "c"], group_rows=200).collect()
    assert len(packed) == cut.count()
    by = {}
    for r in packed:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for spans in by.values():
        at = 0
        for offset, n in sorted(spans):
            assert offset == at
            at += n
        assert at <= 2048
    used = sum(r["length"] for r in packed)
    assert used / (len(by) * 2048) > 0.9
    assert packing.pack(cut.limit(0), order=["doc_id", "start"]).count() == 0


def test_best_fit_takes_the_tightest_room():
    sequences, offsets = packing.best_fit_decreasing([10, 6, 5, 4, 3, 2], 10)
    assert sequences == [0, 1, 2, 1, 2, 2] and offsets == [0, 0, 0, 6, 5, 8]


def test_queries_on_the_small_tables(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    fps, label = brute_components([(r[0], r[1]) for r in docs])
    got = queries.op2_simhash_neardup(spark, sf).collect()
    assert {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in got} == {
        i: (f"{fps[i]:016x}", label[i]) for i in fps}
    lib = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ids = {r[0]: lib.encode(r[1], add_special_tokens=False).ids + [1] for r in docs[:60]}
    for r in queries.op9_bfd_packing(spark, sf).collect():
        if r["doc_id"] in ids:
            part = np.array(ids[r["doc_id"]][r["start"]:r["start"] + r["length"]], dtype="<u4")
            assert zlib.crc32(part.tobytes()) == r["ids_crc32"] and r["doc_tokens"] == len(ids[r["doc_id"]])
