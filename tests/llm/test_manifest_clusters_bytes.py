"""Merkle manifest, centroid clustering and byte-level BPE against plain models."""

import hashlib
import random
import zlib

import numpy as np
import pandas as pd
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from tests.compare import rows_of, rows_of_sql
from tilework.llm import bytebpe, clusters, merkle, queries

DOC = "doc_id long, source string, lang string, n_chars long, text string"


@pytest.mark.parametrize("name", ["op11_merkle", "op12_clusters"])
def test_query_equals_its_sql(spark, sf_dir, name):
    assert rows_of(queries.QUERIES[name](spark, sf_dir)) == rows_of_sql(queries.ORACLES[name], sf_dir)


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(doc, text):
    return sha(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc[0], doc[1], doc[2], doc[3], text)))


def climb(nodes):
    """(top, siblings of each node level by level, with the slot)."""
    paths, at, level = [[] for _ in nodes], list(range(len(nodes))), list(nodes)
    while len(level) > 1:
        for path, k in zip(paths, at, strict=True):
            run = level[k // 3 * 3 : k // 3 * 3 + 3]
            path.append((run[: k % 3], run[k % 3 + 1 :]))
        level = [sha(*level[k : k + 3]) for k in range(0, len(level), 3)]
        at = [k // 3 for k in at]
    return level[0], paths


def model(docs):
    by_source = {}
    for doc in docs:
        by_source.setdefault(doc[1], []).append(doc)
    order = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    tops, own = [], []
    for source in order:
        rows = sorted(by_source[source], key=lambda d: (d[0] is not None, d[0] or 0, leaf(d, d[4])))
        top, paths = climb([leaf(d, d[4]) for d in rows])
        tops.append(top)
        own.append((rows, paths))
    root, above = climb(tops)
    out = []
    for (rows, paths), top, over in zip(own, tops, above, strict=True):
        for doc, path in zip(rows, paths, strict=True):
            bare = doc[0] is not None and zlib.crc32(str(doc[0]).encode()) % 2 == 0 and doc[4] is not None
            h = leaf(doc, doc[4].replace("\n", "") if bare else doc[4])
            for before, after in path + over:
                h = sha(*before, h, *after)
            proof = sha(*(x for before, after in path + over for x in before + after))
            out.append((doc[0], leaf(doc, doc[4]), top, root, proof, h, h == root))
    return out


def found(df):
    return sorted(map(repr, (tuple(r)[:7] for r in df.collect())))


def test_manifest_equals_a_plain_tree(spark):
    rng = random.Random(3)
    sources = ["hot"] * 40 + ["b", "é", "Z", "", None, "one"]
    docs = [(k, rng.choice(sources), rng.choice(["de", None]), rng.choice([5, None]), rng.choice(["a\nb", "", None, "ü \n\n", "plain"])) for k in range(300)]
    docs += [(None, "hot", None, None, "no id\n"), (None, None, None, None, None), (7, "hot", "de", 1, "again\n"), (7, "hot", "de", 1, "again\n"), (900, "alone", "de", 1, "x\ny")]
    assert found(merkle.manifest(spark.createDataFrame(docs, DOC))) == sorted(map(repr, model(docs)))


@pytest.mark.parametrize("n", [0, 1, 2, 3, 4, 10])
def test_manifest_of_few_rows(spark, n):
    docs = [(k, "s", "de", 3, f"{k}\n") for k in range(n)]
    assert found(merkle.manifest(spark.createDataFrame(docs, DOC))) == (sorted(map(repr, model(docs))) if n else [])


def test_manifest_tells_tampered_rows_and_does_not_depend_on_partitions(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").withColumn("node", F.lit(1)).withColumn("leaf", F.lit("x"))
    got = merkle.manifest(docs)
    assert found(got) == found(merkle.manifest(docs.repartition(7, "lang")))
    false = {r["doc_id"] for r in got.filter("not verified").collect()}
    assert false == {r["doc_id"] for r in docs.collect() if zlib.crc32(str(r["doc_id"]).encode()) % 2 == 0 and "\n" in (r["text"] or "")}


def vectors(spark, rows, kind="float"):
    return spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>")


def plain_clusters(rows, k=40, rounds=5):
    kept = [(i, [int(np.floor(256 * float(x))) if abs(x) < 1e15 else int(x) * 256 for x in e]) for i, e in rows if e is not None and len(e) == 64 and all(x is not None and np.isfinite(x) for x in e)]
    first = sorted((i is None, "" if i is None else sha(f"2:{i}"), e) for i, e in kept)[:k]
    centres = [e for *_, e in first]
    near = lambda e: min((sum((a - b) ** 2 for a, b in zip(e, c, strict=True)), j) for j, c in enumerate(centres))
    for turn in range(rounds + 1):
        at = [near(e) for _, e in kept]
        if turn < rounds:
            members = [[e for (_, e), (_, j) in zip(kept, at, strict=True) if j == c] for c in range(len(centres))]
            centres = [[sum(x) // len(some) for x in zip(*some, strict=True)] if some else c for some, c in zip(members, centres, strict=True)]
    most = (1 << 63) - 1
    total = [sum(d for d, j in at if j == c) for c in range(len(centres))]
    return sorted(repr((i, j, min(d, most), min(total[j], most), min(sum(total), most), sha(",".join(map(str, centres[j]))))) for (i, _), (d, j) in zip(kept, at, strict=True))


def test_clusters_equal_plain_rounds(spark):
    rng = np.random.default_rng(5)
    rows = [(k, (rng.normal(size=64) + 3 * rng.integers(0, 4)).astype(np.float32).tolist()) for k in range(260)]
    rows += [(k, np.round(rng.normal(size=64)).tolist()) for k in range(300, 420)]  # ties
    rows += [(5, rows[6][1]), (None, rows[1][1]), (None, [0.0] * 64), (900, [0.5] * 63), (901, None), (902, []), (903, [float("nan")] * 64), (904, [None] + [0.0] * 63), (905, [float("inf")] * 64)]
    rows += [(1000 + k, rows[9][1]) for k in range(200)]  # copies
    got = clusters.cluster(vectors(spark, rows).repartition(5).withColumn("cluster", F.lit(1)))
    assert sorted(repr(tuple(r)) for r in got.collect()) == plain_clusters(rows)


@pytest.mark.parametrize("n", [0, 1, 2, 30])
def test_clusters_of_few_and_of_huge_vectors(spark, n):
    rng = np.random.default_rng(n)
    rows = [(k, (rng.normal(size=64) * (1e30 if k % 2 else 3e6)).tolist()) for k in range(n)]
    got = clusters.cluster(vectors(spark, rows, "double"))
    assert sorted(repr(tuple(r)) for r in got.collect()) == plain_clusters(rows)


def test_bounds_spare_most_comparisons(monkeypatch):
    rng = np.random.default_rng(1)
    x = (rng.normal(size=(4000, 64)) + 12 * rng.integers(0, 8, (4000, 1))).round().astype(np.int64) * 100
    centres = x[:40].tolist()
    moved = [[v + 3 for v in c] for c in centres]
    state = clusters.Search(centres).first(x)
    compared = []
    real = clusters.squared
    monkeypatch.setattr(clusters, "squared", lambda a, c: compared.append(len(a)) or real(a, c))
    search = clusters.Search(moved, centres)
    compared.clear()
    a, *_ = search.again(x, *state)
    assert sum(compared) < len(x) * 40 / 2
    assert (a == clusters.Search(moved).first(x)[0]).all()


@pytest.fixture(scope="module")
def ranks():
    return bytebpe.ranks_of(public_tokenizers.path("byte_bpe_50k.tiktoken"))


@pytest.fixture(scope="module")
def public(ranks):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def odd_texts(n):
    rng = random.Random(n)
    some = ["etaoin", "ab cdeTh\n\t '0123é中—　\x1c\x85s", "".join(map(chr, range(32, 1200))), "😀👍🏽한글ไทย   x"]
    return ["".join(rng.choice(some[k % 4]) for _ in range(rng.randrange(90))) for k in range(n)]


def test_ids_equal_the_public_encoder(ranks, public):
    own, texts = bytebpe.Encoder(ranks, public_tokenizers.PATTERN), ["", " ", "a", "It's  we'll\n\n x", "aaaaaaaaaaaaaaaaaaaaaaaa", "<|endoftext|>", *odd_texts(3000)]
    for lo in range(0, len(texts), 500):
        for text, slices in zip(texts[lo : lo + 500], own.encoded(texts[lo : lo + 500]), strict=True):
            ids = b"".join(slices)
            assert np.frombuffer(ids, "<u4").tolist() == public.encode_ordinary(text)
            assert own.decoded(ids).decode() == text


def test_one_tree_and_many_trees_merge_alike(ranks):
    rng, pairs = random.Random(2), bytebpe.splits(ranks)
    pieces = ["".join(rng.choice("abeorst ñ中") for _ in range(rng.randrange(1, 9))).encode() for _ in range(500)]
    together = bytebpe.merged_together(pieces, ranks, pairs, 32)
    assert [np.frombuffer(x, "<u4").tolist() for x in together] == [bytebpe.merged(x, ranks, 128) for x in pieces]


def test_the_leftmost_of_equal_pairs_is_merged_first():
    ranks = {b"a": 0, b"b": 1, b"aa": 2, b"aab": 3}
    assert bytebpe.merged(b"aaab", ranks, 3) == [2, 0, 1]
    assert bytebpe.merged(b"aab", ranks, 3) == [3]


def test_a_long_match_and_a_long_text_are_encoded_whole(ranks, public, monkeypatch):
    monkeypatch.setattr(bytebpe, "SLICE", 1000)
    monkeypatch.setattr(bytebpe, "KEPT", 50)
    rng = random.Random(4)
    own = bytebpe.Encoder(ranks, public_tokenizers.PATTERN)
    for text in ("".join(rng.choice("etaoins") for _ in range(30_000)), " ".join(odd_texts(300))):
        assert own.encode(text).tolist() == public.encode_ordinary(text)


def test_digest_of_nulls_repeats_and_extra_columns(spark, public):
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    rows = [(1, "Hello  world"), (1, "Hello  world"), (2, None), (3, ""), (None, "x\ny")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n_tokens", F.lit("x"))
    hexed = lambda b: hashlib.sha256(b).hexdigest()
    want = [(d, len(i), hexed(np.array(i, "<u4").tobytes()), hexed((t or "").encode())) for d, t in rows for i in [public.encode_ordinary(t or "")]]
    got = bytebpe.digest(docs, path, public_tokenizers.PATTERN)
    assert sorted(map(repr, want)) == sorted(repr(tuple(r)) for r in got.collect())
    assert bytebpe.digest(docs.limit(0), path, public_tokenizers.PATTERN).count() == 0
    ids = bytebpe.encode(docs.select(F.col("doc_id").alias("row"), "text"), path, public_tokenizers.PATTERN)
    assert sorted(map(repr, rows)) == sorted(repr(tuple(r)) for r in bytebpe.decode(ids, path, public_tokenizers.PATTERN).collect())


def test_digest_equals_the_public_encoder_on_documents(spark, sf_dir, public):
    got = {r["doc_id"]: tuple(r)[1:] for r in queries.op13_bytebpe(spark, sf_dir).collect()}
    docs = pd.read_parquet(f"{sf_dir}/documents.parquet")
    assert len(got) == len(docs)
    for doc, text in zip(docs["doc_id"], docs["text"], strict=True):
        ids = np.array(public.encode_ordinary(text or ""), "<u4").tobytes()
        assert got[doc] == (len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest())
