"""Corner cases of the corpus operators: direct computations, awkward rows and columns, hot ids, long texts."""

import hashlib
import math
import random
import re
import time
import zlib

import numpy as np
import pandas as pd
import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tilework.llm import ann, linededup, mainhtml, minhash, packing, pii, topk, toxicity

from .test_operators import DOCS, PATTERNS, docs, luhn, shingles, valid, vectors, words

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")


def test_noisy_or_loss_and_gradient_equal_a_direct_computation():
    rng = np.random.default_rng(1)
    names = list("abcde")
    sample = pd.DataFrame({"toxic": [1, 0, 1, 0, 0], "sentences": [3, 2, 1, 4, 0], "bags": [[[0, 1], [2]], [[3]], [[0, 4]], [[1], [2, 3], [4]], []]})
    theta = rng.normal(size=len(names) + 2)
    sigmoid = lambda x: 1 / (1 + np.exp(-x))

    def direct(theta):
        total = 0.0
        for y, n, bags in zip(sample["toxic"], sample["sentences"], sample["bags"], strict=True):
            clean = 1 - sigmoid(theta[-1])
            for bag in [*bags, *[[]] * (n - len(bags))]:
                clean *= 1 - sigmoid(theta[-2] + sum(theta[k] for k in bag))
            total -= np.log(1 - clean) if y else np.log(clean)
        return total / len(sample)

    bags = toxicity.Bags.of(sample)
    loss, slope = toxicity.slope_at(theta, bags)
    assert abs(loss - direct(theta)) < 1e-9
    for k in range(len(theta)):
        step = np.eye(len(theta))[k] * 1e-6
        assert abs((direct(theta + step) - direct(theta - step)) / 2e-6 - slope[k]) < 1e-6
    model = toxicity.Model(dict(zip(names, theta[:-2], strict=True)), theta[-2], sigmoid(theta[-1]))
    score, found = toxicity.Scorer(model)("a b. zz zz! c\nd")
    clean = (1 - sigmoid(theta[-1])) * np.prod([1 - sigmoid(theta[-2] + x) for x in (theta[0] + theta[1], 0.0, theta[2], theta[3])])
    assert abs(score - (1 - clean)) < 1e-9 and all(s["score"] >= 0.5 for s in found)


def test_a_training_sample_holds_one_row_an_id(spark):
    rows = docs(spark, [(7, f"text {k}") for k in range(50)] + [(8, "other")])
    labels = spark.createDataFrame([(7, 1), (8, 0)], "doc_id long, toxic int")
    assert {r["doc_id"]: r["text"] for r in toxicity._training_rows(rows, labels).collect()} == {k: t for k, t in ((7, "text 0"), (8, "other")) if zlib.crc32(str(k).encode()) % 5}


def test_added_tokens_are_encoded_as_the_tokenizer_does_in_any_case():
    from tokenizers import Tokenizer

    plain, own = Tokenizer.from_file(WORD_BPE), packing._loaded(WORD_BPE)
    assert own.by_word and own.by_case and own.by_mark
    for token in [t.content for t in plain.get_added_tokens_decoder().values()]:
        for x in (token, token.upper(), token.title(), token.swapcase()):
            for text in (x, f"so {x} it", f"a{x}b c.", f".{x}, D", f"{x}{x}"):
                assert own.encode(text).tolist() == plain.encode(text, add_special_tokens=False).ids


def test_word_ids_survive_forgetting_and_odd_words(monkeypatch):
    from tokenizers import Tokenizer

    plain, own, rng = Tokenizer.from_file(WORD_BPE), packing._loaded(WORD_BPE, 50), random.Random(2)
    odd = ["don't", "é́x", "İ", "ß.", "x1.", "3.4,", "日本語", "a‍b", "...", ",", "\x1c", "Ǆ,", "ﬁn", "A.B.", "😀,"]
    for _ in range(30):
        texts = [" ".join(rng.choice(odd) if rng.random() < 0.2 else words(rng, 1) + rng.choice(["", "", ",", "."]) for _ in range(40)) for _ in range(5)]
        assert [x.tolist() for x in own.encode_many(texts)] == [plain.encode(t, add_special_tokens=False).ids for t in texts]


@pytest.mark.parametrize("tokens", [1, 2, 3, 4, 5, 7, 8])
def test_short_texts_fill_their_sequences(spark, tokens):
    """Each word is a token, and the end id is one more."""
    rows = spark.range(6000).select(F.col("id").alias("doc_id"), F.lit(" ".join(["the"] * (tokens - 1))).alias("text"))
    got = packing.pack(rows, WORD_BPE).groupBy("sequence_id").agg(F.sum("length").alias("n"), F.max("offset").alias("last")).collect()
    assert sum(r["n"] for r in got) == 6000 * tokens
    assert max(r["n"] for r in got) <= 2048 and 6000 * tokens / (2048 * math.ceil(6000 * tokens / 2048)) == 6000 * tokens / (2048 * len(got))


def test_items_take_each_rank_once():
    rng = random.Random(3)
    histogram = {size: rng.randrange(1, 50) for size in range(1, packing.SHORT + 257) if rng.random() < 0.7 and not packing.SHORT < size <= packing.SHORT + 8}
    demand, rows = packing._items(histogram)
    taken = {}
    for size, lo, hi, per, units, before in rows:
        taken.setdefault(size, []).append((lo, hi))
        assert (hi - lo) % per == 0
        assert per * size <= units * 8 < per * size + 8 if size <= packing.SHORT else per == 1 and units == size - packing.SHORT
        assert per == 1 or per * size == units * 8
        assert 0 <= before < demand[units - 1]
    for size, n in histogram.items():
        assert [x for lo, hi in sorted(taken[size]) for x in range(lo, hi)] == list(range(n))
    assert demand.sum() == sum((hi - lo) // per for _, lo, hi, per, _, _ in rows)


def test_a_third_of_all_rows_alike_is_packed_in_many_tasks(spark):
    rows = spark.range(3000).select(F.lit(5).cast("long").alias("doc_id"), F.lit("the same words here").alias("text")).union(spark.range(6000).select("id", F.concat(F.lit("row "), F.col("id").cast("string"))))
    got = packing.pack(rows, WORD_BPE)
    assert got.count() == 9000 and got.groupBy("sequence_id", "offset").count().filter("count > 1").count() == 0
    assert got.groupBy("sequence_id").agg(F.sum("length").alias("n")).filter("n > 2048").count() == 0


PAGES = [
    ('<article class="post tag-news"><p>hello world</p></article>', "hello world"),
    ('<body class="has-sidebar"><article><p>abc</p></article></body>', "abc"),
    ('<div class="content no-comments">abc def</div>', "abc def"),
    ('<div id="search-results-main">abc text</div>', "abc text"),
    ('<p class="side-effects">abc text</p>', "abc text"),
    ('<p class="advert">Buy now<p>Article text', "Article text"),
    ("<article><p><a>only a link</a></p></article>", "only a link"),
    ("<article><ul><li><a>x</a></li></ul></article>", "x"),
    ("<article><figure><img><figcaption>Cap</figcaption></figure><p>text</p><p><a>last</a></p></article>", "Cap\ntext\nlast"),
    ("<article><header><h1>H</h1></header><h1><a>Head</a></h1><p>one<br>two</p></article>", "Head\none two"),
    ("<article><p>1 < 2 and <b>x</p></b><p>y <</article>", "1 < 2 and x\ny <"),
    ('<article><p title="a > b">x</p><p title=">y</p>', 'x\ny'),
    (None, ""), ("", ""), ("<nav>menu</nav>", ""),
]


@pytest.mark.parametrize("page,text", PAGES)
def test_main_text_of_common_layouts(page, text):
    assert mainhtml.main_text(page) == text


@pytest.mark.parametrize("part", ["<a ", '<a ">"', "<a '", '<a "x', "</b>", "<b>", "<li>", "<b><li>", "<!", "<!--", "<", "<td><tr>", "<div></p>", "<i><div></i>"])
def test_a_page_costs_in_proportion_to_its_length(part):
    took = []
    for n in (20_000, 80_000):
        page = "<p>text</p>" + part * n
        began = time.process_time()
        mainhtml.main_text(page)
        took.append(time.process_time() - began)
    assert took[1] < 12 * took[0] + 0.2


def test_pages_without_rows_and_with_nulls(spark):
    pages = spark.createDataFrame([(1, None, None, 5), (None, "u", "<p>x</p>", 6)], "page_id long, url string, html string, text int")
    assert sorted(((r["page_id"], r["text"], r["n_chars"]) for r in mainhtml.extract(pages).collect()), key=str) == [(1, "", 0), (None, "x", 1)]
    assert mainhtml.extract(pages.limit(0)).count() == 0


def test_personal_data_in_long_texts_equals_the_plain_patterns(spark):
    rng = random.Random(4)
    parts = ["a@b.co", "1.2.3.4", "4111 1111 1111 1111", "+33 (0)1.23-45 67 89", "word", "Word", "é😀", "12", "9-9 9", "\n", ", ", "; "]
    rows = [(k, "".join(rng.choice(parts) + rng.choice([" ", " ", "", "\n"]) for _ in range(n))) for k, n in enumerate((3_000, 6_000, 900))]
    rows += [(10, "a" * 150_000), (11, "1" * 150_000), (12, "1 " * 60_000), (13, "+1" * 60_000), (14, "a@b." * 30_000), (15, "1.2.3.4 " * 8_000), (16, "a@b.co " * 8_000)]
    got = {r["doc_id"]: r for r in pii.digest(docs(spark, rows)).collect()}
    for i, t in rows:
        if i not in (10, 11, 12, 13):  # there the plain patterns take quadratic time
            spans = {kind: [(m.start(), m.end()) for m in re.finditer(p, t) if valid(kind, m.group())] for kind, p in PATTERNS.items()}
            assert got[i]["base_sha256"] == hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, found in spans.items() for a, b in found).encode()).hexdigest()
        else:
            assert got[i]["n_email"] == got[i]["n_card"] == got[i]["n_ip"] == got[i]["n_phone"] == 0
    assert luhn("4111111111111111") and got[15]["n_ip"] == 8_000 and got[16]["n_email"] == 8_000


def test_columns_of_any_name_pass_through_the_text_stages(spark):
    own = {"pieces": "keep", "raw": "keep", "at": "keep", "_found": "keep", "a.b": "keep", "row": "keep", "cut": "keep", "gone": "keep", "removed_lines": "keep", "h": "keep"}
    rng = random.Random(1)
    passage = "\n".join(words(rng, 30) for _ in range(4))
    rows = docs(spark, [(1, passage), (2, passage + "\nmail a@b.co"), (None, None), (3, "")]).withColumns({k: F.lit(v) for k, v in own.items()})
    for stage in (pii.redact, linededup.without_repeats):
        found = stage(rows)
        assert found.columns == rows.columns
        assert all(r[k] == v for r in found.collect() for k, v in own.items())
    assert {r["text"] for r in linededup.without_repeats(rows).collect()} == {passage, "mail a@b.co", None, ""}


def test_rows_that_share_an_id_or_have_none_are_compared_like_others(spark):
    rng = random.Random(3)
    passage = "\n".join(words(rng, 20) for _ in range(5))
    for doc in (7, None):
        rows = [(doc, passage + "\n" + words(rng, 3)) for _ in range(60)] + [(doc, passage)] * 2 + [(1000 + k, words(rng, 60)) for k in range(5)]
        found = [r["text"] for r in linededup.dedup_lines(docs(spark, rows), runs=True).collect()]
        assert len(found) == len(rows) and sum(passage.split("\n")[0] in t for t in found) == 1


def test_pieces_of_a_long_text_give_the_same_shingles(monkeypatch):
    rng = random.Random(5)
    texts = [words(rng, 3_000), "x" * 5_000 + " " + words(rng, 900), "one two", "", None, words(rng, 50)]
    whole = [x.tolist() for x in minhash.shingle_sets(texts)]
    monkeypatch.setattr(minhash, "CHUNK", 1_000)
    assert [x.tolist() for x in minhash.shingle_sets(texts)] == whole
    assert [len(x) for x in whole] == [len(shingles(t)) for t in texts] == [len(minhash.word_shingles(t)) for t in texts]


def test_neighbours_of_any_finite_size_and_repeated_ids(spark):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(300, 8))
    for scale in (1e200, 1e-200, 1.0):
        rows = [(k, (x[k] * scale).tolist(), 0) for k in range(300)] + [(350, [float("inf")] * 8, 0), (400, [0.0] * 8, 0), (1, (x[0] * scale).tolist(), 0), (50, (x[50] * scale).tolist(), 0)]
        frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
        got = {}
        for r in sorted(ann.search(frame).collect(), key=lambda r: (r["query_id"], r["rank"])):
            got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        unit = x / np.linalg.norm(x, axis=1, keepdims=True)
        ids = np.array([r[0] for r in rows if r[0] not in (350, 400)])
        near = np.concatenate((unit, unit[[0, 50]]))
        assert set(got) == set(range(0, 300, 50))
        for q, found in got.items():
            cos = near @ unit[q]
            at = [k for k in np.lexsort((ids, -cos.round(12))) if ids[k] != q][:5]
            assert [v for v, _ in found] == ids[at].tolist() and np.allclose([s for _, s in found], cos[at], atol=1e-12)


def test_a_hot_vector_id_is_spread_over_the_shards(spark, monkeypatch):
    monkeypatch.setattr(topk, "SHARD", 50)
    rows = [(3, [float(k % 7), 1.0], 0) for k in range(400)] + [(k, [1.0, float(k % 5)], 0) for k in range(50, 250)]
    frame = vectors(spark, rows)
    _, candidates, shards = topk.tiles(topk.asking(frame, 50).withColumn("dim", F.lit(2)), frame.withColumn("dim", F.lit(2)), 2048, 50)
    most = candidates.groupBy("block", "shard").count().agg(F.max("count")).first()[0]
    assert shards == 12 and most < 100
    best = topk.exact_top_k(frame).filter("query_id = 50").orderBy("rank").collect()
    assert [(r["vec_id"], r["score"]) for r in best] == [(3, 6 * 65536)] * 5
    huge = spark.createDataFrame([(0, [1e306, 1.0], 0), (1, [1.0, 2.0], 0), (2, [-1.0, 2.0], 0)], "vec_id long, embedding array<double>, label int")
    assert [(r["vec_id"], r["score"]) for r in topk.exact_top_k(huge).orderBy("rank").collect()] == [(1, 2**63 - 1), (2, -(2**63))]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Tables with awkward documents, and empty ones."""
    rng = random.Random(9)
    passage = "\n".join(words(rng, 25) for _ in range(4))
    base = words(rng, 200)
    rows = [(k, words(rng, 40) + ("\nyou are vilex." if k % 3 == 0 else "")) for k in range(300)]
    rows += [(400, base), (401, base + " end"), (401, base + " end"), (402, passage + "\n" + words(rng, 30)), (403, words(rng, 30) + "\n" + passage), (404, None), (405, ""), (None, words(rng, 30)), (406, "mail a@b.co now " + words(rng, 10)), (407, words(rng, 9_000))]
    out = {}
    for name, some in (("full", rows), ("empty", [])):
        where = str(tmp_path_factory.mktemp(name))
        docs(spark, some).write.parquet(f"{where}/documents.parquet")
        spark.createDataFrame([(i, 1, int("vilex" in (t or ""))) for i, t in some if i is not None and i < 300], "doc_id long, quality int, toxic int").write.parquet(f"{where}/labels.parquet")
        out[name] = where
    return out, rows


def test_the_pipeline_keeps_what_it_should(spark, folder):
    where, rows = folder
    stages, kept = dict(corpus_pipeline.STAGES), spark.read.parquet(f"{where['full']}/documents.parquet")
    toxic = {i for i, t in rows if t and "vilex" in t}
    seen = {}
    for name, stage in list(stages.items())[:-1]:
        kept = stage(spark, kept, where["full"])
        assert kept.columns == [c.split()[0] for c in DOCS.split(", ")]
        kept = spark.createDataFrame(kept.collect(), DOCS)
        seen[name] = kept.collect()
    ids = lambda name: sorted(r["doc_id"] for r in seen[name] if r["doc_id"] is not None)
    assert set(ids("toxicity")) == {i for i, _ in rows if i is not None} - toxic and len(seen["toxicity"]) == len(rows) - len(toxic)
    lines = {r["doc_id"]: r["text"] for r in seen["line_dedup"]}
    passage = rows[-7][1].split("\n")[:4]
    assert all(x in lines[402] for x in passage) and not any(x in (lines.get(403) or "") for x in passage) and lines[404] is None and lines[405] == ""
    near = ids("near_dedup")
    assert 400 in near and 401 not in near and {402, 404, 405, 406, 407} <= set(near) and any(r["doc_id"] is None for r in seen["near_dedup"])
    last = {r["doc_id"]: (r["text"], r["n_chars"]) for r in seen["pii"]}
    assert last[406][0].startswith("mail [EMAIL] now ") and last[406][1] == len(last[406][0])
    packed = stages["packing"](spark, kept, where["full"]).collect()
    assert {r["doc_id"] for r in packed} == {r["doc_id"] for r in seen["pii"]} and max(r["offset"] + r["length"] for r in packed) <= 2048


def test_the_pipeline_runs_on_empty_tables(spark, folder):
    assert corpus_pipeline.run(spark, folder[0]["empty"]).count() == 0
