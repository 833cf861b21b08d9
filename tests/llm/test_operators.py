"""Corpus operators on small inputs, against brute force, with the awkward rows: nulls, empty and long
texts, ties, repeated rows, empty tables, extra columns."""

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pandas as pd
import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tilework.llm import ann, chat, linededup, mainhtml, minhash, packing, pii, queries, sampling, topk, toxicity

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def words(rng, n):
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 6))) for _ in range(n))


def docs(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", None if t is None else len(t)) for i, t in rows], DOCS)


@pytest.fixture(scope="module")
def awkward():
    rng = random.Random(3)
    base = words(rng, 120)
    long = "\n".join(words(rng, 40) for _ in range(900))
    copies = [" ".join(w if k != 7 * c else "zzz" for k, w in enumerate(base.split())) for c in range(1, 6)]
    rows = [(1, base), (2, base), (3, ""), (4, None), (5, "   \n\t "), (6, "one two"), (7, "ONE  two"), (8, long), (9, base.upper()), (None, base), (10, "solo line"), (10, "solo line")]
    return rows + [(20 + k, c) for k, c in enumerate(copies)] + [(40 + k, words(rng, 200)) for k in range(6)]


def shingles(text):
    found = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    if not found:
        return frozenset()
    return frozenset(tuple(found[k : k + 5]) for k in range(len(found) - 4)) if len(found) >= 5 else frozenset([tuple(found)])


def test_near_duplicates_equal_brute_force(spark, awkward):
    sets = [(i, shingles(t)) for i, t in awkward]
    root = {i: i for i, _ in sets if i is not None}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, s in sets:
        for j, t in sets:
            if i is not None and j is not None and i < j and s and t and 100 * len(s & t) >= 85 * len(s | t):
                a, b = top(i), top(j)
                root[max(a, b)] = min(a, b)
    frame = docs(spark, awkward).withColumn("rep", F.lit(1)).withColumn("bands", F.lit("x"))
    got = sorted((r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in minhash.near_duplicates(frame).collect() if r["doc_id"] is not None)
    assert got == sorted((i, len(s), top(i), top(i) == i) for i, s in sets if i is not None)
    assert minhash.near_duplicates(docs(spark, [])).count() == 0


def test_a_chain_of_copies_links_through_blocks(spark, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK", 4)
    rng = random.Random(5)
    base = words(rng, 300).split()
    rows = []
    for k in range(14):
        for at in rng.sample(range(300), 4):
            base[at] = f"v{k}x{at}"
        rows.append((k, " ".join(base)))
    sets = [shingles(t) for _, t in rows]
    label = list(range(14))
    for _ in range(14):
        for a in range(14):
            for b in range(14):
                if 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b]):
                    label[a] = label[b] = min(label[a], label[b])
    got = {r["doc_id"]: r["component_id"] for r in minhash.near_duplicates(docs(spark, rows)).collect()}
    assert got == dict(enumerate(label))


def test_the_stage_links_at_four_fifths(spark):
    rng = random.Random(8)
    rows = []
    for k in range(12):
        base = words(rng, 300).split()
        other = list(base)
        for at in range(6):
            other[10 + 40 * at : 10 + 40 * at + k % 6] = [f"v{k}x{at}x{c}" for c in range(k % 6)]
        rows += [(2 * k, " ".join(base)), (2 * k + 1, " ".join(other))]
    sets = {i: shingles(t) for i, t in rows}
    near = {b for a in sets for b in sets if a < b and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])}
    between = {b for b in near if 100 * len(sets[b - 1] & sets[b]) < 85 * len(sets[b - 1] | sets[b])}
    assert between and len(near) < 12
    stage = dict(corpus_pipeline.STAGES)["near_dedup"]
    assert {r["doc_id"] for r in stage(spark, docs(spark, rows), "").collect()} == set(sets) - near
    assert {r["doc_id"] for r in minhash.near_duplicates(docs(spark, rows)).filter("kept").collect()} == set(sets) - (near - between)


def test_min_and_max_estimate_similarity():
    rng = np.random.default_rng(4)
    common, a, b = (rng.integers(0, 2**63, n, dtype=np.uint64) for n in (900, 50, 50))
    x, y = minhash.signature(np.concatenate((common, a))), minhash.signature(np.concatenate((common, b)))
    assert abs((x == y).mean() - 0.9) < 0.1 and len(x) == 2 * minhash.PERMUTATIONS


def test_line_chunks_equal_sequential_removal(spark, awkward):
    rng = random.Random(6)
    passage = "\n".join(words(rng, 12) for _ in range(12))
    rows = [*awkward, (60, words(rng, 60) + "\n" + passage), (61, passage + "\n" + words(rng, 60)), (62, "x\n" + passage)]
    seen, want = set(), []
    for i, t in sorted(((i, t) for i, t in rows if i is not None), key=lambda r: r[0]):
        lines, keep, gone = (t or "").split("\n"), [], 0
        for lo, hi, n in linededup.chunks(t or ""):
            part = "\n".join(lines[lo:hi])
            if linededup._eligible(lo, hi, n):
                if part in seen or part == base_of(rows):
                    gone += 1
                    seen.add(part)
                    continue
                seen.add(part)
            keep += lines[lo:hi]
        want.append((i, "\n".join(keep) if gone else t, gone))
    got = [(r["doc_id"], r["text"], r["removed_chunks"]) for r in linededup.dedup_lines(docs(spark, rows)).collect() if r["doc_id"] is not None]
    key = lambda r: (r[0], r[1] or "", r[2])
    assert sorted(got, key=key) == sorted(want, key=key)
    assert linededup.dedup_lines(docs(spark, [])).count() == 0
    kept = linededup.without_repeats(docs(spark, rows))
    assert kept.columns == docs(spark, []).columns and kept.filter("doc_id = 2").count() == 0 and kept.filter("doc_id in (3, 4, 5)").count() == 3


def base_of(rows):
    """The text that the row without an id holds: it counts as the earlier occurrence."""
    return next(t for i, t in rows if i is None)


def test_boundaries_resist_shifts():
    rng = random.Random(7)
    lines = [words(rng, 6) for _ in range(200)]
    cut = lambda t: {"\n".join(t.split("\n")[lo:hi]) for lo, hi, _ in linededup.chunks(t)}
    a, b = cut("\n".join(lines)), cut("\n".join([*lines[:50], "new line", *lines[50:]]))
    assert len(a - b) <= 3
    assert "\n".join("\n".join("\n".join(lines).split("\n")[lo:hi]) for lo, hi, _ in linededup.chunks("\n".join(lines))) == "\n".join(lines)


def test_repeated_runs_of_lines_go_whole(spark):
    rng = random.Random(11)
    texts = []
    for n, size in ((2, 30), (3, 20), (6, 10), (12, 8), (4, 15), (40, 2)):
        passage = [words(rng, size) for _ in range(n)]
        passage.insert(n // 2, "")
        texts += ["\n".join([words(rng, 12) for _ in range(rng.randint(0, 4))] + passage + [words(rng, 12) for _ in range(rng.randint(0, 4))]) for _ in range(3)]
    short = "\n".join(words(rng, 5) for _ in range(4))
    texts += [words(rng, 12) + "\n" + short + "\n" + words(rng, 12) for _ in range(2)]
    split = [t.split("\n") for t in texts]
    gone = [set() for _ in texts]
    for b in range(len(texts)):
        for a in range(b):
            for i in range(len(split[a])):
                for j in range(len(split[b])):
                    k = 0
                    while i + k < len(split[a]) and j + k < len(split[b]) and split[a][i + k] == split[b][j + k]:
                        k += 1
                    while k and not split[b][j + k - 1]:
                        k -= 1
                    if k and split[b][j] and sum(len(x.split()) for x in split[b][j : j + k]) > 50:
                        gone[b].update(range(j, j + k))
    seen = set()
    for b, t in enumerate(texts):
        for lo, hi, n in linededup.chunks(t):
            part = "\n".join(split[b][lo:hi])
            if linededup._eligible(lo, hi, n) and part in seen:
                gone[b].update(range(lo, hi))
            seen.add(part)
    want = [(b, "\n".join(x for k, x in enumerate(split[b]) if k not in gone[b]), len(gone[b])) for b in range(len(texts))]
    assert sum(n for _, _, n in want) > 120
    got = linededup.dedup_lines(docs(spark, enumerate(texts)), runs=True).collect()
    assert sorted((r["doc_id"], r["text"], r["removed_lines"]) for r in got) == want
    assert all((r["removed_chunks"] > 0) == (r["removed_lines"] > 0) for r in got)


def test_runs_that_overlap_their_own_repeat_keep_one_copy(spark):
    lines = ["one two three four five six seven eight nine ten eleven"] * 40
    got = {r["doc_id"]: r["text"] for r in linededup.dedup_lines(docs(spark, [(1, "\n".join(lines)), (2, "\n".join(lines))]), runs=True).collect()}
    assert got[2] == "" and 0 < len(got[1].split("\n")) <= 5


PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(digits):
    total = 0
    for k, c in enumerate(reversed(digits)):
        v = int(c) * (1 + k % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def valid(kind, text):
    digits = re.sub("[^0-9]", "", text)
    return {"ip": lambda: all(int(p) <= 255 for p in text.split(".")), "card": lambda: 16 <= len(digits) <= 19 and luhn(digits), "phone": lambda: 8 <= len(digits) <= 15, "email": lambda: True}[kind]()


def test_personal_data_equals_the_plain_patterns(spark):
    rng = random.Random(8)
    parts = ["a@b.co", "a@b.c_d@e.f", "x.y+z@sub.host-1.org.", "1.2.3.4.5.6.7.8", "256.1.1.1", "007.0.0.1", "4111 1111 1111 1111", "4111-1111-1111-11112", "4111111111111111 4111111111111111", "+33 (0)1.23-45 67 89", "+1 2", "++4912345678", "é😀", "12", "9-9 9", "@", "a@@b.c", " ", "\n", "GB82 WEST 1234 5698 7654 32", "tel 555-123-4567"]
    rows = [(k, "".join(rng.choice(parts) + rng.choice(["", " ", "z"]) for _ in range(rng.randint(0, 12)))) for k in range(300)]
    rows += [(1000, None), (1001, ""), (1002, "a" * 150_000), (1003, "1" * 150_000), (1004, "1 " * 60_000), (1005, "+1" * 60_000), (1006, "a@b." * 30_000)]
    got = {r["doc_id"]: r for r in pii.digest(docs(spark, rows)).collect()}
    for i, t in rows:
        spans = [f"{kind}:{m.start()}:{m.end()}" for kind, p in PATTERNS.items() for m in re.finditer(p, t if t and len(t) < 100_000 else "") if valid(kind, m.group())]
        if len(t or "") < 100_000:
            assert got[i]["base_sha256"] == hashlib.sha256(",".join(spans).encode()).hexdigest(), (i, t)
            assert got[i]["spans"].split(",")[: len(spans)] == (spans or [got[i]["spans"]])[: len(spans)]
    assert pii.digest(docs(spark, [])).count() == 0


def test_checksums_and_context_add_spans(spark):
    rows = [(1, "iban GB82 WEST 1234 5698 7654 32 ok"), (2, "iban GB83 WEST 1234 5698 7654 32 ok"), (3, "my card 378282246310005"), (4, "item 378282246310005"), (5, "call 555-123-4567"), (6, "code 555-123-4567")]
    got = {r["doc_id"]: r["spans"].split(":")[0] for r in pii.digest(docs(spark, rows)).collect()}
    assert got == {1: "iban", 2: "", 3: "card_short", 4: "", 5: "phone_national", 6: ""}


def test_redaction_masks_and_keeps_columns(spark):
    rows = docs(spark, [(1, "mail é a@b.co and 10.0.0.1!"), (2, None), (3, "clean")])
    out = pii.redact(rows)
    assert out.columns == rows.columns and {r["doc_id"]: r["text"] for r in out.collect()} == {1: "mail é [EMAIL] and [IP]!", 2: None, 3: "clean"}


def test_packing_covers_every_id_once(spark, awkward):
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(WORD_BPE)
    rows = packing.pack(docs(spark, [*awkward, (70, "don't, İt's\x1cé ́x <|endoftext|>y 42.")]), WORD_BPE).collect()
    by = {}
    for r in rows:
        by.setdefault((r["doc_id"], r["doc_tokens"]), []).append((r["start"], r["length"], r["ids_crc32"]))
    for i, t in [*awkward, (70, "don't, İt's\x1cé ́x <|endoftext|>y 42.")]:
        ids = np.array([*plain.encode(t or "", add_special_tokens=False).ids, 1], "<u4")
        cut = [(lo, min(2048, len(ids) - lo), zlib.crc32(ids[lo : lo + 2048].tobytes())) for lo in range(0, len(ids), 2048)]
        assert set(cut) <= set(by[i, len(ids)])
    fill = {}
    for r in sorted(rows, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == fill.get(r["sequence_id"], 0)
        fill[r["sequence_id"]] = r["offset"] + r["length"]
    assert max(fill.values()) <= 2048
    assert packing.pack(docs(spark, []), WORD_BPE).count() == 0


def test_patterns_cover_the_demand_and_come_near_the_bound():
    rng = np.random.default_rng(9)
    demand = np.append(np.floor(900 * np.exp(-np.arange(255) / 60)) + rng.integers(0, 40, 255), 30_000.0)
    found = packing.patterns(demand)
    assert (sum(c * n for c, n in found) == demand).all() and all((c * np.arange(1, 257)).sum() <= 256 for c, _ in found)
    used = sum(n for _, n in found)
    assert used <= 1.001 * math.ceil((demand * np.arange(1, 257)).sum() / 256) + 2
    assert packing.patterns(np.zeros(256)) == []


def test_toxicity_learns_words_and_finds_the_sentence(spark):
    rng = random.Random(10)
    rows, marks = [], []
    for k in range(1200):
        lines = [words(rng, 8) + "." for _ in range(rng.randint(1, 6))]
        if k % 4 == 0:
            lines.insert(rng.randint(0, len(lines)), f"you are {rng.choice(['vilex', 'nastyish', 'nastyal'])} " + words(rng, 3) + ".")
        rows.append((k, " ".join(lines)))
        marks.append((k, 5, int(k % 4 == 0)))
    marks += [(None, 1, 1), (3, 1, None)]
    rows += [(5000, ""), (5001, None), (None, "you are vilex."), (5002, "you are vilex. " + words(rng, 20_000))]
    labels = spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
    got = {r["doc_id"]: r for r in toxicity.scored_documents(docs(spark, rows).withColumn("score", F.lit(1)), labels).collect()}
    held = [k for k in range(1200) if zlib.crc32(str(k).encode()) % 5 == 0]
    assert all(got[k]["held_out"] == (k in held) for k in range(1200))
    assert sum(got[k]["predicted"] == int(k % 4 == 0) for k in held) >= 0.98 * len(held)
    assert got[5000]["predicted"] == got[5001]["predicted"] == 0 and got[None]["predicted"] == got[5002]["predicted"] == 1
    s = got[5002]["sentences"][0]
    assert "vilex" in rows[-1][1][s["start"] : s["end"]]
    assert toxicity.scored_documents(docs(spark, []), labels).count() == 0
    assert all(r["predicted"] == 0 for r in toxicity.scored_documents(docs(spark, rows[:5]), labels.limit(0)).collect())


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")


def test_exact_top_k_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(topk, "SHARD", 60)
    monkeypatch.setattr(topk, "QUERY_BLOCK", 3)
    rng = np.random.default_rng(11)
    e = rng.normal(size=(400, 8)).astype(np.float32)
    e[50:120] = e[0]
    rows = [(k, e[k].tolist(), 0) for k in range(400)] + [(900, None, 0), (950, [float("nan")] * 8, 0), (1000, [1.0, None] * 4, 0), (1050, [], 0), (1100, [1.0, 2.0], 0), (1101, [3.0, 4.0], 0)]
    got = {}
    for r in sorted(topk.exact_top_k(vectors(spark, rows)).collect(), key=lambda r: (r["query_id"], r["rank"])):
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    q = np.floor(256 * e.astype(np.float64)).astype(np.int64)
    for i in range(0, 400, 50):
        s = q @ q[i]
        order = [k for k in np.lexsort((np.arange(400), -s)) if k != i][:5]
        assert got[i] == [(k, s[k]) for k in order]
    assert got[1100] == [(1101, 256 * 256 * 11)] and set(got) == {*range(0, 400, 50), 1100}
    assert topk.exact_top_k(vectors(spark, [])).count() == 0


def test_large_products_stay_exact():
    a = np.array([[2.0**40, 3.0]])
    assert topk.products(a, a)[0, 0] == (1 << 63) - 1
    b = np.array([[2.0**30, 1.0]])
    assert topk.products(b, b)[0, 0] == 2**60 + 1


def test_neighbours_reach_recall_and_exact_scores(spark, monkeypatch):
    monkeypatch.setattr(topk, "SHARD", 500)
    rng = np.random.default_rng(12)
    e = rng.normal(size=(1500, 32)).astype(np.float32)
    e[300:320] = 2 * e[0]
    rows = [(k, e[k].tolist(), 0) for k in range(1500)] + [(2000, [0.0] * 32, 0), (2050, None, 0)]
    got = {}
    for r in sorted(ann.search(vectors(spark, rows)).collect(), key=lambda r: (r["query_id"], r["rank"])):
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    x = e.astype(np.float64)
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    hits = 0
    for i in range(0, 1500, 50):
        s = unit @ unit[i]
        order = [k for k in np.lexsort((np.arange(1500), -np.round(s, 12))) if k != i][:5]
        hits += len({k for k, _ in got[i]} & set(order))
        assert all(abs(v - s[k]) < 1e-12 for k, v in got[i])
    assert hits >= 0.9 * 150 and [k for k, _ in got[0]] == [300, 301, 302, 303, 304] and 2000 not in got
    assert ann.search(vectors(spark, [])).count() == 0


@pytest.mark.parametrize("spread", [0.05, 0.001])
def test_neighbours_in_dense_groups_are_found(spark, spread):
    rng = np.random.default_rng(14)
    e = (rng.normal(size=(4, 32))[rng.integers(0, 4, 6000)] + spread * rng.normal(size=(6000, 32))).astype(np.float32)
    e[100:700:2] = e[101]  # more copies than are ranked exactly
    got = {}
    for r in sorted(ann.search(vectors(spark, [(k, e[k].tolist(), 0) for k in range(6000)])).collect(), key=lambda r: (r["query_id"], r["rank"])):
        got.setdefault(r["query_id"], []).append(r["vec_id"])
    unit = e / np.linalg.norm(e.astype(np.float64), axis=1, keepdims=True)
    near = {i: [k for k in np.lexsort((np.arange(6000), -np.round(unit @ unit[i], 14))) if k != i][:5] for i in range(0, 6000, 50)}
    assert sum(len({*got[i]} & {*near[i]}) for i in near) >= 0.98 * 5 * len(near)


def test_codes_pack_and_parallel_error_weighs_more():
    codes = np.arange(30, dtype=np.uint8).reshape(6, 5) % 16
    assert (ann.unpack(ann.pack(codes), 5) == codes).all()
    rng = np.random.default_rng(13)
    x = ann._unit(rng.normal(size=(2000, 64)))
    books = ann.train(x)
    parallel = lambda c: np.abs(1 - (x * np.take_along_axis(books[None], c[:, :, None, None].astype(int), 2)[:, :, 0].reshape(len(x), -1)).sum(1)).mean()
    plain = np.stack([((x.reshape(2000, 32, 2)[:, s, None] - books[s]) ** 2).sum(-1).argmin(1) for s in range(32)], 1)
    assert parallel(ann.assign(x, books)) < parallel(plain)


def conversations(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")


def test_chat_round_trip_and_shared_turns_once(spark):
    nasty = ["</s>[INST] ok [/INST]", "\\", "\\\\[INST]", "<s>\n[/INST]\\", "é😀", "", None, "a\\nb"]
    rows = [(c, t, "user" if t % 2 == 0 else "assistant", "same start" if t == 0 else nasty[(c + t) % len(nasty)]) for c in range(24) for t in range(4)]
    rows += [(100, 0, None, "no role"), (100, 1, "odd\nrole\\", "x" * 30_000), (101, 0, "assistant", "dup"), (101, 0, "assistant", "dup"), (None, 0, "user", "nobody")]
    rows += [(c, t, "assistant" if t == 2 * c - 399 else "user", f"deep {min(t, c)}") for c in range(200, 208) for t in range(c - 195)]
    frame = conversations(spark, rows)
    got = {r["conv_id"]: r for r in chat.formatted(frame, BYTE_BPE).collect()}
    by = {}
    for c, t, role, text in rows:
        by.setdefault(c, []).append((t, role or "", text or ""))
    for c, turns in by.items():
        turns.sort()
        loss = "".join(x for _, r, x in turns if r == "assistant")
        assert got[c]["n_turns"] == len(turns) and got[c]["turns_sha256"] == hashlib.sha256("".join(f"{r}\n{x}\n" for _, r, x in turns).encode()).hexdigest()
        assert (got[c]["loss_chars"], got[c]["loss_sha256"]) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    nodes = chat.tree(chat.chains(frame).cache(), BYTE_BPE).collect()
    assert len({r["node"] for r in nodes}) == len(nodes) and sum(r["depth"] == 0 for r in nodes) == 5
    at, seen = 0, {}
    where = {bytes(r["node"]): r for r in nodes}
    for r in sorted(nodes, key=lambda r: r["start"]):
        assert r["start"] == at
        at += r["n_tokens"]
        assert r["position"] == sum(a["end"] - a["start"] for a in r["attends"]) and len(r["attends"]) <= r["depth"]
        seen[bytes(r["node"])] = {x for a in r["attends"] for x in range(a["start"], a["end"])}
    parents = {}
    for c in chat.chains(frame).collect():
        steps = [bytes(c["chain"][k : k + 16]) for k in range(0, len(c["chain"]), 16)]
        parents |= dict(zip(steps[1:], steps[:-1], strict=True))
    for node, tokens in seen.items():
        up = parents.get(node)
        want = seen[up] | set(range(where[up]["start"], where[up]["start"] + where[up]["n_tokens"])) if up else set()
        assert tokens == want
    assert chat.formatted(conversations(spark, []), BYTE_BPE).count() == 0


@pytest.mark.parametrize("text", ["", "plain", "\\", "[INST]", "\\[INST]", "<s></s><<SYS>>", "a\\\\b</s>"])
def test_escape_is_reversible(text):
    assert chat.unescape(chat.escape(text)) == text
    assert not any(x in chat.escape(text) for x in chat.CONTROL)
    assert chat.parsed("".join(chat.framed(text, text) + chat.framed("a", "b"))) == [(text, text), ("a", "b")]


def test_turns_are_read_in_linear_time():
    import time

    took = []
    for n in (1_000, 8_000):
        path, began = chat._Path(), time.perf_counter()
        for k in range(n):
            path.intervals()
            path.push(b"x", 3 * k, 3)
        assert path.intervals() == [(0, 3 * n)]
        chat.parsed("".join(sum((chat.framed("user", "[INST] x") for _ in range(n)), ())))
        took.append(time.perf_counter() - began)
    assert took[1] < 40 * took[0]


def segmentations(lat, text):
    if not text:
        return [((), 0.0)]
    out = []
    for k in range(1, len(text) + 1):
        if piece := lat.pieces.get(text[:k]):
            out += [((piece[0], *rest), piece[1] + w) for rest, w in segmentations(lat, text[k:])]
    return out


def test_samples_follow_the_lattice_without_replacement():
    lat = sampling.lattices(PIECES)
    text = lat.model.normalize("then, we")
    found = segmentations(lat, text)
    total = math.log(sum(math.exp(w) for _, w in found))
    p = {s: math.exp(w - total) for s, w in found}
    n = 4000
    drawn = sampling.sample_paths(lat, lat.starts([text]) * n, np.arange(n, dtype=np.uint64) * sampling._C[0], 2)
    ids = [[tuple(lat.piece[x.edges].tolist()) for x in paths] for paths, _ in drawn]
    assert all(a != b for a, b in ids)
    for s in sorted(p, key=p.get)[-3:]:
        assert abs(sum(a == s for a, _ in ids) / n - p[s]) < 0.03
        second = sum(p[a] * p[s] / (1 - p[a]) for a in p if a != s)
        assert abs(sum(b == s for _, b in ids) / n - second) < 0.03
    weights = [sum(math.exp(v) / -math.expm1(-math.exp(v + bound)) for v in (float(lat.share[x.edges].sum()) for x in paths)) for paths, bound in drawn]
    assert abs(np.mean(weights) - 1) < 0.02


def test_only_bytes_of_longer_characters_are_decoded_as_bytes(monkeypatch):
    lat = sampling.lattices(PIECES)
    ids = [lat.byte[10], *(lat.pieces[c][0] for c in "then"), lat.byte[0xC3], lat.byte[0xA9]]
    assert lat.decode(np.array(ids)) == "\nthen\u00e9"
    monkeypatch.setattr(lat, "spelt", None)
    assert lat.decode(np.array(ids[:5])) == "\nthen"


def test_units_are_numbered_once_and_built_apart_from_their_order():
    lat = sampling.Lattices(PIECES)
    texts = [lat.model.normalize(x) for x in ("a\n\u0000b the", "the \u65e5\u672c a b\n", "zz the")]
    first = lat.starts(texts)
    known = len(lat.index)
    again = lat.starts(texts)
    assert not lat.index.new and len(lat.index) == known and all((a == b).all() for a, b in zip(first, again, strict=True))
    other = sampling.Lattices(PIECES)
    key = np.arange(1, 4, dtype=np.uint64)
    drawn = [sampling.sample_paths(x, x.starts(order), k, 2) for x, order, k in ((lat, texts, key), (other, texts[::-1], key[::-1]))]
    ids = [[[x.piece[p.edges].tolist() for p in paths] for paths, _ in found] for x, found in zip((lat, other), drawn, strict=True)]
    assert ids[0] == ids[1][::-1]


def test_equal_units_of_texts_are_looked_up_once():
    class Counted(type(sampling.lattices(PIECES).index)):
        asked = 0

        def __getitem__(self, unit):
            self.asked += 1
            return super().__getitem__(unit)

    lat = sampling.Lattices(PIECES)
    lat.index = Counted()
    text = lat.model.normalize("then, we\n" * 500)
    found = lat.starts([text, text])
    assert lat.index.asked <= 10 and len(lat.index) <= 5
    assert [len(x) for x in found] == [len(lat.cut.findall(text))] * 2


def test_units_are_those_of_the_pattern():
    lat = sampling.Lattices(PIECES)
    parts = [*"ab Z09_,.'\u00b2\u00e9\u00df\n\t\0\u2581\u65e5\u0301\ud800\uffff", "\U0001f600", "\U00010400", "\U00020000", "\n\n", "\u2581\u2581", "eightlet", "nineletter", "tenletters", "\u2581eightlet", " eightlet", "........."]
    rng = np.random.default_rng(1)
    texts = ["", *("".join(rng.choice(parts, rng.integers(0, 12))) for _ in range(3000)), "", ""]
    for lo in range(0, len(texts), 700):
        some = texts[lo : lo + 700]
        named = {n: u for u, n in lat.index.items()}
        numbers = lat._numbered(some)
        named |= {n: u for u, n in lat.index.items()}
        assert [[named[n] for n in x.tolist()] for x in numbers] == [lat.cut.findall(t) for t in some]
    assert [len(x) for x in lat._numbered(["", ""])] == [0, 0]


def test_the_best_branches_are_found_without_the_bounds_of_most(monkeypatch):
    lat = sampling.Lattices(PIECES)
    texts = [lat.model.normalize(x) for x in ("then, we were in the house of the other people " * 20, "a", "then, we")]
    keys = np.arange(1, 4, dtype=np.uint64) * sampling._C[0]
    paths = [(k, found[0], 0) for k, (found, _) in enumerate(sampling.sample_paths(lat, lat.starts(texts), keys, 1))]
    every = {}
    for k, path, _ in paths:
        every[k] = []
        for place, (source, before) in enumerate(zip(path.sources.tolist(), path.before.tolist(), strict=True)):
            for offset in range(lat.many[source]):
                if (edge := int(lat.first[source]) + offset) != path.edges[place]:
                    noise = -np.log(sampling._uniform(keys[k : k + 1], *([x] for x in (1_000, place, offset))))[0]
                    every[k].append((float(np.logaddexp(path.bound, np.log(noise / np.exp(lat.share[edge])) - before)), 0, place, edge))
        every[k].sort()
    bounded, plain = [], np.logaddexp
    monkeypatch.setattr(np, "logaddexp", lambda a, b: bounded.append(np.size(b)) or plain(a, b))
    for keep in (1, 2):
        found = sampling._branches(lat, paths, keys, 0, keep, [np.inf] * 3)
        assert all(sorted(found.get(k, []))[:keep] == every[k][:keep] for k in every)
    assert sum(bounded) < sum(map(len, every.values())) / 2
    limits = [x[min(3, len(x) - 1)][0] if x else np.inf for x in every.values()]
    found = sampling._branches(lat, paths, keys, 0, 4, limits)
    assert all(sorted(found.get(k, []))[:4] == every[k][:4] for k in every)


def test_samples_leave_the_worker_as_arrow_arrays_with_whole_ids(spark):
    frame = docs(spark, [(2**60 + 1, "then, we"), (None, "then, we"), (2**60 + 3, None)]).coalesce(1)
    found = sampling.sample(frame, PIECES)
    assert "MapInArrow" in found._jdf.queryExecution().executedPlan().toString()
    assert sorted(r["doc_id"] or 0 for r in found.collect()) == [0, 0, 2**60 + 1, 2**60 + 1, 2**60 + 3]
    assert found.dtypes[-1] == ("ids", "array<int>")


def test_encoding_decodes_and_does_not_depend_on_partitions(spark, awkward):
    frame = docs(spark, [*awkward, (80, "  tabs\tand ² 😀 日本\r\n x"), (81, "a")])
    rows = sampling.sample(frame, PIECES).collect()
    assert all(r["decoded"] for r in rows)
    again = sampling.sample(frame.repartition(3), PIECES, ids=False).collect()
    key = lambda r: (r["doc_id"] or -1, r["rank"], r["ids_crc32"], r["inclusion"])
    assert sorted(map(key, rows)) == sorted(map(key, again))
    texts = sampling.decode(sampling.sample(frame.filter("doc_id = 1"), PIECES), PIECES).select("text").distinct().collect()
    assert [r["text"] for r in texts] == [awkward[0][1]]
    assert sampling.sample(docs(spark, []), PIECES).count() == 0


def test_sampling_query_returns_the_ids_and_runs_its_decode(spark, sf_dir, monkeypatch):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()}
    lat, got = sampling.lattices(PIECES), queries.op6_sampling(spark, sf_dir).collect()
    assert len(got) > len(texts) and all(r["decoded"] and len(r["ids"]) == r["n_pieces"] for r in got)
    assert all(zlib.crc32(np.array(r["ids"], "<u4").tobytes()) == r["ids_crc32"] for r in got)
    assert all(lat.model.decode(r["ids"]) == sampling.shown(lat.model.normalize(texts[r["doc_id"]] or "")) for r in got[:200])
    monkeypatch.setattr(sampling.Lattices, "decode", lambda self, ids: "other")
    assert not any(next(sampling._encoded(PIECES, 2, True)(iter([pd.DataFrame({"doc_id": [1], "text": ["some text"]})])))["decoded"])


PAGE = '<html><head><title>T</title><style>p{}</style></head><body><nav><a href=x>Home</a></nav><div class="ad">Buy</div><article><h1>Big &amp; small</h1><p>One  <b>two</b>\n three<br>four<p>Five</article><div id="comments"><p>Nice</p></div><form><p>f</p></form><footer>&copy; me</footer>'


@pytest.mark.parametrize(("page", "text"), [
    (PAGE, "Big & small\nOne two three four\nFive"), (None, ""), ("", ""), ("just text", "just text"), ("<script>x", ""), ("<!-- a", ""), ("<p>a &lt;b&gt;&nbsp; c", "a <b> c"),
    ("<div id=menu><a href=1>Home</a></div><p>A first line of text</p><p>B</p><aside>side</aside>", "A first line of text\nB"),
])
def test_main_text(page, text):
    assert mainhtml.main_text(page) == text


def test_main_text_leaves_link_blocks_outside():
    links = "".join(f"<li><a href=/{k}>link {k}</a></li>" for k in range(6))
    page = f"<div><ul>{links}</ul></div><div><p>{'word ' * 30}</p><p>Short.</p><p>{'more ' * 20}</p></div><div><ul>{links}</ul></div>"
    assert mainhtml.main_text(page) == "\n".join((("word " * 30).strip(), "Short.", ("more " * 20).strip()))


@pytest.mark.parametrize("name", ["post hentry tag-news", "no-sidebar", "layout-with-sidebar", "entry no-comments", "side-by-side", "legal-analysis", "social-policy"])
def test_main_text_keeps_elements_whose_class_only_contains_a_noise_word(name):
    assert mainhtml.main_text(f'<div class="{name}"><p>A line of text</p></div>') == "A line of text"
    assert mainhtml.main_text(f'<body class="{name} sidebar"><article class="tags {name}"><p>A line of text</p></article></body>') == "A line of text"


@pytest.mark.parametrize("name", ["sidebar", "x cookie-banner", "site-footer", "nav", "comments-area", "comment-list", "share_buttons"])
def test_main_text_drops_whole_noise_classes(name):
    assert mainhtml.main_text(f'<div class="{name}"><p>Noise of some length</p></div><p>A line of text</p>') == "A line of text"


@pytest.mark.parametrize(("page", "text"), [
    ('<p title=" the hidden cost of">A line</p>', "A line"), ("<p hidden>no</p><p>A line</p>", "A line"), ('<p aria-hidden="true">no</p><p style="display: none">no</p><p>A line</p>', "A line"),
    ("<article><h1><a href=1>Head</a></h1><p><a href=2>By one</a></p><p>A line</p><p><a href=3>Last</a></p></article>", "Head\nBy one\nA line\nLast"),
    ("<select><option>a<option>b</select><p class=ad>Buy<p>A line", "A line"), ("<ul><li class=ad>Buy<li>A line</ul>", "A line"), ("<table><tr><td class=ad>Buy<td>A line</table>", "A line"),
])
def test_main_text_keeps_what_markup_only_seemed_to_drop(page, text):
    assert mainhtml.main_text(page) == text


def test_main_text_keeps_every_substantial_stretch():
    links = "".join(f"<p><a href=/{k}>link {k}</a></p>" for k in range(5))
    one, two = ("word " * 60).strip(), ("more " * 40).strip()
    assert mainhtml.main_text(f"<div><p>{one}</p>{links}<p>{two}</p>{links}<p>x</p></div>") == f"{one}\n{two}"


def test_pages_query_shape(spark):
    rows = spark.createDataFrame([(1, "u", PAGE), (None, None, None)], "page_id long, url string, html string").withColumn("text", F.lit("x"))
    got = {r["page_id"]: r["n_chars"] for r in mainhtml.extract(rows).collect()}
    assert got == {1: len("Big & small\nOne two three four\nFive"), None: 0}


def test_pipeline_keeps_columns_and_clean_documents(spark, sf_dir):
    docs_in = spark.read.parquet(f"{sf_dir}/documents.parquet")
    kept = docs_in
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, kept, sf_dir)
        assert out.columns == docs_in.columns, name
        kept = corpus_pipeline.written(out)
    assert 0 < kept.count() < docs_in.count()
    packed = corpus_pipeline.STAGES[-1][1](spark, kept, sf_dir)
    assert packed.select("doc_id").distinct().count() == kept.select("doc_id").distinct().count()
