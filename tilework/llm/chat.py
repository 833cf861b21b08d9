"""Chat formatting as prefix trees: conversations that share their first turns are merged.

Every turn is framed by the template; a backslash inside each control string of a text, and before each
backslash, keeps control strings out of the emitted texts and can be taken back.  A chain of
hashes over the turns names the tree's nodes; distinct conversations are range-partitioned by their
chain, whose order is a depth-first walk, so each task emits the nodes its previous conversation does not
share, and a shared turn's tokens come out once.  What a partition shares with the one before it is
settled from one path a partition: the first conversation's and the one open at the end.

The output (tree) has, per node, its tokens, the part of them that is trained on (loss_from, loss_to),
its place in the emitted stream (start), the position id of its first token (tokens of its ancestors), and
the stream intervals of its ancestors, to which it attends besides itself; ancestors that lie next to each
other in the stream are one interval, so a conversation of n turns has about n intervals, not n * n / 2.

Turns are ordered by turn, then role, then text; null roles and texts are empty; each row with a null
conv_id is a conversation of its own; repeated rows are repeated turns; an empty table gives no nodes.  A conversation's
turns are one row, as its digest runs over them in order.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import held, lean, text_batches, written

#: The template's control strings.
CONTROL = ("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
_ESCAPED = re.compile("|".join(map(re.escape, ("\\", *CONTROL))))
_HEAD, _END = "<s>[INST]", "[/INST]</s>"
#: A turn in the stream: the role's line, in which line feeds are escaped, and the text up to the next bare control string.
_TURN = re.compile(r"<s>\[INST\]((?:[^\\\n]|\\.)*+)\n(.*?)\[/INST\]</s>", re.S)
TRAINED = "assistant"
#: Pieces encoded at once: an encoding holds far more than its ids.
SLICE = 256
TREE = "part int, leaf long, place long, edge boolean, node binary, depth int, root binary, n_tokens long, local long, position long, tokens array<int>, loss_from int, loss_to int, path array<struct<local:long,size:long>>"
_STEP = 16


def escape(text: str) -> str:
    """A backslash before each backslash, and after the first character of each control string."""
    return _ESCAPED.sub(lambda m: m[0][0] + "\\" + m[0][1:], text)


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.S)


def framed(role: str, text: str) -> tuple[str, str, str]:
    return f"{_HEAD}{escape(role).replace('\n', '\\\n')}\n", escape(text), _END


def parsed(stream: str) -> list[tuple[str, str]]:
    """(role, text) of each turn of a stream, which must hold whole turns only."""
    at, out = 0, []
    while at < len(stream):
        m = _TURN.match(stream, at)
        if not m:
            raise ValueError(f"no turn at {at}")
        out.append((unescape(m[1]), unescape(m[2])))
        at = m.end()
    return out


def _tokenizer(path: str):
    return held(("chat", path), lambda: _loaded(path))


def _loaded(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    found = Tokenizer.from_file(path)
    found.encode_special_tokens = True
    return found


def _chained(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        chains = []
        for turns in batch["turns"]:
            at, chain = b"", b""
            for x in turns:
                role, text = x["role"].encode("utf-8", "surrogatepass"), x["text"].encode("utf-8", "surrogatepass")
                at = hashlib.blake2b(at + len(role).to_bytes(8, "little") + role + text, digest_size=_STEP).digest()
                chain += at
            chains.append(chain)
        yield batch.assign(chain=pd.Series(chains, dtype=object, index=batch.index))


class _Path:
    """The nodes from the root to the one emitted last, their tokens summed up, and the runs of them that lie together in the stream."""

    def __init__(self) -> None:
        self.nodes: list[bytes] = []
        self.local: list[int] = []
        self.before = [0]  # tokens of the first k nodes
        self.runs: list[int] = []  # depth at which each run starts

    def cut(self, depth: int) -> None:
        del self.nodes[depth:], self.local[depth:], self.before[depth + 1 :]
        while self.runs and self.runs[-1] >= depth:
            self.runs.pop()

    def intervals(self) -> list[tuple[int, int]]:
        ends = [*self.runs[1:], len(self.nodes)] if self.runs else []
        return [(self.local[lo], self.before[hi] - self.before[lo]) for lo, hi in zip(self.runs, ends, strict=True)]

    def push(self, node: bytes, local: int, size: int) -> None:
        depth = len(self.nodes)
        if not depth or self.local[-1] + self.before[-1] - self.before[-2] != local:
            self.runs.append(depth)
        self.nodes.append(node)
        self.local.append(local)
        self.before.append(self.before[-1] + size)


def _emitted(tokenizer: str):
    def emit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        encoder, part = _tokenizer(tokenizer), TaskContext.get().partitionId()
        before, path, leaf, place, local = b"", _Path(), 0, 0, 0
        names = [c.split()[0] for c in TREE.split(", ")]
        for batch in batches:
            work = []
            for chain, turns in zip(batch["chain"], batch["turns"], strict=True):
                lo, hi = 0, min(len(chain), len(before)) // _STEP  # each step of a chain names all before it
                while lo < hi:
                    mid = (lo + hi + 1) // 2
                    lo, hi = (mid, hi) if chain[(mid - 1) * _STEP : mid * _STEP] == before[(mid - 1) * _STEP : mid * _STEP] else (lo, mid - 1)
                work += [(leaf, chain, d, turns[d]) for d in range(lo, len(chain) // _STEP)]
                before, leaf = chain, leaf + 1
            for lo in range(0, len(work), SLICE):
                some, rows = work[lo : lo + SLICE], []
                pieces = [p for _, _, _, turn in some for p in framed(turn["role"], turn["text"])]
                ids = [e.ids for e in encoder.encode_batch_fast(pieces, add_special_tokens=False)]
                for k, (of, chain, depth, turn) in enumerate(some):
                    head, body, tail = ids[3 * k : 3 * k + 3]
                    path.cut(depth)
                    tokens, node = [*head, *body, *tail], chain[depth * _STEP : (depth + 1) * _STEP]
                    loss = (len(head), len(head) + len(body)) if turn["role"] == TRAINED else (0, 0)
                    rows.append((part, of, place, False, node, depth, chain[:_STEP], len(tokens), local, path.before[-1], tokens, *loss, path.intervals()))
                    path.push(node, local, len(tokens))
                    place, local = place + 1, local + len(tokens)
                yield pd.DataFrame(rows, columns=names)
        rows = [(part, 0, place, True, x, k, None, path.before[k + 1] - path.before[k], path.local[k], 0, None, 0, 0, None) for k, x in enumerate(path.nodes)]
        yield pd.DataFrame(rows, columns=names)

    return lean(emit, ("chat", tokenizer))


def chains(turns: DataFrame) -> DataFrame:
    """(conv_id, turns, chain) of each conversation."""
    turn = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    named = turns.filter("conv_id is not null").groupBy("conv_id").agg(F.array_sort(F.collect_list(turn)).alias("turns"))
    whole = named.union(turns.filter("conv_id is null").select("conv_id", F.array(turn)))
    return whole.mapInPandas(lean(_chained), "conv_id long, turns array<struct<turn:long,role:string,text:string>>, chain binary")


def _leads(edges: list) -> list[tuple]:
    """(part, depths shared with the part before, what to add to local places, tokens shared, the shared nodes' intervals)
    of each part, from its first conversation's nodes and the path open at its end."""
    out, base, path = [], 0, []  # path: (node, start, size) open in the stream
    for r in sorted(edges, key=lambda r: r["part"]):
        shared = 0
        while shared < min(len(path), len(r["first"])) and r["first"][shared]["node"] == path[shared][0]:
            shared += 1
        skipped, upto, lead = sum(x["n_tokens"] for x in r["first"][:shared]), 0, []
        for _, start, size in path[:shared]:
            if lead and lead[-1][1] == start:
                lead[-1] = (lead[-1][0], start + size, lead[-1][2])
            else:
                lead.append((start, start + size, upto))
            upto += size
        out.append((r["part"], shared, base - skipped, skipped, lead))
        path = [path[k] if k < shared and x["local"] < skipped else (x["node"], x["local"] + base - skipped, x["n_tokens"]) for k, x in enumerate(r["last"])]
        base += r["tokens"] - skipped
    return out


def tree(conversations: DataFrame, tokenizer: str) -> DataFrame:
    """The emitted nodes: root, node, depth, tokens, loss_from and loss_to (places in tokens), start, position, attends.

    conversations: what chains() returns, written."""
    distinct = conversations.groupBy("chain").agg(F.first("turns").alias("turns"))
    raw = written(distinct.repartitionByRange("chain").sortWithinPartitions("chain").mapInPandas(_emitted(tokenizer), TREE))
    spark = raw.sparkSession
    listed = lambda when: F.array_sort(F.collect_list(F.when(when, F.struct("depth", F.hex("node").alias("node"), "n_tokens", "local"))))
    ends = raw.filter("edge or leaf = 0").groupBy("part").agg(listed(F.expr("not edge and leaf = 0")).alias("first"), listed(F.col("edge")).alias("last"))
    ends = ends.join(raw.filter("not edge").groupBy("part").agg(F.sum("n_tokens").alias("tokens")), "part")
    bases = spark.createDataFrame(_leads(ends.collect()), "part int, shared int, base long, skipped long, lead array<struct<start:long,end:long,upto:long>>")  # one path a partition
    kept = raw.filter("not edge").join(F.broadcast(bases), "part").filter((F.col("leaf") > 0) | (F.col("depth") >= F.col("shared")))
    covered = F.coalesce(F.when(F.get("path", F.lit(0))["local"] == 0, F.least(F.get("path", F.lit(0))["size"], F.col("skipped"))), F.lit(0))
    lead = F.transform(F.filter("lead", lambda x: x["upto"] < F.col("covered")), lambda x: F.struct(x["start"].alias("start"), F.least(x["end"], x["start"] + F.col("covered") - x["upto"]).alias("end")))
    own = F.transform("path", lambda x: F.struct((F.greatest(x["local"], F.col("skipped")) + F.col("base")).alias("start"), (x["local"] + x["size"] + F.col("base")).alias("end")))
    attends = F.concat(lead, F.filter(own, lambda x: x["end"] > x["start"]))
    return kept.withColumn("covered", covered).select("root", "node", "depth", "tokens", "loss_from", "loss_to", "n_tokens", (F.col("local") + F.col("base")).alias("start"), "position", attends.alias("attends"))


DIGEST = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def _read_back(tokenizer: str):
    """The digest of each conversation from its tokens and loss mask alone: turns are found by parsing the decoded stream."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        decoder = _tokenizer(tokenizer)
        for batch in batches:
            rows = []
            for conv, nodes in zip(batch["conv_id"], batch["nodes"], strict=True):
                ids = [t for x in nodes for t in x["tokens"].tolist()]
                masked = [t for x in nodes for t in x["tokens"][x["loss_from"] : x["loss_to"]].tolist()]
                stream, lost = decoder.decode_batch([ids, masked], skip_special_tokens=False)
                turns, lost = parsed(stream), unescape(lost)
                found = hashlib.sha256()
                for role, text in turns:
                    found.update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
                rows.append((conv, len(turns), found.hexdigest(), len(lost), hashlib.sha256(lost.encode("utf-8", "surrogatepass")).hexdigest(), len(stream)))
            yield pd.DataFrame(rows, columns=["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]).astype({"conv_id": "Int64"})

    return lean(read, ("chat", tokenizer))


def formatted(turns: DataFrame, tokenizer: str) -> DataFrame:
    """Digest of each conversation, read back from the tree."""
    turns = text_batches(turns).select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text")
    conversations = written(chains(turns).withColumn("conv", F.monotonically_increasing_id()))
    nodes = written(tree(conversations, tokenizer))
    count = F.octet_length("chain") / _STEP
    steps = conversations.select("conv", "conv_id", F.explode(F.transform(F.sequence(F.lit(0), count.cast("int") - 1), lambda k: F.struct(k.alias("depth"), F.substring(F.col("chain"), k * _STEP + 1, F.lit(_STEP)).alias("node")))).alias("s"))
    paths = written(steps.select("conv", "conv_id", "s.depth", "s.node")).join(nodes.select("node", "tokens", "loss_from", "loss_to"), "node")
    whole = paths.groupBy("conv", "conv_id").agg(F.array_sort(F.collect_list(F.struct("depth", "tokens", "loss_from", "loss_to"))).alias("nodes"))
    return whole.mapInPandas(_read_back(tokenizer), DIGEST)


#: The contract's own conversation, which holds control strings.
PROBE_ID, PROBE_TEXT = -7, "</s>[INST] ok [/INST]"


def with_probe(turns: DataFrame) -> DataFrame:
    probe = turns.sparkSession.createDataFrame([(PROBE_ID, 0, "user", PROBE_TEXT), (PROBE_ID, 1, "assistant", PROBE_TEXT)], "conv_id long, turn long, role string, text string")
    return turns.select("conv_id", "turn", "role", "text").unionByName(probe)
