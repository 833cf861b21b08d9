"""Merkle manifest of a dataset by slot pivots.

A row's leaf is the hash of its fields; per source the leaves, in order of doc_id, are hashed three at a time until one
node remains, and the sources' nodes are hashed in the same way to the root.  A level is one aggregation: conditional
aggregates spread each parent's children into a column a slot; the columns joined are what the parent hashes, and
without a child's own column they are that child's siblings.  Down from the root every parent hands its path to its
children, so a leaf's proof is put together without ever joining a leaf to a level above its parent's.

Numbers within a source come from one range partitioning over (source, doc_id, leaf, row): each part is numbered in its own
task, and a part's first number from the counts of the parts, so a source of any size is never sorted in one task.
What grows with a source is its number of levels (log 3); a level holds a third of the rows of the one below it.

Null fields are hashed as "-"; null sources are one source, before all others; null doc_ids come first in their source and
are never tampered with.  Rows that share a doc_id are ordered by leaf, equal rows are interchangeable.  An empty table gives no
rows.  A source of one row has its leaf as subroot, a table of one source its subroot as root; a proof without siblings is the hash
of the empty string.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import written

FANOUT = 3
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
SLOTS = [f"slot{s}" for s in range(FANOUT)]


def _hashed(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def _field(value: Column) -> Column:
    """The value after its length in bytes, or a dash."""
    return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))


def leaf_of(columns: dict[str, Column]) -> Column:
    return _hashed(*(_field(columns[c].cast("string")) for c in FIELDS))


def leaves(docs: DataFrame) -> DataFrame:
    """(doc_id, source, leaf, seen): each row's leaf, and the leaf that a reader of the tampered copy sees."""
    columns = {c: F.col(f"`{c}`") for c in FIELDS}
    tampered = leaf_of(columns | {"text": F.translate(columns["text"], "\n", "")})
    even = F.crc32(columns["doc_id"].cast("string").cast("binary")) % 2 == 0
    return docs.select("doc_id", "source", leaf_of(columns).alias("leaf"), F.when(even, tampered).otherwise(leaf_of(columns)).alias("seen"))


def numbered(df: DataFrame, order: list[str]) -> DataFrame:
    """df, written, with its 0-based number in the order (which must tell rows apart) and part, the partition that holds it."""
    place = F.monotonically_increasing_id()
    placed = written(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("place", place).withColumn("part", F.shiftright("place", 33)))
    before = Window.partitionBy(F.lit(0)).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = placed.groupBy("part").agg(F.count("*").alias("n"), F.min("place").alias("lo"))
    skips = counts.select("part", (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("lo")).alias("skip"))  # one row a partition
    return placed.join(F.broadcast(skips), "part").withColumn("number", F.col("place") + F.col("skip")).drop("place", "skip")


def _siblings(slot: int) -> Column:
    """What stands before and after the slot's child in its parent."""
    side = lambda some: F.concat(F.lit(""), *(F.coalesce(F.col(f"{c}.h"), F.lit("")) for c in some))
    return F.struct(side(SLOTS[:slot]).alias("before"), side(SLOTS[slot + 1 :]).alias("after"))


def pivoted(nodes: DataFrame) -> DataFrame:
    """(tree, k, n, slots, h) of the parents of nodes (tree, k, n, node with h); n nodes are on a tree's level."""
    own = [F.max(F.when(F.col("k") % FANOUT == s, F.col("node"))).alias(c) for s, c in enumerate(SLOTS)]
    parent, level = F.floor(F.col("k") / FANOUT).alias("k"), F.ceil(F.col("n") / FANOUT).alias("n")
    rows = nodes.filter("n > 1").groupBy("tree", parent, level).agg(*own)
    return rows.withColumn("h", _hashed(*(F.coalesce(F.col(f"{c}.h"), F.lit("")) for c in SLOTS)))


def levels(nodes: DataFrame, most: int) -> list[DataFrame]:
    """Parents of nodes, their parents, and so on, each written, for trees of at most that many nodes."""
    out = []
    while most > 1:
        out.append(written(pivoted(out[-1].select("tree", "k", "n", F.struct("h").alias("node")) if out else nodes)))
        most = -(-most // FANOUT)
    return out


def tops(nodes: DataFrame, above: list[DataFrame]) -> DataFrame:
    """(tree, height, h): the node that remains of each tree."""
    found = [nodes.select("tree", "n", F.col("node.h").alias("h")), *(x.select("tree", "n", "h") for x in above)]
    return reduce(DataFrame.union, [x.filter("n = 1").select("tree", F.lit(height).alias("height"), "h") for height, x in enumerate(found)])


def proofs(nodes: DataFrame, above: list[DataFrame], ends: DataFrame) -> DataFrame:
    """(tree, k, node, path, top) of each node; ends (tree, height, h, path) are the trees' tops with their own paths."""
    at_top = lambda height: ends.filter(F.col("height") == height).select("tree", F.lit(0).cast("long").alias("k"), "path", F.col("h").alias("top"))
    given = at_top(len(above))
    for height in range(len(above), 0, -1):
        parents = above[height - 1].join(given, ["tree", "k"])
        child = lambda s: F.struct((F.col("k") * FANOUT + s).alias("k"), F.col(SLOTS[s]).alias("node"), F.concat(F.array(_siblings(s)), "path").alias("path"))
        spread = parents.select("tree", "top", F.explode(F.array(*map(child, range(FANOUT)))).alias("c")).filter("c.node is not null")
        given = spread.select("tree", "c.k", *(["c.node"] if height == 1 else []), "c.path", "top")
        if height > 1:
            given = given.union(at_top(height - 1))
    alone = nodes.filter("n = 1").select("tree", "k", "node").join(at_top(0), ["tree", "k"])
    return alone if not above else given.select("tree", "k", "node", "path", "top").union(alone.select("tree", "k", "node", "path", "top"))


def manifest(docs: DataFrame) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified, source) of each row."""
    cut = leaves(docs).withColumn("row", F.monotonically_increasing_id())
    ranked = numbered(written(cut), ["source", "doc_id", "leaf", "row"])
    parts = written(ranked.groupBy("source", "part").agg(F.min("number").alias("lo"), F.count("*").alias("n")))
    found = parts.groupBy("source").agg(F.min("lo").alias("first"), F.sum("n").alias("n"))
    sources = numbered(found, ["first"]).select(F.col("source").alias("named"), "first", "n", F.col("number").alias("tree"))
    sources = written(sources)
    of_part = parts.join(sources, F.col("source").eqNullSafe(F.col("named"))).select("part", "named", "first", sources["n"], "tree")
    # a source's rows of one part are at most a partition, so this join has no hot key
    rows = ranked.withColumnRenamed("part", "own").join(of_part, (F.col("own") == F.col("part")) & F.col("source").eqNullSafe(F.col("named")))
    node = F.struct(F.col("leaf").alias("h"), "seen", "doc_id", "source")
    nodes = rows.select("tree", (F.col("number") - F.col("first")).alias("k"), F.col("n").cast("long").alias("n"), node.alias("node"))
    size = sources.agg(F.max("n"), F.count("*")).first()
    above = levels(nodes, size[0] or 0)
    ends = written(tops(nodes, above))

    forest = ends.select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("k"), F.lit(size[1]).cast("long").alias("n"), F.struct("h", "height").alias("node"))
    over = levels(forest, size[1])
    top = tops(forest, over)
    root = (top.select("h").first() or [None])[0]  # one row: the root
    bare = F.array().cast("array<struct<before:string,after:string>>")
    trees = proofs(forest, over, top.withColumn("path", bare)).select(F.col("k").alias("tree"), "node.height", "node.h", "path")

    proven = proofs(nodes, above, written(trees)).withColumn("root", F.lit(root).cast("string"))
    proof = F.sha2(F.array_join(F.transform("path", lambda p: F.concat(p["before"], p["after"])), ""), 256)
    folded = F.aggregate("path", F.col("node.seen"), lambda h, p: _hashed(p["before"], h, p["after"]))
    out = proven.select("node.doc_id", F.col("node.h").alias("leaf"), F.col("top").alias("subroot"), "root", proof.alias("proof_sha256"), folded.alias("folded_root"), "node.source")
    return out.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"), "source")


def _leaf_sql(text: str) -> str:
    one = lambda c: f"coalesce(strlen(cast({c} as varchar)) || ':' || cast({c} as varchar), '-')"
    return "sha256(" + " || ".join(one(text if c == "text" else c) for c in FIELDS) + ")"


#: The same in SQL: a recursion over levels makes the nodes, another climbs from each leaf along them.
SQL = f"""
with recursive bytes as (select list_transform(range(256), lambda b: list_reduce(list_concat([b], range(8)), lambda c, i: case when c % 2 = 1 then xor(c >> 1, 3988292384) else c >> 1 end)) as t),
rows as (
  select doc_id, source, {_leaf_sql("text")} as leaf, {_leaf_sql("replace(text, chr(10), '')")} as bare,
         xor(list_reduce(list_concat([4294967295], list_transform(string_split(cast(doc_id as varchar), ''), lambda c: cast(ascii(c) as bigint))),
                         lambda acc, b: xor(acc >> 8, t[(xor(acc, b) & 255) + 1])), 4294967295) as crc
  from documents, bytes
), leaves as (
  select *, case when crc % 2 = 0 then bare else leaf end as seen, dense_rank() over (order by source nulls first) - 1 as tree,
         row_number() over (partition by source order by doc_id nulls first, leaf) - 1 as k, count(*) over (partition by source) as n
  from rows
), nodes as (
  select tree, 0 as level, k, leaf as h, n from leaves
  union all
  select tree, level + 1, k // {FANOUT}, sha256(string_agg(h, '' order by k)), (n + {FANOUT - 1}) // {FANOUT} from nodes where n > 1 group by tree, level, k // {FANOUT}, n
), subroots as (select tree, h, (select count(distinct tree) from leaves) as n from nodes where n = 1
), crowns as (
  select 0 as level, tree as k, h, n from subroots
  union all
  select level + 1, k // {FANOUT}, sha256(string_agg(h, '' order by k)), (n + {FANOUT - 1}) // {FANOUT} from crowns where n > 1 group by level, k // {FANOUT}, n
), runs as (
  select tree, level, k // {FANOUT} as parent, list(h order by k) as hs, min(k) as first from nodes where n > 1 group by all
), tips as (
  select level, k // {FANOUT} as parent, list(h order by k) as hs, min(k) as first from crowns where n > 1 group by all
), climbed as (
  select tree, k as leaf_k, 0 as level, k as at, seen as h, '' as proof, false as done from leaves
  union all
  select c.tree, leaf_k, c.level + 1, c.at // {FANOUT},
         sha256(array_to_string(list_transform(hs, lambda x, i: case when i = c.at - first + 1 then c.h else x end), '')),
         proof || array_to_string(list_filter(hs, lambda x, i: i <> c.at - first + 1), ''), false
  from climbed c join runs r on r.tree = c.tree and r.level = c.level and r.parent = c.at // {FANOUT}
), ends as (
  select tree, leaf_k, arg_max(h, level) as h, arg_max(proof, level) as proof from climbed group by all
), risen as (
  select tree, leaf_k, 0 as level, tree as at, h, proof from ends
  union all
  select tree, leaf_k, c.level + 1, c.at // {FANOUT},
         sha256(array_to_string(list_transform(hs, lambda x, i: case when i = c.at - first + 1 then c.h else x end), '')),
         proof || array_to_string(list_filter(hs, lambda x, i: i <> c.at - first + 1), '')
  from risen c join tips r on r.level = c.level and r.parent = c.at // {FANOUT}
), proven as (
  select tree, leaf_k, arg_max(h, level) as h, arg_max(proof, level) as proof from risen group by all
)
select l.doc_id, l.leaf, s.h as subroot, c.h as root, sha256(p.proof) as proof_sha256, p.h as folded_root, p.h = c.h as verified, l.source
from leaves l join subroots s using (tree) join proven p on p.tree = l.tree and p.leaf_k = l.k join crowns c on c.n = 1
"""
