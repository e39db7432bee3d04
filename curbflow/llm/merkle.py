"""A Merkle manifest of a dataset: one binary tree per language, their roots joined by one more tree.

Leaves are numbered by a range sort with counts per task, so no task sees a whole tree. Builders take aligned blocks of
2**height nodes and append every node to their log when it is complete (postorder). Where a node stands in such a log
follows from the sizes of the subtrees before and under it (`position`), so a sibling is read by its place and nothing
is searched. The last node of each log is the block's root; the roots of all blocks are the leaves of the next round, so
trees of any size take a few rounds. Proofs go down the same rounds: a block hands each of its nodes the siblings above.
"""

from __future__ import annotations

import hashlib
import math
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from curbflow.llm.tables import fold, table, written

#: Levels of a builder: a block has 2**HEIGHT nodes at most.
HEIGHT = 8
#: Every DIVISOR-th document by hash has its n_chars changed in the check of the proofs.
DIVISOR = 7
#: Sides of a proof's entries: the sibling stands left, right, or there is none.
LEFT, RIGHT, ALONE = b"L", b"R", b"-"
WIDTH = 33


def h(*parts: bytes) -> bytes:
    """SHA-256 over the lowercase hex of the digests, as raw bytes."""
    return hashlib.sha256(b"".join(p.hex().encode() for p in parts)).digest()


def subtree_size(leaves: int, level: int) -> int:
    """Nodes of a subtree of the given height over `leaves` leaves, runs of one node included."""
    return sum(-(-leaves // (1 << k)) for k in range(level + 1))


def position(level: int, index: int, leaves: int) -> int:
    """Where node `index` of `level` stands in the postorder log of a block of `leaves` leaves: after all nodes of the
    complete subtrees left of it and after its own subtree."""
    before = index << level
    own = min(1 << level, leaves - before)
    own_size = (2 << level) - 1 if own == 1 << level else subtree_size(own, level)
    return 2 * before - before.bit_count() + own_size - 1


def levels(leaves: int, whole: bool, height: int = HEIGHT) -> int:
    """Height of a block: up to its single root if it is the whole tree, else as high as all aligned blocks."""
    return (leaves - 1).bit_length() if whole else height


def build(nodes: list[bytes], top: int) -> list[bytes]:
    """The log of a block: each node is appended when its last child is there."""
    log: list[bytes] = []
    last = len(nodes) - 1
    for k, node in enumerate(nodes):
        log.append(node)
        level, index = 1, k >> 1
        while level <= top and (k == last or (k + 1) % (1 << level) == 0):
            children = [log[position(level - 1, 2 * index, len(nodes))]]
            if (2 * index + 1) << (level - 1) <= last:
                children.append(log[position(level - 1, 2 * index + 1, len(nodes))])
            log.append(h(*children))
            level, index = level + 1, index >> 1
    return log


def entries(log: list[bytes], leaf: int, leaves: int, top: int) -> bytes:
    """The proof of a leaf within its block: per level the side and the digest of the sibling, WIDTH bytes each."""
    out = []
    for level in range(top):
        index = (leaf >> level) ^ 1
        if index << level >= leaves:
            out.append(ALONE + bytes(WIDTH - 1))
        else:
            out.append((LEFT if index < leaf >> level else RIGHT) + log[position(level, index, leaves)])
    return b"".join(out)


def cut(data: bytes, width: int) -> list[bytes]:
    return [data[k : k + width] for k in range(0, len(data), width)]


def folded(leaf: bytes, proof: bytes) -> bytes:
    """The root that a leaf and its proof lead to."""
    for entry in cut(proof, WIDTH):
        side, other = entry[:1], entry[1:]
        leaf = h(other, leaf) if side == LEFT else h(leaf, other) if side == RIGHT else h(leaf)
    return leaf


def siblings(proof: bytes) -> list[bytes]:
    return [e[1:] for e in cut(proof, WIDTH) if e[:1] != ALONE]


def ranked(rows: DataFrame, order: list[Column], name: str) -> DataFrame:
    """rows (with the column `tree`) and rank (from 0) and n (rows) within their tree, written to the shared folder.

    The rows are ranged over tasks by tree and order; what a task has to add to its own numbers are the counts of the
    tasks before it, one row per task and tree."""
    placed = rows.repartitionByRange(F.col("tree"), *order).sortWithinPartitions(F.col("tree"), *order)
    placed = written(placed.withColumn("at", F.monotonically_increasing_id()), f"{name}-sorted")
    placed = placed.withColumn("task", F.shiftright("at", 33))
    parts = placed.groupBy("tree", "task").agg(F.count(F.lit(1)).alias("rows"), F.min("at").alias("start"))
    of_tree = Window.partitionBy("tree")
    earlier = of_tree.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(
        "tree", "task", "start", F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("before"),
        F.sum("rows").over(of_tree).alias("n"),
    )
    parts = written(parts, f"{name}-parts")
    numbered = placed.join(parts, ["tree", "task"]).withColumn("rank", F.col("before") + F.col("at") - F.col("start"))
    return written(numbered.select(*rows.columns, "rank", "n"), name)


def segments(nodes: DataFrame, height: int) -> DataFrame:
    """(tree, block, leaves, whole, log, root): the logs of the aligned blocks over nodes (tree, rank, n, node)."""

    def run(group: pa.Table) -> pa.Table:
        group = group.sort_by("rank")
        found = group.column("node").to_pylist()
        whole = group.column("n")[0].as_py() <= 1 << height
        log = build(found, levels(len(found), whole, height))
        keys = {c: [group.column(c)[0].as_py()] for c in ("tree", "block")}
        return pa.table({**keys, "leaves": [len(found)], "whole": [whole], "log": [b"".join(log)], "root": [log[-1]]})

    blocked = nodes.select("tree", F.shiftright("rank", height).alias("block"), "rank", "n", "node")
    return blocked.groupBy("tree", "block").applyInArrow(
        run, "tree string, block long, leaves long, whole boolean, log binary, root binary"
    )


def rounds(nodes: DataFrame, height: int, name: str) -> list[DataFrame]:
    """Segments of every round, from the leaves up: trees of more than one block go on with their blocks' roots."""
    found, size = [], nodes.agg(F.max("n")).first()[0] or 0
    while True:
        found.append(written(segments(nodes, height), f"{name}-segments-{len(found)}"))
        if size <= 1 << height:
            return found
        size = math.ceil(size / (1 << height))
        upper = found[-1].filter("not whole")
        counts = nodes.filter(F.col("rank") == 0).select("tree", F.ceil(F.col("n") / (1 << height)).alias("n"))
        nodes = upper.join(counts, "tree").select("tree", F.col("block").alias("rank"), "n", F.col("root").alias("node"))


def roots(found: list[DataFrame]) -> DataFrame:
    """(tree, root) of all trees."""
    return reduce(DataFrame.unionByName, (s.filter("whole").select("tree", "root") for s in found))


def handed_down(segment: DataFrame, above: DataFrame, height: int) -> DataFrame:
    """(tree, block, proof, subroot) for the nodes of the segments: `above` has the same columns for the segments."""

    def run(batches):
        for batch in batches:
            rows = []
            for tree, block, leaves, whole, log, proof, subroot in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                nodes, top = cut(log, 32), levels(leaves, whole, height)
                for k in range(leaves):
                    rows.append((tree, (block << height) + k, entries(nodes, k, leaves, top) + proof, subroot))
            columns = list(zip(*rows, strict=True)) or [()] * 4
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int64(), pa.binary(), pa.binary()), strict=True)],
                names=["tree", "block", "proof", "subroot"],
            )

    joined = segment.join(above, ["tree", "block"])
    joined = joined.select("tree", "block", "leaves", "whole", "log", "proof", "subroot")
    return joined.mapInArrow(run, "tree string, block long, proof binary, subroot binary")


def met(segment: DataFrame, of_trees: DataFrame, above: DataFrame | None) -> DataFrame:
    """Proofs of the segments of a round: those handed down, and those of the trees that end in this round."""
    ending = of_trees.join(segment.filter("whole").select("tree"), "tree", "left_semi")
    return ending if above is None else ending.unionByName(above)


def descended(found: list[DataFrame], of_trees: DataFrame, height: int) -> DataFrame:
    """Proofs of the nodes of the first round of `found`, from the proofs of the trees' roots."""
    above = None
    for segment in reversed(found):
        above = written(handed_down(segment, met(segment, of_trees, above), height), "merkle-proofs")
    return above


def tree_name(lang: Column) -> Column:
    """Names sort as the languages do by bytes, null first."""
    return F.coalesce(F.concat(F.lit("="), lang.cast("string")), F.lit(""))


def leaf_digest(columns: list[Column]) -> Column:
    """SHA-256 of the values, each as its byte count, a colon and its text, or `-` if null."""
    texts = [c.cast("string") for c in columns]
    coded = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.unhex(F.sha2(F.concat(*coded).cast("binary"), 256))


def manifest(
    docs: DataFrame, height: int = HEIGHT, id_col: str = "doc_id", tree_col: str = "lang",
    columns: tuple[str, ...] = ("doc_id", "source", "lang", "n_chars", "text"), count_col: str = "n_chars",
    divisor: int = DIVISOR,
) -> DataFrame:
    """One row per row of docs: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified, n_siblings.

    Leaves of a language ascend by id, a null id last, rows that repeat an id by their leaf (equal leaves are
    interchangeable). Nulls in any column are hashed as `-`; a null language is a tree of its own, the first one. A lone
    leaf is its tree's root. The proofs are those of the data as they are; folded_root starts from the leaf with
    count_col raised by one where `divisor` divides the crc32 of the id, as a tampered row would have it (null counts and
    null ids stay). Other columns play no part; no rows give no rows.
    """
    spark = docs.sparkSession
    tampered = F.coalesce(fold(id_col, divisor) == 0, F.lit(False)) & F.col(count_col).isNotNull()
    changed = [F.col(c) + 1 if c == count_col else F.col(c) for c in columns]
    leaf = leaf_digest([F.col(c) for c in columns])
    rows = written(
        docs.select(
            tree_name(F.col(tree_col)).alias("tree"), F.col(id_col).alias("doc_id"), leaf.alias("node"),
            F.when(tampered, leaf_digest(changed)).alias("changed"),
        ),
        "merkle-leaves",
    )
    nodes = ranked(rows, [F.col("doc_id").asc_nulls_last(), F.col("node")], "merkle-ranked")
    lower = rounds(nodes, height, "merkle")
    # the roots of the languages are the leaves of one more tree
    subroots = roots(lower).select(F.lit("").alias("tree"), F.col("tree").alias("of"), F.col("root").alias("node"))
    tops = ranked(subroots, [F.col("of")], "merkle-subroots")
    upper = rounds(tops, height, "merkle-top")
    last = roots(upper).first()
    root = last.root if last else b""

    start = spark.createDataFrame([("", 0, b"", bytes(root))], "tree string, block long, proof binary, subroot binary")
    of_trees = tops.join(descended(upper, start, height), F.col("rank") == F.col("block")).select(
        F.col("of").alias("tree"), F.lit(0).cast("long").alias("block"), "proof", F.col("node").alias("subroot")
    )
    of_trees = written(of_trees, "merkle-subroot-proofs")
    above = met(lower[0], of_trees, descended(lower[1:], of_trees, height) if lower[1:] else None)
    blocks = lower[0].join(above, ["tree", "block"])
    id_type = docs.schema[id_col].dataType.simpleString()

    def check(left: pa.Table, right: pa.Table) -> pa.Table:
        left = left.sort_by("rank")
        segment = {c: right.column(c)[0].as_py() for c in right.column_names}
        log, leaves = cut(segment["log"], 32), segment["leaves"]
        top = levels(leaves, segment["whole"], height)
        out = []
        for k, (node, altered) in enumerate(zip(left.column("node").to_pylist(), left.column("changed").to_pylist(), strict=True)):
            proof = entries(log, k, leaves, top) + segment["proof"]
            others = siblings(proof)
            reached = folded(node if altered is None else altered, proof)
            out.append((node.hex(), segment["subroot"].hex(), root.hex(), h(*others).hex(), reached.hex(), reached == root, len(others)))
        kinds = (*[pa.string()] * 5, pa.bool_(), pa.int32())
        names = ("leaf", "subroot", "root", "proof_sha256", "folded_root", "verified", "n_siblings")
        cells = [pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)]
        return pa.table([left.column("doc_id"), *cells], names=["doc_id", *names])

    blocked = nodes.withColumn("block", F.shiftright("rank", height))
    return blocked.groupBy("tree", "block").cogroup(blocks.groupBy("tree", "block")).applyInArrow(
        check,
        f"doc_id {id_type}, leaf string, subroot string, root string, proof_sha256 string, folded_root string, "
        "verified boolean, n_siblings int",
    )


def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest(table(spark, sf_dir, "documents"))


# Per level the nodes' digests; `nodes` holds all levels of all trees, `tops` those of the tree over the languages.
OP12_SQL = """
with recursive coded as (
  select doc_id, lang, n_chars,
         {head} as head,
         coalesce(octet_length(encode(text))::varchar || ':' || text, '-') as tail,
         coalesce(octet_length(encode(n_chars::varchar))::varchar || ':' || n_chars::varchar, '-') as middle,
         coalesce(octet_length(encode((n_chars + 1)::varchar))::varchar || ':' || (n_chars + 1)::varchar, '-') as altered
  from documents
), leaves as (
  select doc_id, lang, sha256(head || middle || tail) as leaf, sha256(head || altered || tail) as changed,
         row_number() over (partition by lang order by doc_id) - 1 as i, count(*) over (partition by lang) as n
  from coded
), nodes as (
  select lang, 0 as level, i, n, leaf as node from leaves
  union all
  select lang, level + 1, i // 2, (any_value(n) + 1) // 2, sha256(string_agg(node, '' order by i))
  from nodes where n > 1 group by lang, level, i // 2
), subroots as (
  select lang, level as height, node as subroot, row_number() over (order by lang nulls first) - 1 as i, count(*) over () as n
  from nodes where n = 1
), tops as (
  select 0 as level, i, n, subroot as node from subroots
  union all
  select level + 1, i // 2, (any_value(n) + 1) // 2, sha256(string_agg(node, '' order by i))
  from tops where n > 1 group by level, i // 2
), top as (select level as height, node as root from tops where n = 1
), crc_bits as (
  select i::ubigint as value, i::ubigint as rest, 0 as step from range(256) r(i)
  union all
  select value, case when rest % 2 = 1 then xor(rest // 2, 3988292384::ubigint) else rest // 2 end, step + 1
  from crc_bits where step < 8
), crc_table as (select value, rest from crc_bits where step = 8
), crc as (
  select doc_id, encode(doc_id::varchar) as bytes, 0 as pos, 4294967295::ubigint as rest from leaves where doc_id is not null
  union all
  select doc_id, bytes, pos + 1, xor(c.rest // 256, t.rest)
  from crc c join crc_table t on t.value = xor(c.rest % 256, ascii(substr(decode(bytes), pos + 1, 1))::ubigint)
  where pos < octet_length(bytes)
), marked as (
  select doc_id, xor(rest, 4294967295::ubigint) % 7 = 0 as tampered from crc where pos = octet_length(bytes)
), paths as (
  select doc_id, s.lang, l.i as leaf_at, s.i as top_at, s.height, s.subroot, leaf,
         case when coalesce(tampered, false) then changed else leaf end as start
  from leaves l join subroots s on l.lang is not distinct from s.lang left join marked using (doc_id)
), steps as (
  select doc_id, k as level, 0 as part, leaf_at // pow(2, k)::bigint as pos, lang from paths, range(40) r(k) where k < height
  union all
  select doc_id, k, 1, top_at // pow(2, k)::bigint, null from paths, top, range(40) r(k) where k < top.height
), others as (
  select doc_id, part, s.level, pos, coalesce(n.node, '') as node
  from steps s left join nodes n on part = 0 and n.lang is not distinct from s.lang and n.level = s.level and n.i = xor(pos, 1)
  where part = 0
  union all
  select doc_id, part, s.level, pos, coalesce(t.node, '')
  from steps s left join tops t on t.level = s.level and t.i = xor(pos, 1) where part = 1
), ordered as (
  select *, row_number() over (partition by doc_id order by part, level) as place from others
), proofs as (
  select doc_id, sha256(string_agg(node, '' order by place)) as proof_sha256,
         count(*) filter (node <> '')::int as n_siblings, max(place) as places
  from ordered group by doc_id
), folding as (
  select doc_id, 0 as place, start as node from paths
  union all
  select f.doc_id, o.place, sha256(case when o.pos % 2 = 1 then o.node || f.node else f.node || o.node end)
  from folding f join ordered o on o.doc_id = f.doc_id and o.place = f.place + 1
), reached as (select doc_id, arg_max(node, place) as folded_root from folding group by doc_id)
select doc_id, leaf, subroot, root, coalesce(proof_sha256, sha256('')) as proof_sha256, folded_root,
       folded_root = root as verified, coalesce(n_siblings, 0)::int as n_siblings
from paths cross join top join reached using (doc_id) left join proofs using (doc_id)
""".format(head=" || ".join(
    f"coalesce(octet_length(encode({c}::varchar))::varchar || ':' || {c}::varchar, '-')" for c in ("doc_id", "source", "lang")
))
