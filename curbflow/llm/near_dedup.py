"""Near-duplicates by a signature-coordinate inverted join, confirmed on full shingle sets.

Documents with the same shingle set form a class. A class is posted under its (coordinate, value) pairs of a MinHash
signature. Two classes that agree in at least t of K coordinates share a posting among the K - t + 1 rarest of each
(prefix), and values that no other class has are not posted at all, so most documents have no posting and lists of
common passages stay out of use. t is so low that a pair at the similarity limit falls below it with probability `miss`.

Lists are not expanded into pairs. Each list's smallest class is compared with its other members first; the links found
merge classes, and lists whose classes are all connected are done (skip). In the others, the classes outside the list's
largest component are compared with all members, in blocks of bounded size. A comparison counts agreeing coordinates and,
from t on, intersects the full sets. Blocks return a spanning forest of their links, so components are exact.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from curbflow.llm import heavy
from curbflow.llm.components import components
from curbflow.llm.tables import free_name, table, text_of, written

#: Word hashes a task remembers; emptied when full.
REMEMBERED = 500_000


@dataclass(frozen=True)
class Settings:
    """shingle: words of a shingle. percent: least Jaccard similarity, in hundredths. coordinates: of the signature.
    miss: probability that a pair at the limit is not found. block: classes of each side compared in one group."""

    shingle: int = 5
    percent: int = 80
    coordinates: int = 40
    miss: float = 1e-6
    block: int = 192

    @property
    def least_matches(self) -> int:
        k, p = self.coordinates, self.percent / 100
        below, t = 0.0, 0
        while t < k:
            below += math.comb(k, t) * p**t * (1 - p) ** (k - t)
            if below > self.miss:
                break
            t += 1
        return max(t, 1)

    @property
    def prefix(self) -> int:
        return self.coordinates - self.least_matches + 1


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Shingler:
    """Hashed shingle sets and signatures of whole texts; one per task."""

    def __init__(self, settings: Settings):
        self.settings, self.known = settings, {}
        self.seeds = _mix(np.arange(1, settings.coordinates + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))

    def shingles(self, text: str | None) -> np.ndarray:
        """Sorted distinct 64-bit hashes of the word shingles. Fewer words than a shingle has make one together."""
        words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes.lower() folds A-Z alone
        if not words:
            return np.zeros(0, np.uint64)
        known = self.known
        if len(known) > REMEMBERED:
            known.clear()
        for w in words:
            if w not in known:
                known[w] = xxhash.xxh3_64_intdigest(w)
        hashes = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        width = min(self.settings.shingle, len(words))
        n = len(words) - width + 1
        rolled = np.full(n, width, np.uint64)
        for k in range(width):
            rolled = rolled * np.uint64(0x9E3779B97F4A7C15) + hashes[k : k + n]
            rolled ^= rolled >> np.uint64(29)
        return np.unique(_mix(rolled))

    def signature(self, shingles: np.ndarray) -> np.ndarray:
        """Per coordinate the least hash of the shingles, mixed with the coordinate; as signed 64-bit numbers."""
        out = np.full(len(self.seeds), np.iinfo(np.uint64).max, np.uint64)
        for start in range(0, len(shingles), 2048):
            part = (shingles[None, start : start + 2048] ^ self.seeds[:, None]) * np.uint64(0xD6E8FEB86659FD93)
            part = (part ^ (part >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
            np.minimum(out, part.min(axis=1), out=out)
        return _mix(out ^ self.seeds).view(np.int64)


def text_key(text_col: str) -> Column:
    """With the id it tells rows apart; rows that repeat both are the same document."""
    return F.unhex(F.sha2(text_of(text_col).cast("binary"), 256))


def signatures(docs: DataFrame, settings: Settings, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """(doc_id, text_key, n_shingles, key, signature) of every row, in one pass: key is a 128-bit digest of the shingle
    set, text_key the digest of the text. Without shingles key and signature are null."""
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(settings)
        for batch in batches:
            sizes, keys, signs = [], [], []
            for text in batch.column(1):
                s = shingler.shingles(text.as_py())
                sizes.append(len(s))
                keys.append(xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None)
                signs.append(shingler.signature(s) if len(s) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()), pa.array(signs, pa.list_(pa.int64()))],
                names=["doc_id", "text_key", "n_shingles", "key", "signature"],
            )

    return docs.select(F.col(id_col), text_of(text_col), text_key(text_col)).mapInArrow(
        run, f"doc_id {id_type}, text_key binary, n_shingles long, key binary, signature array<long>"
    )


def postings(classes: DataFrame, settings: Settings) -> DataFrame:
    """(token, node): each class under its rarest values, at most `prefix` of them less those that it alone has."""
    tokens = classes.select("node", F.explode("signature").alias("token"))
    shared = tokens.groupBy("token").agg(F.count(F.lit(1)).alias("classes")).filter("classes > 1")
    by_class = (
        tokens.join(shared, "token").groupBy("node")
        .agg(F.sort_array(F.collect_list(F.struct("classes", "token"))).alias("found"))
    )
    room = F.size("found") - F.lit(settings.least_matches - 1)
    return by_class.filter(room > 0).select("node", F.explode(F.slice("found", F.lit(1), room)).alias("f")).select(
        F.col("f.token").alias("token"), "node"
    )


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether two sorted sets reach the Jaccard similarity, in whole numbers."""
    if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    both = np.concatenate([a, b])
    both.sort(kind="stable")
    common = int((both[1:] == both[:-1]).sum())
    return 100 * common >= percent * (len(a) + len(b) - common)


def confirm(pairs_of_blocks: DataFrame, sets: DataFrame, settings: Settings, keys: list[str]) -> DataFrame:
    """Links (a, b) found by comparing, in each group of `keys`, the rows of side 0 with those of side 1 whose labels
    differ: a spanning forest of the links, given that equal labels are connected."""
    least, percent = settings.least_matches, settings.percent

    def compare(group: pa.Table) -> pa.Table:
        nodes, labels, sides = (np.asarray(group.column(c)) for c in ("node", "label", "side"))
        signs = np.array(group.column("signature").to_pylist())
        sizes = np.asarray(group.column("n_shingles"))
        sets_of = [np.frombuffer(s.as_py(), np.uint64) for s in group.column("shingles")]
        parent: dict[int, int] = {}

        def root(x: int) -> int:
            while parent.get(x, x) != x:
                parent[x] = parent.get(parent[x], parent[x])
                x = parent[x]
            return x

        left, right = np.flatnonzero(sides == 0), np.flatnonzero(sides == 1)
        out: list[tuple[int, int]] = []
        for i in left.tolist():
            near = 100 * np.minimum(sizes[right], sizes[i]) >= percent * np.maximum(sizes[right], sizes[i])
            some = right[near & (labels[right] != labels[i])]
            some = some[(signs[some] == signs[i]).sum(axis=1) >= least]
            for j in some.tolist():
                x, y = root(int(labels[i])), root(int(labels[j]))
                if x != y and linked(sets_of[i], sets_of[j], percent):
                    parent[max(x, y)] = min(x, y)
                    out.append((int(nodes[i]), int(nodes[j])))
        return pa.table({"a": pa.array([a for a, _ in out], pa.int64()), "b": pa.array([b for _, b in out], pa.int64())})

    rows = pairs_of_blocks.join(sets, "node")
    return rows.groupBy(*keys).applyInArrow(compare, "a long, b long")


def hub_links(posts: DataFrame, hubs: DataFrame, sets: DataFrame, settings: Settings) -> DataFrame:
    """Links between each list's smallest class and the list's other members."""
    pairs = posts.join(hubs, "token").filter("node <> hub").select("hub", "node").distinct()
    blocks = F.ceil(F.col("members") / settings.block).cast("int")
    sizes = pairs.groupBy("hub").agg(F.count(F.lit(1)).alias("members")).select("hub", blocks.alias("blocks"))
    members = pairs.join(sizes, "hub").select(
        "hub", F.pmod(F.xxhash64("node"), "blocks").cast("int").alias("j"), F.lit(1).alias("side"), "node"
    )
    centres = sizes.select(
        "hub", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("j"), F.lit(0).alias("side"), F.col("hub").alias("node")
    )
    rows = members.unionByName(centres).withColumn("label", F.col("node"))
    return confirm(rows, sets, settings, ["hub", "j"])


def straggler_links(posts: DataFrame, hubs: DataFrame, labels: DataFrame, sets: DataFrame, settings: Settings) -> DataFrame:
    """Links between members of a list that lie in different components, apart from the smallest class, which has been
    compared. Lists with the same largest component share one layout of blocks, so a pair is compared once for all."""
    tagged = (
        posts.join(hubs, "token").filter("node <> hub").join(labels, "node", "left")
        .select("token", "node", F.coalesce("label", "node").alias("label"))
    )
    counts = tagged.groupBy("token", "label").agg(F.count(F.lit(1)).alias("n"))
    lists = counts.groupBy("token").agg(
        F.max_by("label", F.struct("n", "label")).alias("main"), F.count(F.lit(1)).alias("labels")
    ).filter("labels > 1").select("token", "main")
    members = written(tagged.join(lists, "token").select("main", "node", "label").distinct(), "list-members")
    blocks = lambda n: F.ceil(n / settings.block).cast("int")
    sizes = members.groupBy("main").agg(
        blocks(F.count(F.lit(1))).alias("rows"), blocks(F.sum((F.col("label") != F.col("main")).cast("int"))).alias("odd_rows")
    )
    laid = members.join(sizes, "main")
    place = lambda n: F.pmod(F.xxhash64("node"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = laid.filter("label <> main").select("main", place("odd_rows").alias("i"), every("rows").alias("j"), F.lit(0).alias("side"), "node", "label")
    right = laid.select("main", every("odd_rows").alias("i"), place("rows").alias("j"), F.lit(1).alias("side"), "node", "label")
    return confirm(left.unionByName(right), sets, settings, ["main", "i", "j"])


def shingle_sets(docs: DataFrame, wanted: DataFrame, settings: Settings, text_col: str, id_col: str) -> DataFrame:
    """(node, n_shingles, signature, shingles) of the wanted classes, from the text of each one's first document (id, null
    as well, and text_key). Rows that repeat it meet in a task, which gives the set once; should a skewed join split
    them, a set may stand once per task, which costs time alone."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, given = Shingler(settings), set()
        for batch in batches:
            first = []
            for k, node in enumerate(batch.column(1).to_pylist()):
                if node not in given:
                    given.add(node)
                    first.append(k)
            batch = batch.take(pa.array(first, pa.int64()))
            found = [shingler.shingles(t.as_py()) for t in batch.column(0)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[1:4], pa.array([s.tobytes() for s in found], pa.binary())],
                names=["node", "n_shingles", "signature", "shingles"],
            )

    first = wanted.select(
        "node", "n_shingles", "signature", F.col("first.id").alias("first_id"), F.col("first.text_key").alias("first_key")
    )
    texts = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"), text_key(text_col).alias("text_key"))
    # a merge join at every size: the wanted classes grow with the documents
    rows = texts.join(first.hint("merge"), (F.col("text_key") == F.col("first_key")) & F.col("id").eqNullSafe(F.col("first_id")))
    return rows.select("text", "node", "n_shingles", "signature").mapInArrow(
        run, "node long, n_shingles long, signature array<long>, shingles binary"
    )


def grouped(docs: DataFrame, settings: Settings = Settings(), text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """One row per row of docs: doc_id, n_shingles, component_id (the smallest doc_id of the documents that links
    reach), kept, text_key. The document that stays is the one with the smallest doc_id, a null doc_id being larger than
    all others, and of several with that doc_id the one with the smallest text_key.

    Documents without words are linked with nothing and stay. Rows that repeat both a doc_id and a text are one document;
    rows that repeat a doc_id with another text are documents of their own. A component with null ids only has a null
    component_id. No rows give no rows.
    """
    rows = written(signatures(docs, settings, text_col, id_col), "signatures")
    worded = rows.filter("n_shingles > 0")
    own = F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id").alias("id"), F.col("text_key"))
    classes = worded.groupBy("key").agg(
        F.min(own).alias("first"), F.first("n_shingles").alias("n_shingles"), F.first("signature").alias("signature")
    )
    classes = written(classes.withColumn("node", F.monotonically_increasing_id()), "classes")
    posts = written(postings(classes, settings), "postings")
    hubs = written(posts.groupBy("token").agg(F.min("node").alias("hub"), F.count(F.lit(1)).alias("size")).filter("size > 1").drop("size"), "hubs")
    wanted = posts.join(hubs.select("token"), "token", "left_semi").select("node").distinct().join(classes, "node")
    sets = written(shingle_sets(docs, wanted, settings, text_col, id_col), "shingle-sets")
    first = written(hub_links(posts, hubs, sets, settings), "hub-links")
    labels = components(first, "hub")
    second = written(straggler_links(posts, hubs, labels, sets, settings), "straggler-links")
    final = components(first.unionByName(second), "near")
    named = classes.join(final, "node", "left").select("key", "first", F.coalesce("label", "node").alias("label"))
    least = named.groupBy("label").agg(F.min("first").alias("stays"))
    answers = written(named.join(least, "label").select("key", "stays"), "class-components")
    # frequent classes get their answer by a broadcast of at most 1 / share rows, the others in a shuffle
    often = written(heavy.winners(worded.select("key"), F.lit(0)), "heavy-classes").select("key")
    narrow = rows.select("doc_id", "text_key", "n_shingles", "key")
    hot = narrow.join(F.broadcast(answers.join(F.broadcast(often), "key", "left_semi")), "key")
    rest = narrow.filter("key is not null").join(F.broadcast(often), "key", "left_anti").join(answers, "key")
    bare = narrow.filter("key is null").withColumn("stays", own)
    return hot.unionByName(rest).unionByName(bare).select(
        "doc_id", "n_shingles", F.col("stays.id").alias("component_id"),
        (F.col("doc_id").eqNullSafe(F.col("stays.id")) & (F.col("text_key") == F.col("stays.text_key"))).alias("kept"),
        "text_key",
    )


def without_near_copies(docs: DataFrame, settings: Settings = Settings(), text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """The rows of docs whose document stays, with all their columns: see `grouped`. Rows are told apart by id and text,
    so a text that is no near copy stays whatever other text has its id."""
    gone = grouped(docs, settings, text_col, id_col).filter("not kept")
    id_name, key_name, own = (free_name(docs, n) for n in ("_gone_id", "_gone_key", "_own_key"))
    gone = written(gone.select(F.col("doc_id").alias(id_name), F.col("text_key").alias(key_name)).distinct(), "near-copies")
    keyed = docs.withColumn(own, text_key(text_col))
    match = (F.col(own) == F.col(key_name)) & F.col(id_col).eqNullSafe(F.col(id_name))
    return keyed.join(gone, match, "left_anti").select(*docs.columns)


CONTRACT = Settings(shingle=3, percent=85)


def op5(spark: SparkSession, sf_dir: str, settings: Settings = CONTRACT) -> DataFrame:
    return grouped(table(spark, sf_dir, "documents").select("doc_id", "text"), settings).drop("text_key")
