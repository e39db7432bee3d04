"""Secret scans with DataFrame functions alone: fixed patterns, and random strings by character Markov models.

Two first-order Markov models over characters, one of random strings and one of ordinary identifiers and words, are
trained by counting character pairs of labelled samples. A candidate string is a secret if its log-likelihood ratio,
or that of a contiguous part of it, reaches a limit. Everything on the path of the texts is an expression of Spark; the
driver only turns pair counts (at most twice the square of the alphabet) into log ratios.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from curbflow.llm.tables import free_name, table, text_of, written

#: The base patterns, by kind and in the order of kinds. Runs are greedy, so a least length in the pattern
#: of `access` and `hex` finds what checking the length of every run would; `assign` is checked after matching.
ASSIGN = r"""(?=[PpSsTtAa])((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
KINDS = ("assign", "access", "hex", "random")
LEAST_VALUE = 6

ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_=-"
CANDIDATE = r"[A-Za-z0-9+/_=-]{16,}"
ORDINARY = r"[A-Za-z0-9+/_=-]{6,}"


@dataclass(frozen=True)
class Settings:
    """sample_docs bounds the documents (by hash of the id) from whose ids random strings are made; words and pattern hits
    are counted over all documents, and made strings so many times more, so that their part does not depend on the size.
    smoothing is added to each pair count. A candidate is taken if its log ratio reaches `least` in total and
    `least_mean` for each pair."""

    sample_docs: int = 2_000
    random_per_doc: int = 3
    smoothing: float = 0.5
    least: float = 10.0
    least_mean: float = 0.5


def pairs(samples: DataFrame) -> DataFrame:
    """(label, pair, n) of rows (label, sample): adjacent characters, counted over all samples."""
    cut = samples.select("label", F.explode(F.regexp_extract_all("sample", F.lit("(?=(..))"), F.lit(1))).alias("pair"))
    return cut.groupBy("label", "pair").agg(F.count(F.lit(1)).alias("n"))


def log_ratios(counts: DataFrame, smoothing: float) -> list[float]:
    """log P(b | a) as random less log P(b | a) as ordinary, for a and b of the alphabet in order. Without samples 0."""
    place = {c: k for k, c in enumerate(ALPHABET)}
    size = len(ALPHABET)
    n = [[smoothing] * (size * size) for _ in (0, 1)]
    for label, pair, k in counts.collect():  # 2 * size * size rows at most
        if len(pair) == 2 and pair[0] in place and pair[1] in place:
            n[label][place[pair[0]] * size + place[pair[1]]] += k
    out = []
    for a in range(size):
        total = [sum(n[label][a * size : (a + 1) * size]) for label in (0, 1)]
        for b in range(size):
            out.append(math.log(n[1][a * size + b] / total[1]) - math.log(n[0][a * size + b] / total[0]))
    return out


def found_samples(docs: DataFrame, text_col: str) -> DataFrame:
    """(label, sample) of all documents: ordinary words outside pattern hits (0), values of pattern hits (1)."""
    rest = text_of(text_col)
    for pattern in (ASSIGN, ACCESS, HEX):
        rest = F.regexp_replace(rest, F.lit(pattern), F.lit(" "))
    words = F.regexp_extract_all(rest, F.lit(ORDINARY), F.lit(0))
    hits = F.concat(*(F.regexp_extract_all(text_of(text_col), F.lit(p), F.lit(g)) for p, g in ((ASSIGN, 2), (ACCESS, 0), (HEX, 0))))
    labelled = lambda samples, label: F.transform(samples, lambda x: F.struct(F.lit(label).alias("label"), x.alias("sample")))
    return docs.select(F.inline(F.concat(labelled(words, 0), labelled(F.filter(hits, lambda x: F.length(x) >= 16), 1))))


def made_samples(picked: DataFrame, settings: Settings) -> DataFrame:
    """(label, sample): random strings made from digests of the ids in base 64, hexadecimal and capitals (1)."""
    made = []
    for k in range(settings.random_per_doc):
        digest = F.sha2(F.concat("id", F.lit(f"/{k}")).cast("binary"), 256)
        plain = F.base64(F.unhex(digest))
        made += [plain, F.substr(digest, F.lit(1), F.lit(40)), F.regexp_replace(F.upper(plain), "[^A-Z0-9]", "")]
    return picked.select(F.lit(1).alias("label"), F.explode(F.array(*made)).alias("sample"))


def train(docs: DataFrame, settings: Settings = Settings(), text_col: str = "text", id_col: str = "doc_id") -> list[float]:
    """The log ratios of all character pairs. Without documents they are 0, so no string is taken."""
    ids = docs.select(F.col(id_col).alias("id")).orderBy(F.xxhash64(F.col(id_col).cast("string")), id_col).limit(settings.sample_docs)
    picked = written(ids.select(F.coalesce(F.col("id").cast("string"), F.lit("")).alias("id")), "secret-sample")
    times = docs.count() / max(picked.count(), 1)
    made = pairs(made_samples(picked, settings)).withColumn("n", F.col("n") * F.lit(times))
    return log_ratios(pairs(found_samples(docs, text_col)).unionByName(made), settings.smoothing)


#: Least pairs of a part that is scored on its own: those of the shortest candidate.
PART = 15


def scores_random(sample: Column, ratios: list[float], settings: Settings) -> Column:
    """Whether a string over the alphabet, or a contiguous part of it of at least PART pairs, reaches the limits.

    The part is the one whose ratio exceeds least_mean a pair by most: of the parts that end at a pair, the last PART
    pairs and, if that adds to them, the best run before these. One pass, with a state of bounded size."""
    known = F.split(F.lit(",".join(f"{r:.6f}" for r in ratios)), ",").cast("array<double>")
    code = lambda pair, i: F.instr(F.lit(ALPHABET), F.substr(pair, F.lit(i), F.lit(1))) - 1
    each = F.transform(
        F.regexp_extract_all(sample, F.lit("(?=(..))"), F.lit(1)),
        lambda pair: F.get(known, code(pair, 1) * len(ALPHABET) + code(pair, 2)),
    )
    mean, zero = settings.least_mean, F.lit(0.0)

    def best(acc: Column) -> Column:
        part = F.struct((acc["last"] + acc["before"]["score"]).alias("score"), (acc["before"]["n"] + PART).alias("n"))
        return F.when(acc["seen"] >= PART, F.greatest(acc["best"], part)).otherwise(acc["best"])

    def step(found: Column, acc: Column, i: Column) -> Column:
        now = F.get(found, i)
        left = F.when(acc["seen"] >= PART, F.get(found, i - PART) - mean).otherwise(zero)
        run = F.struct((acc["before"]["score"] + left).alias("score"), (acc["before"]["n"] + 1).alias("n"))
        none = F.struct(zero.alias("score"), F.lit(0).alias("n"))
        return F.struct(
            (acc["whole"] + now).alias("whole"), (acc["last"] + now - mean - left).alias("last"),
            F.when(acc["seen"] >= PART, F.greatest(run, none)).otherwise(none).alias("before"),
            best(acc).alias("best"), (acc["seen"] + 1).alias("seen"),
        )

    def reached(acc: Column) -> Column:
        part = best(acc)
        return (acc["whole"] >= F.greatest(F.lit(settings.least), mean * acc["seen"])) | (
            (part["score"] >= 0) & (part["score"] + mean * part["n"] >= settings.least)
        )

    start = F.struct(
        zero.alias("whole"), zero.alias("last"), F.struct(zero.alias("score"), F.lit(0).alias("n")).alias("before"),
        F.struct(F.lit(-1.0).alias("score"), F.lit(0).alias("n")).alias("best"), F.lit(0).alias("seen"),
    )
    # the ratios are bound as a variable, so that a step does not find them again
    scored = F.transform(F.array(each), lambda found: F.aggregate(
        F.sequence(F.lit(0), F.size(found) - 1), start, lambda acc, i: step(found, acc, i), reached
    ))
    return F.get(scored, F.lit(0))


#: Elements of a block of a running aggregate. Only a block's own results are appended to, so the work grows with the
#: number of elements; the results of blocks are appended once a block.
BLOCK = 256


def let(value: Column, body) -> Column:
    """body of a variable that holds value: in a lambda, a plain column may be worked out again for each element."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def running(items: Column, value, combine, zero: Column) -> Column:
    """Per element of an array what `combine` makes of the values of the elements before it (`zero` for the first).

    `combine` is associative with `zero` as its neutral element; values are longs."""
    start = F.struct(zero.alias("at"), F.array().cast("array<bigint>").alias("before"))

    def fold(array: Column, of) -> Column:
        return F.aggregate(
            array, start,
            lambda acc, x: F.struct(
                combine(acc["at"], of(x)).alias("at"), F.array_append(acc["before"], acc["at"]).alias("before")
            ),
        )

    def of_blocks(found: Column) -> Column:
        starts = fold(found, lambda b: b["at"])["before"]
        moved = lambda at: F.transform(found, lambda b, k: F.transform(b["before"], lambda v: combine(F.get(at, k), v)))
        return let(starts, lambda at: F.flatten(moved(at)))

    def blocks(xs: Column) -> Column:
        last = F.greatest(F.ceil(F.size(xs) / BLOCK) - 1, F.lit(0)).cast("int")
        return F.transform(F.sequence(F.lit(0), last), lambda b: fold(F.slice(xs, b * BLOCK + 1, F.lit(BLOCK)), value))

    return let(items, lambda xs: let(blocks(xs), of_blocks))


def spans_of(matches: Column, gaps: Column, kind: int) -> Column:
    """Spans (start, kind, end) of all matches, in their order. `gaps` are the texts between them, so positions are sums
    of lengths in code points."""
    sizes = let(gaps, lambda g: F.transform(matches, lambda m, i: F.struct(
        F.length(F.get(g, i)).cast("long").alias("gap"), F.length(m).cast("long").alias("own")
    )))
    sums = lambda xs: running(xs, lambda x: x["gap"] + x["own"], lambda a, b: a + b, F.lit(0).cast("long"))
    return let(sizes, lambda xs: F.zip_with(xs, sums(xs), lambda x, at: F.struct(
        (at + x["gap"]).cast("int").alias("start"), F.lit(kind).alias("kind"), (at + x["gap"] + x["own"]).cast("int").alias("end")
    )))


def clear_of(base: Column, spans: Column) -> Column:
    """Whether each of the spans (ordered, none overlapping another) overlaps no base span, in their order.

    Both are laid out by start. A span is overlapped from the left if a base span before it ends after its start, and
    from the right if the next base span starts before its end."""
    random, far = KINDS.index("random"), 1 << 40
    ends = lambda s: F.when(s["kind"] < random, s["end"]).otherwise(0).cast("long")
    starts = lambda s: F.when(s["kind"] < random, s["start"]).otherwise(far).cast("long")

    def marked(laid: Column) -> Column:
        left = running(laid, ends, lambda a, b: F.greatest(a, b), F.lit(0).cast("long"))
        right = F.reverse(running(F.reverse(laid), starts, lambda a, b: F.least(a, b), F.lit(far).cast("long")))
        both = F.zip_with(left, right, lambda a, b: F.struct(a.alias("left"), b.alias("right")))
        return F.zip_with(laid, both, lambda s, x: F.struct(
            (s["kind"] == random).alias("own"), ((x["left"] <= s["start"]) & (x["right"] >= s["end"])).alias("clear")
        ))

    found = let(F.sort_array(F.concat(base, spans)), marked)
    return F.transform(F.filter(found, lambda x: x["own"]), lambda x: x["clear"])


def scanned(docs: DataFrame, ratios: list[float], settings: Settings = Settings(), text_col: str = "text") -> DataFrame:
    """docs with `base` and `added`: spans (start, kind, end) in code points, end exclusive, in the order of starts and
    kinds. kind counts KINDS from 0. `added` holds candidates that look random and overlap no base span.

    Null texts count as empty and have no spans. If docs has columns of these names, the new ones get underscores in
    front. Every text is scanned whole, and one text's spans are found in the row itself, without a shuffle, in time that
    grows with the text and its matches."""
    text = free_name(docs, "_scanned")
    patterns = {"assign": ASSIGN, "access": ACCESS, "hex": HEX, "random": CANDIDATE}
    names = {k: (free_name(docs, f"_{k}"), free_name(docs, f"_{k}_gaps"), free_name(docs, f"_{k}_spans")) for k in KINDS}
    values, clear, base, added = (free_name(docs, n) for n in ("_values", "_clear", "base", "added"))
    rows = docs.withColumn(text, text_of(text_col))
    rows = rows.withColumns({names[k][0]: F.regexp_extract_all(text, F.lit(p), F.lit(0)) for k, p in patterns.items()})
    none = F.array().cast("array<string>")
    rows = rows.withColumns({
        names[k][1]: F.when(F.size(names[k][0]) > 0, F.split(F.col(text), F.lit(p), -1)).otherwise(none)
        for k, p in patterns.items()
    } | {
        values: F.when(F.size(names["assign"][0]) > 0, F.regexp_extract_all(text, F.lit(ASSIGN), F.lit(2))).otherwise(none),
    })
    rows = rows.withColumns({names[k][2]: spans_of(F.col(names[k][0]), F.col(names[k][1]), n) for n, k in enumerate(KINDS)})
    assigned = let(F.col(values), lambda v: F.filter(names["assign"][2], lambda s, i: F.length(F.get(v, i)) >= LEAST_VALUE))
    rows = rows.withColumn(base, F.sort_array(F.concat(assigned, names["access"][2], names["hex"][2])))
    rows = rows.withColumn(clear, clear_of(F.col(base), F.col(names["random"][2])))
    taken = let(F.struct(F.col(clear).alias("clear"), F.col(names["random"][0]).alias("own")), lambda v: F.filter(
        names["random"][2], lambda s, i: F.get(v["clear"], i) & scores_random(F.get(v["own"], i), ratios, settings)
    ))
    rows = rows.withColumn(added, taken)
    return rows.select(*docs.columns, base, added)


def joined(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    kinds = F.array(*(F.lit(k) for k in KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(kinds, s["kind"]), s["start"], s["end"])), ",")


def op6(spark: SparkSession, sf_dir: str, settings: Settings = Settings()) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = scanned(docs, train(docs, settings), settings)
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == KINDS.index(kind))).cast("long")
    return found.select(
        "doc_id", count("assign").alias("n_assign"), count("access").alias("n_access"), count("hex").alias("n_hex"),
        F.sha2(joined(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        joined(F.sort_array(F.concat("base", "added"))).alias("spans"),
    )
