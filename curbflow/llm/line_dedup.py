"""Line deduplication by overlapping windows of three lines.

Windows of three consecutive lines (lines without a word don't count) are hashed; a window that occurs more than once in
all documents stays where it occurs first, by doc_id and position, and its later occurrences are removed. Covered
positions of a document are merged, and lines that belong to a first occurrence are never removed.

Texts of one or two lines have no window, and two copied lines at the edge of a text lie in none that repeats. With
`edges`, each document is taken as lying between two marks, one before and one behind it, so both have windows. Without
`protect`, every position that a later occurrence covers is removed: each line still stands at the earliest of its copies.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from curbflow.llm import heavy
from curbflow.llm.tables import free_name, table, text_of, written

WIDTH = 3
HAS_WORD = r"[^\x20\x09-\x0D]"


def lines_of(text: Column) -> Column:
    return F.split(text, "\n", -1)


def worded(lines: Column) -> Column:
    """(at, line) of the lines that have a word."""
    numbered = F.transform(lines, lambda line, at: F.struct(at.alias("at"), line.alias("line")))
    return F.filter(numbered, lambda x: x["line"].rlike(HAS_WORD))


def identity(id_col: str, text_col: str) -> Column:
    """Tells documents apart; rows that repeat both doc_id and text are one document."""
    own = F.coalesce(F.col(id_col).cast("string"), F.lit("-"))
    return F.unhex(F.md5(F.concat(own, F.lit("\n"), text_of(text_col)).cast("binary")))


def windows(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", edges: bool = False) -> DataFrame:
    """(doc, doc_id, i, key): the i-th window of each document, by its hash. With `edges` i is -1 for the window that
    begins with the mark of the start; a mark is a blank line, which no worded line equals."""
    found = docs.select(
        identity(id_col, text_col).alias("doc"), F.col(id_col).alias("doc_id"), worded(lines_of(text_of(text_col))).alias("w")
    )
    first = 0
    if edges:
        mark = F.array(F.struct(F.lit(-1).alias("at"), F.lit("").alias("line")))
        found = found.filter(F.size("w") > 0).withColumn("w", F.concat(mark, "w", mark))
        first = -1
    found = found.filter(F.size("w") >= WIDTH)
    digest = lambda i: F.unhex(F.md5(F.concat_ws("\n", *(F.get(F.col("w"), i + k)["line"] for k in range(WIDTH))).cast("binary")))
    each = F.transform(F.sequence(F.lit(0), F.size("w") - WIDTH), lambda i: F.struct((i + first).alias("i"), digest(i).alias("key")))
    return found.select("doc", "doc_id", F.inline(each))


def repeats(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", edges: bool = False,
            protect: bool = True) -> DataFrame:
    """(doc, removed): per document with later occurrences, the indexes of its worded lines to remove. With `edges`
    they may be the places of marks, below 0 or behind the last line. `protect` leaves out lines of first occurrences.

    Frequent windows are settled on the map side, the others in a shuffle where none exceeds the share."""
    rows = written(windows(docs, text_col, id_col, edges), "line-windows")
    best = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "doc", "i"))
    often = written(heavy.winners(rows, best), "frequent-windows")
    marked = heavy.group_winners(rows, best, often).filter("size > 1")
    first = (F.col("best")["doc"] == F.col("doc")) & (F.col("best")["i"] == F.col("i"))
    spread = lambda c: F.flatten(F.transform(c, lambda i: F.transform(F.sequence(F.lit(0), F.lit(WIDTH - 1)), lambda k: i + k)))
    by_doc = marked.groupBy("doc").agg(
        F.collect_set(F.when(~first, F.col("i"))).alias("later"), F.collect_set(F.when(first, F.col("i"))).alias("own")
    ).filter(F.size("later") > 0)
    later = F.array_distinct(spread(F.col("later")))
    return by_doc.select("doc", (F.array_except(later, spread(F.col("own"))) if protect else later).alias("removed"))


def deduplicated(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", edges: bool = False,
                 protect: bool = True) -> DataFrame:
    """docs with the remaining text, and `n_lines`, `n_removed` (with underscores in front if docs has such columns).

    One row per row of docs. A null text stays null; texts of fewer than three lines with a word are left alone, unless
    `edges` gives them windows of their own. Rows that repeat doc_id and text are treated alike. A null doc_id comes after all others. No rows give no rows.
    """
    doc, removed, lines, own = (free_name(docs, f"_{n}") for n in ("doc", "removed", "lines", "worded"))
    n_lines, n_removed = free_name(docs, "n_lines"), free_name(docs, "n_removed")
    marks = written(repeats(docs, text_col, id_col, edges, protect), "repeated-lines").withColumnsRenamed({"doc": doc, "removed": removed})
    # merge: the marks grow with the documents, so they are not broadcast where they happen to be few
    joined = docs.withColumn(doc, identity(id_col, text_col)).join(marks.hint("merge"), doc, "left").withColumn(lines, lines_of(F.col(text_col)))
    joined = joined.withColumn(own, F.when(F.col(removed).isNotNull(), worded(F.col(lines))))
    if edges:
        joined = joined.withColumn(removed, F.filter(removed, lambda i: (i >= 0) & (i < F.size(own))))
    gone = F.transform(F.col(removed), lambda i: F.get(F.col(own), i)["at"])
    stay = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), gone)
    rest = F.array_join(F.transform(stay, lambda at: F.get(F.col(lines), at)), "\n")
    return joined.withColumns({
        text_col: F.when(F.col(removed).isNull(), F.col(text_col)).otherwise(rest),
        n_lines: F.coalesce(F.size(lines), F.lit(0)).cast("long"),
        n_removed: F.coalesce(F.size(removed), F.lit(0)).cast("long"),
    }).select(*docs.columns, n_lines, n_removed)


def op2(spark: SparkSession, sf_dir: str, edges: bool = False, protect: bool = True) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return deduplicated(docs, edges=edges, protect=protect).select("doc_id", "n_lines", "n_removed", F.sha2(F.col("text").cast("binary"), 256).alias("text_sha256"))


def op2_whole(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op2(spark, sf_dir, edges=True, protect=False)


OP2_SQL = r"""
with lines as (
    select doc_id, unnest(range(len(string_split(coalesce(text, ''), chr(10))))) as spot,
           unnest(string_split(coalesce(text, ''), chr(10))) as line from documents
), worded as (
    select doc_id, spot, line, row_number() over (partition by doc_id order by spot) - 1 as i
    from lines where regexp_matches(line, '[^\x20\x09-\x0D]')
), windows as (
    select doc_id, i, window_text from (
        select doc_id, i, line || chr(10) || lead(line) over w || chr(10) || lead(line, 2) over w as window_text
        from worded window w as (partition by doc_id order by i)) where window_text is not null
), placed as (
    select *, row_number() over (partition by window_text order by doc_id, i) as occurrence,
           count(*) over (partition by window_text) as n from windows
), covered as (
    select doc_id, i + k as i, bool_or(occurrence > 1) as later, bool_or(occurrence = 1) as own
    from placed, range(3) as r(k) where n > 1 group by 1, 2
), removed as (
    select doc_id, spot from covered join worded using (doc_id, i) where later and not own
), stay as (
    select doc_id, count(*) as n_stay, string_agg(line, chr(10) order by spot) as text
    from lines left join removed using (doc_id, spot) where not exists (
        select 1 from removed r where r.doc_id = lines.doc_id and r.spot = lines.spot) group by 1
), sizes as (select doc_id, count(*) as n_lines from lines group by 1)
select doc_id, n_lines, (n_lines - coalesce(n_stay, 0))::bigint as n_removed, sha256(coalesce(stay.text, '')) as text_sha256
from sizes left join stay using (doc_id)
"""

OP2_WHOLE_SQL = r"""
with lines as (
    select doc_id, unnest(range(len(string_split(coalesce(text, ''), chr(10))))) as spot,
           unnest(string_split(coalesce(text, ''), chr(10))) as line from documents
), worded as (
    select doc_id, spot, line, row_number() over (partition by doc_id order by spot) - 1 as i
    from lines where regexp_matches(line, '[^\x20\x09-\x0D]')
), windows as (
    select doc_id, i, coalesce(lag(line) over w, '') || chr(10) || line || chr(10) || coalesce(lead(line) over w, '') as window_text
    from worded window w as (partition by doc_id order by i)
), placed as (
    select *, row_number() over (partition by window_text order by doc_id, i) as occurrence from windows
), removed as (
    select distinct doc_id, i + k as i from placed, range(-1, 2) as r(k) where occurrence > 1
), stay as (
    select doc_id, count(*) as n_stay, string_agg(line, chr(10) order by spot) as text
    from lines where not exists (
        select 1 from removed r join worded w using (doc_id, i) where w.doc_id = lines.doc_id and w.spot = lines.spot) group by 1
), sizes as (select doc_id, count(*) as n_lines from lines group by 1)
select doc_id, n_lines, (n_lines - coalesce(n_stay, 0))::bigint as n_removed, sha256(coalesce(stay.text, '')) as text_sha256
from sizes left join stay using (doc_id)
"""
