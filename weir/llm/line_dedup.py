"""Line deduplication: repeated runs of lines, found with a suffix array over line ids.

Every text is a sequence of its non-blank lines. Lines that stand in the corpus once cannot be part of a
repeat and cut the sequences into stretches. Over these, prefix doubling ranks all suffixes by their first
1, 2, 4, ... lines: a rank is a pair of earlier ranks, numbered in sorted order, and a suffix whose rank
nobody shares is done. Suffixes that share their first L lines are an interval of the suffix array, the one
whose longest common prefix is L or more; it is named by the ranks of its first and last power-of-two lines.

A line is deleted if it lies in a run of consecutive lines with ``min_words`` words or more that also begins
earlier in the corpus (by document, then line). The runs that decide this are, for each line, the shortest one
with enough words that starts with it and the shortest that ends with it: what a longest repeated run covers
is covered by these. Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weir.llm.common import stored

_SPACE = r"[ \t\r\f\x0B]+"


def document_lines(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc, seq, line_no, n_words, line): the non-blank lines; ``doc`` is the id with a hash of the text.

    Rows that repeat an id with another text are documents of their own; rows that repeat both are the same
    document. A null id sorts before all others.
    """
    body = F.col(text)
    numbered = F.transform(F.split(body, "\n", -1), lambda line, i: F.struct(
        i.alias("line_no"),
        F.size(F.filter(F.split(line, _SPACE), lambda w: w != "")).alias("n_words"),
        F.unhex(F.md5(line)).alias("line"),
    ))
    return (
        docs.where(body.isNotNull())
        .select(F.struct(F.col(id).alias("id"), F.xxhash64(body).alias("text")).alias("doc"),
                F.posexplode(F.filter(numbered, lambda x: x["n_words"] > 0)).alias("seq", "x"))
        .select("doc", "seq", "x.line_no", "x.n_words", "x.line")
    )


def _numbered(distinct: DataFrame, *keys: str) -> DataFrame:
    """``distinct`` with ``rank``, a number that grows with the keys."""
    return (
        distinct.repartitionByRange(*keys).sortWithinPartitions(*keys)
        .withColumn("rank", F.monotonically_increasing_id())
    )


def repeated_stretches(lines: DataFrame, min_words: int) -> DataFrame:
    """The lines that occur twice or more, with their ids ``r0`` and the runs they start and end.

    ``ahead`` (``behind``) is the number of lines of the shortest run with ``min_words`` words that starts
    (ends) with the line inside its stretch of repeated lines; null if there is none.
    """
    repeated = lines.groupBy("line").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("line")
    ids = _numbered(repeated, "line").withColumnRenamed("rank", "r0")
    rows = lines.join(ids, "line").select("doc", "seq", "line_no", "n_words", "r0").dropDuplicates(["doc", "seq"])
    by_doc = Window.partitionBy("doc").orderBy("seq")
    rows = rows.withColumn("stretch", F.col("seq") - F.row_number().over(by_doc))
    inside = Window.partitionBy("doc", "stretch").orderBy("seq")
    rows = rows.withColumn("upto", F.sum("n_words").over(inside)).withColumns({
        "begin": F.col("upto") - F.col("n_words"),
        "total": F.sum("n_words").over(Window.partitionBy("doc", "stretch")),
    })
    ahead = F.count(F.lit(1)).over(Window.partitionBy("doc", "stretch").orderBy("begin").rangeBetween(0, min_words - 1))
    behind = F.count(F.lit(1)).over(Window.partitionBy("doc", "stretch").orderBy("upto").rangeBetween(1 - min_words, 0))
    return rows.select(
        "doc", "stretch", "seq", "line_no", "r0",
        F.when(F.col("total") - F.col("begin") >= min_words, ahead).alias("ahead"),
        F.when(F.col("upto") >= min_words, behind).alias("behind"),
    )


def suffix_ranks(rows: DataFrame, longest: int | None = None) -> tuple[DataFrame, int]:
    """``rows`` with r1, r2, ...: rk is the rank of the suffix by its first 2**k lines, null if it has none to share it.

    Doubling goes on until no two suffixes share a rank, or past runs of ``longest`` lines. Returns the number
    of the last rank, too.
    """
    k = 0
    while longest is None or 2 ** (k + 1) <= longest:
        after = F.lead(f"r{k}", 2 ** k).over(Window.partitionBy("doc", "stretch").orderBy("seq"))
        paired = rows.withColumn("_next", after)
        shared = (
            paired.where(f"r{k} IS NOT NULL AND _next IS NOT NULL")
            .groupBy(f"r{k}", "_next").agg(F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
        )
        ranks = stored(_numbered(shared, f"r{k}", "_next"), "suffix-ranks")
        if ranks.isEmpty():
            break
        rows = stored(paired.join(ranks, [f"r{k}", "_next"], "left").drop("_next").withColumnRenamed("rank", f"r{k + 1}"), "suffixes")
        k += 1
    return rows, k


def _later_runs(rows: DataFrame, last: int, starts: DataFrame) -> DataFrame:
    """The rows (doc, seq, length, ...) of ``starts`` whose run of ``length`` lines also begins earlier."""
    power = F.lit(0)
    for k in range(1, last + 1):
        power = F.when(F.col("length") >= 2 ** k, k).otherwise(power)
    ranks = F.array(*[f"r{k}" for k in range(last + 1)])
    # Runs longer than twice the last shared power of two stand once.
    wanted = starts.where(F.col("length") < 2 ** (last + 1)).withColumns({
        "power": power, "tail": F.col("seq") + F.col("length") - F.pow(F.lit(2), power).cast("int"),
    })
    at = rows.select("doc", F.col("seq").alias("tail"), ranks.alias("tail_ranks"))
    head = rows.select("doc", "seq", ranks.alias("head_ranks"))
    named = (
        wanted.join(head, ["doc", "seq"]).join(at, ["doc", "tail"])
        .withColumns({"head_rank": F.col("head_ranks")[F.col("power")], "tail_rank": F.col("tail_ranks")[F.col("power")]})
        .where("head_rank IS NOT NULL AND tail_rank IS NOT NULL")
        .select("doc", "seq", "length", "way", "head_rank", "tail_rank")
    )
    named = stored(named, "line-runs")
    interval = ["length", "head_rank", "tail_rank"]
    first = named.groupBy(*interval).agg(F.min(F.struct("doc", "seq")).alias("first"))
    return named.join(first, interval).where(F.col("first") < F.struct("doc", "seq")).select("doc", "seq", "length", "way")


def repeated_lines(docs: DataFrame, min_words: int = 50, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc, line_no) of the lines to delete."""
    lines = stored(document_lines(docs, id, text), "lines")
    rows = stored(repeated_stretches(lines, min_words), "suffixes")
    longest = rows.agg(F.max(F.greatest("ahead", "behind"))).first()[0] or 0
    rows, last = suffix_ranks(rows, longest)
    starts = (
        rows.where("ahead IS NOT NULL").select("doc", "seq", F.col("ahead").cast("int").alias("length"), F.lit("ahead").alias("way"))
        .unionByName(rows.where("behind IS NOT NULL").select(
            "doc", (F.col("seq") - F.col("behind") + 1).cast("int").alias("seq"), F.col("behind").cast("int").alias("length"), F.lit("behind").alias("way")))
    )
    later = _later_runs(rows, last, starts)
    ahead = later.where("way = 'ahead'").select("doc", "seq", (F.col("seq") + F.col("length")).alias("reach"))
    behind = later.where("way = 'behind'").select("doc", (F.col("seq") + F.col("length") - 1).alias("seq"), F.col("seq").alias("since"))
    marked = (
        rows.select("doc", "seq", "line_no").unionByName(ahead, allowMissingColumns=True).unionByName(behind, allowMissingColumns=True)
        .groupBy("doc", "seq").agg(F.max("line_no").alias("line_no"), F.max("reach").alias("reach"), F.min("since").alias("since"))
    )
    down = Window.partitionBy("doc").orderBy("seq").rowsBetween(Window.unboundedPreceding, 0)
    up = Window.partitionBy("doc").orderBy(F.desc("seq")).rowsBetween(Window.unboundedPreceding, 0)
    covered = (F.max("reach").over(down) > F.col("seq")) | (F.min("since").over(up) <= F.col("seq"))
    return marked.withColumn("covered", F.coalesce(covered, F.lit(False))).where("covered").select("doc", "line_no")


def without_lines(text: Column, deleted: Column) -> Column:
    """``text`` without the lines whose numbers are in ``deleted`` (null: none)."""
    lines = F.split(text, "\n", -1)
    kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), deleted)
    return F.when(deleted.isNull(), text).otherwise(F.array_join(F.transform(kept, lambda i: F.get(lines, i)), "\n"))


def dedup_lines(docs: DataFrame, min_words: int = 50, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(row, text, deleted): each row of ``docs`` as a struct, its text without later copies, the deleted line numbers.

    Every row is kept; a text can become empty. Blank lines neither join nor break runs, and stay. A null
    text stays null, a text without repeats is unchanged. Of equal runs the one in the smallest document (a
    null id first, then by a hash of the text), earliest line, stays; rows that repeat id and text get the same
    result and are no copies of each other. Lines repeated inside one document count as well. An empty table
    gives no rows. The columns of ``docs`` stay inside ``row``, where names cannot clash.
    """
    deleted = repeated_lines(docs, min_words, id, text).groupBy("doc").agg(F.sort_array(F.collect_list("line_no")).alias("deleted"))
    body = F.col(f"row.`{text}`")
    rows = docs.select(F.struct("*").alias("row")).withColumn("doc", F.struct(F.col(f"row.`{id}`").alias("id"), F.xxhash64(body).alias("text")))
    return rows.join(deleted, "doc", "left").select(
        "row", without_lines(body, F.col("deleted")).alias("text"),
        F.coalesce("deleted", F.array().cast("array<int>")).alias("deleted"),
    )


def dedup_sql(min_words: int = 50) -> str:
    """DuckDB SQL for the query: all shortest runs with enough words, compared by their texts."""
    return rf"""
    WITH split_up AS (
        SELECT doc_id, text, string_split(text, chr(10)) AS lines FROM documents
    ), numbered AS (
        SELECT doc_id, unnest(lines) AS line, unnest(range(len(lines))) AS line_no FROM split_up WHERE text IS NOT NULL
    ), counted AS (
        SELECT *, len(list_filter(regexp_split_to_array(line, '[ \t\r\f\x0B]+'), lambda w: w <> '')) AS n_words FROM numbered
    ), seqs AS (
        SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY line_no) AS seq,
               sum(n_words) OVER (PARTITION BY doc_id ORDER BY line_no) AS upto
        FROM counted WHERE n_words > 0
    ), shortest AS (
        SELECT a.doc_id, a.seq AS seq, min(b.seq) AS until
        FROM seqs a JOIN seqs b ON a.doc_id = b.doc_id AND b.upto - a.upto + a.n_words >= {min_words} AND b.seq >= a.seq GROUP BY ALL
        UNION
        SELECT b.doc_id, max(a.seq) AS seq, b.seq AS until
        FROM seqs a JOIN seqs b ON a.doc_id = b.doc_id AND b.upto - a.upto + a.n_words >= {min_words} AND b.seq >= a.seq GROUP BY ALL
    ), runs AS (
        SELECT s.doc_id, s.seq, s.until, string_agg(q.line, chr(10) ORDER BY q.seq) AS run
        FROM shortest s JOIN seqs q ON q.doc_id = s.doc_id AND q.seq BETWEEN s.seq AND s.until GROUP BY ALL
    ), later AS (
        SELECT * FROM runs QUALIFY row_number() OVER (PARTITION BY run ORDER BY doc_id, seq) > 1
    ), deleted AS (
        SELECT DISTINCT q.doc_id, q.line_no FROM later l JOIN seqs q ON q.doc_id = l.doc_id AND q.seq BETWEEN l.seq AND l.until
    ), per_document AS (
        SELECT doc_id, count(*) AS n FROM deleted GROUP BY doc_id
    ), kept AS (
        SELECT n.doc_id, string_agg(n.line, chr(10) ORDER BY n.line_no) AS text
        FROM numbered n ANTI JOIN deleted d ON n.doc_id = d.doc_id AND n.line_no = d.line_no
        WHERE n.doc_id IN (SELECT doc_id FROM per_document) GROUP BY n.doc_id
    )
    SELECT s.doc_id, CASE WHEN p.n IS NULL THEN s.text ELSE coalesce(k.text, '') END AS text,
           CAST(coalesce(p.n, 0) AS INTEGER) AS n_deleted
    FROM split_up s LEFT JOIN per_document p ON p.doc_id = s.doc_id LEFT JOIN kept k ON k.doc_id = s.doc_id
    """
