"""Operator 6: repeated runs of lines, by winnowing over line hashes.

A window is a run of lines, as short as it can be, with at least `min_words` words; each line begins
one and ends one. A window's fingerprint is its line with the smallest hash, which only depends on
the window's lines, so a run of `min_words` words or more that occurs twice has equal fingerprints in
both places for certain. Windows whose fingerprint occurs once are dropped; of the rest, equal ones
are joined to their first occurrence. Windows that begin at a line extend a match to the right,
those that end at it to the left: together they cover the repeated run as far as it goes. Later
occurrences are deleted. Everything is built-in functions.

In other words: a line is deleted if it lies in a run of lines with at least `min_words` words that
also begins earlier, in the order of keys and lines. The first occurrence of a window stays, so each
line that is deleted is still there at least once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridspark.llm.common import text_or_empty, written

MIN_WORDS = 10


def units(text: Column) -> Column:
    """Lines with a word in them: place among all lines, two hashes, number of words."""
    lines = F.transform(
        F.split(text, "\n", -1),
        lambda line, i: F.struct(
            i.alias("at"), F.xxhash64(line).alias("hash"), F.xxhash64(line, F.lit(1)).alias("more"),
            F.regexp_count(line, F.lit(r"\S+")).alias("words"),
        ),
    )
    return F.filter(lines, lambda u: u["words"] > 0)


def _reach(run: Column, min_words: int) -> Column:
    """How many units from the first it takes for `min_words` words; 0 if there are not as many."""
    start = F.struct(F.lit(0).alias("words"), F.lit(0).alias("n"))
    return F.aggregate(
        run, start,
        lambda a, u: F.when(a["words"] >= min_words, a).otherwise(
            F.struct((a["words"] + u["words"]).alias("words"), (a["n"] + 1).alias("n"))
        ),
        lambda a: F.when(a["words"] >= min_words, a["n"]).otherwise(0),
    )


def windows(lines: Column, min_words: int) -> Column:
    """Distinct windows: first and last line, key of the content, smallest line hash and its line."""
    n = F.size(lines)
    # Each unit has a word, so `min_words` of them are enough.
    ahead = lambda i: F.struct(
        (i + 1).alias("first"), _reach(F.slice(lines, i + 1, min_words), min_words).alias("n")
    )
    behind = lambda i: F.struct(
        F.lit(0).alias("first"),
        _reach(F.reverse(F.slice(lines, F.greatest(i + 2 - min_words, F.lit(1)), F.least(i + 1, F.lit(min_words)))), min_words).alias("n"),
    )
    places = F.sequence(F.lit(0), n - 1)
    left = F.transform(places, ahead)
    right = F.transform(F.transform(places, lambda i: F.struct(i.alias("i"), behind(i)["n"].alias("n"))),
                        lambda x: F.struct((x["i"] + 2 - x["n"]).alias("first"), x["n"].alias("n")))
    # One number for a window's begin and length: distinct numbers are found by hashing, distinct
    # structs by comparing each with all.
    packed = lambda w: w["first"].cast("long") * (min_words + 1) + w["n"]
    both = F.array_distinct(F.transform(F.filter(F.concat(left, right), lambda w: w["n"] > 0), packed))

    def made(w: Column) -> Column:
        own = F.slice(lines, F.floor(w / (min_words + 1)).cast("int"), (w % (min_words + 1)).cast("int"))
        least = F.array_min(F.transform(own, lambda u: F.struct(u["hash"], u["at"])))
        return F.struct(
            F.element_at(own, 1)["at"].alias("begin"), F.element_at(own, -1)["at"].alias("end"),
            F.xxhash64(F.transform(own, lambda u: u["hash"])).alias("key"),
            F.xxhash64(F.transform(own, lambda u: u["more"])).alias("more"),
            least["hash"].alias("mark"), least["at"].alias("mark_at"),
        )

    return F.when(n > 0, F.transform(both, made)).otherwise(
        F.array().cast("array<struct<begin:int,end:int,key:bigint,more:bigint,mark:bigint,mark_at:int>>")
    )


def repeated(rows: DataFrame, min_words: int) -> DataFrame:
    """`id`, `version`, `gone`: for each text with repeated runs, the lines to delete, as disjoint
    ranges (begin, end) in order. `rows` has `id`, `version`, `text`."""
    lined = rows.select("id", "version", units(F.col("text")).alias("lines"))
    found = written(lined.select("id", "version", windows(F.col("lines"), min_words).alias("windows")), "windows")

    # Fingerprints that occur in more than one place; windows side by side mostly share one.
    new = F.filter("windows", lambda w, i: (i == 0) | (w["mark_at"] != F.get("windows", i - 1)["mark_at"]))
    places = F.transform(new, lambda w: F.struct(w["mark"].alias("mark"), F.xxhash64("id", "version", w["mark_at"]).alias("at")))
    marks = found.select(F.explode(places).alias("m")).groupBy("m.mark").agg(F.min("m.at").alias("a"), F.max("m.at").alias("z"))
    # Written: between two plain tables Spark splits the join's large partitions.
    marks = written(marks.filter("a < z").select("mark"), "marks")
    every = found.select("id", "version", F.explode("windows").alias("w")).select("id", "version", "w.*").drop("mark_at")
    every = every.join(marks, "mark", "left_semi").drop("mark")
    every = written(every, "matches")

    place = F.struct("id", "version", "begin", "end")
    firsts = every.groupBy("key", "more").agg(F.min(place).alias("first"), F.count("*").alias("n")).filter("n > 1")
    later = every.join(written(firsts.drop("n"), "firsts"), ["key", "more"]).filter(
        "NOT (id <=> first.id AND version = first.version AND begin = first.begin)"
    )
    # In the same text, what overlaps the first occurrence is part of it.
    same = F.col("id").eqNullSafe(F.col("first.id")) & (F.col("version") == F.col("first.version"))
    begin = F.when(same, F.greatest("begin", F.col("first.end") + 1)).otherwise(F.col("begin"))
    later = later.select("id", "version", begin.alias("begin"), "end").filter("begin <= end")

    # Ranges that touch become one; a text's ranges are no more than twice its lines.
    order = Window.partitionBy("id", "version").orderBy("begin", "end")
    reached = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    starts = later.distinct().withColumn("new", F.coalesce((F.col("begin") > reached + 1).cast("int"), F.lit(1)))
    island = F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    merged = starts.withColumn("island", island).groupBy("id", "version", "island").agg(
        F.min("begin").alias("begin"), F.max("end").alias("end")
    )
    return merged.groupBy("id", "version").agg(F.array_sort(F.collect_list(F.struct("begin", "end"))).alias("gone"))


def without(lines: Column, gone: Column) -> Column:
    """The lines outside the ranges: the slices before, between and behind them."""
    ranges = F.size(gone)

    def part(j: Column) -> Column:
        begin = F.when(j == 0, 0).otherwise(F.get(gone, j - 1)["end"] + 1)
        end = F.when(j == ranges, F.size(lines)).otherwise(F.get(gone, j)["begin"])
        return F.slice(lines, begin + 1, end - begin)

    return F.flatten(F.transform(F.sequence(F.lit(0), ranges), part))


def deduplicated(df: DataFrame, key: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """`df` with the later repeated runs of lines cut out of `text`, and `n_lines` (before) and
    `n_removed`.

    Null texts count as empty and have no lines. Lines are equal if all their characters are; those
    without a word never repeat, but go with a run that they lie inside. Texts come in the order of
    `key` (nulls first). Rows alike in key and text are one text and come out alike; rows that share a
    key only come in an order of their own. Other columns stay; some called like the new ones are
    replaced.
    """
    own = [c for c in df.columns if c not in (text, "n_lines", "n_removed")]
    whole = text_or_empty(text)
    rows = df.select(F.col(key).alias("id"), F.xxhash64(whole).alias("version"), whole.alias("text"))
    gone = repeated(rows, min_words).withColumnRenamed("id", "__id").withColumnRenamed("version", "__version")
    # Few short rows on this side: hashed, so the texts need no sort.
    given = df.select(*own, whole.alias(text), F.xxhash64(whole).alias("__own"))
    joined = given.join(
        gone.hint("shuffle_hash"), F.col(key).eqNullSafe(F.col("__id")) & (F.col("__own") == F.col("__version")), "left"
    )
    lines = F.split(F.col(text), "\n", -1)
    removed = F.aggregate("gone", F.lit(0), lambda a, r: a + r["end"] - r["begin"] + 1)
    kept = F.when(F.col("gone").isNull(), F.col(text)).otherwise(F.array_join(without(lines, F.col("gone")), "\n"))
    return joined.select(
        *own, kept.alias(text),
        F.when(F.col(text) == "", 0).otherwise(F.size(lines)).cast("long").alias("n_lines"),
        F.coalesce(removed, F.lit(0)).cast("long").alias("n_removed"),
    )


#: The same in DuckDB's SQL over `documents`, without hashes.
SQL = r"""
WITH lines AS (
    SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
           generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) - 1 AS place
    FROM documents
), counted AS (
    SELECT *, len(regexp_extract_all(line, '\S+')) AS words FROM lines
), units AS (
    SELECT *, row_number() OVER w AS i, sum(words) OVER w AS upto
    FROM counted WHERE words > 0 WINDOW w AS (PARTITION BY doc_id ORDER BY place)
), spans AS (
    SELECT a.doc_id, a.i AS initial, min(b.i) AS final
    FROM units a JOIN units b ON a.doc_id = b.doc_id AND b.i BETWEEN a.i AND a.i + MIN_WORDS
    WHERE b.upto - a.upto + a.words >= MIN_WORDS GROUP BY ALL
    UNION
    SELECT b.doc_id, max(a.i) AS initial, b.i AS final
    FROM units a JOIN units b ON a.doc_id = b.doc_id AND a.i BETWEEN b.i - MIN_WORDS AND b.i
    WHERE b.upto - a.upto + a.words >= MIN_WORDS GROUP BY ALL
), windows AS (
    SELECT s.doc_id, min(u.place) AS "begin", max(u.place) AS "end", string_agg(u.line, chr(10) ORDER BY u.place) AS content
    FROM spans s JOIN units u ON u.doc_id = s.doc_id AND u.i BETWEEN s.initial AND s.final
    GROUP BY s.doc_id, s.initial, s.final
), ranked AS (
    SELECT *, row_number() OVER w AS n, first_value(doc_id) OVER w AS of_doc, first_value("end") OVER w AS of_end
    FROM windows WINDOW w AS (PARTITION BY content ORDER BY doc_id, "begin", "end")
), gone AS (
    SELECT doc_id, CASE WHEN of_doc = doc_id THEN greatest("begin", of_end + 1) ELSE "begin" END AS "begin", "end"
    FROM ranked WHERE n > 1
), judged AS (
    SELECT l.doc_id, l.place, l.line, bool_or(g.doc_id IS NOT NULL) AS removed
    FROM lines l LEFT JOIN gone g ON g.doc_id = l.doc_id AND l.place BETWEEN g."begin" AND g."end"
    GROUP BY l.doc_id, l.place, l.line
)
SELECT j.doc_id,
       coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE NOT removed), '') AS text,
       CASE WHEN any_value(coalesce(d.text, '')) = '' THEN 0 ELSE count(*) END AS n_lines,
       count(*) FILTER (WHERE removed) AS n_removed
FROM judged j JOIN documents d USING (doc_id) GROUP BY j.doc_id
""".replace("MIN_WORDS", str(MIN_WORDS))
