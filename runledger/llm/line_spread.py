"""Line dedup by the number of distinct sites a line is found on. DataFrame functions only.

Each line that is long enough gets a 64-bit hash. HyperLogLog sketches of its sites are
built in every task and merged by aggregation, so a line that a third of all
documents hold is one sketch a task when it is shuffled. Lines whose estimate is
near the threshold get an exact distinct count; clear ones keep the estimate's verdict. A line on ``min_sites`` sites or more is boilerplate and is
removed everywhere but in its first place (the smallest doc_id, then the first
line), so that of a text copied all over the corpus one copy stays whole.

Where one source holds much of the corpus, copies of a passage stand on few sites. So
thresholds differ by length: ``more`` adds pairs of words and sites, and of the
pairs whose words a line has, the one with the most words counts. The query and the
pipeline add ``MORE``: a long line needs few sites, one of less than ``MIN_WORDS`` words many.

Only hashes are shuffled for counting. The documents themselves meet the list of line
numbers they lose, which for most is empty.

Defined cases: a null text stays null and counts no lines; an empty line, and one
of fewer than ``min_words`` words, always stays; a null source counts as the empty one.
Rows that repeat a doc_id lose the same line numbers. Rows with a null doc_id stay as
they are, though their lines count. Extra columns are carried along, whatever their names; ones named ``n_lines`` or
``n_removed`` are replaced.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import checkpointed, settled, table

#: A line of so many words on so many sites is boilerplate.
MIN_SITES, MIN_WORDS = 10, 4
#: Words and sites: a passage, hardly chance, needs few sites; a line of one to three words, often chance, needs many.
MORE = ((15, 4), (1, 16))
#: Sketches hold 2 ** LG_K registers: a relative standard error of about 1.04 / 2 ** (LG_K / 2).
LG_K = 12
#: Estimates within five standard errors of the threshold are counted exactly.
NEAR = 5 * 1.04 / 2 ** (LG_K / 2)


def lines(docs: DataFrame, site: str = "source", limits: tuple[tuple[int, int], ...] = ((MIN_WORDS, MIN_SITES),)) -> DataFrame:
    """``doc_id, place, line, site`` (both hashes) of every line that is judged, and ``need``, the sites that mark it."""
    word = r"[^ \t\n\x0B\f\r]+"
    need = F.lit(None).cast("int")
    for words, sites in sorted(limits):
        enough = rf"^[ \t\x0B\f\r]*({word}[ \t\x0B\f\r]+){{{words - 1}}}[^ \t\n\x0B\f\r]"
        need = F.when(F.col("col").rlike(enough), sites).otherwise(need)
    split = docs.filter("text is not null").select(
        "doc_id", F.xxhash64(F.coalesce(F.col(site).cast("string"), F.lit(""))).alias("site"), F.posexplode(F.split("text", "\n", -1))
    )
    named = split.select("doc_id", F.col("pos").alias("place"), F.xxhash64("col").alias("line"), "site", need.alias("need"))
    return named.filter("need is not null")


def boilerplate(found: DataFrame) -> DataFrame:
    """``line, first``: the hashes on at least ``need`` sites, and the first place of each."""
    place = F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "place")))
    spread = found.groupBy("line").agg(F.hll_sketch_agg("site", LG_K).alias("sketch"), place.alias("first"), F.max("need").alias("need"))
    spread = spread.select("line", "first", "need", F.hll_sketch_estimate("sketch").alias("sites"))
    spread = checkpointed(spread.filter(F.col("sites") >= F.col("need") * (1 - NEAR) - 1))
    clear = F.col("sites") > F.col("need") * (1 + NEAR) + 1
    near = spread.filter(~clear).select("line", "first", "need")
    # One row for each line and site before anything meets by line.
    pairs = found.select("line", "site").distinct()
    exact = pairs.join(near, "line", "left_semi").groupBy("line").count()
    exact = near.join(exact, "line").filter("count >= need").select("line", "first")
    return spread.filter(clear).select("line", "first").unionByName(exact)


def dedup(
    docs: DataFrame,
    site: str = "source",
    min_sites: int = MIN_SITES,
    min_words: int = MIN_WORDS,
    more: tuple[tuple[int, int], ...] = (),
) -> DataFrame:
    """``docs`` with ``text`` cleaned, ``n_lines`` before and ``n_removed``."""
    found = checkpointed(lines(docs, site, ((min_words, min_sites), *more)))
    marked = checkpointed(boilerplate(found))
    named = found.filter("doc_id is not null").select("line", F.struct("doc_id", "place").alias("at"))
    lost = (
        named.join(marked, "line")
        .filter(F.col("at") != F.col("first"))
        .groupBy(F.col("at.doc_id").alias("doc_id"))
        .agg(F.collect_set("at.place").alias("_lost"))
    )
    # What is not used here stays in a struct, so that no name of it can clash.
    rest = [c for c in docs.columns if c not in ("text", "n_lines", "n_removed")]
    out = docs.select(F.struct(*[F.col(f"`{c}`") for c in rest]).alias("_rest"), "doc_id", "text").join(lost, "doc_id", "left")
    out = out.withColumn("_lines", F.split("text", "\n", -1))
    kept = F.array_except(F.sequence(F.lit(0), F.size("_lines") - 1), F.col("_lost"))
    out = out.withColumn("_kept", F.when(F.col("_lost").isNotNull(), kept))
    clean = F.array_join(F.transform("_kept", lambda i: F.get("_lines", i)), "\n")
    n_lines = F.when(F.col("text").isNull(), 0).otherwise(F.size("_lines")).cast("long")
    removed = F.coalesce(n_lines - F.size("_kept"), F.lit(0)).cast("long")
    changed = F.col("_kept").isNotNull()
    result = F.struct(
        F.when(changed, clean).otherwise(F.col("text")).alias("text"),
        n_lines.alias("n_lines"),
        F.when(changed, removed).otherwise(F.lit(0)).cast("long").alias("n_removed"),
    )
    names = [F.col("_rest").getField(c).alias(c) for c in rest]
    return out.select("_rest", settled(result).alias("_r")).select(*names, "_r.text", "_r.n_lines", "_r.n_removed")


def op4_line_spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return dedup(docs, more=MORE).select("doc_id", "n_lines", "n_removed", "text")


ORACLE = r"""
WITH l AS (SELECT doc_id, coalesce(source, '') AS site, unnest(string_split(text, chr(10))) AS line,
             generate_subscripts(string_split(text, chr(10)), 1) AS place
           FROM documents WHERE text IS NOT NULL),
w AS (SELECT *, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS words FROM l),
marked AS (SELECT line, min((doc_id, place)) AS first FROM w WHERE words > 0 GROUP BY line, words
  HAVING count(DISTINCT site) >= CASE WHEN words >= 15 THEN 4 WHEN words >= 4 THEN 10 ELSE 16 END),
kept AS (SELECT l.doc_id, l.place, l.line, m.line IS NOT NULL AND (l.doc_id, l.place) <> m.first AS lost
         FROM l LEFT JOIN marked m ON l.line = m.line),
back AS (SELECT doc_id, count(*) AS n_lines, sum(lost::BIGINT) AS n_removed,
           coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE NOT lost), '') AS text
         FROM kept GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_lines, 0)::BIGINT AS n_lines, coalesce(n_removed, 0)::BIGINT AS n_removed,
       CASE WHEN d.text IS NULL THEN NULL ELSE back.text END AS text
FROM documents d LEFT JOIN back USING (doc_id)
"""

QUERIES = {"op4_line_spread": op4_line_spread}
ORACLES = {"op4_line_spread": ORACLE}
