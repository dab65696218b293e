"""Quality rules as a bitmask ledger. DataFrame functions only.

Every rule is evaluated once; a document keeps its measurements and one integer
whose bit b is set if rule b fails. A policy is a version name and a mask of the
rules it enforces, so new policies, comparisons and ablations need only bitwise
work on the ledger, never the texts again.

Words are ``[^\\x20\\x09-\\x0D]+``. Null texts have no words, like empty ones. Texts
without words fail the length rule. Extra columns of the input are carried along, but for
ones named ``m`` or ``failed``, which the ledger's own replace.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import settled, table

WINDOW = 5
# ASCII white space, and the symbols that count as such.
SPACE = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"

#: ``(name, SQL condition under which a document fails)``; the place in the list is the bit.
RULES = (
    ("too_few_words", "n_words < 10"),
    ("repeated_windows", "100 * n_repeat_words > 20 * n_words"),
    ("word_length", "n_words > 0 and (word_chars < 2 * n_words or word_chars > 15 * n_words)"),
    ("symbols", "10 * n_symbols > n_words"),
    ("duplicate_lines", "n_dup_lines >= 3 and 10 * n_dup_lines > 3 * n_lines"),
    ("stutter", "5 * n_stutters > n_words"),
)

#: ``version -> names of the rules it enforces``. ``base`` is fixed; ``v1`` decides.
POLICIES = {
    "base": ("too_few_words", "repeated_windows"),
    "v1": tuple(name for name, _ in RULES),
}


def mask(names: Sequence[str]) -> int:
    places = {name: bit for bit, (name, _) in enumerate(RULES)}
    return sum(1 << places[name] for name in names)


def measure(docs: DataFrame) -> DataFrame:
    """``docs`` with ``n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words, n_stutters`` in a struct ``m``.

    Each step is a projection of its own, since a lambda that held an earlier
    expression would compute it once for every element.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.expr(f"filter(split(_text, '\\n', -1), l -> length(translate(l, {_sql(SPACE)}, '')) > 0)")
    words = F.split(F.btrim(F.col("_text"), F.lit(SPACE)), "[ \\t\\n\\x0B\\f\\r]+")
    dense = F.translate(F.col("_text"), SPACE, "")
    # What is not used here stays in a struct, so that no name of it can clash.
    rest = [c for c in docs.columns if c != "m"]
    step = (
        docs.select(F.struct(*[F.col(f"`{c}`") for c in rest]).alias("_rest"), text.alias("_text"))
        .withColumn("_words", F.when(F.length(dense) == 0, F.array().cast("array<string>")).otherwise(words))
        .withColumn("_lines", lines)
    )
    # The window that starts at word i, as a hash of its words.
    at = ", ".join(f"get(_words, i + {k})" for k in range(WINDOW))
    step = step.withColumn(
        "_windows",
        F.expr(f"if(size(_words) < {WINDOW}, array(), transform(sequence(0, size(_words) - {WINDOW}), i -> xxhash64({at})))"),
    )
    step = step.withColumn("_repeats", F.expr("size(_windows) > size(array_distinct(_windows))"))
    # Starts of windows that are found twice or more: neighbours with equal hashes when sorted.
    step = step.withColumn(
        "_sorted",
        F.expr("if(_repeats, sort_array(transform(_windows, (w, i) -> struct(w, i))), array())"),
    )
    step = step.withColumn(
        "_starts",
        F.expr(
            "if(_repeats, sort_array(transform(filter(transform(_sorted, (s, k) -> struct(s.i as i,"
            " (k > 0 and get(_sorted, k - 1).w = s.w) or coalesce(get(_sorted, k + 1).w = s.w, false) as twice)),"
            " s -> s.twice), s -> s.i)), array())"
        ),
    )
    covered = F.expr(
        f"aggregate(transform(_starts, (s, k) -> least({WINDOW}, coalesce(get(_starts, k + 1) - s, {WINDOW}))),"
        " 0L, (total, x) -> total + x)"
    )
    symbols = F.length("_text") - F.length(F.translate(F.col("_text"), SYMBOLS, ""))
    found = F.struct(
        F.size("_words").cast("long").alias("n_words"),
        F.length(dense).cast("long").alias("word_chars"),
        symbols.cast("long").alias("n_symbols"),
        F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        covered.alias("n_repeat_words"),
        F.expr("size(filter(_words, (w, i) -> coalesce(w = get(_words, i + 1), false)))").cast("long").alias("n_stutters"),
    )
    return step.select("_rest", settled(found).alias("m")).select(*[F.col("_rest").getField(c).alias(c) for c in rest], "m")


def _sql(text: str) -> str:
    return "'" + "".join(f"\\u{ord(c):04x}" for c in text) + "'"


def ledger(docs: DataFrame) -> DataFrame:
    """``docs`` with measurements ``m`` and the failure bits ``failed``."""
    bits = [F.when(F.expr(_on_m(rule)), F.lit(1 << bit)).otherwise(0) for bit, (_, rule) in enumerate(RULES)]
    out = bits[0]
    for b in bits[1:]:
        out = out.bitwiseOR(b)
    return measure(docs).withColumn("failed", out.cast("long"))


def _on_m(rule: str) -> str:
    for name in ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_stutters"):
        rule = rule.replace(name, f"m.{name}")
    return rule


def passes(version: str, failed: Column | str = "failed") -> Column:
    column = F.col(failed) if isinstance(failed, str) else failed
    return column.bitwiseAND(F.lit(mask(POLICIES[version]))) == 0


def ablations(book: DataFrame, version: str = "v1") -> DataFrame:
    """Per rule of a policy: documents that fail it, that fail it alone, and what the policy keeps without it."""
    whole = mask(POLICIES[version])
    patterns = book.select(F.col("failed").bitwiseAND(F.lit(whole)).alias("bits")).groupBy("bits").count()
    rules = F.array(*[F.struct(F.lit(n).alias("rule"), F.lit(mask([n])).cast("long").alias("bit")) for n in POLICIES[version]])
    each = patterns.withColumn("r", F.explode(rules))
    fails, rest = F.expr("bits & r.bit <> 0"), F.expr(f"bits & ({whole} & ~r.bit)")
    return each.groupBy("r.rule").agg(
        F.sum(F.when(fails, F.col("count")).otherwise(0)).alias("n_failed"),
        F.sum(F.when(fails & (rest == 0), F.col("count")).otherwise(0)).alias("n_failed_alone"),
        F.sum(F.when(rest == 0, F.col("count")).otherwise(0)).alias("n_kept_without"),
    )


def op8_rule_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    book = ledger(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return book.select(
        "doc_id", "m.n_words", "m.word_chars", "m.n_symbols", "m.n_dup_lines", "m.n_repeat_words",
        (~passes("base")).alias("base_failed"), passes("v1").alias("kept"), F.col("failed").alias("failed_bits"),
    )


ORACLE = r"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws,
        list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS ls FROM t),
word AS (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS i FROM w),
win AS (SELECT doc_id, i, word, lead(word) OVER p AS b, lead(word, 2) OVER p AS c, lead(word, 3) OVER p AS d, lead(word, 4) OVER p AS e
        FROM word WINDOW p AS (PARTITION BY doc_id ORDER BY i)),
twice AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, word, b, c, d, e) AS n FROM win WHERE e IS NOT NULL),
covered AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM twice, range(5) r(k) WHERE twice.n > 1 GROUP BY doc_id),
stutter AS (SELECT doc_id, count(*) AS n FROM win WHERE word = b GROUP BY doc_id),
m AS (SELECT w.doc_id, len(ws) AS n_words, coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0) AS word_chars,
        length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
        len(ls) AS n_lines, len(ls) - len(list_distinct(ls)) AS n_dup_lines,
        coalesce(covered.n, 0) AS n_repeat_words, coalesce(stutter.n, 0) AS n_stutters
      FROM w LEFT JOIN covered USING (doc_id) LEFT JOIN stutter USING (doc_id)),
f AS (SELECT *, CASE WHEN n_words < 10 THEN 1 ELSE 0 END + CASE WHEN 100 * n_repeat_words > 20 * n_words THEN 2 ELSE 0 END
        + CASE WHEN n_words > 0 AND (word_chars < 2 * n_words OR word_chars > 15 * n_words) THEN 4 ELSE 0 END
        + CASE WHEN 10 * n_symbols > n_words THEN 8 ELSE 0 END
        + CASE WHEN n_dup_lines >= 3 AND 10 * n_dup_lines > 3 * n_lines THEN 16 ELSE 0 END
        + CASE WHEN 5 * n_stutters > n_words THEN 32 ELSE 0 END AS bits FROM m)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
       n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words,
       bits & 3 <> 0 AS base_failed, bits = 0 AS kept, bits::BIGINT AS failed_bits FROM f
"""

QUERIES = {"op8_rule_ledger": op8_rule_ledger}
ORACLES = {"op8_rule_ledger": ORACLE}
