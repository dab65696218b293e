"""Secret scans by two character Markov models. DataFrame functions only.

Base rules find secrets by their form: an assignment to a telling name, a cloud access key, a
long run of hex digits. Beyond these, two models of order one judge every long run of token
characters: one of random strings, one of ordinary identifiers. A run whose log-likelihood
ratio, random over ordinary, reaches ``LIMIT`` is a secret of kind ``random``.

The models are trained from labelled samples (:func:`train`), each distinct token once, so
copies and frequent words weigh no more than others. :func:`corpus_samples` labels the whole
corpus: what the base rules find is random, shorter runs of the corpus are ordinary.
Half of the random model is uniform, so random strings over letters that no sample has count
as well. Ratios are whole thousandths, so sums are exact. A model is one number for each pair of ASCII
characters (128 * 128 at most), whatever the size of the corpus.

Everything on a text happens within its row: runs and their places come from splitting at the
pattern and adding up lengths, in blocks, so a text with many matches costs little more than
its length. Only distinct tokens are shuffled, for training.

Defined cases: a null text is empty and has no spans; rows that repeat an id are judged
each by itself; null ids stay null; an empty table gives an empty result; without any random
sample the random model is uniform. Extra columns are carried along by :func:`scan`, but for ones named
``base`` or ``added``, which its own replace. Places are code points, ends exclusive. A run holds no white space,
and dots around it are not part of it. A run that ends where an assigned value ends, or that holds an
access key or hex digits that the base found, is the base's and not added again; it may hold the name before an assignment.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import checkpointed, settled, table

# The base patterns by kind, in order, and the least length of what counts.
NAMES = "password|passwd|secret|token|api_?key"
VALUE = "[A-Za-z0-9+/_.=-]+"
ASSIGN = rf"""(?i:({NAMES}))["']?\x20*[:=]\x20*["']?({VALUE})"""
ACCESS = "AKIA[A-Z0-9]{14,}"  # AKIA[A-Z0-9]+ of 18 characters or more: the longest run decides, so this is the same
HEX = "[0-9a-f]{16,}"
VALUE_LENGTH = 12
KINDS = ("assign", "access", "hex", "random")

#: Runs that the models judge: at least so many characters of a value's alphabet.
RUN_LENGTH = 16
RUN = f"[A-Za-z0-9+/_.=-]{{{RUN_LENGTH},}}"
#: Ordinary samples are runs from this length on, below ``RUN_LENGTH``.
ORDINARY_LENGTH = 4
#: Thousandths of the natural logarithm of the ratio: about a million to one.
LIMIT = 14_000
#: Characters of the alphabet and the start; the share of the random model that is uniform; additive smoothing of the ordinary one.
ALPHABET, UNIFORM, ADDED = 68, 0.5, 0.5
START = 94  # ^
#: Matches in a block when their places are added up.
BLOCK = 256


def matches(df: DataFrame, found: dict[str, tuple[str, int | None]], text: str = "text") -> DataFrame:
    """``df`` with, for each name, an array of ``start, end, value, part`` of the pattern's matches in order.

    ``found``: name -> (pattern, number of the group that ``part`` holds, or None for no part).
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    names, rest = list(found), [c for c in df.columns if c not in found]

    def behind(columns: list[str], expressions: dict[str, str | Column]) -> DataFrame:
        """One more set of columns for each name, behind a generator of one row."""
        fields = [(F.expr(e) if isinstance(e, str) else e).alias(c) for c, e in expressions.items()]
        return step.select(*columns, F.inline(F.array(F.struct(*fields))))

    step, raw = df, {}
    for n, (pattern, group) in found.items():
        hit = whole.rlike(pattern)
        raw[f"_value_{n}"] = F.when(hit, F.regexp_extract_all(whole, F.lit(pattern), F.lit(0)))
        raw[f"_part_{n}"] = F.when(hit, F.regexp_extract_all(whole, F.lit(pattern), F.lit(group))) if group else F.lit(None).cast("array<string>")
        raw[f"_gap_{n}"] = F.when(hit, F.transform(F.split(whole, pattern, -1), F.length))
    step, kept = behind(rest, raw), [*rest, *(c for c in raw if not c.startswith("_gap_"))]
    # What lies between the ends of neighbouring matches; then sums of blocks; then sums ahead of each block.
    add = "0L, (total, x) -> total + x"
    step = behind(kept, {f"_long_{n}": f"transform(_value_{n}, (v, i) -> length(v) + get(_gap_{n}, i))" for n in names})
    kept += [f"_long_{n}" for n in names]
    step = behind(kept, {
        f"_sum_{n}": f"transform(sequence(0, size(_long_{n}) div {BLOCK}), b -> aggregate(slice(_long_{n}, b * {BLOCK} + 1, {BLOCK}), {add}))" for n in names
    })
    step = behind(kept, {f"_ahead_{n}": f"transform(_sum_{n}, (x, b) -> aggregate(slice(_sum_{n}, 1, b), {add}))" for n in names})
    step = behind([c for c in kept if not c.startswith("_long_")], {
        f"_end_{n}": f"transform(_long_{n}, (x, i) -> get(_ahead_{n}, i div {BLOCK})"
        f" + aggregate(slice(_long_{n}, (i div {BLOCK}) * {BLOCK} + 1, i % {BLOCK} + 1), {add}))" for n in names
    })
    shown = [
        F.coalesce(
            F.expr(
                f"transform(_value_{n}, (v, i) -> named_struct('start', get(_end_{n}, i) - length(v), 'end', get(_end_{n}, i), 'value', v, 'part', get(_part_{n}, i)))"
            ),
            F.expr("cast(array() as array<struct<start: bigint, end: bigint, value: string, part: string>>)"),
        ).alias(n)
        for n in names
    ]
    return step.select(*rest, F.inline(F.array(F.struct(*shown))))


def base_spans(docs: DataFrame) -> DataFrame:
    """``docs`` without its text, with arrays ``assign``, ``access``, ``hex`` and ``run`` (start, end, value)."""
    found = matches(docs, {"assign": (ASSIGN, 2), "access": (ACCESS, None), "hex": (HEX, None), "run": (RUN, None)})
    good = F.expr(
        f"transform(filter(assign, m -> length(m.part) >= {VALUE_LENGTH}), m -> named_struct('start', m.start, 'end', m.end, 'value', m.part))"
    )
    plain = [F.expr(f"transform({n}, m -> named_struct('start', m.start, 'end', m.end, 'value', m.value))").alias(n) for n in ("access", "hex", "run")]
    rest = [c for c in docs.columns if c not in ("text", "assign", "access", "hex", "run")]
    return found.select(*rest, good.alias("assign"), *plain)


def corpus_samples(docs: DataFrame, spans: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Distinct tokens labelled by the base rules: ``(random, ordinary)``, both with a column ``token``."""
    random = spans.select(F.explode(F.concat("assign", "access", "hex")).alias("m")).select(_trimmed(F.col("m.value")).alias("token")).distinct()
    words = docs.select(F.explode(F.split("text", "[^A-Za-z0-9+/_.=-]+", -1)).alias("w")).select(_trimmed(F.col("w")).alias("token"))
    return random, words.filter(F.length("token").between(ORDINARY_LENGTH, RUN_LENGTH - 1)).distinct()


def _trimmed(token: Column) -> Column:
    return F.btrim(token, F.lit("."))


def _pairs(samples: DataFrame) -> DataFrame:
    """``a, b, n``: how often character b follows a, the start being one."""
    steps = F.expr(f"split(concat(chr({START}), token), '')")
    chars = samples.filter("token <> ''").select(settled(F.transform(steps, F.ascii)).alias("c"))
    both = chars.select(F.explode(F.expr("transform(sequence(1, size(c) - 1), i -> get(c, i - 1) * 128 + get(c, i))")).alias("p"))
    return both.groupBy("p").count().select((F.col("p") / 128).cast("int").alias("a"), (F.col("p") % 128).alias("b"), F.col("count").alias("n"))


def train(random: DataFrame, ordinary: DataFrame) -> list[int]:
    """The ratio of the two models for each pair of characters, in thousandths; both samples have a column ``token``."""
    counts = _pairs(random).withColumn("kind", F.lit(0)).unionByName(_pairs(ordinary).withColumn("kind", F.lit(1)))
    seen: tuple[dict, dict] = ({}, {})
    for row in counts.collect():  # at most 2 * 128 * 128
        seen[row.kind][row.a, row.b] = row.n
    from_ = tuple([sum(n for (x, _), n in s.items() if x == a) for a in range(128)] for s in seen)
    ratios = []
    for a in range(128):
        for b in range(128):
            told = seen[0].get((a, b), 0) / from_[0][a] if from_[0][a] else 1 / ALPHABET
            p = UNIFORM / ALPHABET + (1 - UNIFORM) * told
            q = (seen[1].get((a, b), 0) + ADDED) / (from_[1][a] + ADDED * ALPHABET)
            ratios.append(math.floor(1000 * math.log(p / q) + 0.5))
    return ratios


def ratio(token: Column, model: list[int]) -> Column:
    """The log-likelihood ratio of a token of ASCII characters, in thousandths."""
    numbers = F.split(F.lit(",".join(map(str, model))), ",").cast("array<int>")  # folded to one literal
    step = lambda acc, c: F.struct(
        F.ascii(c).alias("before"), (acc["total"] + F.get(numbers, acc["before"] * 128 + F.ascii(c))).alias("total")
    )
    return F.aggregate(F.split(token, ""), F.struct(F.lit(START).alias("before"), F.lit(0).cast("bigint").alias("total")), step, lambda acc: acc["total"])


def _added(model: list[int], limit: int) -> tuple[Column, Column]:
    """The runs that are not the base's, by place; those of them that the models call random."""
    # Sorted by end, an assigned value comes right before the run that ends with it.
    both = F.array_sort(
        F.concat(
            F.transform("assign", lambda m: F.struct(m["end"].alias("end"), F.lit(0).alias("is_run"), F.lit("").alias("value"))),
            F.transform("run", lambda m: F.struct(m["end"].alias("end"), F.lit(1).alias("is_run"), m["value"].alias("value"))),
        )
    )
    own = F.expr(f"filter(_both, (m, i) -> m.is_run = 1 and not coalesce(get(_both, i - 1).end = m.end, false) and not m.value rlike '{ACCESS}|{HEX}')")
    own = F.transform(
        own,
        lambda m: F.struct(
            (m["end"] - F.length(F.ltrim(m["value"], F.lit(".")))).alias("start"),
            (m["end"] - F.length(m["value"]) + F.length(F.rtrim(m["value"], F.lit(".")))).alias("end"),
            _trimmed(m["value"]).alias("value"),
        ),
    )
    return both, F.filter(own, lambda m: (F.length(m["value"]) >= RUN_LENGTH) & (ratio(m["value"], model) >= limit))


def scan(docs: DataFrame, model: list[int] | None = None, limit: int = LIMIT) -> DataFrame:
    """``docs`` without its text, with ``base`` and ``added``: arrays of ``start, kind, end`` by place.

    ``kind`` is the place in ``KINDS``. Without a model, one is trained on ``docs`` itself.
    """
    rest = [c for c in docs.columns if c not in ("text", "base", "added")]
    # Only what has spans or runs is kept of a text, so this is small.
    spans = checkpointed(base_spans(docs.select(*[F.col(c).alias(f"c_{n}") for n, c in enumerate(rest)], "text")))
    if model is None:
        model = train(*corpus_samples(docs, spans))
    both, added = _added(model, limit)
    found = spans.withColumn("_both", settled(both)).withColumn("_added", settled(added))
    kind = lambda k: lambda m: F.struct(m["start"].alias("start"), F.lit(k).alias("kind"), m["end"].alias("end"))
    base = F.array_sort(F.concat(*[F.transform(n, kind(k)) for k, n in enumerate(KINDS[:3])]))
    return found.select(*[F.col(f"c_{n}").alias(c) for n, c in enumerate(rest)], base.alias("base"), F.transform("_added", kind(3)).alias("added"))


def shown(spans: Column) -> Column:
    """``kind:start:end`` joined by commas."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda m: F.concat_ws(":", F.get(names, m["kind"]), m["start"], m["end"])), ",")


def op11_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    count = lambda k: F.size(F.filter("base", lambda m: m["kind"] == k)).cast("bigint")
    return found.select(
        "doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
        F.sha2(shown(F.col("base")), 256).alias("base_sha256"), shown(F.array_sort(F.concat("base", "added"))).alias("spans"),
    )


def _oracle() -> str:
    """The same rules and models in another way: every match is a row, places are window sums."""
    anycase = "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in NAMES)
    patterns = {
        "assign": rf"""({anycase})["']?\x20*[:=]\x20*["']?({VALUE})""",
        "access": "AKIA[A-Z0-9]+",
        "hex": "[0-9a-f]+",
        "run": VALUE,
    }
    q = lambda s: "'" + s.replace("'", "''") + "'"
    parts = "".join(
        f"""
g{k} AS (SELECT doc_id, unnest(string_split_regex(text, {q(p)})) AS gap, generate_subscripts(string_split_regex(text, {q(p)}), 1) AS i FROM t),
v{k} AS (SELECT doc_id, unnest(regexp_extract_all(text, {q(p)})) AS v, unnest(regexp_extract_all(text, {q(p)}, {2 if k == 0 else 0})) AS part,
       generate_subscripts(regexp_extract_all(text, {q(p)}), 1) AS i FROM t),
m{k} AS (SELECT doc_id, {k} AS kind, v, part, sum(length(gap) + length(v)) OVER (PARTITION BY doc_id ORDER BY i) AS stop FROM g{k} JOIN v{k} USING (doc_id, i)),"""
        for k, p in enumerate(patterns.values())
    )
    return rf"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),{parts}
base AS (SELECT doc_id, kind, stop - length(v) AS start, stop, part FROM m0 WHERE length(part) >= {VALUE_LENGTH}
  UNION ALL SELECT doc_id, kind, stop - length(v), stop, v FROM m1 WHERE length(v) >= 18
  UNION ALL SELECT doc_id, kind, stop - length(v), stop, v FROM m2 WHERE length(v) >= 16),
samples AS (SELECT DISTINCT 0 AS label, trim(part, '.') AS w FROM base
  UNION ALL SELECT DISTINCT 1, trim(v, '.') FROM m3 WHERE length(trim(v, '.')) BETWEEN {ORDINARY_LENGTH} AND {RUN_LENGTH - 1}),
pairs AS (SELECT label, p[1] AS a, p[2] AS b, count(*) AS n FROM (
    SELECT label, substr('^' || w, r.i, 2) AS p FROM samples, range(1, 2000000) r(i) WHERE r.i <= length(w) AND w <> '') GROUP BY ALL),
froms AS (SELECT label, a, sum(n) AS n FROM pairs GROUP BY ALL),
runs AS (SELECT doc_id, stop, v, trim(v, '.') AS w FROM m3 r WHERE length(v) >= {RUN_LENGTH}
  AND NOT EXISTS (SELECT 1 FROM base b WHERE b.doc_id = r.doc_id AND b.kind = 0 AND b.stop = r.stop)
  AND NOT regexp_matches(v, '{ACCESS}|{HEX}') AND length(trim(v, '.')) >= {RUN_LENGTH}),
words AS (SELECT DISTINCT w FROM runs),
steps AS (SELECT w, substr('^' || w, r.i, 1) AS a, substr(w, r.i, 1) AS b FROM words, range(1, 2000000) r(i) WHERE r.i <= length(w)),
judged AS (SELECT w, sum(floor(1000 * ln(({UNIFORM} / {ALPHABET} + {1 - UNIFORM} * CASE WHEN f0.n IS NULL THEN 1.0::DOUBLE / {ALPHABET}
      ELSE coalesce(p0.n, 0)::DOUBLE / f0.n END) / ((coalesce(p1.n, 0) + {ADDED}) / (coalesce(f1.n, 0) + {ADDED * ALPHABET})::DOUBLE)) + 0.5)) AS score
  FROM steps s LEFT JOIN froms f0 ON f0.label = 0 AND f0.a = s.a LEFT JOIN froms f1 ON f1.label = 1 AND f1.a = s.a
  LEFT JOIN pairs p0 ON p0.label = 0 AND p0.a = s.a AND p0.b = s.b LEFT JOIN pairs p1 ON p1.label = 1 AND p1.a = s.a AND p1.b = s.b GROUP BY w),
spans AS (SELECT doc_id, kind, start, stop FROM base
  UNION ALL SELECT doc_id, 3, stop - length(v) + length(v) - length(ltrim(v, '.')), stop - length(v) + length(rtrim(v, '.'))
  FROM runs JOIN judged USING (w) WHERE score >= {LIMIT}),
named AS (SELECT *, CASE kind WHEN 0 THEN 'assign' WHEN 1 THEN 'access' WHEN 2 THEN 'hex' ELSE 'random' END || ':' || start::BIGINT || ':' || stop::BIGINT AS span FROM spans),
told AS (SELECT doc_id, count(*) FILTER (WHERE kind = 0) AS n_assign, count(*) FILTER (WHERE kind = 1) AS n_access, count(*) FILTER (WHERE kind = 2) AS n_hex,
    coalesce(string_agg(span, ',' ORDER BY start, kind) FILTER (WHERE kind < 3), '') AS base, string_agg(span, ',' ORDER BY start, kind) AS spans FROM named GROUP BY doc_id)
SELECT t.doc_id, coalesce(n_assign, 0)::BIGINT AS n_assign, coalesce(n_access, 0)::BIGINT AS n_access, coalesce(n_hex, 0)::BIGINT AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM t LEFT JOIN told USING (doc_id)
"""


QUERIES = {"op11_secret_scan": op11_secret_scan}
ORACLES = {"op11_secret_scan": _oracle()}
