"""Quality rules with adaptive thresholds, in DataFrame functions only.

Every document is measured once. For each metric, language and source, a mergeable quantile sketch is kept: counts of
values rounded down to six significant bits (so a quantile is exact up to 1/32 of itself), which merge by adding up,
in any order and with the same result. Sketches of sources merge into those of languages, and these into one of all;
a group with few documents uses the next wider one. Fences from the sketches are joined to the documents by language
and source, in two steps:

* Quartiles don't move if a quarter of a group is junk. Their fences (Tukey) lie several spreads between quartiles
  away, and at least a wide slack, since the usual document of a group may show nothing of a metric: gross outliers.
* What is left is sketched again, and its first, 50th and 99th percentiles give the fences that decide: the outer
  percentile, as far again as it is from the median, and the sketch's resolution. No fixed share enters here; in a
  source where repetition is unknown, a document with some of it goes, and it stays where it is usual. Shares of short
  documents are coarse, so that a few occurrences (``OCCURRENCES``) prove nothing.

Documents that fail the base rules (too few words, or too many of them in repeated windows) don't enter the sketches.

Defined cases: a null or empty text has no words and fails the base rules; null languages and sources are groups of
their own; repeated rows are each judged; a table without a document that passes the base rules gets no fences, and
all of its documents fail; an empty table gives an empty result; columns other than the four named are ignored.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quayside.llm.common import cut, table
from quayside.llm.registry import register

SPACE = r"[\x20\x09-\x0D]+"
#: Words of a window; fewest words; share of words in repeated windows (percent).
WINDOW, LEAST_WORDS, MOST_REPEATED = 5, 10, 20
#: Documents that a group needs for its own fences, and the spreads between quartile and fence.
LEAST_GROUP, SPREADS = 100, 3
#: Metrics in thousandths, with the slack of the first fence above; the word length also has fences below, and for it a
#: document of n words has LENGTH_SLACK / sqrt(n) more.
METRICS = {"symbols": 300, "upper": 200, "dup_lines": 400, "repeated": 200, "word_length": 1000}
LENGTH_SLACK = 12_000
#: The second fences: documents that a group needs, distances from median to percentile added to the percentile, and
#: the occurrences that a document has free (a window found twice covers ten words).
LEAST_TAIL, TAIL_SPREADS = 200, 1
OCCURRENCES = {"symbols": 3, "upper": 10, "dup_lines": 2, "repeated": 10}
#: What each share is made of: the count, and what it is a share of.
SHARES = {"symbols": ("n_symbols", "n_words"), "upper": ("n_upper", "word_chars"), "dup_lines": ("n_dup_lines", "n_lines"),
          "repeated": ("n_repeat_words", "n_words")}
#: Percentiles by the names that their columns end in.
QUARTILES, TAILS = {"1": 25, "2": 50, "3": 75}, {"_low": 1, "_mid": 50, "_high": 99}


def repeated_words(words: Column) -> list[tuple[str, Column]]:
    """Steps (name, expression over the steps before) that end in ``n_repeat_words``.

    Windows are compared as strings (words hold no space, so joining is unique). Where all are distinct, that is the
    end; else they are sorted with their places, equal neighbours give the places of repeated windows, and what these
    cover is summed up from place to place.
    """
    k = WINDOW
    grams = F.when(F.size(words) > k, F.transform(F.sequence(F.lit(1), F.size(words) - F.lit(k - 1)),
                                                  lambda i: F.array_join(F.slice(words, i, k), " ")))
    placed = F.when(F.expr("size(array_distinct(grams)) < size(grams)"),
                    F.array_sort(F.transform("grams", lambda g, i: F.struct(g.alias("g"), i.alias("i")))))
    places = F.expr("transform(filter(placed, (x, j) -> (j > 0 AND x.g = placed[greatest(j - 1, 0)].g) OR "
                    "(j < size(placed) - 1 AND x.g = placed[least(j + 1, size(placed) - 1)].g)), x -> x.i)")
    covered = F.expr(f"aggregate(array_sort(places), named_struct('n', 0, 'last', {-k}), (a, p) -> named_struct("
                     f"'n', a.n + least({k}, p - a.last), 'last', p), a -> a.n)")
    return [("grams", grams), ("placed", placed), ("places", places),
            ("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long"))]


def measure(docs: DataFrame) -> DataFrame:
    """doc_id, lang, source and the counts of each document."""
    gone = lambda chars: F.char_length("text") - F.char_length(F.translate("text", chars, ""))
    d = docs.select("doc_id", "lang", "source", F.coalesce("text", F.lit("")).alias("text"))
    d = d.select("*", F.filter(F.split("text", SPACE), lambda w: w != "").alias("words"),
                 F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("lines"))
    for name, step in repeated_words(F.col("words")):
        d = d.withColumn(name, step)
    return d.select(
        "doc_id", "lang", "source", F.size("words").cast("long").alias("n_words"),
        (F.char_length("text") - gone(" \t\n\x0b\x0c\r")).cast("long").alias("word_chars"),
        gone("#*$%&|<>").cast("long").alias("n_symbols"), gone("ABCDEFGHIJKLMNOPQRSTUVWXYZ").cast("long").alias("n_upper"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"), "n_repeat_words",
    ).withColumn("base_failed", F.expr(f"n_words < {LEAST_WORDS} OR 100 * n_repeat_words > {MOST_REPEATED} * n_words"))


def with_metrics(measured: DataFrame) -> DataFrame:
    """The counts with the metrics in thousandths; null where a document has no words."""
    some = lambda e: F.expr(f"IF(n_words > 0, {e}, NULL)")
    return measured.withColumns({
        "symbols": some("1000 * n_symbols DIV n_words"), "upper": some("1000 * n_upper DIV word_chars"),
        "dup_lines": some("1000 * n_dup_lines DIV n_lines"), "repeated": some("1000 * n_repeat_words DIV n_words"),
        "word_length": some("1000 * word_chars DIV n_words")})


def sketch(metrics: DataFrame) -> DataFrame:
    """Sketches of all metrics by language and source: lang, source, metric, value (rounded down), n."""
    pairs = ", ".join(f"'{m}', {m}" for m in METRICS)
    rounded = F.expr("IF(value < 64, value, shiftleft(shiftright(value, length(bin(value)) - 6), length(bin(value)) - 6))")
    return (metrics.selectExpr("lang", "source", f"stack({len(METRICS)}, {pairs}) AS (metric, value)")
            .where("value IS NOT NULL").groupBy("lang", "source", "metric", rounded.alias("value"))
            .agg(F.count(F.lit(1)).alias("n")))


def percentiles(sketches: DataFrame, keys: list[str], prefix: str, points: dict[str, int] = QUARTILES) -> DataFrame:
    """Sketches merged by ``keys``, as one row each: keys, ``prefix``n, and the named percentiles of every metric."""
    merged = sketches.groupBy(*keys, "metric", "value").agg(F.sum("n").alias("n"))
    group = Window.partitionBy(*keys, "metric")
    ranked = (merged.withColumn("upto", F.sum("n").over(group.orderBy("value")))
              .withColumn("all", F.sum("n").over(group)))
    least = lambda m, p: F.min(F.expr(f"IF(metric = '{m}' AND 100 * upto >= {p} * all, value, NULL)"))
    return ranked.groupBy(*keys).agg(
        F.max("all").alias(f"{prefix}n"),
        *[least(m, p).alias(f"{prefix}{m}{k}") for m in METRICS for k, p in points.items()])


def group_percentiles(metrics: DataFrame, of: DataFrame, points: dict[str, int], least: int) -> DataFrame:
    """For each language and source of ``metrics``, the percentiles among ``of`` that apply to it: lang, source, and
    one column a metric and point. A group of fewer than ``least`` documents takes those of its language, or of all."""
    s = cut(sketch(of))
    groups = metrics.select("lang", "source").distinct()
    own, by_lang = percentiles(s, ["lang", "source"], "s_", points), percentiles(s, ["lang"], "l_", points)
    everything = percentiles(s, [], "a_", points).first().asDict()  # one row
    g = (groups.alias("g").join(own.alias("o"), F.col("g.lang").eqNullSafe(F.col("o.lang"))
                                & F.col("g.source").eqNullSafe(F.col("o.source")), "left")
         .join(by_lang.alias("l"), F.col("g.lang").eqNullSafe(F.col("l.lang")), "left"))
    pick = lambda c: (F.when(F.col("s_n") >= least, F.col(f"s_{c}")).when(F.col("l_n") >= least, F.col(f"l_{c}"))
                      .otherwise(F.lit(everything[f"a_{c}"]).cast("long")))
    return g.select("g.lang", "g.source", *[pick(f"{m}{k}").alias(f"{m}{k}") for m in METRICS for k in points])


def gross_rule() -> str:
    """SQL condition on metrics and quartiles: nothing far beyond the quartiles."""
    above = [f"{x} <= {x}3 + greatest({SPREADS} * ({x}3 - {x}1), {slack})" for x, slack in METRICS.items() if x != "word_length"]
    length = (f"abs(word_length - word_length2) <= greatest({SPREADS} * (word_length3 - word_length1), "
              f"{METRICS['word_length']}) + {LENGTH_SLACK} / sqrt(n_words)")
    return " AND ".join([*above, length])


def tail_rule() -> str:
    """SQL condition on counts, metrics and outer percentiles: nothing beyond what these and their spread allow.

    A value of the sketch stands for those up to 1/32 and 1 above it.
    """
    high = lambda x: f"({x}_high + {TAIL_SPREADS} * ({x}_high - {x}_mid) + shiftright({x}_high, 5) + 1)"
    above = [f"1000 * {count} <= {of} * {high(x)} + {1000 * OCCURRENCES[x]}" for x, (count, of) in SHARES.items()]
    free = f"{LENGTH_SLACK} / sqrt(greatest(n_words, 1))"
    return " AND ".join([*above, f"word_length <= {high('word_length')} + {free}",
                         f"word_length >= word_length_low - {TAIL_SPREADS} * (word_length_mid - word_length_low) - {free}"])


def with_verdict(metrics: DataFrame, fences: DataFrame, rule: str, out_col: str) -> DataFrame:
    """``metrics`` with the verdict of ``rule`` on them and the fences of their group; false where it has none."""
    j = metrics.alias("m").join(fences.alias("f"), F.col("m.lang").eqNullSafe(F.col("f.lang"))
                                & F.col("m.source").eqNullSafe(F.col("f.source")), "left")
    return j.select("m.*", F.coalesce(F.expr(rule), F.lit(False)).alias(out_col))


def judge(docs: DataFrame) -> DataFrame:
    """The counts and metrics of each document with its verdict: base_failed, usual (no gross outlier), and kept."""
    m = cut(with_metrics(measure(docs)))
    quarters = group_percentiles(m, m.where("NOT base_failed"), QUARTILES, LEAST_GROUP)
    m = cut(with_verdict(m, quarters, f"NOT base_failed AND {gross_rule()}", "usual"))
    tails = group_percentiles(m, m.where("usual"), TAILS, LEAST_TAIL)
    return with_verdict(m, tails, f"usual AND {tail_rule()}", "kept")


_METRIC_SQL = """unnest([{'metric': 'symbols', 'value': 1000 * n_symbols // n_words}, {'metric': 'upper', 'value': 1000 * n_upper // word_chars},
    {'metric': 'dup_lines', 'value': 1000 * n_dup_lines // n_lines}, {'metric': 'repeated', 'value': 1000 * n_repeat_words // n_words},
    {'metric': 'word_length', 'value': 1000 * word_chars // n_words}])"""
_ROUNDED_SQL = """CASE WHEN m.value < 64 THEN m.value ELSE (m.value >> (length(bin(m.value)) - 6)) << (length(bin(m.value)) - 6) END"""


def _free_sql() -> str:
    """What a document has free in the unit of its count."""
    return "CASE m.metric " + " ".join(f"WHEN '{x}' THEN {n}" for x, n in OCCURRENCES.items()) + " END"


ORACLE = f"""
WITH w AS (
  SELECT doc_id, lang, source, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines
  FROM documents
), g AS (
  SELECT doc_id, i, array_to_string(words[i : i + 4], ' ') AS gram
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 3)) AS i FROM w WHERE len(words) >= 5)
), r AS (
  SELECT doc_id, i FROM g QUALIFY count(*) OVER (PARTITION BY doc_id, gram) > 1
), p AS (
  SELECT DISTINCT doc_id, i + k AS place FROM r, (VALUES (0), (1), (2), (3), (4)) AS v(k)
), n AS (
  SELECT doc_id, count(*) AS n FROM p GROUP BY doc_id
), c AS (
  SELECT w.doc_id, lang, source, len(words)::BIGINT AS n_words, length(array_to_string(words, ''))::BIGINT AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
         length(regexp_replace(text, '[^A-Z]', '', 'g'))::BIGINT AS n_upper, len(lines)::BIGINT AS n_lines,
         (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(n.n, 0)::BIGINT AS n_repeat_words
  FROM w LEFT JOIN n ON w.doc_id = n.doc_id
), b AS (
  SELECT *, n_words < {LEAST_WORDS} OR 100 * n_repeat_words > {MOST_REPEATED} * n_words AS base_failed FROM c
), x AS (
  SELECT lang, source, m.metric AS metric, {_ROUNDED_SQL} AS value
  FROM (SELECT lang, source, {_METRIC_SQL} AS m FROM b WHERE NOT base_failed)
), q AS (
  SELECT GROUPING(lang, source) AS lvl, lang, source, metric, count(*) AS n, quantile_disc(value, 0.25) AS q1,
         quantile_disc(value, 0.5) AS q2, quantile_disc(value, 0.75) AS q3
  FROM x GROUP BY GROUPING SETS ((lang, source, metric), (lang, metric), (metric))
), m AS (
  SELECT b.*, unnest(['symbols', 'upper', 'dup_lines', 'repeated', 'word_length']) AS metric,
         unnest([1000 * n_symbols // n_words, 1000 * n_upper // word_chars, 1000 * n_dup_lines // n_lines,
                 1000 * n_repeat_words // n_words, 1000 * word_chars // n_words]) AS value,
         unnest([n_symbols, n_upper, n_dup_lines, n_repeat_words, NULL]) AS count,
         unnest([n_words, word_chars, n_lines, n_words, NULL]) AS share_of
  FROM b WHERE NOT base_failed
), j AS (
  SELECT m.doc_id, bool_and(CASE WHEN m.metric = 'word_length'
      THEN abs(m.value - f.q2) <= greatest({SPREADS} * (f.q3 - f.q1), {METRICS['word_length']}) + {LENGTH_SLACK} / sqrt(m.n_words)
      ELSE m.value <= f.q3 + greatest({SPREADS} * (f.q3 - f.q1),
           CASE m.metric WHEN 'symbols' THEN {METRICS['symbols']} WHEN 'upper' THEN {METRICS['upper']}
                         WHEN 'dup_lines' THEN {METRICS['dup_lines']} ELSE {METRICS['repeated']} END) END) AS good
  FROM m LEFT JOIN q s ON s.lvl = 0 AND s.metric = m.metric AND s.lang IS NOT DISTINCT FROM m.lang AND s.source IS NOT DISTINCT FROM m.source
         LEFT JOIN q l ON l.lvl = 1 AND l.metric = m.metric AND l.lang IS NOT DISTINCT FROM m.lang
         LEFT JOIN q a ON a.lvl = 3 AND a.metric = m.metric,
       LATERAL (SELECT CASE WHEN s.n >= {LEAST_GROUP} THEN s.q1 WHEN l.n >= {LEAST_GROUP} THEN l.q1 ELSE a.q1 END AS q1,
                       CASE WHEN s.n >= {LEAST_GROUP} THEN s.q2 WHEN l.n >= {LEAST_GROUP} THEN l.q2 ELSE a.q2 END AS q2,
                       CASE WHEN s.n >= {LEAST_GROUP} THEN s.q3 WHEN l.n >= {LEAST_GROUP} THEN l.q3 ELSE a.q3 END AS q3) AS f
  GROUP BY m.doc_id
), u AS (
  SELECT b.* FROM b JOIN j ON b.doc_id = j.doc_id WHERE j.good
), y AS (
  SELECT lang, source, m.metric AS metric, {_ROUNDED_SQL} AS value
  FROM (SELECT lang, source, {_METRIC_SQL} AS m FROM u)
), z AS (
  SELECT GROUPING(lang, source) AS lvl, lang, source, metric, value, count(*) AS n
  FROM y GROUP BY GROUPING SETS ((lang, source, metric, value), (lang, metric, value), (metric, value))
), z2 AS (
  SELECT *, sum(n) OVER (PARTITION BY lvl, lang, source, metric ORDER BY value) AS upto, sum(n) OVER (PARTITION BY lvl, lang, source, metric) AS total FROM z
), t AS (
  SELECT lvl, lang, source, metric, max(total) AS n, min(value) FILTER (WHERE 100 * upto >= total) AS low,
         min(value) FILTER (WHERE 2 * upto >= total) AS mid, min(value) FILTER (WHERE 100 * upto >= 99 * total) AS high
  FROM z2 GROUP BY lvl, lang, source, metric
), v AS (
  SELECT m.doc_id, bool_and(CASE WHEN m.metric = 'word_length'
      THEN m.value <= f.high + {TAIL_SPREADS} * (f.high - f.mid) + (f.high >> 5) + 1 + {LENGTH_SLACK} / sqrt(m.n_words)
           AND m.value >= f.low - {TAIL_SPREADS} * (f.mid - f.low) - {LENGTH_SLACK} / sqrt(m.n_words)
      ELSE 1000 * m.count <= m.share_of * (f.high + {TAIL_SPREADS} * (f.high - f.mid) + (f.high >> 5) + 1) + 1000 * {_free_sql()} END) AS good
  FROM m SEMI JOIN u ON m.doc_id = u.doc_id
         LEFT JOIN t s ON s.lvl = 0 AND s.metric = m.metric AND s.lang IS NOT DISTINCT FROM m.lang AND s.source IS NOT DISTINCT FROM m.source
         LEFT JOIN t l ON l.lvl = 1 AND l.metric = m.metric AND l.lang IS NOT DISTINCT FROM m.lang
         LEFT JOIN t a ON a.lvl = 3 AND a.metric = m.metric,
       LATERAL (SELECT CASE WHEN s.n >= {LEAST_TAIL} THEN s.low WHEN l.n >= {LEAST_TAIL} THEN l.low ELSE a.low END AS low,
                       CASE WHEN s.n >= {LEAST_TAIL} THEN s.mid WHEN l.n >= {LEAST_TAIL} THEN l.mid ELSE a.mid END AS mid,
                       CASE WHEN s.n >= {LEAST_TAIL} THEN s.high WHEN l.n >= {LEAST_TAIL} THEN l.high ELSE a.high END AS high) AS f
  GROUP BY m.doc_id
)
SELECT b.doc_id, b.n_words, b.word_chars, b.n_symbols, b.n_dup_lines, b.n_repeat_words, b.base_failed,
       coalesce(v.good, FALSE) AS kept
FROM b LEFT JOIN v ON b.doc_id = v.doc_id
"""


@register("op3_quality_rules", ORACLE)
def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdict of every document."""
    return judge(table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "text")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
