"""Information-theoretic sanitisation of personal data, in DataFrame functions only.

Protected entities are the values of four kinds of personal data (email, ip, card, phone), found by pattern in whole
texts and compared without case and separators, and two classes of them: the domains of emails and the networks (first
two parts) of ips. Terms can give an entity away without naming it: over the whole corpus, a term t (a run of letters
and digits) that occurs in documents with an entity c discloses, of the information that naming c would give,

    PMI(c; t) / IC(c) = log(N * n(c, t) / (n(c) * n(t))) / log(N / n(c)),

with documents counted over their whole texts: N all, n(c) and n(t) those with c and with t, n(c, t) those with both.
Terms are sanitised wherever they occur if they disclose at least ``DISCLOSURE`` of an entity, and if this is no chance:
in at least ``LEAST_TEXTS`` different texts (copies of one text prove nothing), and in so many that the information
these give, texts * IC(c), exceeds log(V * S / ``CHANCE``), as V terms are tried with S entities. They are removed if they
never occur without the entity (all of the information), else generalised to a placeholder, as entities are
generalised to their kind. What the four patterns match is no term.

Entities that are in the same texts disclose the same, and are one. Terms are held against entities only where their
own count still allows the threshold, which the common ones don't.

Term counts are aggregated before they are shuffled. What is broadcast is counted first, rows and bytes
(``BROADCAST_ROWS``, ``BROADCAST_BYTES``), and joined by a shuffle beyond that. Places in texts are sums of lengths by blocks
of ``BLOCK`` matches or words, so that very long texts with many of them cost little more than their share.

Defined cases: a null text counts as empty; rows with a null doc_id are kept; repeated rows count as often as they occur
and get the same spans; spans of one kind never overlap, a term inside an entity is left to it; an entity that is in
every document discloses nothing; an empty table gives an empty result; other columns are ignored.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.llm.common import cut, table
from quayside.llm.registry import register

#: Patterns by kind, in the order of results. Possessive and anchored forms of the patterns in ``SQL_PATTERNS``: they
#: match the same, without trying every start within a run again, and without recursion.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
SQL_PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: What a text must contain for a kind to be looked for.
HINTS = {"email": "@", "ip": "[0-9][.][0-9]", "card": r"[0-9][\x20-]?[0-9]", "phone": "[+][0-9]"}
_BYTE = r"0*(25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
_IP = rf"^{_BYTE}[.]{_BYTE}[.]{_BYTE}[.]{_BYTE}$"
TERM = r"[\p{L}\p{N}]{3,}"
#: Digits that are long enough for a card: what terms leave out of that kind's pattern.
CARD_LONG, CARD_LONG_SQL = r"[0-9](?:[\x20-]?[0-9]){15,}+", r"[0-9](?:[\x20-]?[0-9]){15,}"
#: Different texts, share of the information, and chance of any term being sanitised wrongly, to act on.
LEAST_TEXTS, DISCLOSURE, CHANCE = 3, 0.95, 0.01
BROADCAST_ROWS, BROADCAST_BYTES, BLOCK = 100_000, 16 << 20, 128
_SPANS = "array<struct<kind:string,start:int,end:int,value:string>>"


def _passes(kind: str) -> str:
    """SQL condition on a match ``x.value``."""
    digits = "regexp_replace(x.value, '[^0-9]', '')"
    return {"email": "true", "ip": f"x.value RLIKE r'{_IP}'",
            "card": f"length({digits}) BETWEEN 16 AND 19 AND luhn_check({digits})",
            "phone": f"length({digits}) BETWEEN 8 AND 15"}[kind]


def _let(name: str, value: str, of: str) -> str:
    """SQL ``of`` with ``name`` for a value that is computed once."""
    return f"transform(array({value}), {name} -> {of})[0]"


def _sum(lengths: str) -> str:
    return f"aggregate({lengths}, 0, (a, n) -> a + n)"


def _block_starts(lengths: str) -> str:
    """SQL: the sum of the lengths before each block of ``BLOCK`` of them."""
    sums = f"transform(sequence(0, size({lengths}) DIV {BLOCK}), j -> {_sum(f'slice({lengths}, int(j) * {BLOCK} + 1, {BLOCK})')})"
    return _let("sums", sums, f"transform(sums, (s, j) -> {_sum('slice(sums, 1, j)')})")


def _before(lengths: str, starts: str, i: str) -> str:
    """SQL: the sum of the first ``i`` lengths."""
    return f"({starts}[{i} DIV {BLOCK}] + {_sum(f'slice({lengths}, int({i} DIV {BLOCK}) * {BLOCK} + 1, {i} % {BLOCK})')})"


def entity_spans(kind: str) -> Column:
    """The spans of one kind in column ``text``: matches that pass, with starts and exclusive ends in code points.

    Splitting at the matches gives what is between them, so lengths of both, summed up, give the places.
    """
    p = PATTERNS[kind]
    parts = (f"zip_with(regexp_extract_all(text, r'{p}', 0), split(text, r'{p}', -1), (m, b) -> "
             "named_struct('m', m, 'b', char_length(b), 'n', char_length(b) + coalesce(char_length(m), 0)))")
    span = f"named_struct('kind', '{kind}', 'start', at + x.b, 'end', at + x.n, 'value', x.m)"
    spans = f"transform(parts, (x, i) -> {_let('at', _before('lengths', 'starts', 'i'), span)})"
    found = _let("parts", parts, _let("lengths", "transform(parts, x -> x.n)", _let("starts", _block_starts("lengths"), spans)))
    found = f"filter({found}, x -> x.value IS NOT NULL AND {_passes(kind)})"
    hint = f"contains(text, '{HINTS[kind]}')" if len(HINTS[kind]) == 1 else f"text RLIKE r'{HINTS[kind]}'"
    return F.expr(f"CASE WHEN {hint} THEN {found} ELSE CAST(array() AS {_SPANS}) END")


def own_terms() -> Column:
    """The distinct terms of column ``text``, outside what the patterns match.

    Matches become line ends, which no pattern takes, so that they join nothing to a new match.
    """
    text = "text"
    for kind in ("email", "ip", "phone", "card"):
        hint = f"contains(text, '{HINTS[kind]}')" if len(HINTS[kind]) == 1 else f"text RLIKE r'{HINTS[kind]}'"
        pattern = CARD_LONG if kind == "card" else PATTERNS[kind]
        text = f"transform({text if text != 'text' else 'array(text)'}, x -> IF({hint}, regexp_replace(x, r'{pattern}', '\n'), x))"
    return F.expr(f"array_distinct(transform(regexp_extract_all({text}[0], r'{TERM}', 0), t -> lower(t)))")


def entity_names() -> Column:
    """The distinct (kind, value) that column ``entities`` stands for: values without case and separators, and classes."""
    name = lambda kind, value: f"named_struct('kind', {kind}, 'value', {value})"
    email = f"array({name(chr(39) + 'email' + chr(39), 'lower(e.value)')}, {name(chr(39) + 'domain' + chr(39), 'lower(substring_index(e.value, chr(64), -1))')})"
    ip = f"array({name(chr(39) + 'ip' + chr(39), 'e.value')}, {name(chr(39) + 'network' + chr(39), 'substring_index(e.value, chr(46), 2)')})"
    digits = f"array({name('e.kind', 'regexp_replace(e.value, r' + chr(39) + '[^0-9]' + chr(39) + ', ' + chr(39) * 2 + ')')})"
    return F.expr(f"array_distinct(flatten(transform(entities, e -> CASE e.kind WHEN 'email' THEN {email} WHEN 'ip' THEN {ip} ELSE {digits} END)))")


def find_entities(docs: DataFrame) -> DataFrame:
    """doc_id, h (hash of the text), entities (spans by kind, then start), and own (terms) of rows with entities."""
    d = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    d = d.withColumn("entities", F.concat(*[entity_spans(k) for k in PATTERNS]))
    return d.select("doc_id", F.xxhash64("text").alias("h"), "entities",
                    F.when(F.expr("size(entities) > 0"), own_terms()).alias("own"))


def entity_sets(found: DataFrame, least_texts: int) -> DataFrame:
    """Entities in enough different texts, those in the same texts as one: h, copies (rows of that text), own, and sets,
    an array of (s1, s2: two hashes of the set's texts; n_c: rows with it). Texts without any are left out."""
    one = cut(found.where("size(entities) > 0").groupBy("h")
              .agg(F.count(F.lit(1)).alias("copies"), F.any_value("entities").alias("entities"), F.any_value("own").alias("own")))
    named = one.select("h", "copies", F.explode(entity_names()).alias("e")).select("h", "copies", "e.kind", "e.value")
    often = cut(named.groupBy("kind", "value")
                .agg(F.sum("copies").alias("n_c"), F.count(F.lit(1)).alias("texts"),
                     F.bit_xor(F.xxhash64("h", F.lit(1))).alias("s1"), F.bit_xor(F.xxhash64("h", F.lit(2))).alias("s2"))
                .where(F.col("texts") >= least_texts).drop("texts"))
    sets = (named.drop("copies").join(_small(often), ["kind", "value"])
            .groupBy("h").agg(F.collect_set(F.struct("s1", "s2", "n_c")).alias("sets")))
    return one.select("h", "copies", "own").join(sets, "h")


def disclosing_terms(docs: DataFrame, found: DataFrame, least_texts: int = LEAST_TEXTS,
                     disclosure: float = DISCLOSURE) -> DataFrame:
    """Terms to sanitise: term, disclosure (the largest of any entity) and removed (never without the entity).

    ``found`` is as of ``find_entities``. Counts of terms cover all documents.
    """
    n = found.count()
    held = cut(entity_sets(found, least_texts))
    sets = held.select(F.explode("sets").alias("s")).select("s.*").distinct().where(F.col("n_c") < n)
    s, most = sets.agg(F.count(F.lit(1)), F.max("n_c")).first()
    tried = cut(held.select("copies", F.explode("own").alias("term")).groupBy("term")
                .agg(F.count(F.lit(1)).alias("texts")).where(F.col("texts") >= least_texts).select("term"))
    v = tried.count()
    if not s or not v:
        return tried.select("term", F.lit(0.0).alias("disclosure"), F.lit(False).alias("removed"))
    # n(c, t) is at most n(c), so that a term of more documents than this can't reach the threshold
    allows = lambda n_c: f"n_t <= {1 + 1e-9} * pow({n}.0D, {1 - disclosure}D) * pow({n_c}, {disclosure}D)"
    texts = docs.select(F.coalesce("text", F.lit("")).alias("text"))
    terms = cut(texts.select(F.explode(own_terms()).alias("term")).join(_small(tried), "term", "left_semi")
                .groupBy("term").agg(F.count(F.lit(1)).alias("n_t")).where(allows(f"{most}.0D")))
    pairs = (held.select("h", "copies", "sets", F.explode("own").alias("term")).join(_small(terms), "term")
             .select("h", "copies", "term", "n_t", F.explode(F.expr(f"filter(sets, s -> s.n_c < {n} AND {allows('s.n_c')})")).alias("s"))
             .groupBy("s", "term", "n_t").agg(F.sum("copies").alias("n_ct"), F.count(F.lit(1)).alias("texts"))
             .where(F.col("texts") >= least_texts).select("s.n_c", "term", "n_t", "n_ct", "texts"))
    scored = (pairs.withColumn("disclosure", F.expr(f"ln({n}.0D * n_ct / (n_c * n_t)) / ln({n}.0D / n_c)"))
              .where(F.expr(f"texts * ln({n}.0D / n_c) >= ln({v}.0D * {s} / {CHANCE}D)")))
    return (scored.where(F.col("disclosure") >= disclosure).groupBy("term")
            .agg(F.max("disclosure").alias("disclosure"), F.max(F.expr("n_ct >= n_t")).alias("removed")))


def _small(df: DataFrame) -> DataFrame:
    """``df`` (as computed by ``cut``) for a broadcast, if its rows and bytes are bounded; else as it is, for a shuffle."""
    size = sum((F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) for c in df.columns), F.lit(0))
    rows, size = df.agg(F.count(F.lit(1)), F.coalesce(F.sum(size), F.lit(0))).first()
    return F.broadcast(df) if rows <= BROADCAST_ROWS and size <= BROADCAST_BYTES else df


def term_spans(docs: DataFrame, terms: DataFrame) -> DataFrame | None:
    """Spans of the terms to sanitise: doc_id, h, terms (spans by start); rows without any are left out."""
    terms = cut(terms.select("term", "removed"))
    if terms.isEmpty():
        return None
    d = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("h", F.xxhash64("text"))
    hits = (d.select("doc_id", "h", F.posexplode(F.expr(f"regexp_extract_all(text, r'{TERM}', 0)")).alias("i", "word"))
            .withColumn("term", F.lower("word")).join(_small(terms), "term")
            .groupBy("doc_id", "h").agg(F.array_sort(F.collect_set(F.struct("i", "removed"))).alias("at")))
    hits = cut(hits)
    hits = _small(hits).withColumnsRenamed({"doc_id": "k", "h": "kh"})
    on = F.col("doc_id").eqNullSafe(F.col("k")) & (F.col("h") == F.col("kh"))
    words = (d.join(hits, on).dropDuplicates(["doc_id", "h"])
             .select("doc_id", "h", "at", F.expr(f"regexp_extract_all(text, r'{TERM}', 0)").alias("words"),
                     F.expr(f"split(text, r'{TERM}', -1)").alias("between")))
    span = ("named_struct('kind', IF(x.removed, 'removed', 'term'), 'start', start, "
            "'end', start + char_length(words[x.i]), 'value', words[x.i])")
    start = f"{_before('lengths', 'starts', 'x.i')} + char_length(between[x.i])"
    lengths = "zip_with(words, between, (w, b) -> coalesce(char_length(w), 0) + char_length(b))"
    return words.select("doc_id", "h", F.expr(_let("lengths", lengths, _let(
        "starts", _block_starts("lengths"), f"transform(at, x -> {_let('start', start, span)})"))).alias("terms"))


def sanitise(docs: DataFrame, least_texts: int = LEAST_TEXTS, disclosure: float = DISCLOSURE) -> DataFrame:
    """doc_id, h, entities and terms: all spans of each row. Texts without them are made by ``sanitised_text``."""
    docs = docs.select("doc_id", "text")
    found = cut(find_entities(docs))
    spans = term_spans(docs, disclosing_terms(docs, found, least_texts, disclosure))
    none = F.expr(f"CAST(array() AS {_SPANS})")
    if spans is None:
        return found.select("doc_id", "h", "entities", none.alias("terms"))
    spans = spans.withColumnsRenamed({"doc_id": "k", "h": "kh"})
    on = F.col("doc_id").eqNullSafe(F.col("k")) & (F.col("h") == F.col("kh"))
    outside = F.expr("filter(terms, t -> NOT exists(entities, e -> t.start < e.end AND e.start < t.end))")
    return found.join(spans, on, "left").select("doc_id", "h", "entities", F.coalesce(outside, none).alias("terms"))


def sanitised_text() -> Column:
    """The text (column ``text``) with entities as ``<KIND>``, terms as ``<TERM>``, and removed terms gone.

    Spans are served by start; where kinds overlap, what is left of the later span goes with the earlier one.
    """
    spans = "array_sort(transform(concat(entities, terms), s -> named_struct('start', s.start, 'end', s.end, 'kind', s.kind)))"
    return F.expr(
        f"aggregate({spans}, named_struct('at', 0, 'out', ''), (a, s) -> IF(s.end <= a.at, a, named_struct('at', s.end, 'out', "
        "concat(a.out, IF(s.start < a.at, '', concat(substr(text, a.at + 1, s.start - a.at), "
        "IF(s.kind = 'removed', '', concat('<', upper(s.kind), '>'))))))), "
        "a -> concat(a.out, substr(text, a.at + 1)))")


def sanitised(docs: DataFrame, **limits) -> DataFrame:
    """doc_id and text of all documents, sanitised."""
    found = sanitise(docs, **limits).dropDuplicates(["doc_id", "h"]).withColumnsRenamed({"doc_id": "k", "h": "kh"})
    d = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("h", F.xxhash64("text"))
    return (d.join(found, F.col("doc_id").eqNullSafe(F.col("k")) & (F.col("h") == F.col("kh")), "left")
            .select("doc_id", sanitised_text().alias("text")))


def _joined(column: str) -> Column:
    return F.expr(f"array_join(transform({column}, s -> concat(s.kind, ':', s.start, ':', s.end)), ',')")


def _oracle() -> str:
    """DuckDB SQL of the query: matches by plain patterns, placed by what is between them; then the method."""
    digits = "regexp_replace(v, '[^0-9]', '', 'g')"
    luhn = (f"list_sum(list_transform(range(1, length({digits}) + 1), lambda i: CASE WHEN i % 2 = 0 THEN "
            f"2 * substr(reverse({digits}), i, 1)::INT - CASE WHEN substr(reverse({digits}), i, 1)::INT > 4 THEN 9 ELSE 0 END "
            f"ELSE substr(reverse({digits}), i, 1)::INT END)) % 10 = 0")
    passes = {"email": "true", "ip": "list_aggregate(list_transform(string_split(v, '.'), lambda x: x::HUGEINT <= 255), 'bool_and')",
              "card": f"length({digits}) BETWEEN 16 AND 19 AND {luhn}", "phone": f"length({digits}) BETWEEN 8 AND 15"}
    size = lambda part, upto: f"coalesce(list_sum(list_transform({part}[1:{upto}], lambda x: length(x))), 0)"
    kinds = " UNION ALL ".join(
        f"SELECT rid, '{k}' AS kind, {n} AS place, s::BIGINT AS s, s::BIGINT + length(v) AS e, v FROM ("
        f"SELECT rid, m[i] AS v, {size('b', 'i')} + {size('m', 'i - 1')} AS s FROM ("
        f"SELECT rid, m, b, unnest(range(1, len(m) + 1)) AS i FROM (SELECT rid, regexp_extract_all(t, '{p}') AS m, "
        f"string_split_regex(t, '{p}') AS b FROM d))) WHERE {passes[k]}"
        for n, (k, p) in enumerate((k, p.replace("(", "(?:", 3 if k == "ip" else 1) if k != "phone" else p) for k, p in SQL_PATTERNS.items()))
    blank = "t"
    for kind in ("email", "ip", "phone", "card"):
        p = CARD_LONG_SQL if kind == "card" else SQL_PATTERNS[kind]
        blank = f"regexp_replace({blank}, '{p}', chr(10), 'g')"
    return f"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents
), spans AS ({kinds}
), texts AS (
  SELECT rid, md5(t) AS h FROM d
), names AS (
  SELECT DISTINCT rid, x.kind AS kind, x.v AS v FROM (SELECT rid, unnest(CASE kind
      WHEN 'email' THEN [{{'kind': 'email', 'v': lower(v)}}, {{'kind': 'domain', 'v': lower(string_split(v, '@')[2])}}]
      WHEN 'ip' THEN [{{'kind': 'ip', 'v': v}}, {{'kind': 'network', 'v': array_to_string(string_split(v, '.')[1:2], '.')}}]
      ELSE [{{'kind': kind, 'v': {digits}}}] END) AS x FROM spans)
), often AS (
  SELECT kind, v, count(*) AS n_c, md5(string_agg(DISTINCT h, ',' ORDER BY h)) AS same
  FROM names JOIN texts USING (rid) GROUP BY kind, v HAVING count(DISTINCT h) >= {LEAST_TEXTS}
), held AS (
  SELECT DISTINCT rid, h, same, n_c FROM names JOIN texts USING (rid) JOIN often USING (kind, v)
), words AS (
  SELECT rid, regexp_extract_all(t, '{TERM}') AS ws, string_split_regex(t, '{TERM}') AS b FROM d
), own AS (
  SELECT DISTINCT rid, lower(unnest(regexp_extract_all({blank}, '{TERM}'))) AS term FROM d
), tried AS (
  SELECT term FROM own JOIN texts USING (rid) WHERE rid IN (SELECT rid FROM held) GROUP BY term HAVING count(DISTINCT h) >= {LEAST_TEXTS}
), terms AS (
  SELECT term, count(*) AS n_t FROM own WHERE term IN (SELECT term FROM tried) GROUP BY term
), total AS (
  SELECT (SELECT count(*)::DOUBLE FROM d) AS n, (SELECT count(*)::DOUBLE FROM tried) AS v,
         (SELECT count(DISTINCT same) FROM often, (SELECT count(*) AS n FROM d) WHERE n_c < n) AS s
), pairs AS (
  SELECT same, n_c, term, count(*) AS n_ct, count(DISTINCT h) AS texts FROM held JOIN own USING (rid) GROUP BY ALL HAVING count(DISTINCT h) >= {LEAST_TEXTS}
), flagged AS (
  SELECT term, bool_or(n_ct >= n_t) AS removed
  FROM pairs JOIN terms USING (term), total
  WHERE n_c < n AND ln(n * n_ct / (n_c * n_t)) / ln(n / n_c) >= {DISCLOSURE} AND texts * ln(n / n_c) >= ln(v * s / {CHANCE}) GROUP BY term
), hits AS (
  SELECT rid, CASE WHEN removed THEN 'removed' ELSE 'term' END AS kind, s::BIGINT AS s, s::BIGINT + length(w) AS e FROM (
    SELECT rid, removed, ws[i] AS w, {size('b', 'i')} + {size('ws', 'i - 1')} AS s FROM (
      SELECT rid, ws, b, unnest(range(1, len(ws) + 1)) AS i FROM words
      WHERE rid IN (SELECT rid FROM (SELECT rid, lower(unnest(ws)) AS term FROM words) WHERE term IN (SELECT term FROM flagged))) JOIN flagged ON flagged.term = lower(ws[i]))
), kept AS (
  SELECT * FROM hits h WHERE NOT EXISTS (SELECT 1 FROM spans x WHERE x.rid = h.rid AND h.s < x.e AND x.s < h.e)
), every AS (
  SELECT rid, kind, place, s, e FROM spans UNION ALL SELECT rid, kind, CASE kind WHEN 'removed' THEN 4 ELSE 5 END, s, e FROM kept
), made AS (
  SELECT rid, {', '.join(f"count(*) FILTER (WHERE kind = '{k}') AS n_{k}" for k in PATTERNS)},
         string_agg(kind || ':' || s || ':' || e, ',' ORDER BY place, s) FILTER (WHERE place < 4) AS base,
         string_agg(kind || ':' || s || ':' || e, ',' ORDER BY place, s) AS spans
  FROM every GROUP BY rid
)
SELECT d.doc_id, {', '.join(f"coalesce(m.n_{k}, 0) AS n_{k}" for k in PATTERNS)},
       sha256(coalesce(m.base, '')) AS base_sha256, coalesce(m.spans, '') AS spans
FROM d LEFT JOIN made m ON m.rid = d.rid
"""


@register("op1_pii", _oracle())
def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of personal data, and of terms that disclose it, in all documents."""
    s = sanitise(table(spark, sf_dir, "documents"))
    counts = [F.expr(f"bigint(size(filter(entities, e -> e.kind = '{k}')))").alias(f"n_{k}") for k in PATTERNS]
    return s.select("doc_id", *counts, F.sha2(_joined("entities"), 256).alias("base_sha256"),
                    _joined("concat(entities, array_sort(terms))").alias("spans"))
