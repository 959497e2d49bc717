"""Registered queries of this subpackage: each reads whole tables."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankwise.llm import (
    byte_gru,
    conversation_sql,
    decontaminate,
    html_blocks,
    licenses,
    line_templates,
    lm_automaton,
    mixing,
    ngram_join,
    pii,
    prefix_trie,
    quality_rules,
    structure_repair,
    warc,
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_lm_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_automaton.score(table(spark, sf_dir, "documents"))


def op2_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The key is the secret that takes pseudonyms back: set it on a cluster."""
    key = spark.conf.get("spark.rankwise.pii.key", "not a secret: for tests")
    out = pii.pseudonymise(table(spark, sf_dir, "documents").select("doc_id", "text"), key.encode())
    return out.select("doc_id", "text", F.size("pii_found").cast("long").alias("n_replaced"))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(table(spark, sf_dir, "documents")).drop("distance")


def op4_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.classes(table(spark, sf_dir, "documents"))


def op5_line_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_templates.deduplicate(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op6_html_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_blocks.extract(table(spark, sf_dir, "pages"))


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.report(table(spark, sf_dir, "documents"),
                                table(spark, sf_dir, "benchmark"))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents").select("doc_id", "source"))


def op9_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Derivative records of all pages; files of them are written by warc.write."""
    made = warc.derive(warc.responses(table(spark, sf_dir, "pages")))
    return made.withColumnRenamed("source_id", "page_id")


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie(table(spark, sf_dir, "conversations"))


def op12_byte_gru(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_gru.detect(table(spark, sf_dir, "documents"))


def op13_structure_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return structure_repair.damaged_repairs(table(spark, sf_dir, "conversations"))


QUERIES = {
    "op1_lm_automaton": op1_lm_automaton,
    "op2_pseudonyms": op2_pseudonyms,
    "op3_quality_rules": op3_quality_rules,
    "op4_ngram_join": op4_ngram_join,
    "op5_line_templates": op5_line_templates,
    "op6_html_blocks": op6_html_blocks,
    "op7_decontaminate": op7_decontaminate,
    "op8_mixing": op8_mixing,
    "op9_licenses": op9_licenses,
    "op10_warc": op10_warc,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_byte_gru": op12_byte_gru,
    "op13_structure_repair": op13_structure_repair,
}

# Words of a text, lower-cased A-Z only, as DuckDB sees them.
_ALNUM = """list_filter(string_split_regex(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '')"""



def _canonical_sql(text: str) -> str:
    """The canonical form of a licence text, step by step."""
    quoted = [s.replace("'", "''") for s in (licenses.COPYRIGHT, licenses.PUNCTUATION)]
    out = f"regexp_replace(lower(coalesce({text}, '')), '{quoted[0]}', ' ', 'g')"
    out = f"' ' || regexp_replace({out}, '{quoted[1]}', '  ', 'g') || ' '"
    for word, other in licenses.EQUIVALENT.items():
        out = f"replace({out}, ' {word} ', ' {other} ')"
    return f"trim(regexp_replace({out}, ' +', ' ', 'g'))"


def _known_sql() -> str:
    rows = ((name, text.replace("'", "''")) for name, text in licenses.KNOWN)
    return ", ".join(f"('{name}', '{text}')" for name, text in rows)


def _quality_sql() -> str:
    """The quality rules step by step. A document's rank by distance bucket in
    its group, less one, is the number of documents in nearer buckets."""
    q, v, pairs = quality_rules, quality_rules.VECTOR, quality_rules.PAIRS

    def share(part, whole):
        return f"ln(1 + 100 * {part} / CAST(greatest({whole}, 1) AS DOUBLE))"
    vector = {"x_words": "ln(CAST(greatest(n_words, 1) AS DOUBLE))",
              "x_length": "ln(greatest(word_chars, 1) / CAST(greatest(n_words, 1) AS DOUBLE))",
              "x_variety": "ln(greatest(n_words, 1) / CAST(greatest(n_distinct, 1) AS DOUBLE))",
              "x_symbols": share("n_symbols", "n_words"),
              "x_lines": share("n_dup_lines", "n_lines"),
              "x_repeats": share("n_repeat_words", "n_words")}

    def plus(parts):
        return " + ".join(parts) or "0"

    def solved(prefix=""):
        """Forward substitution; an alias may be used by the ones after it."""
        y = [f"({a} - {prefix}m_{a} - ({plus(f'{prefix}l_{a}_{b} * y_{b}' for b in v[:i])}))"
             f" / {prefix}l_{a}_{a} AS y_{a}" for i, a in enumerate(v)]
        return ", ".join([*y, f"{plus(f'y_{a} * y_{a}' for a in v)} AS d"])
    cells = " UNION ALL ".join(
        f"SELECT g, '{x}' AS name, floor({x} * {q.GRID}) AS cell FROM p" for x in v)

    def at(x, level):
        return f"min(cell) FILTER (name = '{x}' AND upto >= {level} * n) / {q.GRID}"
    start = ", ".join(
        [f"{at(x, 0.5)} AS m_{x}, greatest(({at(x, 0.75)} - {at(x, 0.25)}) / 1.349, {f}) AS l_{x}_{x}"
         for x, f in q.FLOORS.items()] + [f"0.0 AS l_{a}_{b}" for a, b in pairs if a != b])
    steps = []
    for k in range(1, q.STEPS + 1):
        means = [f"avg({a}) AS m_{a}" for a in v] + [f"avg({a} * {b}) AS p_{a}_{b}" for a, b in pairs]
        factor = []
        for i, a in enumerate(v):
            for j, b in enumerate(v[:i + 1]):
                spread = f"{q.CONSISTENCY!r} * (p_{a}_{b} - m_{a} * m_{b})" \
                    + (f" + {q.FLOORS[a] ** 2!r}" if a == b else "")
                left = f"({spread} - ({plus(f'l_{a}_{c} * l_{b}_{c}' for c in v[:j])}))"
                factor.append(f"sqrt({left}) AS l_{a}_{b}" if a == b
                              else f"{left} / l_{b}_{b} AS l_{a}_{b}")
        steps.append(f"""near{k} AS (SELECT *, floor(ln(d + 1e-6) * {q.BUCKETS_PER_UNIT}) AS bucket
  FROM (SELECT p.*, {solved()} FROM p JOIN e{k - 1} USING (g))),
e{k} AS (SELECT g, n_group, {", ".join(f"m_{a}" for a in v)}, {", ".join(factor)} FROM (
  SELECT g, any_value(n_group) AS n_group, {", ".join(means)} FROM (
    SELECT *, rank() OVER (PARTITION BY g ORDER BY bucket) - 1 AS before,
      count(*) OVER (PARTITION BY g) AS n_group FROM near{k})
  WHERE before < {q.SUPPORT} * n_group GROUP BY g))""")
    names = [f"m_{a}" for a in v] + [f"l_{a}_{b}" for a, b in pairs]
    chosen = ", ".join(f"CASE WHEN own.g IS NULL THEN wide.{c} ELSE own.{c} END AS {c}" for c in names)
    last, blank = q.STEPS, r"[\x09-\x0D\x20]+"
    return f"""
WITH w AS (SELECT doc_id, lang, source, coalesce(text, '') AS t,
    list_filter(string_split_regex(coalesce(text, ''), '{blank}'), lambda x: x <> '') AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)),
                lambda x: regexp_matches(x, '[^\\x09-\\x0D\\x20]')) AS l FROM documents),
win AS (SELECT doc_id, i, array_to_string(w[i : i + {q.WINDOW - 1}], ' ') AS x
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - {q.WINDOW - 2})) AS i FROM w)),
twice AS (SELECT doc_id, i FROM win QUALIFY count(*) OVER (PARTITION BY doc_id, x) > 1),
hit AS (SELECT doc_id, count(*) AS n FROM (
  SELECT DISTINCT doc_id, unnest(range(i, i + {q.WINDOW})) FROM twice) GROUP BY doc_id),
s AS (SELECT doc_id, lang, source, CAST(len(w) AS BIGINT) AS n_words,
    CAST(len(list_distinct(w)) AS BIGINT) AS n_distinct,
    CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
    CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(len(l) AS BIGINT) AS n_lines,
    CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(hit.n, 0) AS BIGINT) AS n_repeat_words FROM w LEFT JOIN hit USING (doc_id)),
x AS (SELECT *, n_words < {q.MIN_WORDS}
      OR 100 * n_repeat_words > {q.MAX_REPEAT_PERCENT} * n_words AS base_failed,
    lang || '/' || source AS own_g, lang AS wide_g,
    {", ".join(f"{c} AS {x}" for x, c in vector.items())} FROM s),
p AS (SELECT unnest([own_g, wide_g]) AS g, {", ".join(v)} FROM x WHERE NOT base_failed),
cells AS (SELECT *, sum(1) OVER (PARTITION BY g, name ORDER BY cell) AS upto,
    count(*) OVER (PARTITION BY g, name) AS n FROM ({cells})),
e0 AS (SELECT g, {start} FROM cells GROUP BY g),
{", ".join(steps)},
large AS (SELECT * FROM e{last} WHERE n_group >= {q.MIN_GROUP}),
judged AS (SELECT *, {solved()} FROM (
  SELECT x.*, {chosen} FROM x LEFT JOIN large own ON own.g = own_g
  LEFT JOIN large wide ON wide.g = wide_g))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND coalesce(d <= {q.LIMIT!r}, true) AS kept FROM judged"""


ORACLE: dict[str, str] = {
    "op11_prefix_trie": conversation_sql.TRIE,
    "op13_structure_repair": conversation_sql.REPAIRS,
    "op3_quality_rules": _quality_sql(),
    # Every window of every document against every window of every item.
    "op7_decontaminate": f"""
WITH d AS (SELECT doc_id, {_ALNUM} AS w FROM documents),
b AS (SELECT item_id, {_ALNUM} AS w FROM benchmark),
spans AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS span,
    array_to_string(w[i : i + least(10, len(w)) - 1], ' ') AS phrase
  FROM (SELECT *, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
lengths AS (SELECT DISTINCT span FROM spans),
places AS (
  SELECT doc_id, span, i, array_to_string(w[i : i + span - 1], ' ') AS phrase
  FROM (SELECT doc_id, w, span, unnest(range(1, len(w) - span + 2)) AS i
        FROM d, lengths WHERE len(w) >= span)),
hits AS (SELECT p.doc_id, p.i, p.span, s.item_id
         FROM places p JOIN spans s ON p.span = s.span AND p.phrase = s.phrase),
covered AS (SELECT doc_id, count(*) AS n_hit FROM (
  SELECT DISTINCT doc_id, unnest(range(i, i + span)) FROM hits) GROUP BY doc_id),
found AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item_id FROM hits) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN found USING (doc_id)""",
    # The schedule is a recursion over the slots of one period.
    "op8_mixing": """
WITH RECURSIVE n AS (SELECT source, count(*) AS n,
    CAST(round(sqrt(CAST(count(*) AS DOUBLE)) * 1000000) AS BIGINT) AS weight
  FROM documents GROUP BY source),
u AS (SELECT source, n, greatest(1000000, CAST(round(weight / CAST(sum(weight) OVER () AS DOUBLE)
    * 1e9) AS BIGINT)) AS a FROM n),
t AS (SELECT CAST(sum(a) AS BIGINT) AS p FROM u),
p AS (SELECT p, list(source ORDER BY source) AS s, list(a ORDER BY source) AS a,
    max((least((n + 31) // 32, a) * p + a - 1) // a) AS slots FROM u, t GROUP BY p),
run AS (
  SELECT -1 :: BIGINT AS slot, 0 :: BIGINT AS i, list_transform(a, lambda x: 0 :: BIGINT) AS had
  FROM p
  UNION ALL
  SELECT slot + 1, best, list_transform(had, lambda h, j: CASE WHEN j = best THEN h + 1 ELSE h END)
  FROM (SELECT slot, had, list_min(list_filter(list_transform(had, lambda h, j:
      CASE WHEN h < p.a[j] AND (h * p.p) // p.a[j] <= slot + 1
      THEN {'d': ((h + 1) * p.p + p.a[j] - 1) // p.a[j], 'j': j :: BIGINT} END),
      lambda x: x IS NOT NULL)).j AS best
    FROM run, p WHERE slot + 1 < p.slots)),
plan AS (SELECT s[i] AS source, a[i] AS a, p.p, slot,
    row_number() OVER (PARTITION BY i ORDER BY slot) - 1 AS k FROM run, p WHERE slot >= 0),
d AS (SELECT doc_id, source, row_number() OVER (
    PARTITION BY source ORDER BY md5('mix:' || doc_id)) - 1 AS place FROM documents)
SELECT doc_id, d.source, a AS mix_units, p AS mix_period, place // 32 AS mix_block,
  (place // 32) // a * p + (k * p) // a AS mix_release,
  (place // 32) // a * p + ((k + 1) * p + a - 1) // a AS mix_deadline,
  (place // 32) // a * p + slot AS mix_slot,
  ((place // 32) // a * p + slot) * 32 + place % 32 AS mix_position
FROM d JOIN plan ON plan.source = d.source AND k = (place // 32) % a""",
    # Forms and templates as texts; ids are unique there.
    "op5_line_templates": r"""
WITH l AS (SELECT doc_id, i - 1 AS line_no, line, trim(regexp_replace(regexp_replace(line,
    '[^\x09-\x0D\x20]*[0-9][^\x09-\x0D\x20]*', '<*>', 'g'), '[\x09-\x0D\x20]+', ' ', 'g')) AS form
  FROM (SELECT doc_id, unnest(s) AS line, unnest(range(1, len(s) + 1)) AS i
        FROM (SELECT doc_id, string_split(text, chr(10)) AS s FROM documents))),
t AS (SELECT *, string_split(form, ' ') AS tokens FROM l WHERE form <> ''),
f AS (SELECT form, any_value(tokens) AS tokens, any_value(len(tokens)) AS n,
    any_value(len(list_filter(tokens, lambda x: x <> '<*>'))) AS fixed,
    count(*) AS lines FROM t GROUP BY form),
leaves AS (SELECT n, tokens[1:2] AS head FROM f GROUP BY ALL HAVING count(*) > 1 AND sum(lines) >= 3),
apart AS (SELECT * FROM (SELECT form, n, tokens[1:2] AS head, lines, unnest(tokens) AS token,
      unnest(range(len(tokens))) AS pos FROM f JOIN leaves l USING (n)
      WHERE n >= 5 AND l.head = tokens[1:2]) WHERE token <> '<*>'),
support AS (SELECT n, head, pos, token, sum(lines) AS s FROM apart GROUP BY ALL),
ranked AS (SELECT form, n, lines, pos, token, s,
    row_number() OVER (PARTITION BY form ORDER BY s DESC) AS r
  FROM apart JOIN support USING (n, head, pos, token)),
stays AS (SELECT *, max(s) FILTER (WHERE r = (n + 1) // 2) OVER (PARTITION BY form) AS common FROM ranked),
general AS (SELECT form, n, any_value(lines) AS lines, min(s) FILTER (WHERE pos >= 2) AS rarest,
    CAST([n] AS VARCHAR) || CAST(list([CAST(pos AS VARCHAR), token] ORDER BY pos) AS VARCHAR) AS template
  FROM stays WHERE s >= 0.5 * common GROUP BY form, n HAVING count(*) >= 5 AND count(*) < n),
held AS (SELECT template FROM general GROUP BY template
  HAVING sum(lines) >= 3 AND sum(lines) >= 0.5 * min(rarest)),
named AS (SELECT f.form, coalesce(template, f.form) AS template,
    CASE WHEN template IS NULL AND f.n >= 50 THEN 2 ELSE 3 END AS least
  FROM f LEFT JOIN (SELECT form, template FROM general JOIN held USING (template)) g USING (form)
  WHERE template IS NOT NULL OR fixed >= 0.5 * f.n),
met AS (SELECT t.doc_id, line_no, template, least FROM t JOIN named USING (form)),
recurring AS (SELECT template, min(doc_id) AS first FROM met GROUP BY template
  HAVING count(DISTINCT doc_id) >= any_value(least)),
gone AS (SELECT DISTINCT doc_id, line_no FROM met JOIN recurring USING (template)
  WHERE doc_id <> first),
out AS (SELECT l.doc_id, string_agg(line, chr(10) ORDER BY l.line_no)
      FILTER (WHERE gone.line_no IS NULL) AS text,
    count(*) FILTER (WHERE form <> '') AS n_lines, count(gone.line_no) AS n_dropped
  FROM l LEFT JOIN gone ON gone.doc_id = l.doc_id AND gone.line_no = l.line_no GROUP BY l.doc_id)
SELECT d.doc_id, CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(out.text, '') END AS text,
  CAST(coalesce(n_lines, 0) AS BIGINT) AS n_lines, CAST(coalesce(n_dropped, 0) AS BIGINT) AS n_dropped
FROM documents d LEFT JOIN out USING (doc_id)""",
    "op9_licenses": f"""
WITH k AS (SELECT form, min(license) AS license FROM (
  SELECT license, {_canonical_sql("text")} AS form FROM (VALUES {_known_sql()}) AS v(license, text))
  WHERE form <> '' GROUP BY form),
l AS (SELECT doc_id, license FROM (
  SELECT doc_id, {_canonical_sql("line")} AS form
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents)) JOIN k USING (form)),
n AS (SELECT doc_id, count(*) AS n, string_agg(DISTINCT license, ',' ORDER BY license) AS names
  FROM l GROUP BY doc_id),
d AS (SELECT doc_id, {_canonical_sql("text")} AS form FROM documents)
SELECT d.doc_id, CASE WHEN form <> '' THEN sha256(form) END AS digest, license,
  coalesce(n, 0) AS n_license_lines, coalesce(names, '') AS line_licenses
FROM d LEFT JOIN k USING (form) LEFT JOIN n ON n.doc_id = d.doc_id""",
}
