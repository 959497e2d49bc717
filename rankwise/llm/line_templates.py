"""Line dedup with a fixed-depth log-template tree (native).

A line's tokens with a digit become the wildcard ``<*>``. The tree routes it by
its token count and its first ``DEPTH`` tokens to a leaf. Inside a leaf, positions
where lines differ generalise. A token's support is the number of lines of the leaf
that have it at that position. The better half of a line's tokens, by support, are
what its kind has in common; a token stays if it has ``KEPT_SHARE`` of the support
of the last of them, and is a wildcard otherwise. The result is the line's template
if its lines are bound to it: they are ``BOUND_SHARE`` of those that have its rarest
token. So boilerplate with variable fields is told from prose that happens to share
words, by ratios that are the same in a small corpus and a large one. Else the line
keeps the form it had with its digits masked. A template found in ``MIN_DOCS``
documents or more recurs, and a line of ``LONG`` tokens, which no chance repeats, in
two: its lines are dropped everywhere but in the first of them, the one with the
least id, so that copies do not wipe out each other.

What moves between tasks are digests: forms and templates as 128 bits, tokens at
their place in a leaf as 64. Forms are moved only for leaves that hold different
ones: those of a leaf of up to ``SMALL`` tokens to one task, where all is counted in
place; a larger leaf is dealt by form and by token, with the same result. Other counts
combine before they move, and joins are plain equi-joins that Spark may split where a
line is very common.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rankwise.llm import sizes
from rankwise.llm.tables import stored
from rankwise.llm.text import BLANKS, fresh, lines

DEPTH = 2             # leading tokens that the tree branches on
MIN_DOCS = 3          # documents that make a template recur
FIXED_SHARE = 0.5     # of a template's tokens
LONG = 50             # tokens from which a line recurs in two documents
KEPT_SHARE = 0.5      # of the support of the better half, for a token to stay
BOUND_SHARE = 0.5     # of the lines with its rarest token, for a template to hold
MIN_FIXED = 5         # tokens, for a template that generalises beyond digits
SMALL = 100_000       # tokens of a leaf whose lines may meet in one task
WILD = "<*>"
# A token with a digit. The look-behind and the possessive run keep it linear.
VARIABLE = r"(?<![^\x09-\x0D\x20])[^\x09-\x0D\x200-9]*+[0-9][^\x09-\x0D\x20]*"


def _form(line: Column) -> Column:
    """The line with one space between tokens and wildcards for digits."""
    masked = F.when(line.rlike("[0-9]"), F.regexp_replace(line, VARIABLE, WILD)).otherwise(line)
    return F.trim(F.regexp_replace(masked, BLANKS, " "))


def line_table(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """A row per line with a token: document, line number from 0, form and the
    form's digest, number of tokens and of fixed ones, leaf."""
    out = docs.select(F.struct(F.col(f"`{doc_id}`").alias("id"),
                               F.xxhash64(F.col(f"`{text}`")).alias("key")).alias("doc"),
                      F.posexplode(lines(F.col(f"`{text}`"))).alias("line_no", "line"))
    out = out.select("doc", "line_no", _form(F.col("line")).alias("form")).filter("form <> ''")
    tokens = F.split("form", " ", -1)
    return out.withColumn("tokens", tokens).select(
        "doc", "line_no", "form", F.unhex(F.md5("form")).alias("line"), F.size("tokens").alias("n"),
        F.size(F.array_remove("tokens", WILD)).alias("fixed"),
        F.xxhash64(F.size("tokens"), F.slice("tokens", 1, DEPTH)).alias("leaf"))


def _cells(forms: DataFrame) -> DataFrame:
    """A row per fixed token of a form: its cell is the token at its place in the leaf."""
    return forms.select("leaf", "line", "n", "lines", F.posexplode(F.split("form", " ", -1))) \
        .filter(F.col("col") != WILD) \
        .select("leaf", "line", "n", "lines", F.xxhash64("leaf", "pos", "col").alias("cell"),
                (F.col("pos") < DEPTH).alias("leads"))


def _by_form(cells: DataFrame) -> DataFrame:
    return cells.groupBy("leaf", "line", "n", "lines").agg(F.sort_array(F.collect_list(
        F.struct("support", "cell", "leads")), asc=False).alias("cells"))


def _in_small(table: DataFrame, leaves: DataFrame, limit: int) -> DataFrame:
    """Forms of small leaves with the support of their cells. The lines of a leaf meet
    in one task, which bounds them by ``SMALL``; all the rest happens where they lie."""
    leaves, sent = sizes.hinted(leaves, limit)
    met = table.select("leaf", "form", "n").join(leaves, "leaf")
    met = met.repartition("leaf") if sent else met
    forms = met.groupBy("leaf", "form", "n").agg(F.count(F.lit(1)).alias("lines")) \
        .withColumn("line", F.unhex(F.md5("form")))
    return _by_form(_cells(forms).withColumn(
        "support", F.sum("lines").over(Window.partitionBy("leaf", "cell"))))


def _in_large(spark: SparkSession, table: DataFrame, leaves: DataFrame, limit: int) -> DataFrame:
    """The same for leaves of any size: what moves is dealt by form and by cell."""
    forms = table.join(sizes.hinted(leaves, limit)[0], "leaf").groupBy("leaf", "line", "n").agg(
        F.first("form").alias("form"), F.count(F.lit(1)).alias("lines"))
    cells = _cells(stored(spark, forms, "line-forms"))
    support = cells.groupBy("cell").agg(F.sum("lines").alias("support"))
    return _by_form(cells.join(support, "cell"))


def _generalised(spark: SparkSession, table: DataFrame, limit: int, small: int) -> DataFrame:
    """(line, template): forms that their leaf generalises to a template it holds."""
    # Lines of one leaf have one token count; those too short have no template.
    table = table.filter(F.col("n") >= MIN_FIXED)
    told = F.xxhash64("line")
    several = table.groupBy("leaf", "n").agg(
        F.min(told).alias("a"), F.max(told).alias("b"), F.count(F.lit(1)).alias("lines")) \
        .filter((F.col("a") != F.col("b")) & (F.col("lines") >= MIN_DOCS)) \
        .select("leaf", (F.col("lines") * F.col("n") <= small).alias("small"))
    several = stored(spark, several, "line-leaves")
    found = _in_small(table, several.filter("small").select("leaf"), limit) \
        .unionByName(_in_large(spark, table, several.filter("not small").select("leaf"), limit))
    half = F.ceil(F.col("n") * FIXED_SHARE).cast("int")
    out = found.withColumn("pivot", F.get("cells", half - 1)["support"]) \
        .withColumn("cells", F.filter("cells", lambda c: c["support"] >= KEPT_SHARE * F.col("pivot"))) \
        .filter((F.size("cells") >= MIN_FIXED) & (F.size("cells") < F.col("n")))

    # A template is the set of its cells, told by two independent xors of hashes.
    def mixed(hashed):
        return F.aggregate("cells", F.lit(0).cast("long"),
                           lambda x, c: x.bitwiseXOR(hashed(c["cell"])))
    named = F.concat_ws(" ", "leaf", mixed(lambda c: c), mixed(lambda c: F.xxhash64(c, F.lit(1))))
    rarest = F.array_min(F.transform(F.filter("cells", lambda c: ~c["leads"]), lambda c: c["support"]))
    general = stored(spark, out.select(
        "line", "lines", F.unhex(F.md5(named)).alias("template"), rarest.alias("rarest")),
        "line-templates")
    held = general.groupBy("template").agg(F.sum("lines").alias("all"), F.min("rarest").alias("rarest")) \
        .filter((F.col("all") >= MIN_DOCS) & (F.col("all") >= BOUND_SHARE * F.col("rarest")))
    return general.select("line", "template").join(held.select("template"), "template") \
        .select("line", "template")


def dropped_lines(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text",
                  limit: int = sizes.BROADCAST_BYTES, small: int = SMALL) -> DataFrame:
    """(doc, drop): per document that loses lines, their numbers from 0.

    ``doc`` is a struct of the id and a hash of the text. Written line tables
    and counts lie in the shared folder.
    """
    spark = docs.sparkSession
    table = stored(spark, line_table(docs, doc_id, text), "lines")
    general = stored(spark, _generalised(spark, table, limit, small), "line-general")
    # Only lines whose template may recur meet their documents again.
    enough = F.when(F.col("n") >= LONG, 2).otherwise(MIN_DOCS)
    plain = table.filter(F.col("fixed") >= FIXED_SHARE * F.col("n")).groupBy("line") \
        .agg(F.count(F.lit(1)).alias("lines"), F.first("n").alias("n")) \
        .withColumn("least", enough).filter(F.col("lines") >= F.col("least")) \
        .join(general.select("line"), "line", "left_anti") \
        .select("line", F.col("line").alias("template"), "least")
    wide = general.select("line", "template", F.lit(MIN_DOCS).alias("least"))
    # These grow with the corpus, so the join is one of shuffled digests at any size.
    named = stored(spark, wide.unionByName(plain), "line-names").hint("merge")
    met = table.select("doc", "line_no", "line").join(named, "line")
    met = stored(spark, met.select("doc", "line_no", "template", "least"), "line-matches")
    recurring = met.groupBy("template").agg(
        F.count_distinct("doc").alias("docs"), F.min("doc").alias("first"),
        F.first("least").alias("least")) \
        .filter(F.col("docs") >= F.col("least")).select("template", "first")
    recurring, _ = sizes.hinted(stored(spark, recurring, "line-recurring"), limit)
    return met.join(recurring, "template").filter(F.col("doc") != F.col("first")) \
        .groupBy("doc").agg(F.collect_set("line_no").alias("drop"))


def deduplicate(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text",
                limit: int = sizes.BROADCAST_BYTES, small: int = SMALL) -> DataFrame:
    """``docs`` with its lines of recurring templates cut out of ``text``, and
    n_lines, n_dropped (long): lines with a token, before and cut.

    All rows and columns stay; names that clash get a leading underscore. A
    null text has no lines and stays null. Lines without a token are never cut.
    Rows with equal id and text are one document and lose the same lines; rows
    of one id with different texts are two. A null id counts as the least.
    """
    spark = docs.sparkSession
    drops = stored(spark, dropped_lines(docs, doc_id=doc_id, text=text, limit=limit,
                                        small=small)
                    .select(F.col("doc.id").alias("d_id"), F.col("doc.key").alias("d_key"), "drop"),
                    "line-drops")
    drops, _ = sizes.hinted(drops, limit)
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"),
                       F.col(f"`{text}`").alias("t"), F.col(f"`{doc_id}`").alias("id"))
    rows = rows.join(drops, rows["id"].eqNullSafe(drops["d_id"])
                     & (F.xxhash64(rows["t"]) == drops["d_key"]), "left")
    cut = rows.withColumn("lines", lines(F.col("t")))
    last = F.size("lines") - 1
    left = F.array_except(F.when(last >= 0, F.sequence(F.lit(0), last)), F.col("drop"))
    cut = cut.withColumn("new", F.when(F.col("drop").isNull(), F.col("t")).otherwise(
        F.array_join(F.transform(left, lambda i: F.get("lines", i)), "\n")))
    cut = cut.withColumn("n_lines", F.size(F.filter(
        "lines", lambda x: x.rlike(r"[^\x09-\x0D\x20]"))).cast("long"))
    n_lines, n_dropped = fresh(docs, "n_lines"), fresh(docs, "n_dropped")
    return cut.select(
        *(F.col("new").alias(c) if c == text else F.col(f"row.`{c}`").alias(c)
          for c in docs.columns),
        F.col("n_lines").alias(n_lines),
        F.coalesce(F.size("drop"), F.lit(0)).cast("long").alias(n_dropped))


def clean(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text",
          n_chars: str | None = None, limit: int = sizes.BROADCAST_BYTES) -> DataFrame:
    """``deduplicate`` with the columns of ``docs`` alone, without documents
    that lost every line with a token; ``n_chars`` names a column to recount."""
    out = deduplicate(docs, doc_id=doc_id, text=text, limit=limit)
    n_lines, n_dropped = out.columns[-2:]
    out = out.filter((F.col(n_dropped) == 0) | (F.col(n_dropped) < F.col(n_lines)))
    if n_chars:
        out = out.withColumn(n_chars, F.when(F.col(n_dropped) == 0, F.col(n_chars))
                             .otherwise(F.char_length(text)).cast(docs.schema[n_chars].dataType))
    return out.select(*(F.col(f"`{c}`") for c in docs.columns))
