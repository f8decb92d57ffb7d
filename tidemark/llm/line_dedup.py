"""Line deduplication by a fixed-depth log-template tree, with DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import fresh, settle, small, stored

#: Leading tokens of a leaf.
DEPTH = 3
#: Share of a line's tokens that must be its leaf template's constants.
SIMILAR = 0.7
#: Share of a line's tokens that digits may mask; a line of more fields is compared as it is.
FIELDS = 0.5
#: A template of at least so many tokens recurs from two documents on, ...
LONG, LONG_DOCS = 10, 2
#: ... a shorter one of at least so many only from ten.
SHORT, SHORT_DOCS = 3, 10
#: ... and one of fewer tokens from a hundred.
TINY_DOCS = 100
FIELD = "<*>"
SPACE = r"[\x20\x09-\x0D]"


def plain(line: Column) -> Column:
    """The line's tokens joined by single spaces."""
    uneven = F.contains(line, F.lit("  "))
    for c in "\t\v\f\r":
        uneven = uneven | F.contains(line, F.lit(c))
    return F.trim(F.when(uneven, F.regexp_replace(line, SPACE + "+", " ")).otherwise(line))


def token_count(line: Column) -> Column:
    return F.octet_length(line) - F.octet_length(F.replace(line, F.lit(" "), F.lit(""))) + 1


def with_fields(line: Column) -> Column:
    """The ``plain`` line with ``<*>`` for tokens with a digit, unless those are more than ``FIELDS`` of it."""
    fields = F.regexp_replace(line, r"(?<![^ ])[^ 0-9]*+[0-9][^ ]*+", FIELD)

    def chosen(text: Column) -> Column:
        return F.when(F.regexp_count(text, F.lit(r"(?<![^ ])<\*>(?![^ ])")) <= FIELDS * token_count(text), text).otherwise(line)

    # a list of one: the fields are found once, however often they are read
    return F.when(line.rlike("[0-9]"), F.element_at(F.transform(F.array(fields), chosen), 1)).otherwise(line)


def lines_of(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Every line with a token: ``id``, ``key`` (of the document), ``pos``, ``line``
    (masked), ``n`` (tokens), ``leaf`` (of token count and leading tokens), ``h``."""
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(F.col(id_col), F.col(text_col)).alias("key"),
                       # masked before the explode: once a line, whatever is filtered or derived later
                       F.posexplode(F.transform(F.transform(F.split(F.col(text_col), "\n", -1), plain), with_fields)).alias("pos", "line"))
    rows = rows.where("line != ''")
    rows = rows.withColumn("n", token_count(F.col("line")))
    lead = F.substring_index("line", " ", DEPTH)
    # a line that kept its digits is compared as it is: in no leaf
    leaf = F.when(~F.col("line").rlike("[0-9]"), F.xxhash64("n", lead))
    return rows.select("id", "key", "pos", "line", "n", leaf.alias("leaf"), F.xxhash64("line").alias("h"))


def group_matches(lines: DataFrame) -> DataFrame:
    """``leaf``, ``h``, ``group``, ``template`` of the ``lines`` (``leaf``, ``h``, ``n``, ``line``,
    ``times``, ``group``) that are an instance of their group's template.

    A group's template has the token that most of its lines share at a position, or
    a variable field where there is none; an instance has ``SIMILAR`` of its tokens
    from the template's constants.
    """
    tokens = lines.select("leaf", "h", "n", "times", "group", F.split("line", " ", -1).alias("tokens"))
    at = tokens.select("group", "times", F.posexplode("tokens").alias("place", "token"))
    counts = at.groupBy("group", "place", "token").agg(F.sum("times").alias("c"))
    most = counts.groupBy("group", "place").agg(F.max(F.struct("c", "token")).alias("top"), F.sum("c").alias("all"))
    constant = F.when((2 * F.col("top.c") > F.col("all")) & (F.col("top.token") != FIELD), F.col("top.token"))
    template = most.groupBy("group").agg(F.array_sort(F.collect_list(F.struct(
        "place", constant.alias("token")))).alias("template"))
    same = F.size(F.filter(F.zip_with("tokens", "template", lambda t, c: t == c["token"]), lambda x: x))
    return tokens.join(template, "group").where(same >= SIMILAR * F.col("n")).select(
        "leaf", "h", "group", "times", F.xxhash64("leaf", F.col("template.token")).alias("template"))


def leaf_matches(lines: DataFrame) -> DataFrame:
    """``h``, ``template`` of the distinct ``lines`` (``leaf``, ``h``, ``n``, ``line``,
    ``times``) that are an instance of a template of their leaf.

    First the template of all its lines. The others are cut in bands, one more than
    an instance may have variable fields: lines of one template share a band,
    whatever else is in the leaf. Those of an equal band are
    a group with a template (bands with the same lines are one group); of the templates of all its
    groups a line takes that of most instances. Defined cases: no lines give no rows; a line that is its leaf's only
    one, or shares no band, is no instance of others; ties go to the larger template hash.
    """
    leaf = settle(group_matches(lines.withColumn("group", F.col("leaf"))).select("h", F.col("leaf").alias("template")))
    rest = stored(lines.join(small(leaf), "h", "left_anti"), "leaf-rest")
    m, size = F.col("n") - DEPTH, F.col("bands")
    bands = F.least(F.floor((1 - SIMILAR) * F.col("n") + 1e-9) + 1, m).cast("int")
    cut = rest.where(m > 0).select("leaf", "h", "n", bands.alias("bands"), F.split("line", " ", -1).alias("tokens"))

    def band(i: Column) -> Column:
        start, end = F.floor(i * m / size), F.floor((i + 1) * m / size)
        return F.xxhash64(F.slice("tokens", (start + DEPTH + 1).cast("int"), (end - start).cast("int")))

    cut = cut.select("leaf", "h", F.posexplode(F.transform(F.sequence(F.lit(0), size - 1), band)).alias("band", "k"))
    cut = stored(cut.select("h", F.xxhash64("leaf", "band", "k").alias("band")), "bands")
    shared = cut.groupBy("band").agg(F.count("*").alias("lines"), F.bit_xor(F.xxhash64("h")).alias("group")).where("lines > 1")
    full = cut.join(small(settle(shared.select("band", "group"))), "band").select("h", "group").distinct()
    found = settle(group_matches(stored(rest.join(full, "h"), "leaf-groups")))
    sizes = found.groupBy("group").agg(F.sum("times").alias("lines"))
    ranked = found.join(small(settle(sizes)), "group").groupBy("h").agg(
        F.max(F.struct("lines", "template"))["template"].alias("template"))
    return leaf.unionByName(ranked)


def recurring(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``key``, ``dropped``: positions of the lines that go from each document.

    Equal masked lines are one template; in leaves of lines that differ, the leaf's
    templates join their instances. A template in
    enough documents recurs: all its lines go but the first, which is that of the
    smallest (id, document key, position). Lines of fewer than ``SHORT`` tokens recur
    from ``TINY_DOCS`` documents on.
    """
    lines = stored(lines_of(docs, id_col, text_col).drop("line"), "lines")
    leaves = (lines.where((F.col("n") >= SHORT) & F.col("leaf").isNotNull()).groupBy("leaf").agg(F.min("h").alias("a"), F.max("h").alias("b"))
              .where("a != b").select("leaf"))
    differing = lines_of(docs, id_col, text_col).where(F.col("n") >= SHORT).join(small(settle(leaves)), "leaf", "left_semi")
    distinct = stored(differing.groupBy("leaf", "h", "n").agg(F.first("line").alias("line"), F.count("*").alias("times")),
                      "leaf-lines")
    joined = settle(leaf_matches(distinct))
    own = lines.join(small(joined), "h", "left").select("id", "key", "pos", "n", F.coalesce("template", "h").alias("t"))
    in_doc = own.groupBy("t", "key").agg(F.min(F.struct("id", "key", "pos")).alias("first"), F.first("n").alias("n"))
    found = in_doc.groupBy("t").agg(F.count("*").alias("docs"), F.min("first").alias("first"), F.first("n").alias("n"))
    often = ((F.col("n") >= LONG) & (F.col("docs") >= LONG_DOCS)) | ((F.col("n") >= SHORT) & (F.col("docs") >= SHORT_DOCS)) | (
        F.col("docs") >= TINY_DOCS)
    found = found.where(often)
    found = settle(found.select("t", F.col("first.key").alias("first_key"), F.col("first.pos").alias("first_pos")))
    gone = own.join(small(found), "t").where((F.col("key") != F.col("first_key")) | (F.col("pos") != F.col("first_pos")))
    return gone.select("key", "pos").distinct().groupBy("key").agg(F.collect_list("pos").alias("dropped"))


def drop_recurring_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                         counts: bool = True) -> DataFrame:
    """``docs`` with the recurring lines taken out of ``text_col``, and with ``counts``
    ``n_lines`` and ``n_dropped`` (int; lines with a token before, and of these dropped).

    Defined cases: null text stays null, empty text empty, both with 0 lines; a
    text all of whose lines go becomes empty; lines without a token stay; texts
    of any length are read whole; rows equal in id and text are one document and
    lose the same lines; an empty table stays empty; extra columns are kept, with
    ``counts`` one called ``n_lines`` or ``n_dropped`` is replaced.
    """
    key, dropped, lines, gone = fresh(docs, "key", "dropped", "lines", "gone")
    cut = recurring(docs, id_col, text_col).select(F.col("key").alias(key), F.col("dropped").alias(dropped))
    text = F.col(text_col)
    out = docs.withColumn(key, F.xxhash64(F.col(id_col), text)).join(cut, key, "left")
    out = out.withColumn(lines, F.split(text, "\n", -1)).withColumn(gone, F.coalesce(dropped, F.array().cast("array<int>")))
    kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col(gone))
    rest = F.array_join(F.transform(kept, lambda i: F.col(lines)[i]), "\n")
    has_token = F.filter(lines, lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    columns = [F.col(c) if c.lower() != text_col.lower() else
               F.when(F.size(gone) > 0, rest).otherwise(text).alias(c)
               for c in docs.columns if not counts or c.lower() not in ("n_lines", "n_dropped")]
    if not counts:
        return out.select(*columns)
    return out.select(*columns, F.when(text.isNull(), 0).otherwise(F.size(has_token)).alias("n_lines"),
                      F.size(gone).alias("n_dropped"))
