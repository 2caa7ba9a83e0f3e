"""Dropping lines whose template recurs across documents, with a fixed-depth template tree. DataFrame functions only."""

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from countcast.llm.common import WORD, stored

#: Leading tokens that a leaf of the tree fixes, below the number of tokens.
DEPTH = 3
#: Shorter lines stay.
LEAST_TOKENS = 4
#: A template recurs if so many documents of different content have it, ...
LEAST_DOCUMENTS = 5
#: ... which are at least this share of all documents that have it: lines that recur within copies of a document stay.
LEAST_SHARE = 0.25
#: Share of a template's tokens that must be constant.
LEAST_CONSTANT = 0.75
VARIABLE = "<*>"
#: Bits of the map that tells which lines' texts are needed, and bits per row of it.
MAP_BITS, ROW_BITS = 1 << 26, 32_768
# For the pipeline's rule (``whole``):
#: A line is a text's own if no other text has a line with the same first or the same last so many tokens; so edits within a line of a copy don't make it its own.
ANCHOR = 6
#: Texts with at least this share of their tokens in lines of their own count each, others by the text they share most with.
OWN_SHARE = 0.05
#: Two texts with less of their own are near copies by the later stage's similarity of 0.8.
NEAR_SHARE = 1 / 9
#: The documents needed fall with the length of a line: (tokens above which, documents). Short lines need ``LEAST_DOCUMENTS``.
LEAST_BY_LENGTH = ((50, 2), (35, 3), (20, 4))


def _needed(whole: bool) -> Column:
    """Documents that a line of ``n`` tokens needs."""
    needed = F.lit(LEAST_DOCUMENTS)
    for above, documents in reversed(LEAST_BY_LENGTH if whole else ()):
        needed = F.when(F.col("n") > above, documents).otherwise(needed)
    return needed


def _unlike(known: DataFrame, found: DataFrame) -> DataFrame:
    """``text_key, own, leader`` of the texts in ``found``: the share of a text's tokens that stand in lines of its own, and the text that it counts as
    if that share is small.

    An anchor is the start or the end of a line. The leader of an anchor is one of the texts that have it, best one with much of its own. A text's leader is that of
    most of its tokens, where an anchor that many texts have weighs less: copies share their rare lines too, unlike texts only the common ones.
    """
    masked = F.transform(F.split("text", "\n"), lambda x, k: F.struct(
        k.alias("place"), F.regexp_extract_all(F.regexp_replace(x, "[0-9]+", VARIABLE), F.lit(f"({WORD})"), F.lit(1)).alias("tokens")))
    ends = F.transform(F.filter(masked, lambda x: F.size(x["tokens"]) > 0), lambda x: F.struct(
        x["place"].alias("place"), F.size(x["tokens"]).alias("n"), F.array(
            F.xxhash64(F.lit("first"), F.slice(x["tokens"], F.lit(1), F.lit(ANCHOR))),
            F.xxhash64(F.lit("last"), F.slice(x["tokens"], F.greatest(F.size(x["tokens"]) - ANCHOR + 1, F.lit(1)), F.lit(ANCHOR)))).alias("anchors")))
    pieces = (
        known.select("text_key", F.inline(ends))
        .join(found.select("text_key").distinct(), "text_key", "left_semi").dropDuplicates(["text_key", "place"])
        .select("text_key", "place", "n", F.explode("anchors").alias("anchor"))
    )
    pieces = stored(pieces, "templates-pieces")
    common = (
        pieces.groupBy("anchor", "text_key").agg(F.lit(1).alias("one")).groupBy("anchor").agg(F.count("*").alias("texts")).filter("texts > 1"))
    met = stored(pieces.join(common, "anchor"), "templates-met")
    total = pieces.groupBy("text_key", "place").agg(F.max("n").alias("n")).groupBy("text_key").agg(F.sum("n").alias("n"))
    shared = met.groupBy("text_key", "place").agg(F.max("n").alias("n")).groupBy("text_key").agg(F.sum("n").alias("n_shared"))
    owned = stored(total.join(shared, "text_key", "left").select("text_key", (1 - F.coalesce("n_shared", F.lit(0)) / F.col("n")).alias("own")), "templates-owned")
    met = met.join(owned, "text_key")
    leaders = met.groupBy("anchor").agg(F.min(F.struct(F.col("own") < NEAR_SHARE, "text_key"))["text_key"].alias("leader"))
    weights = met.join(leaders, "anchor").groupBy("text_key", "leader").agg(F.sum(F.col("n") / F.sqrt("texts")).alias("weight"))
    best = weights.groupBy("text_key").agg(F.max_by("leader", F.struct("weight", "leader")).alias("leader"))
    return owned.join(best, "text_key", "left").select("text_key", "own", F.coalesce("leader", "text_key").alias("leader"))


def _tokens(known: DataFrame, each: DataFrame) -> DataFrame:
    """``each`` with the tokens of its lines, read from the documents that it names.

    A map of ``MAP_BITS`` bits, whose size doesn't depend on the data, goes to all tasks and keeps most other lines from being shuffled; the join
    that follows is exact.
    """
    def bit(*of: Column) -> Column:
        return F.pmod(F.xxhash64(*of), F.lit(MAP_BITS))

    wanted = bit(F.col("text_key"), F.col("place"))
    bits = F.broadcast(each.groupBy(F.floor(wanted / ROW_BITS).alias("row")).agg(F.bitmap_construct_agg(wanted % ROW_BITS).alias("bits")))
    place = bit(F.col("text_key"), F.col("line_place"))
    here = (
        known.select("text_key", F.posexplode(F.split("text", "\n")).alias("line_place", "line")).withColumn("bit", place)
        .join(bits, F.floor(F.col("bit") / ROW_BITS) == F.col("row"))
        .filter(F.expr(f"(conv(hex(substring(bits, int(bit % {ROW_BITS} div 8) + 1, 1)), 16, 10) >> int(bit % 8)) & 1 = 1"))
        .select("text_key", F.col("line_place").alias("place"),
                F.regexp_extract_all(F.regexp_replace("line", "[0-9]+", VARIABLE), F.lit(f"({WORD})"), F.lit(1)).alias("tokens"))
    )
    # Copies of a text come once each; which of them comes doesn't matter.
    one = here.groupBy("text_key", "place").agg(F.first("tokens").alias("tokens"))
    return each.join(one, ["text_key", "place"])


def recurring_lines(docs: DataFrame, whole: bool = False) -> DataFrame:
    """``doc_id, text_key, lines``: for each document with recurring lines, their places (from 0).

    ``LEAST_SHARE`` belongs to the rule of the registered query, which its SQL fixes. With ``whole``, as in the pipeline, there is no such
    share: the number of copies of one document can't protect a line in others. Documents then count by their whole text, near copies with
    next to no text of their own by the text they are near to (``_unlike``), so lines that unlike documents share can't merge those. The
    documents needed fall with the length of the line; where fewer than ``LEAST_DOCUMENTS`` do, near copies are those with less than ``NEAR_SHARE`` of their own.

    Digits are a variable field from the start. The tree's levels are the number of tokens of a line and its first ``DEPTH`` tokens. Only leaves
    with enough documents go on. There a token is constant at its place if enough documents of the leaf have it; other tokens
    become variable fields. Lines with equal templates are one; a template that is mostly constant and has enough documents recurs.

    Lines pass through shuffles as hashes. Only one text of each different line of a live leaf is read again, for its tokens.

    Documents count by content: the smallest and the largest of their lines' md5 sums, which copies share. Counts are taken on hashes and summed on the map
    side, so a line that a third of all documents have is a few rows per task.
    """
    known = docs.filter(F.col("text").isNotNull()).select("doc_id", "text", F.xxhash64("text").alias("text_key"))
    keyed = known.select("doc_id", "text_key", F.split("text", "\n").alias("raw"))
    if whole:
        keyed = keyed.withColumn("content", F.col("text_key"))
    else:
        keyed = keyed.withColumn("sums", F.transform("raw", lambda x: F.md5(x))).withColumn(
            "content", F.xxhash64(F.array_min("sums"), F.array_max("sums")))
    start = r"^[\x20\x09-\x0D]*" + r"[\x20\x09-\x0D]+".join([f"({WORD})"] * DEPTH)
    lines = stored(
        keyed.select("doc_id", "text_key", "content", F.posexplode("raw").alias("place", "line"))
        .withColumn("n", F.regexp_count("line", F.lit(WORD))).filter(F.col("n") >= LEAST_TOKENS)
        .withColumn("line", F.regexp_replace("line", "[0-9]+", VARIABLE))
        .select("doc_id", "text_key", "content", "place", "n", F.xxhash64("line").alias("line"),
                F.xxhash64("n", *[F.regexp_extract("line", start, k + 1) for k in range(DEPTH)]).alias("leaf")), "templates-lines")
    leaves = lines.groupBy("leaf", "n", "content").agg(F.lit(1).alias("one")).groupBy("leaf", "n").agg(F.count("*").alias("contents"))
    leaves = stored(leaves.filter(F.col("contents") >= _needed(whole)).select("leaf", _needed(whole).alias("needed")), "templates-leaves")
    held = stored(lines.join(leaves, "leaf").select("doc_id", "text_key", "content", "place", "leaf", "line"), "templates-held")

    each = held.groupBy("leaf", "line", "content").agg(F.min(F.struct("text_key", "place")).alias("at")).groupBy("leaf", "line").agg(
        F.count("*").alias("contents"), F.min("at").alias("at"))
    each = stored(each.select("leaf", "line", "contents", "at.text_key", "at.place"), "templates-each")
    tokens = stored(_tokens(known, each).select("leaf", "line", "contents", F.posexplode("tokens").alias("at", "token")), "templates-tokens")
    constant = stored(
        tokens.groupBy("leaf", "at", "token").agg(F.sum("contents").alias("support")).join(leaves, "leaf")
        .filter(F.col("support") >= F.col("needed")).drop("support", "needed"), "templates-constant")
    named = constant.withColumn("constant", F.lit(True))
    templates = (
        tokens.join(named, ["leaf", "at", "token"], "left")
        .withColumn("token", F.when(F.col("constant") & (F.col("token") != VARIABLE), F.col("token")))
        .groupBy("leaf", "line")
        .agg(F.sort_array(F.collect_list(F.struct("at", F.coalesce("token", F.lit(VARIABLE)).alias("token")))).alias("parts"),
             F.count("token").alias("n_constant"), F.count("*").alias("n"))
        .filter(F.col("n_constant") >= LEAST_CONSTANT * F.col("n"))
        .select("leaf", "line", F.xxhash64("leaf", F.array_join(F.col("parts.token"), " ")).alias("template"))
    )
    named = stored(templates.join(leaves, "leaf"), "templates-named")
    found = stored(held.join(named, ["leaf", "line"]).select("doc_id", "text_key", "content", "place", "template", "needed"), "templates-found")
    if whole:
        counted = (
            found.groupBy("template", "needed", "text_key").agg(F.lit(1).alias("one")).join(stored(_unlike(known, found), "templates-unlike"), "text_key")
            .withColumn("content", F.when(F.col("own") >= F.when(F.col("needed") < LEAST_DOCUMENTS, NEAR_SHARE).otherwise(OWN_SHARE), F.col("text_key")).otherwise(F.col("leader")))
        )
        recurring = (
            counted.groupBy("template", "needed", "content").agg(F.lit(1).alias("one")).groupBy("template", "needed").agg(F.count("*").alias("contents"))
            .filter(F.col("contents") >= F.col("needed")).select("template")
        )
        return found.join(recurring, "template").groupBy("doc_id", "text_key").agg(F.collect_set("place").alias("lines"))
    recurring = (
        found.groupBy("template", "content").agg(F.count_distinct("doc_id", "text_key").alias("documents"))
        .groupBy("template").agg(F.count("*").alias("contents"), F.sum("documents").alias("documents"))
        .filter((F.col("contents") >= LEAST_DOCUMENTS) & (F.col("contents") >= LEAST_SHARE * F.col("documents")))
        .select("template")
    )
    return found.join(recurring, "template").groupBy("doc_id", "text_key").agg(F.collect_set("place").alias("lines"))


def drop_recurring(docs: DataFrame, whole: bool = False) -> DataFrame:
    """``docs`` with the recurring lines taken out of ``text``, and two new columns, ``n_lines`` and ``n_dropped``.

    All columns are kept, but ``n_lines`` and ``n_dropped``, which are replaced. A document whose lines all recur stays, with an empty text; NULL texts stay NULL
    (0 lines), an empty text is one line. Repeated rows are treated alike; NULL ids too. An empty table gives no rows. ``whole``: see ``recurring_lines``.
    """
    own = [f"drop_{uuid.uuid4().hex}_{c}" for c in ("id", "key", "lines")]
    found = stored(recurring_lines(docs, whole), "templates-drops").toDF(*own)
    drop_id, drop_key, drop_lines = map(F.col, own)
    split = F.split("text", "\n")
    kept = F.array_join(F.filter(split, lambda x, i: ~F.array_contains(drop_lines, i)), "\n")
    return (
        docs.join(found, F.col("doc_id").eqNullSafe(drop_id) & (F.xxhash64("text") == drop_key), "left")
        .withColumns({
            "n_lines": F.when(F.col("text").isNull(), 0).otherwise(F.size(split)).cast("long"),
            "n_dropped": F.coalesce(F.size(drop_lines), F.lit(0)).cast("long"),
            "text": F.when(drop_lines.isNull(), F.col("text")).otherwise(kept),
        })
        .select(*[c for c in docs.columns if c not in ("n_lines", "n_dropped")], "n_lines", "n_dropped")
    )
