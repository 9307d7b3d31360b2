"""Lines that occur again, equal or with one character more, less or other, by a deletion-neighbourhood join.

All of this is DataFrame code. A line's variants are the line itself and the line without each one of its characters.
Of two lines within one edit, either both give the same variant by taking out the character in the same place, or one
gives the other. So equal hashed variants are joined, the earliest line of each is found, and its edit distance is
verified.

Only what may have a partner emits variants. One edit leaves the first or the last part of a line as it is, so a line
enters with hashes of such parts, of the lengths that a partner one character longer or shorter also takes. Where no
other line has the part there is no partner. What is behind a shared beginning, or before a shared end, is halved in
the same way once more, and where more than ``LEFT_CHARS`` are left again and again, each time only what has a partner.
Variants are emitted of what is left then, so a line of any length has few.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablemill.llm.common import text_hash, written

#: Variants are emitted of at most so many characters of a line, and one.
LEFT_CHARS = 96

_LAST_ID = (1 << 63) - 1
_PLACE = ("_d", "_h", "pos")


def _part_length(n: Column) -> Column:
    """The largest power of two that is at most (n - 1) / 2: one edit of n characters leaves a beginning or an end of
    that length. 0 for fewer than three characters."""
    return F.when(n >= 3, F.pow(F.lit(2.0), F.floor(F.log2((n - 1) / 2))).cast("int")).otherwise(0)


def _lengths(n: Column) -> Column:
    """The lengths of parts that a text of ``n`` characters may share with a partner."""
    return F.array_distinct(F.array(_part_length(n - 1), _part_length(n), _part_length(n + 1)))


def _parts(text: Column, known: Column) -> Column:
    """Hashes of the beginnings (side 0) and ends (side 1) that a partner within one edit may share, side by side for
    each length, with ``known`` (what is shared already) in them."""
    return F.flatten(
        F.transform(
            _lengths(F.length(text)),
            lambda p: F.array(
                F.xxhash64(known, F.lit(0), p, F.left(text, p)), F.xxhash64(known, F.lit(1), p, F.right(text, p))
            ),
        )
    )


def _side_by_side(rows: DataFrame, columns: list[str], parts: Column, n: Column) -> DataFrame:
    """A row per part: ``columns``, ``side``, ``p`` (the part's length) and ``part``."""
    each = rows.select(*columns, n.alias("_n"), F.posexplode(parts).alias("_at", "part"))
    p = F.get(_lengths(F.col("_n")), F.floor(F.col("_at") / 2).cast("int"))
    return each.select(*columns, (F.col("_at") % 2).alias("side"), p.alias("p"), "part")


def _left_over(text: str) -> Column:
    """The text without the shared part that ``side`` and ``p`` tell."""
    c, p = F.col(text), F.col("p")
    return F.when(F.col("side") == 0, F.substring(c, p + 1, F.length(c))).otherwise(F.left(c, F.length(c) - p))


def _with_partner(rows: DataFrame) -> DataFrame:
    """The rows whose ``part`` another row has too. Rows are of different lines, and the parts of a line differ."""
    shared = rows.groupBy("part").agg(F.count("*").alias("n")).where("n > 1")
    return rows.join(shared.select("part"), "part", "left_semi")


def _texts(docs: DataFrame) -> DataFrame:
    """Document keys, in whose order lines are earlier or later, and whole rows."""
    return docs.select(
        F.coalesce("doc_id", F.lit(_LAST_ID)).alias("_d"), text_hash(F.col("text")).alias("_h"), F.struct("*").alias("row")
    )


def _whole(joined: DataFrame, other: str) -> DataFrame:
    """The same rows. The condition, true for all, reads the whole document row beside a column of the other side: so
    both joins with the documents need the same columns of them and read one shuffle."""
    return joined.where(F.xxhash64("row", other) >= F.lit(-(1 << 63)))


def _narrowed(rests: DataFrame) -> DataFrame:
    """``_d, _h, pos, part, rest``: rests halved once, and then until they have at most ``LEFT_CHARS``, with the hash of
    all that was taken off. Only rests that share a further part with another one are halved further. Those of one
    character more than ``LEFT_CHARS`` are given and halved, as their partners may be on either side. Each round is
    written; a round takes off a quarter at the least, so there are as many as the longest line needs."""
    spark, short, first = rests.sparkSession, F.length("rest") <= LEFT_CHARS + 1, True
    found = None
    while first or not rests.isEmpty():
        parts = _parts(F.col("rest"), F.col("half"))
        halved = _side_by_side(rests.withColumnRenamed("part", "half"), [*_PLACE, "rest"], parts, F.length("rest"))
        left = _with_partner(halved).select(*_PLACE, "part", _left_over("rest").alias("rest")).distinct()
        left = written(spark, left, "rests")
        found = left.where(short) if found is None else found.union(left.where(short))
        rests, first = left.where(F.length("rest") > LEFT_CHARS), False
    return found


def _near_lines(rows: DataFrame, firsts: DataFrame) -> DataFrame:
    """``_d, _h, pos`` of first occurrences that come after a line within one edit."""
    long = firsts.where(F.size("parts") > 0).select("first.*", "parts", "n")
    halves = _with_partner(_side_by_side(long, [*_PLACE], F.col("parts"), F.col("n")))
    line = F.trim(F.get(F.split("row.text", "\n"), F.col("pos"))).alias("line")
    lines = _whole(halves.join(rows, ["_d", "_h"]), "pos").select(*_PLACE, "side", "p", "part", line)
    left = _narrowed(lines.select(*_PLACE, "part", _left_over("line").alias("rest")))

    variant = F.transform(
        F.sequence(F.lit(0), F.length("rest")),
        lambda i: F.struct(
            i.alias("out"),
            F.xxhash64("part", F.concat(F.left("rest", i), F.substring(F.col("rest"), i + 2, F.length("rest")))).alias(
                "variant"
            ),
        ),
    )  # the last one takes out nothing
    place, whole = F.struct(*_PLACE), F.col("out") == F.length("rest")
    emitted = left.select("rest", place.alias("place"), "part", F.inline(variant)).select(
        "part",
        "variant",
        "out",
        F.when(whole, F.col("place")).alias("of_whole"),
        F.when(~whole, F.col("place")).alias("of_shorter"),
    )
    # Lines that share (part, variant, out) differ in that one character; those that share a variant otherwise are
    # within one edit if one of them is whole. Groups are no larger than the alphabet times the length left over.
    # The first window's order serves the second.
    same = Window.partitionBy("part", "variant", "out")
    equal = Window.partitionBy("part", "variant")
    met = emitted.withColumn("changed", F.min("of_shorter").over(same))
    met = met.withColumn("longer", F.min("of_shorter").over(equal)).withColumn("shorter", F.min("of_whole").over(equal))
    partner = F.when(F.col("of_whole").isNotNull(), F.col("longer")).otherwise(F.least("shorter", "changed"))
    earlier = met.select(F.coalesce("of_whole", "of_shorter").alias("place"), "part", partner.alias("partner"))
    earlier = earlier.where("partner < place").select("place.*", "part", "partner").distinct()
    own = left.withColumnRenamed("rest", "own")
    others = left.select(F.struct(*_PLACE).alias("partner"), "part", F.col("rest").alias("other"))
    verified = earlier.join(own, [*_PLACE, "part"]).join(others, ["partner", "part"])
    return verified.where(F.levenshtein("own", "other") <= 1).select(*_PLACE).distinct()


def without_repeated_lines(docs: DataFrame, min_chars: int = 0) -> DataFrame:
    """For each row of ``docs``: ``row`` (all its columns), ``n_lines``, ``n_removed`` and ``kept``, the text of the
    lines left (null for null texts).

    Lines are compared without blanks around them and end at line feeds; lines of blanks only stay. Lines are in order
    of document id (null ids last), the text's hash, and their number. A line goes if an earlier one equals it, or if
    its first occurrence comes after that of a line within one edit, however long it is; lines shorter than
    ``min_chars`` have to be equal. Rows that repeat id and text are one document here and keep the same lines. An empty
    table gives no rows.
    """
    rows = _texts(docs)
    cut = rows.select("_d", "_h", F.posexplode(F.split(F.coalesce("row.text", F.lit("")), "\n")).alias("pos", "raw"))
    cut = cut.select(*_PLACE, F.trim("raw").alias("line")).where("line != ''")
    near = F.length("line") >= min_chars
    keyed = cut.select(
        F.unhex(F.md5("line")).alias("line_key"),
        F.struct(*_PLACE).alias("place"),
        F.when(near, _parts(F.col("line"), F.lit(0))).alias("parts"),
        F.length("line").alias("n"),
    )
    firsts = keyed.groupBy("line_key").agg(
        F.min("place").alias("first"), F.first("parts").alias("parts"), F.first("n").alias("n")
    )
    # Written, as several jobs read them.
    firsts = written(docs.sparkSession, firsts.drop("line_key"), "first-lines")

    first_lines = firsts.select("first.*").groupBy("_d", "_h").agg(F.collect_set("pos").alias("firsts"))
    near_lines = _near_lines(rows, firsts).groupBy("_d", "_h").agg(F.collect_set("pos").alias("near"))
    joined = _whole(rows.join(first_lines, ["_d", "_h"], "left"), "firsts").join(near_lines, ["_d", "_h"], "left")

    none = F.array().cast("array<int>")
    lines = F.split("row.text", "\n")
    numbered = joined.withColumn("_lines", lines)
    blank = F.filter(
        F.sequence(F.lit(0), F.size("_lines") - 1), lambda i: F.trim(F.get(F.col("_lines"), i)) == ""
    )
    stays = F.array_union(F.array_except(F.coalesce("firsts", none), F.coalesce("near", none)), blank)
    numbered = numbered.withColumn("_stays", F.when(F.col("row.text").isNotNull(), F.array_sort(stays)))
    kept = F.array_join(F.transform("_stays", lambda i: F.get(F.col("_lines"), i)), "\n")
    n_lines = F.when(F.col("row.text").isNull(), 0).otherwise(F.size("_lines"))
    gone = n_lines - F.coalesce(F.when(F.col("_stays").isNotNull(), F.size("_stays")), F.lit(0))
    return numbered.select(
        "row", n_lines.cast("bigint").alias("n_lines"), gone.cast("bigint").alias("n_removed"), kept.alias("kept")
    )
