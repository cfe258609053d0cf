"""Line dedup across documents by a deletion-neighbourhood join; DataFrame functions only.

Two lines are the same if they are equal or at most one character apart (an insertion, a deletion or a
replacement), without the spaces at their ends. Of all such lines the earliest
occurrence stays: an occurrence goes if its line occurs earlier, or if a line within the bound has an
earlier first occurrence.

* A line is cut into blocks. One edit leaves all blocks but one as they are, counted from the left before
  the edit and from the right behind it. So a line has a key for each block: a hash of all that surrounds
  it. Only where two different lines share a key can they be within the bound, and then the edit lies in the
  span that the key leaves out.
* Such a line emits its deletion neighbourhood over that span, as hashed keys: the span less its k-th
  character, once together with k and once without, and the whole span. Lines that share a variant with the
  same k differ by a replacement there; a line whose whole span is another's variant lacks a character. So
  every member of a group is within the bound of its centre, and the earliest one is compared with the
  others only: groups are linear, never all pairs. An edit distance of each pair confirms it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weirflow.llm.common import stored

# Lines below this length have no near copies, only equal ones: one character of a few is not a slip.
NEAR_FROM = 17
# Lines of 17 and 16 characters have blocks of equal size, and so on: both ends of an insertion share keys.
# Blocks are about as long as _BLOCK, longer where a line would have more than _MOST of them.
_STEP, _BLOCK, _MOST = 16, 128, 16
_ROUNDED = f"(m div {_STEP} * {_STEP})"
_COUNT = f"cast(least({_MOST}, greatest(2, ({_ROUNDED} + {_BLOCK - 1}) div {_BLOCK})) as int)"
_SIZES = f"array_distinct(transform(array(_n, _n - 1), m -> named_struct('b', {_COUNT}, 'q', cast({_ROUNDED} div {_COUNT} as int))))"
_KEY = """xxhash64(k, s.q, substring(_norm, 1, k * s.q),
                  substring(_norm, _n - (s.b - 1 - k) * s.q + 1, (s.b - 1 - k) * s.q))"""
_KEYS = f"flatten(transform(_sizes, s -> transform(sequence(0, s.b - 1), k -> {_KEY})))"
_SPANS = f"""flatten(transform(_sizes, s -> transform(sequence(0, s.b - 1), k -> named_struct(
    'key', {_KEY}, 'start', k * s.q + 1, 'size', _n - (s.b - 1) * s.q))))"""
_WITHOUT = "concat(substring(_span, 1, i - 1), substring(_span, i + 1))"
_NONE = "cast(array() as array<struct<kind: string, v: bigint>>)"
_VARIANTS = f"""concat(
    if(_equal, transform(sequence(1, _at.size), i -> named_struct('kind', 'replaced', 'v', xxhash64(_at.key, i, {_WITHOUT}))), {_NONE}),
    if(_shorter, transform(array_distinct(transform(sequence(1, _at.size), i -> xxhash64(_at.key, -1, {_WITHOUT}))),
                           x -> named_struct('kind', 'longer', 'v', x)), {_NONE}),
    if(_longer, array(named_struct('kind', 'shorter', 'v', xxhash64(_at.key, -1, _span))), {_NONE}))"""


def _lines(docs: DataFrame) -> DataFrame:
    """One row per line that is not blank: ``_id, _text`` (a hash), ``_line``, ``_norm``, ``_h, _g`` (96 bits of hash)."""
    split = docs.where("text is not null").select(
        F.col("doc_id").alias("_id"), F.xxhash64("text").alias("_text"), F.posexplode(F.split("text", "\n", -1)).alias("_line", "_raw")
    )
    normal = split.select("_id", "_text", "_line", F.trim("_raw").alias("_norm"))
    return normal.where("_norm != ''").select("*", F.xxhash64("_norm").alias("_h"), F.hash("_norm").alias("_g"))


def _sized(lines: DataFrame) -> DataFrame:
    """``lines`` with their lengths and the numbers and lengths of blocks; none for lines without near copies."""
    sized = lines.withColumn("_n", F.char_length("_norm"))
    return sized.withColumn("_sizes", F.when(F.col("_n") >= NEAR_FROM, F.expr(_SIZES)).otherwise(F.array()))


def _near_copies(docs: DataFrame, lines: DataFrame, firsts: DataFrame) -> DataFrame:
    """``(_h, _g)`` of each line that has a near copy with an earlier first occurrence."""
    keyed = lines.select("_h", F.explode("_keys").alias("_key"))
    crowded = (
        keyed.groupBy("_key").agg(F.min("_h").alias("low"), F.max("_h").alias("high")).where("low != high").select("_key")
    )
    wanted = stored(keyed.join(crowded, "_key", "left_semi").groupBy("_h").agg(F.collect_set("_key").alias("_shared")))
    # The same join at every size: few wanted lines would be broadcast, and many not.
    texts = _sized(_lines(docs).join(wanted.hint("merge"), "_h").select("_h", "_g", "_norm", "_shared")).dropDuplicates(["_h", "_g"])
    ranked = stored(
        texts.join(firsts.select("_h", "_g", "_first"), ["_h", "_g"]).select(
            F.struct("_first", "_h", "_g").alias("_me"), "_norm", "_n", F.expr(f"filter({_SPANS}, x -> array_contains(_shared, x.key))").alias("_spans")
        )
    )
    # Of the lines that share a key, only those of equal length or one character more or less can be near.
    spans = ranked.select("_me", "_norm", "_n", F.explode("_spans").alias("_at"))
    around = spans.select(F.col("_at.key").alias("_key"), "_n", F.explode(F.array(F.lit(0), F.lit(-1), F.lit(1))).alias("_d"))
    lengths = around.groupBy("_key", (F.col("_n") + F.col("_d")).alias("_n")).agg(
        (F.count(F.when(F.col("_d") == 0, 1)) > 1).alias("_equal"),
        (F.count(F.when(F.col("_d") == 1, 1)) > 0).alias("_shorter"),
        (F.count(F.when(F.col("_d") == -1, 1)) > 0).alias("_longer"),
    )
    near = spans.withColumn("_key", F.col("_at.key")).join(lengths.where("_equal or _shorter or _longer"), ["_key", "_n"])
    near = near.select("_me", "_at", "_equal", "_shorter", "_longer", F.expr("substring(_norm, _at.start, _at.size)").alias("_span"))
    members = near.select("_me", F.explode(F.expr(_VARIANTS)).alias("_e")).select("_me", "_e.kind", "_e.v")
    group = Window.partitionBy("v")

    def earliest(kind: str) -> Column:
        return F.min(F.when(F.col("kind") == kind, F.col("_me"))).over(group)

    other = (
        F.when(F.col("kind") == "replaced", earliest("replaced"))
        .when(F.col("kind") == "longer", earliest("shorter"))
        .otherwise(earliest("longer"))
    )
    pairs = members.select("_me", other.alias("_other")).where("_other < _me").distinct()
    norm = ranked.select("_me", "_norm")
    return (
        pairs.join(norm, "_me")
        .join(norm.select(F.col("_me").alias("_other"), F.col("_norm").alias("_theirs")), "_other")
        .where(F.levenshtein("_norm", "_theirs", 1).between(0, 1))
        .select("_me._h", "_me._g")
        .distinct()
    )


def without_repeated_lines(docs: DataFrame) -> DataFrame:
    """``(doc, n_lines, n_removed)``: each row of ``docs`` as a struct, without the repeated lines in its ``text``.

    Occurrences are ordered by doc_id (a null one first), a hash of the text and the line's place. Blank
    lines are never repeated and stay. A null text stays null and has no lines; an empty text has one, blank
    line. A text that loses all its lines becomes empty. Rows that repeat both doc_id and text are one
    document: they lose the same lines. Every row of ``docs`` is kept, with all its columns.
    """
    lines = stored(_sized(_lines(docs)).select("_id", "_text", "_line", "_h", "_g", F.expr(_KEYS).alias("_keys")))
    place = F.struct("_id", "_text", "_line")
    firsts = stored(lines.groupBy("_h", "_g").agg(F.min(place).alias("_first"), F.count("*").alias("_count")))
    near = stored(_near_copies(docs, lines, firsts)).withColumn("_near", F.lit(True))
    judged = firsts.join(near, ["_h", "_g"], "left").where("_count > 1 or _near")
    gone = (
        lines.select("_id", "_text", "_line", "_h", "_g")
        .join(judged, ["_h", "_g"])
        .where(F.coalesce("_near", F.lit(False)) | (place != F.col("_first")))
        .groupBy("_id", "_text")
        .agg(F.collect_set("_line").alias("_gone"))
    )
    # The lines come apart before the join, so that they are an array there and not split again for each line.
    rest = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"]).alias("_rest")
    apart = docs.select(rest, F.split("text", "\n", -1).alias("_lines"), F.xxhash64("text").alias("_hash"))
    same = F.col("_rest.doc_id").eqNullSafe(F.col("_id")) & (F.col("_hash") == F.col("_text"))
    left = F.expr("array_except(sequence(0, size(_lines) - 1), _gone)")
    kept = F.when(F.col("_gone").isNull(), F.col("_lines")).otherwise(F.transform(left, lambda k: F.get("_lines", k)))
    return apart.join(gone, same, "left").select(
        F.struct(
            *[F.array_join(kept, "\n").alias("text") if c == "text" else F.col(f"_rest.`{c}`").alias(c) for c in docs.columns]
        ).alias("doc"),
        F.when(F.col("_lines").isNull(), 0).otherwise(F.size("_lines")).cast("bigint").alias("n_lines"),
        F.when(F.col("_gone").isNull(), 0).otherwise(F.size("_gone")).cast("bigint").alias("n_removed"),
    )


def dedup_lines(docs: DataFrame) -> DataFrame:
    """``docs`` without repeated lines, with the same columns; ``n_chars``, if there, counts the new text."""
    found = without_repeated_lines(docs).select("doc.*", F.col("n_removed").alias("_removed_now"))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        changed = F.when(F.col("_removed_now") > 0, F.char_length("text").cast(kind)).otherwise(F.col("n_chars"))
        found = found.withColumn("n_chars", changed)
    return found.select(*[F.col(f"`{c}`") for c in docs.columns])
