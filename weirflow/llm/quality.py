"""Quality rules with thresholds that follow the data; DataFrame functions only.

A text first meets fixed base rules. Texts that pass them feed quantile sketches of four rates for each
language and source. A sketch is a histogram whose buckets keep the six leading binary digits of a value, so
a quantile is at most 1/32 too low. Sketches merge by adding counts: they are counted partially before the
shuffle, merged from language and source to language and to all texts, and come out the same in any order.

A group's sketch is mixed with that of its language, as if it had ``prior_rows`` more texts of the language's
usual kind, and a language's with that of all texts likewise. So a small group follows its language and a large
one itself, without a step between. A text is kept if each of its rates lies no further outside the middle 96 %
of its group than that reaches from the median; one symbol, one line or one window is never too much by itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weirflow.llm.common import stored

MIN_WORDS = 50
# The share of a group that lies beyond its outer quantiles, on each side: one part in so many.
TAIL = 50
# So many texts of the usual kind are mixed in; it takes as many to have one beyond the outer quantile.
PRIOR_ROWS = TAIL
# Sketches are mixed in millionths of a text.
UNIT = 1_000_000
# What a single symbol, repeated line or repeated window adds to the count of a rate; word length has no such event.
EVENT = {"symbols": 1, "dup_lines": 1, "repeats": 6, "word_length": 0}
_SPACE = "[ \t-\r]+"
_SAME = "shiftright(a, _bits) = shiftright(b, _bits)"
_PLACE = "& (shiftleft(1L, _bits) - 1)"


def measures(docs: DataFrame) -> DataFrame:
    """``(doc_id, lang, source, n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words)`` per row.

    Words lie between ASCII white space; a null text has none. ``n_lines`` counts the lines that have a
    word, ``n_dup_lines`` those among them that equal an earlier line, and ``n_repeat_words`` the words in
    three-word windows that the text has twice or more. Windows with equal hashes are compared word by word.
    """
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(
        "doc_id",
        *[F.col(c) if c in docs.columns else F.lit(None).cast("string").alias(c) for c in ("lang", "source")],
        F.filter(F.split(text, _SPACE, -1), lambda w: w != "").alias("_words"),
        F.filter(F.split(text, "\n", -1), lambda x: x.rlike("[^ \t-\r]")).alias("_lines"),
        F.char_length(F.regexp_replace(text, r"[^#*$%&|<>]+", "")).cast("bigint").alias("n_symbols"),
    )
    counted = rows.select(
        "doc_id",
        "lang",
        "source",
        "n_symbols",
        F.size("_words").cast("bigint").alias("n_words"),
        F.char_length(F.array_join("_words", "")).cast("bigint").alias("word_chars"),
        F.size("_lines").cast("bigint").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("bigint").alias("n_dup_lines"),
        "_words",
        F.transform("_words", lambda w: F.xxhash64(w)).alias("_hashes"),
        F.length(F.bin(F.size("_words"))).alias("_bits"),
    )
    # A window is its hash, cut to make room, with its place in the low bits: sorting brings equal ones together.
    window = "shiftleft(shiftrightunsigned(xxhash64(get(_hashes, i), get(_hashes, i + 1), get(_hashes, i + 2)), _bits + 1), _bits) | i"
    sorted_windows = F.when(
        F.col("n_words") >= 3, F.expr(f"sort_array(transform(sequence(0, cast(n_words as int) - 3), i -> {window}))")
    ).otherwise(F.array().cast("array<bigint>"))
    windows = counted.withColumn("_windows", sorted_windows).drop("_hashes")

    def next_to(array: str, same: str, a: str, b: str) -> Column:
        """What stands beside its like in a sorted array."""
        pairs = f"zip_with(slice({array}, 1, greatest(size({array}) - 1, 0)), slice({array}, 2, greatest(size({array}) - 1, 0)), (a, b) -> "
        return F.expr(f"array_union(array_compact({pairs} if({same}, {a}, null))), array_compact({pairs} if({same}, {b}, null))))")

    windows = counted.withColumn("_windows", sorted_windows).drop("_hashes")
    alike = windows.withColumn("_alike", next_to("_windows", _SAME, f"cast(a {_PLACE} as int)", f"cast(b {_PLACE} as int)")).drop("_windows")
    spelt = "struct(get(_words, p) as u, get(_words, p + 1) as v, get(_words, p + 2) as w, p as p)"
    spelt = alike.withColumn("_spelt", F.expr(f"sort_array(transform(_alike, p -> {spelt}))")).drop("_alike", "_words")
    twice = spelt.withColumn("_twice", next_to("_spelt", "a.u = b.u and a.v = b.v and a.w = b.w", "a.p", "b.p")).drop("_spelt")
    covered = "size(array_union(array_union(_twice, transform(_twice, p -> p + 1)), transform(_twice, p -> p + 2)))"
    return twice.withColumn("n_repeat_words", F.expr(covered).cast("bigint")).drop("_twice", "_bits")


def base_failed(n_words: Column, n_repeat_words: Column) -> Column:
    return (n_words < MIN_WORDS) | (100 * n_repeat_words > 50 * n_words)


def _rates(without_event: bool = False) -> dict[str, Column]:
    """Whole-number rates of a text that has words, also without one event of each."""

    def per(rate: str, part: str, whole: str, scale: int) -> Column:
        count = f"greatest({part} - {EVENT[rate]}, 0)" if without_event else part
        return F.expr(f"{count} * {scale} div nullif({whole}, 0)")

    return {
        "symbols": per("symbols", "n_symbols", "word_chars", 10_000),
        "dup_lines": per("dup_lines", "n_dup_lines", "n_lines", 10_000),
        "repeats": per("repeats", "n_repeat_words", "n_words", 10_000),
        "word_length": per("word_length", "word_chars", "n_words", 100),
    }


def _dropped(value: Column) -> Column:
    """How many low binary digits a bucket leaves out."""
    return F.greatest(F.length(F.bin(value)) - 6, F.lit(0))


def _bucket(value: Column) -> Column:
    """The smallest value of the bucket: all but the six leading binary digits are zero."""
    return F.call_function("shiftleft", F.call_function("shiftright", value, _dropped(value)), _dropped(value))


def _bucket_end(bucket: Column) -> Column:
    """The largest value of a bucket."""
    return bucket + F.call_function("shiftleft", F.lit(1).cast("bigint"), _dropped(bucket)) - 1


def sketches(measured: DataFrame) -> DataFrame:
    """``(lang, source, rate, bucket, n)``: a sketch of each rate for each language and source."""
    rates = F.array(*[F.struct(F.lit(k).alias("rate"), v.alias("value")) for k, v in _rates().items()])
    each = measured.select("lang", "source", F.explode(rates).alias("r"))
    return each.groupBy("lang", "source", F.col("r.rate").alias("rate"), _bucket(F.col("r.value")).alias("bucket")).agg(
        F.count("*").alias("n")
    )


def _mixed(sketch: DataFrame, keys: list[str], prior: DataFrame, prior_rows: int) -> DataFrame:
    """``(*keys, rate, bucket, weight, total)``: sketches merged over all columns but ``keys`` and mixed with ``prior``.

    ``prior`` (some of ``keys``, ``rate``, ``bucket``, ``share``) has the shares of what is above a group.
    """
    above = [k for k in keys if k in prior.columns]
    own = sketch.groupBy(*keys, "rate", "bucket").agg((UNIT * F.sum("n")).alias("weight"))
    groups = own.select(*keys, "rate").distinct().alias("g")
    same = F.col("g.rate") == F.col("p.rate")
    for k in above:
        same = same & F.col(f"g.{k}").eqNullSafe(F.col(f"p.{k}"))
    given = groups.join(prior.alias("p"), same).select("g.*", "p.bucket", (prior_rows * F.col("p.share")).alias("weight"))
    both = own.unionByName(given).groupBy(*keys, "rate", "bucket").agg(F.sum("weight").alias("weight"))
    return both.withColumn("total", F.sum("weight").over(Window.partitionBy(*keys, "rate")))


def _shares(mixed: DataFrame) -> DataFrame:
    """``mixed`` with the share of each bucket in place of its weight, in millionths."""
    return mixed.withColumn("share", F.expr(f"weight div (total div {UNIT})")).drop("weight", "total")


def thresholds(sketch: DataFrame, prior_rows: int = PRIOR_ROWS) -> DataFrame:
    """``(lang, source, <rate>_low, <rate>_high ...)``: the fences of each language and source.

    ``prior_rows`` is at least 0; with 0 each group follows its own sketch alone.
    """
    whole = sketch.groupBy("rate", "bucket").agg((UNIT * F.sum("n")).alias("weight"))
    of_all = _shares(whole.withColumn("total", F.sum("weight").over(Window.partitionBy("rate"))))
    of_lang = stored(_shares(_mixed(sketch, ["lang"], of_all, prior_rows)))
    keys = ["lang", "source", "rate"]
    own = _mixed(sketch, keys[:2], of_lang, prior_rows)
    ranked = own.withColumn("up_to", F.sum("weight").over(Window.partitionBy(*keys).orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)))

    def least(rank: str) -> Column:
        return F.min(F.when(F.expr(f"up_to >= {rank}"), F.col("bucket")))

    found = ranked.groupBy(*keys).agg(
        least(f"total div {TAIL}").alias("bottom"), least("total div 2").alias("middle"), least(f"total - total div {TAIL}").alias("top")
    )
    low = F.greatest(2 * F.col("bottom") - _bucket_end(F.col("middle")), F.lit(0))
    high = 2 * _bucket_end(F.col("top")) - F.col("middle")
    fences = found.select(*keys, low.alias("low"), high.alias("high"))
    sides = [F.max(F.when(F.col("rate") == rate, F.col(side))).alias(f"{rate}_{side}") for rate in EVENT for side in ("low", "high")]
    return fences.groupBy("lang", "source").agg(*sides)


def judge(docs: DataFrame, prior_rows: int = PRIOR_ROWS) -> DataFrame:
    """``(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept)`` per row.

    Reads ``text``, ``lang`` and ``source``; the last two may be missing or null, and null is a group like
    any other. A null, empty or blank text fails the base rules. Repeated rows count as often as they occur
    and have equal rows. An empty table has no thresholds and no rows.
    """
    failed = base_failed(F.col("n_words"), F.col("n_repeat_words"))
    measured = stored(measures(docs).withColumn("base_failed", failed))
    fences = stored(thresholds(sketches(measured.where("not base_failed")), prior_rows))
    same = F.col("m.lang").eqNullSafe(F.col("f.lang")) & F.col("m.source").eqNullSafe(F.col("f.source"))
    inside = F.lit(True)
    for rate, value in _rates(without_event=True).items():
        within = value.between(F.col(f"{rate}_low"), F.col(f"{rate}_high"))
        inside = inside & (within if rate == "word_length" else value <= F.col(f"{rate}_high"))
    kept = F.when(F.col("base_failed"), False).otherwise(F.coalesce(inside, F.lit(False)))
    return measured.alias("m").join(fences.alias("f"), same, "left").select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", kept.alias("kept")
    )
