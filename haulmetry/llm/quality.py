"""Quality rules whose thresholds follow the corpus.

Measures are taken natively, in one pass over the texts. Quantiles of four ratios come from mergeable
KLL sketches per language and source, merged again per language and over all for groups that are too
small to speak for themselves. A ratio outside its group's fence rejects the document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from haulmetry.llm.common import staged, text_or_empty, words_of

SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MAX_REPEATED_PERCENT = 50
#: Ratio -> least width of its fence, so that an even group has one too.
SPREADS = {"word_length": 0.5, "symbol_ratio": 0.01, "dup_line_ratio": 0.1, "repeat_ratio": 0.1}
#: Ratios -> quantiles whose distance is the width, and how many widths the fence lies outside them. Most
#: texts repeat nothing, so repetition is judged by its group's upper end, and its lower fence is not met.
WIDTHS = {("word_length", "symbol_ratio"): (0.25, 0.75, 5.0), ("dup_line_ratio", "repeat_ratio"): (0.5, 0.95, 1.0)}
MIN_GROUP = 30
SKETCH_K = 2048


def _trigrams(words: Column) -> Column:
    """A hash for each run of three words."""
    return F.when(
        F.size(words) >= 3,
        F.transform(
            F.sequence(F.lit(0), F.size(words) - 3),
            lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)),
        ),
    ).otherwise(F.array().cast("array<bigint>"))


def _repeated(runs: Column) -> Column:
    """Positions, in order, of runs that occur twice or more: equal runs are neighbours once sorted."""
    last = F.size(runs) - 1
    twice = F.filter(
        runs,
        lambda x, k: ((k > 0) & (F.get(runs, k - 1)["run"] == x["run"]))
        | ((k < last) & (F.get(runs, k + 1)["run"] == x["run"])),
    )
    return F.sort_array(F.transform(twice, lambda x: x["at"]))


def with_measures(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` as one struct column ``row``, and ``m``, the measures of its text.

    The struct keeps whatever columns the input has apart from those made here. A null text counts
    as empty: no words, all counts 0.
    """
    t, w = F.col("t"), F.col("w")
    spaceless = F.translate(t, " \t\n\x0b\x0c\r", "")
    lines = F.filter(F.split(t, "\n"), lambda x: F.length(F.translate(x, " \t\x0b\x0c\r", "")) > 0)
    one = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), text_or_empty(text).alias("t"))
    two = one.select(
        "row",
        words_of(t).alias("w"),
        lines.alias("l"),
        F.length(spaceless).cast("bigint").alias("word_chars"),
        (F.length(t) - F.length(F.translate(t, SYMBOLS, ""))).cast("bigint").alias("n_symbols"),
    )
    three = two.select(
        "row",
        F.size(w).cast("bigint").alias("n_words"),
        F.size("l").cast("bigint").alias("n_lines"),
        (F.size("l") - F.size(F.array_distinct("l"))).cast("bigint").alias("n_dup_lines"),
        "word_chars",
        "n_symbols",
        _trigrams(w).alias("g"),
    )
    sorted_runs = F.sort_array(
        F.arrays_zip(F.col("g").alias("run"), F.sequence(F.lit(0), F.size("g") - 1).alias("at"))
    )
    none = F.array().cast("array<struct<run:bigint,at:int>>")
    four = three.withColumn(
        "runs", F.when(F.size(F.array_distinct("g")) < F.size("g"), sorted_runs).otherwise(none)
    ).drop("g")
    five = four.withColumn("at", _repeated(F.col("runs"))).drop("runs")
    at = F.col("at")
    steps = F.transform(at, lambda x, k: F.least(F.lit(3), F.coalesce(F.get(at, k + 1) - x, F.lit(3))))
    six = five.withColumn(
        "n_repeat_words", F.aggregate(steps, F.lit(0), lambda a, x: a + x).cast("bigint")
    )
    n, chars = F.col("n_words"), F.col("word_chars")
    ratio = lambda a, b: F.when(b > 0, a / b).otherwise(F.lit(0.0))
    return six.select(
        "row",
        F.struct(
            n,
            chars,
            "n_symbols",
            "n_dup_lines",
            "n_repeat_words",
            ((n < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * n)).alias("base_failed"),
            ratio(chars, n).alias("word_length"),
            ratio(F.col("n_symbols"), chars).alias("symbol_ratio"),
            ratio(F.col("n_dup_lines"), F.col("n_lines")).alias("dup_line_ratio"),
            ratio(F.col("n_repeat_words"), n).alias("repeat_ratio"),
        ).alias("m"),
    )


def fences(measures: DataFrame, min_group: int = MIN_GROUP) -> DataFrame:
    """Lower and upper fence of each ratio, per language and source.

    ``measures`` has ``lang``, ``source`` and ``m``; null languages and sources are groups of their
    own. Only documents that pass the base rules are sketched. A group with fewer than ``min_group``
    of them takes the merged sketches of its language, and a language with fewer those of all
    documents. Without any such document there is no fence, and nothing more is rejected.
    A fence lies so many times the distance of two quantiles (``WIDTHS``), or the ratio's least width,
    outside them. Null and empty texts fail the base rules; an empty table has no groups and no fences.
    """
    kept = F.when(~F.col("m.base_failed"), True)
    groups = measures.groupBy("lang", "source").agg(
        F.count(kept).alias("n"),
        *[F.kll_sketch_agg_double(F.when(kept, F.col(f"m.{r}")), F.lit(SKETCH_K)).alias(r) for r in SPREADS],
    )
    groups = staged(groups, "sketches")
    some = groups.where("n > 0")
    merged = [F.sum("n").alias("n"), *[F.kll_merge_agg_double(r, F.lit(SKETCH_K)).alias(r) for r in SPREADS]]

    def cut(level: DataFrame, name: str, *keys: str) -> DataFrame:
        found = []
        for ratios, (*at, reach) in WIDTHS.items():
            for r in ratios:
                low, high = (F.kll_sketch_get_quantile_double(r, F.lit(p)) for p in at)
                width = reach * F.greatest(high - low, F.lit(SPREADS[r]))
                found.append(F.struct((low - width).alias("low"), (high + width).alias("high")).alias(r))
        return level.select(*keys, F.struct(F.col("n"), *found).alias(name))

    own, per_lang = cut(some, "own", "lang", "source"), cut(some.groupBy("lang").agg(*merged), "per_lang", "lang")
    whole = cut(some.agg(*merged).where("n > 0"), "whole")
    kind = whole.schema["whole"].dataType.simpleString()
    row = whole.select(F.to_json("whole")).first()  # one row of nine numbers
    keys = groups.select("lang", "source").alias("k")
    same = lambda c: F.col(f"k.{c}").eqNullSafe(F.col(f"o.{c}"))
    joined = (
        keys.join(own.alias("o"), same("lang") & same("source"), "left")
        .select("k.lang", "k.source", "own")
        .alias("k")
        .join(per_lang.alias("o"), same("lang"), "left")
        .select("k.lang", "k.source", "own", "per_lang", F.from_json(F.lit(row[0] if row else None), kind).alias("whole"))
    )
    chosen = (
        F.when(F.col("own.n") >= min_group, F.col("own"))
        .when(F.col("per_lang.n") >= min_group, F.col("per_lang"))
        .otherwise(F.col("whole"))
    )
    return staged(joined.select("lang", "source", chosen.alias("fence")), "fences")


def judged(measured: DataFrame, limits: DataFrame) -> DataFrame:
    """``measured`` (``lang``, ``source``, ``m`` and others) with the verdict ``kept`` and the ratios that broke it."""
    joined = measured.alias("d").join(
        limits.alias("f"),
        F.col("d.lang").eqNullSafe(F.col("f.lang")) & F.col("d.source").eqNullSafe(F.col("f.source")),
        "left",
    )
    outside = lambda r: F.coalesce(
        (F.col(f"m.{r}") < F.col(f"fence.{r}.low")) | (F.col(f"m.{r}") > F.col(f"fence.{r}.high")), F.lit(False)
    )
    broken = F.array_compact(F.array(*[F.when(outside(r), F.lit(r)) for r in SPREADS]))
    return joined.select("d.*", broken.alias("broken")).withColumn(
        "kept", ~F.col("m.base_failed") & (F.size("broken") == 0)
    )


def _grouped(docs: DataFrame, text: str, lang: str, source: str, name: str, slim: list[str] | None) -> DataFrame:
    measured = with_measures(docs, text)
    rows = F.struct(*[F.col(f"row.{c}").alias(c) for c in slim]) if slim is not None else F.col("row")
    return staged(
        measured.select(
            F.col(f"row.{lang}").alias("lang"), F.col(f"row.{source}").alias("source"), "m", rows.alias("row")
        ),
        name,
    )


def quality_report(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", source: str = "source"
) -> DataFrame:
    """Measures and verdict of each document, one row per input row, repeated rows included.

    Null and empty texts have no words and fail; an empty table gives no rows.
    """
    measured = _grouped(docs, text, lang, source, "measures", [doc_id])
    return judged(measured, fences(measured)).select(F.col(f"row.{doc_id}").alias(doc_id), "m.*", "broken", "kept")


def keep_good(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """The documents that pass, with their own columns; texts are read and measured once."""
    measured = _grouped(docs, text, lang, source, "measured", None)
    return judged(measured, fences(measured)).where("kept").select("row.*")
