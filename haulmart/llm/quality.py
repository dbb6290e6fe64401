"""Quality rules with thresholds that follow the corpus.

Every document gets counts; fixed base rules take out what is surely no prose.
The ratios of the rest go into mergeable quantile sketches, one per language,
source and ratio: counts of the values with their lowest bits cut off, so
sketches merge by adding and a quantile is off by less than one part in 128,
whatever the order in which tasks finish. A group with few documents takes the
merged sketch of its language, and a language with few that of the corpus. A
threshold is the upper quartile and a multiple of the quartile distance, at
least a slack; mean word length has a lower threshold too.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from haulmart.llm.frames import bounded_batches, free_names, workspace
from haulmart.llm.text import WORD_SPACE, plain, slices, words

# Base rules, as the contract states them.
LEAST_WORDS = 50
MOST_REPEATED_PERCENT = 50
SYMBOLS = b"#*$%&|<>"
LEAST_DOCUMENTS = 50
REACH = 3
# Thousandths by which a value may always leave the quartiles: word length in code points per word,
# symbols and repeated words per word, repeated lines per line.
SLACK = {"word_length": 1000, "symbols": 150, "repeated_lines": 350, "repeated_words": 250}
RATIOS = tuple(SLACK)
COUNTS = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")
BROADCAST_GROUPS = 50_000


def per_text(flags: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums of flags over the bytes of each text."""
    total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return total[bounds[1:]] - total[bounds[:-1]]


def repeat_words(codes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Words of each text that lie in a window of three which the text has at least twice."""
    text = np.repeat(np.arange(len(counts)), counts)
    n = len(codes)
    covered = np.zeros(n, bool)
    if n >= 3:
        inside = np.flatnonzero(text[:-2] == text[2:])
        base = int(codes.max()) + 1
        pairs = codes[:-1].astype(np.int64) * base + codes[1:]
        _, pair = np.unique(pairs, return_inverse=True)
        _, here = np.unique(pair[inside].astype(np.int64) * base + codes[inside + 2], return_inverse=True)
        # Number the windows together with their text; equal numbers are equal windows of one text.
        key = here.astype(np.int64) * len(counts) + text[inside]
        order = np.argsort(key, kind="stable")
        same = key[order][1:] == key[order][:-1]
        again = np.zeros(len(order), bool)
        again[order[1:][same]] = True
        again[order[:-1][same]] = True
        for shift in range(3):
            covered[inside[again] + shift] = True
    return np.bincount(text[covered], minlength=len(counts))


def counted(texts_: pa.Array) -> list[np.ndarray]:
    """The counts of every text, in the order of ``COUNTS``."""
    strings = plain(texts_)
    _, codes, counts = words(strings)
    offsets = np.frombuffer(strings.buffers()[1], np.int64, len(strings) + 1, strings.offset * 8)
    bounds = offsets - offsets[0]
    data = np.frombuffer(strings.buffers()[2], np.uint8, int(bounds[-1]), int(offsets[0])) if bounds[-1] else np.zeros(0, np.uint8)
    is_space = np.zeros(256, bool)
    is_space[list(WORD_SPACE)] = True
    is_symbol = np.zeros(256, bool)
    is_symbol[list(SYMBOLS)] = True
    starts_char = (data & 0xC0) != 0x80
    chars = per_text(starts_char & ~is_space[data], bounds)
    symbols = per_text(is_symbol[data], bounds)
    n_lines, n_dup = [], []
    space = WORD_SPACE.decode()
    for text in strings.to_pylist():
        lines = [line for line in text.split("\n") if line.strip(space)]
        n_lines.append(len(lines))
        n_dup.append(len(lines) - len(set(lines)))
    return [counts, chars, symbols, np.array(n_lines), np.array(n_dup), repeat_words(codes, counts)]


def count_batches(batches, kept: list[str], prefix: str):
    """The kept columns and the counts of the text."""
    for batch in batches:
        for part in slices(batch, f"{prefix}text"):
            yield pa.RecordBatch.from_arrays(
                [*[part.column(name) for name in kept], *[pa.array(c, pa.int64()) for c in counted(part.column(f"{prefix}text"))]],
                [*kept, *[prefix + name for name in COUNTS]],
            )


def base_failed(prefix: str = "") -> Column:
    n, repeated = F.col(f"{prefix}n_words"), F.col(f"{prefix}n_repeat_words")
    return (n < LEAST_WORDS) | (100 * repeated > MOST_REPEATED_PERCENT * n)


def ratio(name: str, prefix: str = "") -> Column:
    """Whole thousandths."""
    part, of = {
        "word_length": ("word_chars", "n_words"),
        "symbols": ("n_symbols", "n_words"),
        "repeated_lines": ("n_dup_lines", "n_lines"),
        "repeated_words": ("n_repeat_words", "n_words"),
    }[name]
    return F.expr(f"coalesce(1000 * `{prefix}{part}` div nullif(`{prefix}{of}`, 0), 0)")


def cell(value: Column) -> Column:
    """The value with all but its eight highest bits cut off."""
    low = F.greatest(F.length(F.bin(value)) - 8, F.lit(0))
    return F.call_function("shiftleft", F.call_function("shiftright", value, low), low)


def sketches(counts: DataFrame, lang: str = "lang", source: str = "source") -> DataFrame:
    """``lang, source, ratio, cell, n``: tasks add up their own cells before anything is shuffled."""
    pairs = F.array(*[F.struct(F.lit(r).alias("ratio"), ratio(r).alias("value")) for r in RATIOS])
    return (
        counts.where(~base_failed())
        .select(F.col(lang).alias("lang"), F.col(source).alias("source"), F.explode(pairs).alias("p"))
        .groupBy("lang", "source", F.col("p.ratio").alias("ratio"), cell(F.col("p.value")).alias("cell"))
        .agg(F.count("*").alias("n"))
    )


def quartiles(sketch: DataFrame, *group: str) -> DataFrame:
    """``total, low, high`` of each group and ratio: the cells where the first and third quarter are reached."""
    keys = [*group, "ratio"]
    merged = sketch.groupBy(*keys, "cell").agg(F.sum("n").alias("n"))
    upto = Window.partitionBy(*keys).orderBy("cell")
    whole = Window.partitionBy(*keys)
    summed = merged.withColumn("upto", F.sum("n").over(upto)).withColumn("total", F.sum("n").over(whole))
    return summed.groupBy(*keys).agg(
        F.max("total").alias("total"),
        F.min(F.when(4 * F.col("upto") >= F.col("total"), F.col("cell"))).alias("low"),
        F.min(F.when(4 * F.col("upto") >= 3 * F.col("total"), F.col("cell"))).alias("high"),
    )


def thresholds(sketch: DataFrame) -> DataFrame:
    """A row per language and source: ``least`` and ``most`` of each ratio, as maps."""
    own = quartiles(sketch, "lang", "source")
    lang = quartiles(sketch, "lang").select(
        F.col("lang").alias("l"), F.col("ratio").alias("r"), *[F.col(c).alias(f"lang_{c}") for c in ("total", "low", "high")]
    )
    corpus = quartiles(sketch).select(F.col("ratio").alias("c"), F.col("low").alias("all_low"), F.col("high").alias("all_high"))
    joined = own.join(lang, F.col("lang").eqNullSafe(F.col("l")) & (F.col("ratio") == F.col("r"))).join(
        corpus, F.col("ratio") == F.col("c")
    )

    def chosen(side: str) -> Column:
        return (
            F.when(F.col("total") >= LEAST_DOCUMENTS, F.col(side))
            .when(F.col("lang_total") >= LEAST_DOCUMENTS, F.col(f"lang_{side}"))
            .otherwise(F.col(f"all_{side}"))
        )

    slack = F.create_map(*[F.lit(x) for pair in SLACK.items() for x in pair])
    low, high = chosen("low"), chosen("high")
    reach = F.greatest(REACH * (high - low), F.element_at(slack, F.col("ratio")).cast("long"))
    rows = joined.select("lang", "source", "ratio", (low - reach).alias("least"), (high + reach).alias("most"))
    return rows.groupBy("lang", "source").agg(
        F.min(F.when(F.col("ratio") == "word_length", F.col("least"))).alias("least_word_length"),
        *[F.min(F.when(F.col("ratio") == r, F.col("most"))).alias(f"most_{r}") for r in RATIOS],
    )


def verdict(prefix: str = "") -> Column:
    """Kept: no base rule failed and every ratio within its thresholds."""
    fits = ratio("word_length", prefix) >= F.col("least_word_length")
    for name in RATIOS:
        fits = fits & (ratio(name, prefix) <= F.col(f"most_{name}"))
    return ~base_failed(prefix) & F.coalesce(fits, F.lit(False))


def with_thresholds(frame: DataFrame, limits: DataFrame, groups: int, lang: Column, source: Column) -> DataFrame:
    """Join by language and source, null being a value; broadcast up to ``BROADCAST_GROUPS`` groups."""
    names = [c for c in limits.columns if c not in ("lang", "source")]
    own_lang, own_source = free_names(frame, "lang", "source")
    right = limits.select(F.col("lang").alias(own_lang), F.col("source").alias(own_source), *names)
    if groups <= BROADCAST_GROUPS:
        right = F.broadcast(right)
    joined = frame.join(right, lang.eqNullSafe(F.col(own_lang)) & source.eqNullSafe(F.col(own_source)), "left")
    return joined.drop(own_lang, own_source)


def judged(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source"
) -> DataFrame:
    """Counts, ``base_failed`` and ``kept`` for every row of ``docs``.

    A null text has no words and fails the base rules. Null languages and sources
    are groups of their own. Rows with equal ids are judged each on its own. An
    empty table gives no rows. Extra columns are not read.
    """
    place = workspace(docs)
    read = docs.select(
        docs[id_col].cast("long").alias("doc_id"),
        F.coalesce(docs[text_col], F.lit("")).alias("text"),
        docs[lang_col].alias("lang"),
        docs[source_col].alias("source"),
    )
    bounded_batches(docs.sparkSession)
    kept = ["doc_id", "lang", "source"]
    schema = "doc_id long, lang string, source string, " + ", ".join(f"{c} long" for c in COUNTS)
    counts = place.materialize(read.mapInArrow(lambda b: count_batches(b, kept, ""), schema), "counts")
    limits = place.materialize(thresholds(sketches(counts)), "thresholds")
    joined = with_thresholds(counts, limits, limits.count(), F.col("lang"), F.col("source"))
    return joined.select("doc_id", "lang", "source", *COUNTS, base_failed().alias("base_failed"), verdict().alias("kept"))


def kept_documents(
    docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source"
) -> DataFrame:
    """The rows of ``docs`` that the rules keep, all columns as they are.

    The counts are made twice, for the sketches and for the filter, so that no text
    is shuffled or stored and rows without a unique id are told apart.
    """
    place = workspace(docs)
    bounded_batches(docs.sparkSession)
    columns = [f"`{c}`" for c in docs.columns]
    # The input's columns have numbers for names meanwhile, so that no name clashes.
    given = docs
    docs = given.select(*[F.col(c).alias(f"c{k}") for k, c in enumerate(columns)])
    text_col, lang_col, source_col = (f"c{given.columns.index(c)}" for c in (text_col, lang_col, source_col))
    prefix = "_quality_"
    kept = list(docs.columns)
    schema_of = docs.schema
    groups = docs.select(
        docs[lang_col].alias("lang"), docs[source_col].alias("source"), F.coalesce(docs[text_col], F.lit("")).alias("text")
    ).mapInArrow(
        lambda b: count_batches(b, ["lang", "source"], ""), "lang string, source string, " + ", ".join(f"{c} long" for c in COUNTS)
    )
    limits = place.materialize(thresholds(sketches(groups)), "thresholds")
    schema = schema_of
    for name in COUNTS:
        schema = schema.add(prefix + name, "long")
    again = docs.withColumn(f"{prefix}text", F.coalesce(docs[text_col], F.lit(""))).mapInArrow(
        lambda b: count_batches(b, kept, prefix), schema
    )
    joined = with_thresholds(again, limits, limits.count(), again[lang_col], again[source_col])
    return joined.where(verdict(prefix)).select(*[F.col(c).alias(name) for c, name in zip(kept, given.columns)])
