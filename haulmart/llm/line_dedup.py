"""Line dedup across a corpus: equal lines and lines within a few edits of an earlier one.

A segment-partition edit join in DataFrame functions. For a threshold of t edits
a line has t+1 segments, of a size that its length class fixes. Of two lines
within t edits one segment, with at most as many edits on its left as its
number and the rest on its right, is untouched; so the first segments are looked
up at their place from the start, the last at theirs from the end, and those
between at a few places around. Classes are narrow, so that the segments are
nearly a whole part of the line each. Every distinct line is looked up once,
whatever the number of its copies. Lines that share a segment meet if their
lengths, and the characters that come an odd number of times, allow so few edits;
a banded bit-parallel automaton decides. Lines
below ``LEAST_CHARS`` code points have no segments: of those that have a word only
equal ones are repeats.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from haulmart.llm.frames import free_names, workspace

# Shorter lines are near to equal ones only. A length class has so many lengths.
LEAST_CHARS = 20
CLASS_CHARS = 10
# Keys and lines, of less than 100 bytes each, up to which they are broadcast.
BROADCAST_KEYS, BROADCAST_LINES = 2_000_000, 500_000
WORD = r"[^\x20\x09-\x0D]"
# Edits up to which lines are near, by the shorter line's class: one below 40 code points, else two.
SHORT_EDITS, LONG_EDITS = 1, 2
LONG_CHARS = 2 * LEAST_CHARS


def segment_keys(edits: int, low: str) -> tuple[list[str], list[str]]:
    """SQL of a line's keys in the class that begins at ``low``: of its segments at their own places, and around."""
    own, around = [], []
    size = f"({low} div {edits + 1})"
    for i in range(edits + 1):
        reach = min(i, edits - i)
        for shift in range(-reach, reach + 1):
            first = f"{i} * {size} + 1 + {shift}" if i <= edits - i else f"len - {edits + 1 - i} * {size} + 1 + {shift}"
            key = f"xxhash64(CAST({low} AS BIGINT), {i}, substring(line, {first}, {size}))"
            (around if shift else own).append(key)
    return own, around


def keys_of_line() -> tuple[Column, Column]:
    """Keys in the line's own class and, if it is barely too long for it, in the class below; none of a short line."""
    low = f"(len - len % {CLASS_CHARS})"
    below = f"({low} - {CLASS_CHARS})"
    none = "cast(array() as array<bigint>)"
    columns = []
    for which in (0, 1):

        def listed(edits: int, begin: str) -> str:
            keys = segment_keys(edits, begin)[which]
            return f"array({', '.join(keys)})" if keys else none

        columns.append(
            f"concat(case when len < {LEAST_CHARS} then {none} when len < {LONG_CHARS} then {listed(SHORT_EDITS, low)}"
            f" else {listed(LONG_EDITS, low)} end,"
            f" case when {low} > {LEAST_CHARS} and {low} <= {LONG_CHARS} and len - {low} < {SHORT_EDITS} then {listed(SHORT_EDITS, below)}"
            f" when {low} > {LONG_CHARS} and len - {low} < {LONG_EDITS} then {listed(LONG_EDITS, below)}"
            f" else {none} end)"
        )
    return tuple(F.expr(c) for c in columns)


def within(edits: int, a: str, b: str) -> str:
    """SQL: whether the character arrays a and b are at most ``edits`` edits apart.

    Bit ``edits + d`` of row ``e`` says that, with e edits, the characters of b read so
    far match that many of a plus d; one bit a diagonal of the band.
    """
    full = (1 << (2 * edits + 1)) - 1
    bits = " + ".join(
        f"if(get({a}, j + {d} - 1) = get({b}, j - 1), {1 << (d + edits)}, 0)" for d in range(-edits, edits + 1)
    )
    first = ", ".join(f"'r{e}', {sum(1 << (d + edits) for d in range(e + 1))}" for e in range(edits + 1))
    rows = ["(s.r0 & m)"]
    for e in range(1, edits + 1):
        before = f"s.r{e - 1}"
        rows.append(f"(((s.r{e} & m) | {before} | shiftright({before}, 1) | shiftleft({rows[-1]}, 1)) & {full})")
    step = ", ".join(f"'r{e}', {row}" for e, row in enumerate(rows))
    masks = f"transform(if(size({b}) = 0, cast(array() as array<int>), sequence(1, size({b}))), j -> {bits})"
    ends = f"shiftright(s.r{edits}, size({a}) - size({b}) + {edits}) & 1 = 1"
    return (
        f"if(abs(size({a}) - size({b})) > {edits}, false,"
        f" aggregate({masks}, named_struct({first}), (s, m) -> named_struct({step}), s -> {ends}))"
    )


def edits_for(length: str) -> str:
    return f"if({length} < {LONG_CHARS}, {SHORT_EDITS}, {LONG_EDITS})"


def rows_of(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(docs[text_col], F.lit(""))
    return docs.select(docs[id_col].cast("long").alias("doc_id"), F.xxhash64(text).alias("row"), text.alias("text"))


def counts(line: Column) -> Column:
    """Whether a line can be a repeat: it has a word, or ``LEAST_CHARS`` code points."""
    return (F.char_length(line) >= LEAST_CHARS) | line.rlike(WORD)


def lines_of(rows: DataFrame) -> DataFrame:
    """Lines that count; ``line_id`` is their MD5."""
    lines = rows.select("doc_id", "row", F.posexplode(F.split("text", "\n")).alias("line_no", "line")).where(counts(F.col("line")))
    return lines.withColumns({"len": F.char_length("line"), "line_id": F.unhex(F.md5("line"))})


def first_lines(rows: DataFrame) -> DataFrame:
    """Each distinct line, by its MD5, at its first place, with its segments' keys; texts aren't shuffled."""
    own, around = keys_of_line()
    keyed = lines_of(rows).select("line_id", F.struct("doc_id", "row", "line_no").alias("place"), own.alias("own"), around.alias("around"))
    return keyed.groupBy("line_id").agg(
        F.min("place").alias("place"), F.any_value("own").alias("own"), F.any_value("around").alias("around")
    )


def near_lines(rows: DataFrame, firsts: DataFrame, place) -> DataFrame:
    """``n`` of the distinct lines that are within a few edits of one whose first place is earlier."""
    keyed = firsts.select("n", F.explode("own").alias("key"), F.lit(True).alias("own")).unionByName(
        firsts.select("n", F.explode("around").alias("key"), F.lit(False).alias("own"))
    )
    # A segment matters if two lines have it, one of them at its own place.
    met = keyed.groupBy("key").agg(F.count("*").alias("rows"), F.bool_or("own").alias("indexed"))
    met = place.materialize(met.where("rows > 1 AND indexed").select(F.col("key").alias("_key")), "met_segments")
    few = met.count() <= BROADCAST_KEYS
    shared = place.materialize(
        keyed.join(F.broadcast(met) if few else met, F.col("key") == F.col("_key"), "left_semi"), "shared_segments"
    )

    # Which characters come an odd number of times: an edit changes two of the bits at most.
    odd = F.expr("aggregate(split(line, ''), 0L, (x, c) -> x ^ shiftleft(1L, ascii(c) & 63))")
    wanted = shared.select(F.col("n").alias("wanted")).distinct()
    asked = firsts.select("n", "place", F.col("line_id").alias("asked"))
    asked = place.materialize(asked.join(wanted, F.col("n") == F.col("wanted"), "left_semi"), "asked_lines")
    few = asked.count() <= BROADCAST_LINES
    text = lines_of(rows).select("line_id", "line", "len", "doc_id", "row", "line_no")
    # A line is taken from its first place, once but for rows that are equal.
    first = F.expr("line_id = asked AND place <=> named_struct('doc_id', doc_id, 'row', row, 'line_no', line_no)")
    known = text.join(F.broadcast(asked) if few else asked, first).select("n", "place", "len", "line")
    known = place.materialize(known.dropDuplicates(["n"]).withColumn("odd", odd), "candidate_lines")
    sided = shared.join(known.drop("line"), "n")
    a = sided.select([F.col(c).alias(f"a_{c}") for c in sided.columns])
    b = sided.select([F.col(c).alias(f"b_{c}") for c in sided.columns])
    allowed = edits_for("least(a_len, b_len)")
    met = a.join(
        b,
        F.expr(
            f"a_key = b_key and a_place < b_place and (a_own or b_own) and abs(a_len - b_len) <= {allowed}"
            f" and bit_count(a_odd ^ b_odd) <= 2 * {allowed}"
        ),
    )
    pairs = place.materialize(met.select("a_n", "b_n").distinct(), "line_pairs")
    texts = known.select("n", "line")
    read = pairs.join(texts.select(F.col("n").alias("a_n"), F.col("line").alias("a_line")), "a_n").join(
        texts.select(F.col("n").alias("b_n"), F.col("line").alias("b_line")), "b_n"
    )
    # The characters are bound as lambda variables: as columns they would be split anew at each of their uses.
    near = f"if(least(char_length(a_line), char_length(b_line)) < {LONG_CHARS}, {within(SHORT_EDITS, 'x', 'y')}, {within(LONG_EDITS, 'x', 'y')})"
    verified = F.expr(
        f"get(transform(array(split(a_line, '')), x -> get(transform(array(split(b_line, '')), y -> {near}), 0)), 0)"
    )
    return read.where(verified).select(F.col("b_n").alias("n")).distinct()


def kept_places(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, row, kept``: for each document the numbers of its lines that count and stay."""
    place = workspace(docs)
    rows = rows_of(docs, id_col, text_col)
    firsts = place.materialize(first_lines(rows).withColumn("n", F.monotonically_increasing_id()), "first_lines")
    near = place.materialize(near_lines(rows, firsts, place), "near_lines")
    for name in ("met_segments", "shared_segments", "asked_lines", "candidate_lines", "line_pairs"):
        place.drop(name)
    stay = firsts.select("n", "place").join(near, "n", "left_anti")
    return stay.groupBy(F.col("place.doc_id").alias("doc_id"), F.col("place.row").alias("row")).agg(
        F.collect_list("place.line_no").alias("kept")
    )


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with every line taken out that equals, or is within a few edits of, an earlier one.

    Lines come in the order of document id (null first), a hash of the text for rows
    with equal ids, and place in the text; the first of equal lines stays unless
    it is near an earlier line. Of lines below ``LEAST_CHARS`` code points, those
    with a word go if they equal an earlier line, and those without one stay. A
    document that loses all lines keeps its row, with an empty text; a null text
    becomes empty. Rows equal in id and text lose the same lines. An empty table
    gives no rows. All other columns are kept as they are, whatever their names.
    """
    own_id, own_row, kept, lines = free_names(docs, "id", "row", "kept", "lines")
    stay = kept_places(docs, id_col, text_col).select(
        F.col("doc_id").alias(own_id), F.col("row").alias(own_row), F.col("kept").alias(kept)
    )
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    split = docs.withColumn(lines, F.split(text, "\n"))
    joined = split.join(
        stay, F.col(f"`{id_col}`").cast("long").eqNullSafe(F.col(own_id)) & (F.xxhash64(text) == F.col(own_row)), "left"
    )
    others = F.filter(F.sequence(F.lit(0), F.size(lines) - 1), lambda i: ~counts(F.get(lines, i)))
    places = F.array_sort(F.concat(F.coalesce(kept, F.expr("cast(array() as array<int>)")), others))
    clean = F.array_join(F.transform(places, lambda i: F.get(lines, i)), "\n")
    return joined.select(*[clean.alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns])
