"""Line dedup by a segment-partition edit join, in DataFrame expressions only.

A line is removed if it is the copy of an earlier line or near one. Lines are the parts of a
text between ``\\n``; earlier means a smaller (document id, place). Lines under ``min_chars``
characters are always kept; by default that is empty lines only. Near is, with ``max_edits`` given, that many edits; without it
one edit in ten characters of the shorter line, which has ``NEAR_CHARS`` characters or more.

The join works on distinct lines. With ``max_edits``, a line of length n is cut into ``max_edits + 1`` even
segments; two lines within ``max_edits`` edits share one of them unchanged. Every line is
indexed under (length, segment number, segment) and probes the lengths ``n - max_edits .. n``
at the few starts where a shared segment can lie (the multi-match-aware windows). Index and
probe rows carry counts of eight letters: one edit changes these by two at most, so pairs
that differ more are dropped inside the join and never leave it. What is left is verified on
the texts with the built-in edit distance, which computes only the diagonal band that the
bound allows. (The built-in's band is a row of cells, not of bits: a bit-parallel form would
need a function of one's own, and the main path has built-in functions only.)

The growing budget has two joins, and each finds every pair. If the shorter line has fewer than
``EXACT_BELOW`` characters, all lines of one budget are cut at the same
places, so a probe stands for all their lengths, and its places are listed in a table by
length. From there on the shorter line is cut into segments of ``SEGMENT`` characters, which are more
than its edits, so that two near lines meet at two of them or more: the longer the line, the more meetings are asked for, and lines that
happen to share a segment leave the join as a count, not as a pair. Of the ``GRAM``-character parts of a segment the one with the least hash is
indexed; the longer line is probed by the parts that are the least of any stretch of ``SEGMENT``
characters, which are half of its places: rows grow with the characters, not with the edits. Keys hold a step of the length and of the
place, so segments of other lengths and places never meet it. Both joins go in turns, by budgets and by
lengths, so the rows that lie on disk at once are a share of the table; a length that is too frequent is taken in
stretches of places, whose counts are summed. Short segments are still shared by
lines that are not near, so the rows that meet grow with the square of the table (README): hashes of the
nine characters before the part drop most of them inside the join.
Candidates whose counts of 32 letters differ by more than the edits can change are dropped
before whole texts are joined to them. A line goes if one earlier line is near it, so its likeliest pair is compared first,
and the others only if that one is not near.

A line that fills a third of the table is one row after the first, map-side combined,
grouping. Removed places are gathered per document and taken out inside the document's row.

Nulls and ties: a null text stays null and has no lines; a null id sorts first. Rows that
share an id are taken as one document: the same line at the same place in them is one line.
An empty table gives no rows. Other columns are kept as they are; added ones give way to equal names.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.operators.models import materialize
from quarry.operators.sampling import fresh
from quarry.session import remove_scratch

LETTERS = "eatoinsr"
ALL_LETTERS = (LETTERS, "hldcumfp", "gwybvkxj", "qz .,-'\"")
MIN_CHARS = 1
NEAR_CHARS = 20
EXACT_BELOW = 100
SEGMENT = 9  # k + 1 segments fit into 10 k characters from 90 on
GRAM = 7  # characters of a segment that are looked up
ROUND_ROWS = 20_000_000  # places of a turn, whose rows lie on disk together
MOST_ROUNDS = 64  # in a larger table a turn has that share of the places
SHORT_SEGMENTS_BELOW = 180  # from there on two segments of that length or more are met; shorter lines are cut into smaller ones for that
LENGTH_STEP = 1.1  # ratios of the steps of lengths and places in the keys of long lines
PLACE_STEP = 1.2


def _lines(docs: DataFrame, id_col: str, text_col: str, min_chars: int) -> DataFrame:
    """``doc, place, line, h, h2`` of the lines that count; two hashes name a line."""
    split = F.posexplode(F.split(F.col(text_col), "\n", -1)).alias("place", "line")
    return (
        docs.select(F.col(id_col).alias("doc"), split)
        .where(F.char_length("line") >= min_chars)
        .select("doc", "place", "line", F.xxhash64("line").alias("h"), F.xxhash64(F.lit(1), "line").alias("h2"))
    )


def _segment(n: Column, i: int, parts: int) -> tuple[Column, Column]:
    """0-based start and length of segment ``i`` (from 0) of a line of length ``n``; the last ones are longer."""
    short = F.floor(n / parts).cast("int")
    longer = n - short * parts  # the last `longer` segments have one character more
    first_longer = F.lit(parts) - longer
    start = short * i + F.greatest(F.lit(0), F.lit(i) - first_longer)
    return start, short + (F.lit(i) >= first_longer).cast("int")


def _key(line: Column, n: Column, i: int, start: Column, length: Column) -> Column:
    return F.xxhash64(n, F.lit(i), F.substring(line, start + 1, length))


def index_keys(line: Column, n: Column, max_edits: int) -> list[Column]:
    """Keys of the segments of a line of length ``n``."""
    parts = max_edits + 1
    return [_key(line, n, i, *_segment(n, i, parts)) for i in range(parts)]


def probe_keys(line: Column, own: Column, max_edits: int) -> list[Column]:
    """Keys of the substrings that may be a segment of a line as long as this (``own``) or up to ``max_edits`` shorter; null outside.

    The line's own ``index_keys``, which are looked up too, are left out.

    They go under ``explode`` as a plain array: for any other expression Spark infers a filter on its size,
    which computes all keys again.
    """
    parts, keys = max_edits + 1, []
    for less in range(max_edits + 1):
        n = own - less
        for i in range(parts):
            start, length = _segment(n, i, parts)
            low, high = max(-i, less - (max_edits - i)), min(i, less + (max_edits - i))
            for shift in range(low, high + 1):
                if less == shift == 0:
                    continue
                at = start + shift
                inside = (at >= 0) & (at + length <= own) & (n >= parts)
                keys.append(F.when(inside, _key(line, n, i, at, length)))
    return keys


def letter_counts(line: Column, letters: str = LETTERS) -> Column:
    """Counts of eight letters modulo 256, packed into one long."""
    n = F.octet_length(line)  # the letters are one byte each, so bytes tell their number without a walk over the characters
    packed = F.lit(0).cast("bigint")
    for i, letter in enumerate(letters):
        count = (n - F.octet_length(F.replace(line, F.lit(letter), F.lit("")))).bitwiseAND(F.lit(255))
        packed = packed.bitwiseOR(F.shiftleft(count.cast("bigint"), 8 * i))
    return packed


def _letters_apart(a: Column, b: Column) -> Column:
    total = F.lit(0).cast("bigint")
    for i in range(len(LETTERS)):
        byte = lambda x: F.shiftrightunsigned(x, 8 * i).bitwiseAND(F.lit(255))  # noqa: E731, B023
        apart = F.abs(byte(a) - byte(b))
        total = total + F.least(apart, F.lit(256) - apart)
    return total


def edit_budget(n):
    """Edits allowed between a line of length ``n``, a number or a column, and a line as long or longer."""
    if isinstance(n, Column):
        return F.when(n >= NEAR_CHARS, F.floor(n / 10)).otherwise(0).cast("int")
    return n // 10 if n >= NEAR_CHARS else 0


def segment_table() -> tuple[list[tuple[int, ...]], list[tuple[int, ...]]]:
    """Rows ``n, k, i, at, size``: the segments of lines of length ``n`` and budget ``k``, and the places where lines of length ``n`` probe them.

    All lines of one budget are cut at the same places: ``k + 1`` even segments of the shortest
    such line; what is longer is not looked at. So a probe stands for every length of a budget
    at once. Of two lines within ``k`` edits, some segment ``i`` of the shorter is unchanged
    with at most ``i`` edits before it and ``k - i`` behind it, which bounds its shift by the
    edits before, and the difference of the lengths less its shift by those behind.
    """
    index, probe = [], []
    for k in range(edit_budget(NEAR_CHARS), edit_budget(EXACT_BELOW - 1) + 1):
        lengths = [n for n in range(NEAR_CHARS, EXACT_BELOW) if edit_budget(n) == k]
        short, longer = divmod(lengths[0], k + 1)
        for i in range(k + 1):
            extra = i - (k + 1 - longer)
            start, size = short * i + max(0, extra), short + (extra >= 0)
            index += [(m, k, i, start, size) for m in lengths]
            for n in range(lengths[0], lengths[-1] + k + 1):
                least, most = max(0, n - lengths[-1]), min(k, n - lengths[0])  # how much shorter the other may be
                low, high = max(-i, least - (k - i)), min(i, most + (k - i))
                probe += [(n, k, i, at, size) for at in range(max(0, start + low), min(n - size, start + high) + 1)]
    return index, probe


def _wide(line: Column) -> Column:
    """Four bytes a character, so a part is found by its place without a walk over the characters before it."""
    return F.encode(line, "UTF-32")


def _part(wide: Column, at: Column, size: Column) -> Column:
    return F.substring(wide, at * 4 + 1, size * 4)


def _step(x: Column, ratio: float, least: int = 1) -> Column:
    """Steps of a ladder that grows by ``ratio``; it never falls, so a range of ``x`` is the range of its ends' steps."""
    return F.floor(F.log(x + least) / math.log(ratio)).cast("int")


def _let_go(table: DataFrame) -> None:
    """Removes a written table that is not needed any more."""
    remove_scratch(table.sparkSession, [file.rpartition("/")[0] for file in table.inputFiles()[:1]])


def _turns(rows: dict[int, int], total: int) -> list[tuple[int, int, int, int]]:
    """``first, last, parts, part``: runs of keys (``rows`` has their sizes) near a share of ``total``; a key above it is taken in parts."""
    share = max(ROUND_ROWS, -(-total // MOST_ROUNDS))
    turns, held = [], 0
    for key in sorted(rows):
        if turns and held + rows[key] <= share:
            turns[-1], held = (turns[-1][0], key, 1, 0), held + rows[key]
        else:
            parts = -(-rows[key] // share)
            turns += [(key, key, parts, part) for part in range(parts)]
            held = rows[key] if parts == 1 else share
    return turns


def _gram(at: Column) -> Column:
    return _part(F.col("wide"), at, F.lit(GRAM))


def _is_least(at: Column, segment: int = SEGMENT) -> Column:
    """Whether the part at this place has the least hash, the first of equal ones, of any stretch of ``segment`` characters; true as well for some at the ends."""
    return _least_around(at, F.xxhash64(_gram(at)), segment)


def _least_around(at: Column, own: Column, segment: int) -> Column:
    """``_is_least`` of a part whose hash is ``own``."""
    others = segment - GRAM

    def run(way: int) -> Column:
        n = F.lit(others)
        for far in range(others, 0, -1):
            other = F.xxhash64(_gram(at + way * far))
            n = F.when(other > own if way < 0 else other >= own, n).otherwise(far - 1)
        return n

    return run(-1) + run(1) >= others


def _least_of(start: Column, segment: int = SEGMENT) -> Column:
    """Place of the part of least hash, the first of equal ones, in the segment that starts there."""
    hashes = [F.xxhash64(_gram(start + i)) for i in range(segment - GRAM + 1)]
    place = F.lit(len(hashes) - 1)
    for i in range(len(hashes) - 2, -1, -1):
        place = F.when(reduce(Column.__and__, [hashes[i] <= h for h in hashes[i + 1 :]]), F.lit(i)).otherwise(place)
    return start + place


def _before(at: Column, moved: tuple[int, ...], segment: int) -> Column:
    """A byte each of the hash of the five characters before ``at`` and of the others of a segment before these, moved by ``moved``."""
    byte = lambda x, i: F.shiftleft(F.hash(x).bitwiseAND(F.lit(255)), 8 * i)
    far = [byte(_part(F.col("wide"), at - segment + by, F.lit(segment - 5)), i) for i, by in enumerate(moved, 1)]
    return reduce(Column.bitwiseOR, far, byte(_part(F.col("wide"), at - 5, F.lit(5)), 0))


def _same_before(a: Column, b: Column) -> Column:
    """Whether the characters before two parts (``_before``) may be within one edit: it leaves the near five or the far others unchanged, these moved by one at most."""
    byte = lambda x, i: F.shiftrightunsigned(x, 8 * i).bitwiseAND(F.lit(255))
    return reduce(Column.__or__, [byte(a, 1) == byte(b, i) for i in (1, 2, 3)], byte(a, 0) == byte(b, 0))


def _long_lines(lines: DataFrame) -> DataFrame:
    """``a, b``: hashes of the lines of ``EXACT_BELOW`` characters or more that may be within one edit in ten characters.

    The shorter line is cut into segments of ``SEGMENT`` characters (one less in turns with lines under ``SHORT_SEGMENTS_BELOW``), ``r`` more than its ``k`` edits. Go along them and count the segments
    without their edits: the count ends at ``r`` or more, so there are segments at which it first comes to 1, 2 .. ``r``.
    Each of these ``r`` segments ``i`` is unchanged, with ``i`` edits before it at most, ``k - i + r - 1`` behind it at most, and no more than one
    in the segment before it. So lines within ``k`` edits meet at ``r`` segments or more (``_segments_met``), two at least, and no pair is left out. The part of least hash in a segment is the same wherever the segment stands, so
    the longer line is probed at the places only that are the least of a stretch as long as a segment. Keys hold the step of the longer line's length and that of its place: a
    part is indexed under all steps where it may be met, so other lengths and places never meet it.
    Lengths are taken in turns, and a turn makes the rows of its own lengths only. ``lines`` are read in every turn.
    """
    n, k, at, i = F.col("n"), edit_budget(F.col("n")), F.col("at"), F.col("i")
    step = _step(n, LENGTH_STEP)
    of_step = lines.groupBy(step.alias("step")).agg(F.sum("n").alias("places"), F.min("n").alias("least"), F.max("n").alias("most")).collect()  # some hundred steps at most
    rows = {r.step: r.places for r in of_step}
    found, counted = [], []
    for first, last, parts, part in _turns(rows, sum(rows.values())):
        least = min(r.least for r in of_step if first <= r.step <= last)
        most = max(r.most for r in of_step if first <= r.step <= last)
        segment = SEGMENT - (least * 10 // 11 < SHORT_SEGMENTS_BELOW)
        from_at, to_at, mine = _stretch(most, parts, part)

        def side(name: str, places: DataFrame, *kept: str) -> DataFrame:
            places = places if parts == 1 else places.where(mine(F.col("place")))  # noqa: B023
            keyed = places.withColumn("key", F.xxhash64("step", "place", "part"))
            return keyed.select(F.col("h").alias(name), *[F.col(c).alias(f"{name}_{c}") for c in ("key", "n", "at", "before", *kept)])

        own = ["h", "n", "step", "wide"]
        longer = lines.where(n.between(least, most))
        # Dealt before the rows are made, so tasks are even and their code has no bounds of a turn in it: it is compiled once.
        wide = longer.select("h", "n", "line", step.alias("step")).repartition("h").withColumn("wide", _wide(F.col("line")))
        ends = [F.lit(0), n - GRAM] if parts == 1 else [F.lit(from_at), F.least(n - GRAM, F.lit(to_at))]
        places = wide.where(ends[0] <= ends[1]).select(*own, F.explode(F.sequence(*ends)).alias("at"))
        hashed = places.select(*own, "at", F.explode(F.array(F.xxhash64(_gram(at)))).alias("part"))  # a row each, so the hash is made once
        probe = hashed.where(_least_around(at, F.col("part"), segment)).select("h", "n", "step", "at", "part", _step(at, PLACE_STEP, 8).alias("place"), _before(at, (-1, 0, 1), segment).alias("before"))

        reach = _step(n + k, LENGTH_STEP)
        shorter = lines.where(n.between(least * 10 // 11, most)).where(reach >= first)
        ends = [F.greatest(step, F.lit(first)).alias("step"), F.least(reach, F.lit(last)).alias("last")]
        wide = shorter.select("h", "n", "line", *ends).repartition("h").withColumn("wide", _wide(F.col("line")))
        # A part is met at i places less or more at most, so of the segments those that may be met in this stretch.
        ends = [F.lit(0), F.floor(n / segment).cast("int") - 1]
        if parts > 1:
            ends = [F.lit(max(0, from_at - segment) // (segment + 1)), F.least(ends[1], F.lit(to_at // (segment - 1) + 1))]
        cuts = wide.where(ends[0] <= ends[1]).select(*own, "last", F.explode(F.sequence(*ends)).alias("i")).withColumn("at", _least_of(i * segment, segment))
        behind = (F.floor(n / segment).cast("int") - 1 - i).alias("behind")
        cut = cuts.select("h", "n", "step", "last", "i", behind, "at", F.explode(F.array(F.xxhash64(_gram(at)))).alias("part"), _before(at, (0,), segment).alias("before"))
        met_at = F.sequence(*[_step(x, PLACE_STEP, 8) for x in (at - F.least(i, F.col("behind")), at + i)])
        kept = ["h", "n", "at", "part", "before", "i", "behind"]
        index = cut.select(*kept, F.explode(F.sequence("step", "last")).alias("step")).select(*kept, "step", F.explode(met_at).alias("place"))

        longer_by, shift = F.col("b_n") - F.col("a_n"), F.col("b_at") - F.col("a_at")
        before, within = F.col("a_i"), F.col("a_at") - F.col("a_i") * segment
        where = (F.abs(shift) <= before) & (longer_by >= 0) & (F.abs(longer_by - shift) <= F.col("a_behind")) & (longer_by <= edit_budget(F.col("a_n"))) & (F.col("b_at") >= within)
        # The cheapest test first: most that share a key fail it.
        may_be = ((before == 0) | _same_before(F.col("a_before"), F.col("b_before"))) & (F.col("a") != F.col("b")) & where
        met = side("a", index, "i", "behind").join(side("b", probe).hint("merge"), (F.col("a_key") == F.col("b_key")) & may_be)
        times = met.groupBy("a", "b").agg(F.count(F.lit(1)).alias("times"), F.max(_segments_met(F.col("a_n"), segment)).alias("needed"))
        enough = F.col("times") >= F.col("needed")
        if parts > 1:
            # Counts of all stretches, before any pair is left out. In a large table these are too many rows to keep; there a pair
            # stays that has an even share of its meetings in some stretch, as every near one has, if that is more than one.
            share = F.ceil(F.col("needed") / (parts if sum(rows.values()) > ROUND_ROWS * MOST_ROUNDS else math.inf))
            counted.append(materialize(times.withColumn("share", share).where("share < 2 or times >= share"), "line-times"))
            times = reduce(DataFrame.union, counted).groupBy("a", "b").agg(*[F.max(c).alias(c) for c in ("needed", "share")], F.sum("times").alias("times"))
            enough = enough | (F.col("share") > 1)
        if part == parts - 1:
            found.append(materialize(times.where(enough).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "line-round"))
            for table in counted:
                _let_go(table)
            counted = []
    return reduce(DataFrame.union, found, lines.select(F.col("h").alias("a"), F.col("h").alias("b")).limit(0))


def _stretch(most: int, parts: int, part: int) -> tuple[int, int, Callable[[Column], Column]]:
    """First and last place, and a test for steps of places: the places of a part of the lines of ``most`` characters or less. The ends may be a little wide, the steps are exact."""
    step = lambda part: 0 if part == 0 else math.ceil(math.log(most * part / parts + 8) / math.log(PLACE_STEP))
    first, end = step(part), step(part + 1) if part < parts - 1 else math.inf
    from_at = max(0, math.floor(PLACE_STEP**first) - 9) if part else 0
    to_at = min(most, math.ceil(PLACE_STEP**end) - 7) if end < math.inf else most
    return from_at, to_at, lambda place: (place >= first) & (F.lit(True) if end == math.inf else place < end)


def _segments_met(n: Column, segment: int) -> Column:
    """At how many segments a line of length ``n`` meets one near it that is as long or longer, at least."""
    return F.floor(n / segment).cast("int") - edit_budget(n)


def _short_lines(lines: DataFrame) -> DataFrame:
    """``a, b``: hashes of the lines that may be near, the shorter one of ``NEAR_CHARS`` to ``EXACT_BELOW`` characters, in turns by its edits."""
    spark = lines.sparkSession
    reach = F.col("n").between(NEAR_CHARS, EXACT_BELOW + edit_budget(EXACT_BELOW))
    known = materialize(lines.where(reach).select("h", "n", "line", letter_counts(F.col("line")).alias("letters")), "line-short")
    index, probe = segment_table()
    lengths = {r.n: r.lines for r in known.groupBy("n").agg(F.count(F.lit(1)).alias("lines")).collect()}  # of less than 111 lengths
    rows: dict[int, int] = {}
    for n, k, *_ in probe:
        rows[k] = rows.get(k, 0) + lengths.get(n, 0)
    found = []
    for first, last, parts, part in _turns({k: r for k, r in rows.items() if r}, sum(rows.values())):

        def keys(spec: list[tuple[int, ...]], name: str) -> DataFrame:
            mine = [row for row in spec if first <= row[1] <= last]  # noqa: B023
            at_hand = F.broadcast(spark.createDataFrame(mine, "n int, k int, i int, at int, size int"))
            wide = known.select("h", "n", "letters", _wide(F.col("line")).alias("wide"))
            keyed = wide.join(at_hand, "n").withColumn("key", F.xxhash64("k", "i", _part(F.col("wide"), F.col("at"), F.col("size"))))
            keyed = keyed if parts == 1 else keyed.where(F.pmod(F.col("key"), F.lit(parts)) == part)  # noqa: B023
            return keyed.select(F.col("h").alias(name), *[F.col(c).alias(f"{name}_{c}") for c in ("n", "key", "letters")])

        same = (F.col("a_key") == F.col("b_key")) & (F.col("a") != F.col("b"))
        budget = edit_budget(F.col("a_n"))
        may_be = (F.col("b_n") - F.col("a_n")).between(0, budget) & (_letters_apart(F.col("a_letters"), F.col("b_letters")) <= 2 * budget)
        met = keys(index, "a").join(keys(probe, "b").hint("merge"), same & may_be)
        found.append(materialize(met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "line-round"))
    return reduce(DataFrame.union, found, known.select(F.col("h").alias("a"), F.col("h").alias("b")).limit(0))


def _same_budget(texts: DataFrame, max_edits: int) -> DataFrame:
    """``a, b``: hashes of the lines that may be within ``max_edits`` edits."""
    line, n = F.col("line"), F.col("n")
    with_counts = texts.select("h", "line", F.char_length("line").alias("n"), letter_counts(line).alias("letters"))  # before the rows multiply
    entry = lambda is_index, is_probe, keys: [F.struct(F.lit(is_index).alias("is_index"), is_probe.alias("is_probe"), k.alias("key")) for k in keys]
    own = entry(True, n > max_edits, index_keys(line, n, max_edits))  # of shorter lines a segment may be empty
    both = F.array(*own, *entry(False, F.lit(True), probe_keys(line, n, max_edits)))
    # Written once, so letters are counted once for both sides; a key that is the same on both sides is one row.
    keys = materialize(with_counts.select("h", "letters", F.explode(both).alias("e")).select("h", "letters", "e.*"), "line-keys")
    index = keys.where("is_index").select(F.col("h").alias("a"), F.col("letters").alias("a_letters"), "key")
    probe = keys.where("is_probe").select(F.col("h").alias("b"), F.col("letters").alias("b_letters"), F.col("key").alias("probe_key"))
    close = _letters_apart(F.col("a_letters"), F.col("b_letters")) <= 2 * max_edits
    return index.join(probe, (F.col("key") == F.col("probe_key")) & (F.col("a") != F.col("b")) & close).select("a", "b")


def _growing_budget(texts: DataFrame) -> DataFrame:
    """``a, b``: hashes of the lines that may be within one edit in ten characters."""
    lines = texts.select("h", "line", "n")
    return _short_lines(lines).union(_long_lines(lines.where(F.col("n") >= EXACT_BELOW)))


def _letters_agree(pairs: DataFrame, texts: DataFrame, most_of) -> DataFrame:
    """The ``pairs`` whose letter counts (``l0, l1, ...`` of ``texts``) differ by no more than the edits can change, and by how many; no text is moved for them."""
    known = texts.select("h", F.char_length("line").alias("n"), *[f"l{i}" for i in range(len(ALL_LETTERS))])
    side = lambda p: known.select(*[F.col(c).alias(f"{p}_{c}") for c in known.columns])
    both = pairs.join(side("a"), F.col("a") == F.col("a_h")).join(side("b"), F.col("b") == F.col("b_h"))
    apart = sum((_letters_apart(F.col(f"a_l{i}"), F.col(f"b_l{i}")) for i in range(len(ALL_LETTERS))), F.lit(0).cast("bigint"))
    return both.where(apart <= 2 * most_of(F.least("a_n", "b_n"))).select("a", "b", apart.alias("apart")).distinct()


def _by_length(texts: DataFrame) -> DataFrame:
    """``texts`` with their length ``n``, written in its order, so a turn reads the pages of its own lengths only."""
    return materialize(texts.withColumn("n", F.char_length("line")).sortWithinPartitions("n"), "line-firsts")


def _bound(value: Column, use) -> Column:
    """``use`` of ``value``, which is computed once."""
    return F.transform(F.array(value), use)[0]


def _trimmed(two: Column) -> Column:
    """Two different lines (``x, y``) backwards, without the characters that they share at the start."""
    part = lambda c, at, size: F.substring(two[c], at + 1, size)
    shared = F.aggregate(F.array(*[F.lit(2**i) for i in range(11, -1, -1)]), F.lit(0), lambda n, size: F.when(part("x", n, size) == part("y", n, size), n + size).otherwise(n))
    return _bound(shared, lambda n: F.struct(*[F.reverse(part(c, n, F.char_length(two[c]))).alias(c) for c in "xy"]))


def _within_budget(x: Column, y: Column) -> Column:
    """Whether two different lines are within one edit in ten characters of the shorter one; what they share at the ends changes no distance."""
    most = edit_budget(F.least(F.char_length(x), F.char_length(y)))
    within = lambda two, bound: F.call_function("levenshtein", two["x"], two["y"], bound) >= 0
    # Most near copies differ little: a band of an eighth first, the whole one for the rest.
    near = lambda two: within(two, F.floor(two["most"] / 8).cast("int")) | within(two, two["most"])
    both = lambda two: _bound(_trimmed(two), lambda cut: _bound(_trimmed(cut), lambda left: near(F.struct(left["x"].alias("x"), left["y"].alias("y"), most.alias("most")))))
    return _bound(F.struct(x.alias("x"), y.alias("y")), both)


def near_lines(lines: DataFrame, max_edits: int | None = None) -> DataFrame:
    """``a_h, a_h2, b_h, b_h2``: pairs of different lines near each other, each pair once."""
    texts = lines.groupBy("h", "h2").agg(F.first("line").alias("line"))
    return near_texts(texts if max_edits is not None else _by_length(texts), max_edits)


def near_texts(texts: DataFrame, max_edits: int | None = None) -> DataFrame:
    """``near_lines`` of lines that are one row each (``h, h2, line``; without ``max_edits`` as ``_by_length`` writes them)."""
    pairs, found = _likely(texts, max_edits)
    side = lambda p: found.select(*[F.col(c).alias(f"{p}_{c}") for c in ("h", "h2", "line")])
    both = pairs.join(side("a"), F.col("a") == F.col("a_h")).join(side("b"), F.col("b") == F.col("b_h"))
    return both.where(_near(max_edits)).select(*PAIR)


PAIR = ("a_h", "a_h2", "b_h", "b_h2")


def _near(max_edits: int | None) -> Column:
    """Whether ``a_line`` and ``b_line`` are near each other and not equal."""
    if max_edits is None:
        return (F.col("a_line") != F.col("b_line")) & _within_budget(F.col("a_line"), F.col("b_line"))
    return F.call_function("levenshtein", F.col("a_line"), F.col("b_line"), F.lit(max_edits)).between(1, max_edits)


def _likely(texts: DataFrame, max_edits: int | None) -> tuple[DataFrame, DataFrame]:
    """``a, b``, hashes of pairs that may be near (without ``max_edits`` also how far ``apart`` their letters are), and the rows of ``texts`` that are in one."""
    found = _growing_budget(texts) if max_edits is None else _same_budget(texts, max_edits)
    pairs = materialize(
        found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(),
        "line-pairs",
    )
    wanted = pairs.select(F.col("a").alias("h")).union(pairs.select("b")).distinct()
    met = texts.select("h", "h2", "line", *[c for c in texts.columns if c == "first"]).join(materialize(wanted, "line-wanted"), "h", "left_semi")
    counts = [letter_counts(F.col("line"), eight).alias(f"l{i}") for i, eight in enumerate(ALL_LETTERS)] if max_edits is None else []
    found = materialize(met.select("*", *counts), "line-texts")
    if max_edits is None:
        pairs = materialize(_letters_agree(pairs, found, edit_budget), "line-likely")
    return pairs, found


def _later(first_a: Column, first_b: Column) -> Column:
    """The names of the later line of a pair."""
    return F.when(first_a < first_b, F.struct(F.col("b_h").alias("h"), F.col("b_h2").alias("h2"))).otherwise(F.struct(F.col("a_h").alias("h"), F.col("a_h2").alias("h2")))


def _near_earlier(firsts: DataFrame) -> DataFrame:
    """``h, h2``: the lines that are near an earlier one, with one edit in ten characters.

    One pair is enough for a line, so its likeliest one is compared first, and its others only if these two are not near.
    """
    pairs, found = _likely(firsts, None)
    side = lambda p, *kept: found.select(*[F.col(c).alias(f"{p}_{c}") for c in ("h", "h2", *kept)])
    both = pairs.join(side("a", "first"), F.col("a") == F.col("a_h")).join(side("b", "first"), F.col("b") == F.col("b_h"))
    tries = materialize(both.select(*PAIR, "apart", _later(F.col("a_first"), F.col("b_first")).alias("later")), "line-tries")

    def compared(some: DataFrame) -> DataFrame:
        texts = some.join(side("a", "line"), ["a_h", "a_h2"]).join(side("b", "line"), ["b_h", "b_h2"])
        return materialize(texts.where(_near(None)).select("later").distinct(), "line-near")

    likeliest = tries.groupBy("later").agg(F.min_by(F.struct(*PAIR), F.struct("apart", *PAIR)).alias("pair")).select("later", "pair.*")
    at_once = compared(likeliest)
    rest = tries.join(at_once, "later", "left_anti").join(likeliest.select(*PAIR), list(PAIR), "left_anti")
    return at_once.union(compared(rest)).select("later.*")


def removed_places(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    max_edits: int | None = None,
    min_chars: int = MIN_CHARS,
) -> DataFrame:
    """``doc, places``: per document the places (from 0) of the lines to remove."""
    lines = _lines(docs, id_col, text_col, min_chars)
    firsts = lines.groupBy("h", "h2").agg(
        F.count(F.lit(1)).alias("copies"), F.min(F.struct("doc", "place")).alias("first"), F.first("line").alias("line")
    )  # the texts too, so documents are split and lines grouped once for both
    firsts = materialize(firsts, "line-firsts") if max_edits is not None else _by_length(firsts)
    if max_edits is None:
        later = _near_earlier(firsts)
    else:
        near = materialize(near_texts(firsts, max_edits), "line-near")
        named = lambda p: firsts.select(*[F.col(c).alias(f"{p}_{c}") for c in ("h", "h2", "first")])
        both = near.join(named("a"), ["a_h", "a_h2"]).join(named("b"), ["b_h", "b_h2"])
        later = both.select(_later(F.col("a_first"), F.col("b_first")).alias("later")).select("later.*").distinct()
    later = later.withColumn("gone", F.lit(True))
    dealt = materialize(
        firsts.join(later, ["h", "h2"], "left").where("copies > 1 or gone").select("h", "h2", "first", "gone"), "line-dealt"
    )
    occurs = lines.select("doc", "place", "h", "h2").join(dealt, ["h", "h2"])
    out = occurs.where(F.col("gone").isNotNull() | (F.struct("doc", "place") != F.col("first")))
    return out.groupBy("doc").agg(F.collect_set("place").alias("places"))


ADDED = ("n_lines", "n_removed", "emptied")


def added_names(docs: DataFrame) -> list[str]:
    """The names that ``dedup_lines`` gives its three columns: those of ``ADDED``, with underscores before them if ``docs`` has such columns."""
    return [fresh(name, docs.columns) for name in ADDED]


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` with lines removed from the text, and ``n_lines, n_removed, emptied`` added (see ``added_names``).

    ``emptied``: lines were removed, and of the lines of ``NEAR_CHARS`` characters or more (of
    any length, if the document had none so long) none is left.
    """
    gone = materialize(removed_places(docs, id_col, text_col, **options), "line-gone")
    own = {c: f"c{i}" for i, c in enumerate(docs.columns)}  # no column of docs can meet a name used here
    text, places = F.col(own[text_col]), F.col("places")
    split = F.split(text, "\n", -1)
    left = F.filter(split, lambda _, i: ~F.array_contains(places, i))
    kept = F.array_join(left, "\n")
    any_of = lambda lines, chars: F.exists(lines, lambda x: F.char_length(x) >= chars)
    emptied = places.isNotNull() & ~F.when(any_of(split, NEAR_CHARS), any_of(left, NEAR_CHARS)).otherwise(any_of(left, 1))
    # The places grow with the documents, so they are joined by sorting at every size, never broadcast.
    joined = docs.toDF(*own.values()).join(gone.hint("merge"), F.col(own[id_col]).eqNullSafe(F.col("doc")), "left")
    counts = [F.coalesce(F.size(x), F.lit(0)).cast("bigint") for x in (split, places)]
    done = joined.select(
        *[(F.when(places.isNull(), text).otherwise(kept) if c == text_col else F.col(n)) for c, n in own.items()], *counts, emptied
    )
    return done.toDF(*docs.columns, *added_names(docs))
