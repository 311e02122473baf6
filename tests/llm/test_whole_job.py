"""Rows that earlier versions left out of the work."""

import random

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from quarry.llm import decontaminate, linededup, quality

SF = "/root/testdata/sf0.001"
DOC = "doc_id long, text string"


def _changed(rng, line, edits):
    """``line`` with that many letters replaced at different places."""
    out = list(line)
    for at in rng.sample(range(len(line)), edits):
        out[at] = "#"
    return "".join(out)


def test_line_edit_budget_grows_with_the_line(spark):
    rng = random.Random(5)
    line = lambda n: "".join(rng.choice("abcdefghijklmn opqé") for _ in range(n))
    rows, gone = [], set()
    for i, (n, edits) in enumerate([(20, 2), (45, 4), (45, 5), (99, 9), (99, 10), (250, 12), (500, 2), (500, 25), (3000, 60), (500, 90)]):
        first = line(n)
        rows += [(i, first), (100 + i, _changed(rng, first, edits))]
        if edits <= n // 10:
            gone.add(100 + i)
    done = linededup.dedup_lines(spark.createDataFrame(rows, DOC)).where("n_removed > 0")
    assert {r.doc_id for r in done.collect()} == gone


@pytest.mark.parametrize("rows_at_once", [linededup.ROUND_ROWS, 10_000])
def test_edits_spread_evenly_over_long_lines_leave_no_pair_out(spark, monkeypatch, rows_at_once):
    monkeypatch.setattr(linededup, "ROUND_ROWS", rows_at_once)
    rng = random.Random(6)
    line = lambda n: "".join(rng.choice("abcdefghijklmn opqé\U0001f600") for _ in range(n))
    rows = []
    for i, n in enumerate([100, 109, 110, 199, 200, 200, 200, 350, 1000, 1009]):
        first, k = line(n), n // 10
        spread = [(j + 1) * n // (k + 1) for j in range(k)]
        for kind, added in ((0, 0), (100, 0), (200, 0), (300, 1)):
            out = list(first)
            for at in spread + [spread[0] + 3] * added:
                out[at] = {0: "#", 100: "#" + out[at], 200: "", 300: "#"}[kind]
            rows.append((1000 + kind + i, "".join(out)))
        rows.append((i, first))
    want = {frozenset((x, y)) for i, x in enumerate(t for _, t in rows) for y in (t for _, t in rows[:i]) if x != y and _within(x, y)}
    lines = linededup._lines(spark.createDataFrame(rows, DOC), "doc_id", "text", linededup.NEAR_CHARS)
    name = {r.h: r.line for r in lines.collect()}
    got = {frozenset((name[r.a_h], name[r.b_h])) for r in linededup.near_lines(lines).collect()}
    assert got == want and len(want) >= 20


def _long(spark, lines):
    rows = [(i, line, len(line)) for i, line in enumerate(lines)]
    pairs = linededup._long_lines(spark.createDataFrame(rows, "h long, line string, n int")).distinct()
    return {(r.a, r.b) for r in pairs.collect()}


def test_lines_that_share_one_segment_only_do_not_leave_the_turn(spark):
    rng = random.Random(9)
    first = "".join(rng.choice("abcdefghijklmn opq\u00e9") for _ in range(300))
    lines = [first]
    for at in (90, 180, 270):  # equal counts of every letter, one segment at the same place
        rest = list(first[:at] + first[at + 9 :])
        rng.shuffle(rest)
        lines.append("".join(rest[:at]) + first[at : at + 9] + "".join(rest[at:]))
    near = _changed(rng, first, 30)
    assert _long(spark, lines) == set() and _long(spark, [*lines, near]) == {(0, 4)}


@pytest.mark.parametrize("rows_at_once", [linededup.ROUND_ROWS, 3_000])
def test_lines_of_one_length_are_split_by_key_and_no_pair_is_lost(spark, monkeypatch, rows_at_once):
    monkeypatch.setattr(linededup, "ROUND_ROWS", rows_at_once)
    rng = random.Random(10)
    lines = ["".join(rng.choice("abcdefghijklmn opq\u00e9") for _ in range(200)) for _ in range(60)]
    lines += [_changed(rng, line, 20) for line in lines[:30]]
    assert {(i, 60 + i) for i in range(30)} <= _long(spark, lines)


def test_turns_take_every_key_once_and_stay_near_their_share(monkeypatch):
    monkeypatch.setattr(linededup, "ROUND_ROWS", 100)
    sizes = {3: 40, 5: 60, 7: 1, 20: 250, 21: 100, 30: 99}
    turns = linededup._turns(sizes, sum(sizes.values()))
    taken = [(key, part) for first, last, parts, part in turns for key in sizes if first <= key <= last]
    assert sorted({key for key, _ in taken}) == sorted(sizes) and len(taken) == len(set(taken))
    assert all(sum(sizes[key] for key in sizes if first <= key <= last) / parts <= 100 for first, last, parts, _ in turns)
    assert linededup._turns({1: 10_000}, 10_000) == [(1, 1, linededup.MOST_ROUNDS, part) for part in range(linededup.MOST_ROUNDS)]
    assert linededup._turns({}, 0) == []


def test_half_of_the_places_are_probed_and_every_segment_has_its_part_among_them(spark):
    rng = random.Random(11)
    texts = ["".join(rng.choice(letters) for _ in range(300)) for letters in ("abcdefghijklmn opq\u00e9", "ab", "a", "xyz\U0001f600")]
    lines = spark.createDataFrame([(i, t, len(t)) for i, t in enumerate(texts)], "h long, line string, n int")
    wide = lines.withColumn("wide", linededup._wide(F.col("line")))
    at = lambda last: wide.withColumn("at", F.explode(F.sequence(F.lit(0), F.col("n") - last)))
    probed = {(r.h, r.at) for r in at(linededup.GRAM).where(linededup._is_least(F.col("at"))).collect()}
    least = {(r.h, r.place) for r in at(linededup.SEGMENT).select("h", linededup._least_of(F.col("at")).alias("place")).collect()}
    assert least <= probed and sum(h == 0 for h, _ in probed) < 0.6 * 300


def test_long_lines_are_not_copied_for_their_turns(spark, monkeypatch):
    written = []
    plain = linededup.materialize
    monkeypatch.setattr(linededup, "materialize", lambda df, label: written.append(df.columns) or plain(df, label))
    rng = random.Random(12)
    lines = ["".join(rng.choice("abcdefghijklmn opq") for _ in range(200)) for _ in range(10)]
    assert (0, 10) in _long(spark, [*lines, _changed(rng, lines[0], 20)])
    assert written and not any("line" in columns for columns in written)


def test_lines_are_compared_without_the_ends_they_share(spark):
    rng = random.Random(13)
    word = lambda n: "".join(rng.choice("ab\u00e9\U0001f600") for _ in range(n))
    rows = [("a" * 30, "a" * 33), ("a" * 30, "a" * 34), ("ab" * 20, "ba" * 20), ("a" * 5000, "a" * 5500), ("a" * 5000, "a" * 5501)]
    for n in (20, 29, 30, 60, 99, 150, 400):
        for _ in range(12):
            x = word(n)
            spot = rng.randrange(n)
            rows.append((x, x[:spot] + word(rng.randint(0, n // 10 + 2)) + x[spot + rng.randint(0, n // 10 + 2) :]))
    rows = [(x, y) for x, y in rows if x != y]
    near = linededup._within_budget(F.col("x"), F.col("y")).alias("near")
    got = {(r.x, r.y): r.near for r in spark.createDataFrame(rows, "x string, y string").select("x", "y", near).collect()}
    long = {row for row in rows if len(row[0]) == 5000}
    want = {(x, y): _within(x, y) for x, y in set(rows) - long} | {(x, y): len(y) <= 5500 for x, y in long}
    want = {(x, y): w and min(len(x), len(y)) >= 20 for (x, y), w in want.items()}
    assert got == want and 0 < sum(got.values()) < len(got)


def _within(x, y):
    """Whether two lines are within one edit in ten characters of the shorter one."""
    most = min(len(x), len(y)) // 10
    if abs(len(x) - len(y)) > most:
        return False
    row = list(range(len(y) + 1))
    for i, a in enumerate(x, 1):
        new = [i]
        for j, b in enumerate(y, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (a != b)))
        if min(new) > most:
            return False
        row = new
    return row[-1] <= most


def test_near_lines_are_all_pairs_of_sf0001(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    lines = linededup._lines(docs, "doc_id", "text", linededup.NEAR_CHARS)
    got = {(r.a_h, r.b_h) for r in linededup.near_lines(lines).collect()}
    texts = lines.select("h", "line", F.char_length("line").alias("n")).distinct().repartition(8)
    a, b = (texts.select(*[F.col(c).alias(f"{p}_{c}") for c in texts.columns]) for p in "ab")
    least = F.least("a_n", "b_n")
    pairs = a.join(b, (F.col("a_h") < F.col("b_h")) & (F.abs(F.col("a_n") - F.col("b_n")) <= F.floor(least / 10)))
    near = pairs.where(F.call_function("levenshtein", F.col("a_line"), F.col("b_line"), F.floor(least / 10).cast("int")) >= 0)
    assert got == {(r.a_h, r.b_h) for r in near.select("a_h", "b_h").collect()} and len(got) > 0


def test_copies_of_short_lines_go_and_shells_are_dropped(spark):
    long = "a line of more than twenty characters"
    rows = [
        (1, f"Title\n{long}\n\nEnd."), (2, f"Title\n{long}\n\nEnd."),  # a copy with short lines
        (3, f"Own\n{long}"),  # nothing of substance stays
        (4, "Title\nOwn words"), (5, "short"), (6, None), (7, ""), (8, "\n"), (9, f"{long}, but this one with other words\nEnd."),
    ]
    docs = spark.createDataFrame(rows, DOC)
    got = {r.doc_id: (r.text, r.n_removed) for r in linededup.dedup_lines(docs).collect()}
    assert got[2] == ("", 3) and got[3] == ("Own", 1) and got[4] == ("Own words", 1) and got[8] == ("\n", 0)
    kept = {r.doc_id: r.text for r in corpus_pipeline.line_stage(spark, docs, SF).collect()}
    assert kept == {d: t for d, t in rows if d not in (2, 3, 4, 9)} | {4: "Own words", 9: f"{long}, but this one with other words"}


def test_quotes_of_80_characters_are_found_wherever_they_start(spark):
    rng = random.Random(8)
    text = lambda n: "".join(rng.choice("abcdefghijklmnopq é") for _ in range(n))
    items = [(i, text(n)) for i, n in enumerate((81, 120, 155, 300, 401))]
    rows, want, n = [], set(), 0
    for i, item in items:
        for start in range(0, len(item) - 79, 3):
            quote = item[start : start + 80]
            for part, found in ((quote, True), (_changed(rng, quote, 6), True), (quote[:60], False)):
                rows.append((n, text(rng.randrange(90)) + "##" + part + "##" + text(90)))
                want |= {(n, i)} if found else set()
                n += 1
    docs = spark.createDataFrame(rows, DOC)
    got = decontaminate.leaks(docs, spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {(r.doc_id, r.item_id) for r in got} == want


def test_toxic_documents_are_no_target(spark):
    rows = [(1, 1, 0), (2, 1, 1), (3, 1, None), (4, 0, 0), (5, 0, 1), (6, 1, 0), (6, 1, 1)]
    labels = spark.createDataFrame(rows, "doc_id long, quality int, toxic int")
    assert {r.doc_id for r in quality.target_labels(labels).where("target").collect()} == {1, 3}


def test_kept_share_is_that_of_all_labels(spark):
    docs = spark.createDataFrame([(i, f"word{i % 7} text") for i in range(300)], DOC)
    labels = spark.createDataFrame([(i, int(i % 3 > 0), 0) for i in range(200)], "doc_id long, quality int, toxic int")
    assert quality.resample(docs, labels, most_labelled=5).count() == -(-300 * 133 // 200)
