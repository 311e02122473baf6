"""What the line stage's turns write, keep and compare."""

import os
import random

import pytest

from quarry.llm import linededup


def _line(rng, n):
    return "".join(rng.choice("abcdefghijklmn opqé") for _ in range(n))


def _spread(line, edits, sign="#"):
    out = list(line)
    for j in range(edits):
        out[(j + 1) * len(line) // (edits + 1)] = sign
    return "".join(out)


@pytest.mark.parametrize("rows_at_once", [linededup.ROUND_ROWS, 6_000, 150])
def test_a_turn_of_long_lines_leaves_its_pairs_only(spark, monkeypatch, rows_at_once):
    written, plain = [], linededup.materialize

    def noted(df, label):
        table = plain(df, label)
        written.append((label, table.columns, [f.removeprefix("file://") for f in table.inputFiles()]))
        return table

    monkeypatch.setattr(linededup, "ROUND_ROWS", rows_at_once)
    monkeypatch.setattr(linededup, "materialize", noted)
    rng = random.Random(14)
    lines = [_line(rng, n) for n in ((100, 107, 119, 160, 179, 180, 199, 360) if rows_at_once > 1000 else (720, 360)) for _ in range(4)]
    monkeypatch.setattr(linededup, "MOST_ROUNDS", 64 if rows_at_once > 1000 else 4)  # then parts are shares of a large table
    near = [_spread(line, len(line) // 10) for line in lines]
    rows = [(i, line, len(line)) for i, line in enumerate([*lines, *near])]
    pairs = {(r.a, r.b) for r in linededup._long_lines(spark.createDataFrame(rows, "h long, line string, n int")).collect()}
    assert pairs == {(i, len(lines) + i) for i in range(len(lines))}
    kept = [(label, columns) for label, columns, files in written if any(os.path.exists(f) for f in files)]
    assert kept and all(row == ("line-round", ["a", "b"]) for row in kept)


def test_a_line_whose_likeliest_pair_is_not_near_is_still_compared_with_the_others(spark):
    rng = random.Random(15)
    third = _line(rng, 300)
    first = third[:100] + third[120:140] + third[100:120] + third[140:]  # the same letters, two parts exchanged
    docs = spark.createDataFrame([(1, first), (2, _spread(third, 20)), (3, third)], "doc_id long, text string")
    assert {r.doc_id for r in linededup.dedup_lines(docs).where("n_removed > 0").collect()} == {3}
