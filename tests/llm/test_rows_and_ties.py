"""Rows that share an id, ties by text, and columns that clash with internal names."""

import hashlib

from pyspark.sql import functions as F

from quarry.llm import chat, decontaminate, linededup, ngramjoin, quality, topk


def test_rows_that_share_an_id_are_rows_of_their_own(spark):
    rows = [(0, [1.0, 0.0]), (5, [0.5, 0.0]), (5, [0.25, 1.0]), (6, [0.1, 0.0]), (0, [2.0, 0.0])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumns({c: F.lit(7) for c in ("row", "own", "query", "block")})
    got = sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in topk.top_k(table, F.col("vec_id") == 0, 10).collect())
    one = [(0, 2048 * 1024), (5, 512 * 1024), (5, 256 * 1024), (6, 102 * 1024)]
    two = [(0, 2048 * 1024), (5, 512 * 2048), (5, 256 * 2048), (6, 102 * 2048)]
    assert got == sorted((0, n + 1, *x) for own in (one, two) for n, x in enumerate(own))


def test_equal_turns_stand_by_their_text_not_by_its_escaped_form(spark):
    texts = ["<|a", "<{b", "<", "< 1", "\\", "[x", "<|", None, ""]
    turns = chat.text_parts(spark.createDataFrame([(1, 0, "user", t) for t in texts], "conv_id long, turn long, role string, text string"))
    got = chat.conversation_digests(chat.write_formatted(turns, spark)).first()
    joined = "".join(f"user\n{t}\n" for t in sorted((t or "" for t in texts), key=lambda t: t.encode()))
    assert got.turns_sha256 == hashlib.sha256(joined.encode()).hexdigest() and got.n_turns == len(texts)


def test_short_items_and_items_without_an_id_are_found(spark):
    long = "a question of more than eighty characters, so that it has windows of its own to be found by, here and there"
    items = [(1, "Red fox, 22 chars long"), (None, long), (3, "?!"), (4, None), (5, ""), (6, "red FOX, 22 chars\tlong"), (7, "né")]
    rows = [(1, "x red fox, 22 chars long y"), (2, f"so {long.upper()} it is"), (3, "tred fox, 22 chars long"), (4, None), (5, "?!"), (6, "né, né and née"), (7, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id): (r.start, r.end) for r in decontaminate.leaks(docs, bench).collect()}
    assert got.keys() == {(1, 1), (1, 6), (2, None), (6, 7)} and got[1, 1] == (2, 24) and got[6, 7] == (0, 6)
    assert {r.doc_id for r in decontaminate.drop_leaking(docs, bench).collect()} == {3, 4, 5, 7}
    short = bench.where("item_id = 7")
    assert {r.doc_id for r in decontaminate.leaks(docs, short).collect()} == {6} and decontaminate.leaks(docs, bench.limit(0)).count() == 0


def test_one_row_of_a_class_stays_whatever_its_id(spark):
    copy, near, other = "one two three four five six seven eight nine ten " * 3, "ONE two three four five six seven eight nine ten " * 3, "a text of its own that nobody else has in the table"
    lone = "rows without any id are one class if their texts are alike"
    rows = [(1, copy, "a"), (1, copy, "b"), (1, copy, "b"), (2, copy, "c"), (2, other, "d"), (None, copy, "e"), (3, near, "f")]
    rows += [(None, lone, "g"), (None, lone, "g"), (7, "", "h"), (7, "", "h"), (8, None, "i")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _gone string").withColumns({c: F.lit(1) for c in ("marked_id", "text_hash", "root", "n")})
    got = sorted(((r.doc_id, r.text, r._gone) for r in ngramjoin.keep_one(docs).collect()), key=str)
    want = [(1, copy, "a"), (2, other, "d"), (None, lone, "g"), (7, "", "h"), (7, "", "h"), (8, None, "i")]
    assert got == sorted(want, key=str)
    assert ngramjoin.keep_one(docs).columns == docs.columns and ngramjoin.keep_one(docs.limit(0)).count() == 0


def test_added_columns_give_way_to_those_of_the_table(spark):
    line = "a line of more than twenty characters"
    rows = [(1, line, 7), (2, line + "\nown words", 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_lines int").withColumns({c: F.lit(1) for c in ("n_removed", "emptied", "places", "_doc", "h", "first")})
    got = {r.doc_id: r.asDict() for r in linededup.dedup_lines(docs).collect()}
    assert got[2]["text"] == "own words" and (got[2]["n_lines"], got[2]["_n_lines"], got[2]["_n_removed"], got[2]["_emptied"]) == (7, 2, 1, True)
    assert got[1]["text"] == line and got[1]["_n_removed"] == 0


def test_other_column_names(spark):
    docs = spark.createDataFrame([(i, "good words here" if i % 2 else "$$$ !!!", 1) for i in range(40)], "key long, body string, drawn_id int")
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(20)], "doc_id long, quality int, toxic int")
    kept = quality.keep_resampled(docs, labels, id_col="key", text_col="body")
    assert kept.columns == docs.columns and kept.count() == 20
    near = ngramjoin.keep_one(docs.select("key", "body"), id_col="key", text_col="body")
    assert sorted(r.key for r in near.collect()) == sorted([1, *range(0, 40, 2)])
    done = linededup.dedup_lines(docs, "key", "body", max_edits=1, min_chars=3)
    assert done.where("n_removed = 0").count() == 2
