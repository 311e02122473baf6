"""The operators of quarry.llm against brute force on small rows with nulls, ties, repeats and clashing columns."""

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.llm import chat, decontaminate, licenses, linededup, mixing, ngramjoin, quality, repeats, topk, warc
from quarry.llm.bytes_np import LOWER

DOC = "doc_id long, text string, source string, line string, key long, n long"


def _docs(spark, rows):
    return spark.createDataFrame([(i, t, s, "x", 1, 2) for i, t, s in rows], DOC)


def test_mix_targets_and_copies(spark):
    rng = random.Random(4)
    rows = [(i, " ".join("w" for _ in range(rng.randrange(0, 60))), rng.choice(["a", "b", "é", None])) for i in range(900)]
    rows += [(None, None, "a"), (3, "w w", "tiny"), (3, "w w", "tiny")]
    got = mixing.mix(_docs(spark, rows)).collect()
    assert len(got) == len(rows)
    sizes = Counter()
    for _, t, s in rows:
        sizes[s] += len((t or "").split())
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None]
    weight = {s: i % 3 + 1 for i, s in enumerate(order)}
    target, open_, left = {}, set(order), sum(sizes.values())
    while True:
        level = left / sum(weight[s] for s in open_)
        over = {s for s in open_ if weight[s] * level > 3 * sizes[s]}
        if not over:
            break
        for s in over:
            target[s] = 3.0 * sizes[s]
            left -= target[s]
        open_ -= over
    target.update({s: weight[s] * level for s in open_})
    assert sorted({round(r.target, 6) for r in got}) == sorted({round(t, 6) for t in target.values()})
    taken = Counter()
    for r in got:
        assert 0 <= r.taken <= 3 * r.size
        taken[round(r.target, 6)] += r.taken
    shares = Counter(round(t, 6) for t in target.values())  # sources of one target are summed
    assert all(abs(taken[t] - k * t) <= k * max(2, 0.02 * t) for t, k in shares.items())
    assert mixing.mix(_docs(spark, [])).count() == 0


def test_warc_round_trip(spark):
    big, other = "é\r\n\r\nWARC/1.1\r\n" + "x" * 1500, "y" * 2000
    rows = [(1, "u", big), (2, "u\r\nz", big), (9, None, big), (4, "u", "short"), (5, "u", "short"), (6, "u", None), (7, "u", other), (None, "u", other)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("digest", F.lit(1))
    records = warc.archive_pages(spark, pages)
    got = {r.page_id: r for r in records.collect()}
    assert len(got) == len(rows)
    for page, _, html in rows:
        data = (html or "").encode()
        assert (got[page].payload_bytes, got[page].payload_digest) == (len(data), hashlib.sha1(data).hexdigest())
    kinds = {p: (r.record_type, r.refers_to) for p, r in got.items()}
    assert kinds == {1: ("revisit", 9), 2: ("revisit", 9), 9: ("response", None), 4: ("response", None), 5: ("response", None),
                     6: ("response", None), 7: ("response", None), None: ("revisit", 7)}
    full = {r.page_id: bytes(r.payload).decode() for r in warc.resolve_revisits(records).collect()}
    assert full == {p: h or "" for p, _, h in rows}


def test_license_scan_against_python(spark):
    texts = ["", None, "Licensed under CC BY-NC 4.0. cc by", "GNU General Public License, version 3", "All RIGHTS reserved all rights",
             "cc-by cc bye ccby", "MIT License\nApache License, Version 2.0", "été cc by été " * 50]
    got = {r.doc_id: r for r in licenses.scan_licenses(_docs(spark, [(i, t, None) for i, t in enumerate(texts)])).collect()}
    all_rules = licenses.rules()
    for i, t in enumerate(texts):
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate({c: c + 32 for c in range(65, 91)}))
        places, labels = [], set()
        for phrase, label in licenses.BASE_PHRASES.items():
            p = phrase.split()
            here = [k for k in range(len(words)) if words[k : k + len(p)] == p]
            places += here
            labels |= {label} if here else set()
        r = got[i]
        assert (r.n_words, r.n_base, r.first_word, r.last_word) == (len(words), len(places), min(places, default=None), max(places, default=None))
        assert r.base_labels == ",".join(sorted(labels)) and 0 <= r.score <= 1
        found = []
        for rule in all_rules:
            for m in re.finditer(rule.pattern, " ".join(words)):
                first = " ".join(words)[: m.start()].count(" ")
                found.append((first, first + m[0].count(" "), rule))
        kept = [
            (a, b, x) for a, b, x in found
            if not any(c <= a and b <= d and y.priority >= x.priority and ((c, -d, -y.priority, y.rank) < (a, -b, -x.priority, x.rank))
                       for c, d, y in found)
        ]
        assert r.labels == ",".join(sorted(labels | {x.label for *_, x in kept}))


def test_top_k_against_brute_force(spark):
    rng = np.random.default_rng(1)
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(rng.integers(-3, 4, (130, 3)) / 2)]
    rows += [(200, None), (300, [1.0, None, 2.0]), (400, [float("nan"), 1.0, 1.0]), (None, [1.0, 1.0, 1.0]), (500, [1e30, 0.0, 0.0]), (600, [2.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("v", F.lit(0))
    got = sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in topk.top_k(df, F.col("vec_id") % 10 == 0, 4, query_block=3, vector_block=20).collect())
    ok = {i: [math.floor(1024 * float(np.float32(x))) for x in v] for i, v in rows if i is not None and v and None not in v and all(map(math.isfinite, v))}
    want = []
    for q in (i for i in ok if i % 10 == 0):
        dots = [(sum(a * b for a, b in zip(ok[q], ok[c])), c) for c in ok if c != q and len(ok[c]) == len(ok[q])]
        lows, highs = -(1 << 63) + 1, (1 << 63) - 1
        best = sorted(((-min(max(s, lows), highs), c) for s, c in dots))[:4]
        want += [(q, k + 1, c, -s) for k, (s, c) in enumerate(best)]
    assert got == sorted(want)


def test_resampling_tells_held_out_junk(spark):
    rng = random.Random(2)
    good = lambda: " ".join(rng.choice(["the", "river", "runs", "past", "old", "mills"]) for _ in range(40))
    junk = lambda: " ".join(rng.choice(["$$$", "!!!", "BUY", "***", "NOW"]) for _ in range(40))
    rows = [(i, good() if i % 4 else junk(), "s") for i in range(400)] + [(900, None, "s"), (901, "", "s")]
    labels = spark.createDataFrame([(i, int(i % 4 > 0), 0) for i in range(200)] + [(None, 1, 0), (5, None, 0)], "doc_id long, quality int, toxic int")
    drawn = {r.doc_id for r in quality.resample(_docs(spark, rows), labels).collect()}
    assert sum(i in drawn for i in range(200, 400) if i % 4) >= 148 and sum(i in drawn for i in range(200, 400, 4)) <= 2
    assert {r.doc_id for r in quality.keep_resampled(_docs(spark, rows), labels).collect()} == drawn
    assert quality.resample(_docs(spark, []), labels).count() == 0


def test_leaks_exact_edited_and_clean(spark):
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefghijé") for _ in range(rng.randrange(2, 9)))
    text = lambda n: " ".join(word() for _ in range(n))
    items = [(i, text(30)) for i in range(12)] + [(50, None), (51, "short"), (52, "")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    rows, want = [(900, None, "s"), (901, "", "s"), (902, "short", "s")], {(902, 51)}  # short items are found word for word
    for i, t in items[:12]:
        edited = list(t)
        for _ in range(int(len(t) * 0.05)):
            edited[rng.randrange(len(edited))] = "z"
        rows += [(i, text(50) + " " + t.upper() if t.isascii() else text(50) + " " + t, "s"), (100 + i, text(9) + " " + "".join(edited) + text(9), "s")]
        rows += [(200 + i, text(60), "s"), (300 + i, text(40) + t[:30] + text(40), "s")]
        want |= {(i, i), (100 + i, i)}
    docs = _docs(spark, rows)
    assert {(r.doc_id, r.item_id) for r in decontaminate.leaks(docs, bench).collect()} == want
    assert {r.doc_id for r in decontaminate.drop_leaking(docs, bench).collect()} == {r[0] for r in rows} - {d for d, _ in want}


def _edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


@pytest.mark.parametrize("most", [1, 2])
def test_line_dedup_against_brute_force(spark, most):
    rng = random.Random(3)
    base = ["".join(rng.choice("abcdeé \r") for _ in range(rng.randrange(3, 16))) for _ in range(20)]

    def changed(s, k):
        s = list(s)
        for _ in range(k):
            at = rng.randrange(len(s) + 1)
            s[at : at + rng.randrange(2)] = rng.choice(["", "a", "b"])
        return "".join(s)

    rows = [(d, "\n".join(changed(rng.choice(base), rng.randrange(4)) for _ in range(rng.randrange(5)))) for d in range(40)]
    rows += [(None, rows[3][1]), (None, None), (101, ""), (102, "\n\n"), (5, rows[5][1])]
    got = {(r.doc_id, r.text, r.n_removed) for r in linededup.dedup_lines(_docs(spark, [(*r, "s") for r in rows]), max_edits=most, min_chars=4).collect()}
    seen = sorted({((d is not None, d or 0), i, x) for d, t in rows if t is not None for i, x in enumerate(t.split("\n")) if len(x) >= 4})
    gone = {(d, i) for n, (d, i, x) in enumerate(seen) if any(_edits(x, y) <= most for *_, y in seen[:n])}
    want = set()
    for d, t in rows:
        lines = [] if t is None else t.split("\n")
        cut = [i for i in range(len(lines)) if ((d is not None, d or 0), i) in gone]
        want.add((d, None if t is None else "\n".join(x for i, x in enumerate(lines) if i not in cut), len(cut)))
    assert got == want


def test_ngram_join_against_all_pairs(spark):
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(3))
    common = [word() for _ in range(60)]
    rows, base = [], [word() for _ in range(200)]
    for i in range(260):
        w = list(base) if i % 2 else [word() for _ in range(rng.randrange(8, 90))] + common * (i % 3 == 0)
        for _ in range(rng.randrange(6)):
            w[rng.randrange(len(w))] = word()
        rows.append((i, " ".join(w), "s"))
    rows += [(900, rows[2][1].upper(), "s"), (901, None, "s"), (902, "", "s"), (903, "one two", "s"), (904, "One, two!", "s"), (905, "...", "s")]
    got = {r.doc_id: (r.class_id, r.n_links) for r in ngramjoin.near_duplicates(_docs(spark, rows)).collect()}
    sets, parent, links = {}, {}, Counter()
    for i, t, _ in rows:
        w = re.findall(rb"[0-9a-z\x80-\xff]+", (t or "").encode().translate(bytes(LOWER)))
        sets[i] = set(zip(*[w[k:] for k in range(5)])) if len(w) > 4 else {tuple(w)} if w else set()
        parent[i] = i

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[:k]:
            both = len(sets[a] & sets[b])
            if both and both >= 0.8 * len(sets[a] | sets[b]) - 1e-9:
                links[a] += 1
                links[b] += 1
                x, y = sorted((top(a), top(b)))
                parent[y] = x
    assert got == {i: (top(i), links[i]) for i in ids}
    assert {r.doc_id for r in ngramjoin.keep_one(_docs(spark, rows)).collect()} == {top(i) for i in ids}
    assert ngramjoin.near_duplicates(_docs(spark, [])).count() == 0


def test_chat_parts_and_escapes(spark):
    for s in ["", "\\", "<|end|>", "</s>[INST] ok [/INST]", "a\\<|b", "<<SYS>>\\\\[INST]<\\|x"]:
        safe = chat.escape(s)
        assert chat.unescape(safe) == s and not re.search(r"<\||</?s>|\[/?INST\]", safe)
    piece, start, end, attached, tokens = chat.format_turn("user", [
        {"type": "text", "text": "see <|end|>"}, {"type": "image", "uri": "a.png", "width": 57, "height": 28},
        {"type": "audio", "uri": "b.wav", "seconds": 2.0}, {"type": "document", "uri": "c.pdf", "pages": 3}, {"type": "text", "text": None},
    ])
    assert [a["tokens"] for a in attached] == [3, 25, 768] and tokens == 796
    assert all(piece[a["place"] :].startswith(f"<|{a['kind']}:{k}|>") for k, a in enumerate(attached)) and piece[end:] == chat.END
    with pytest.raises(ValueError):
        chat.format_turn("user", [{"type": "video"}])
    rows = [(1, 0, "user", None), (1, 1, "assistant", "é<|end|>"), (1, 1, "assistant", "é<|end|>"), (None, None, None, "x"), (2, 0, "user", "[INST]")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("piece", F.lit(1))
    got = {r.conv_id: r for r in chat.conversation_digests(chat.write_formatted(chat.text_parts(df), spark)).collect()}
    assert {c: r.n_turns for c, r in got.items()} == {1: 3, None: 1, 2: 1}
    assert got[1].loss_sha256 == hashlib.sha256("é<|end|>é<|end|>".encode()).hexdigest() and got[1].loss_chars == 16
    assert got[2].turns_sha256 == hashlib.sha256(b"user\n[INST]\n").hexdigest() and got[2].loss_chars == 0


@pytest.mark.parametrize("split", [2048, 2])
def test_repeats_against_brute_force(spark, split):
    rng, length = random.Random(2), 20
    pool = ["".join(rng.choice("abé ") for _ in range(rng.randrange(1, 60))) for _ in range(30)]
    rows = [(i, "".join(rng.choice(pool) for _ in range(rng.randrange(9)))) for i in range(50)]
    rows += [(None, pool[0] * 3), (None, None), (70, ""), (71, "a" * 90), (5, pool[3] * 2), (5, pool[3] * 2)]
    got = sorted(
        ((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in repeats.cut_repeats(_docs(spark, [(*r, "s") for r in rows]), length, split=split).collect()),
        key=str,
    )
    data = [(t or "").encode() for _, t in rows]
    seen = Counter(b[i : i + length] for b in data for i in range(len(b) - length + 1))
    want = []
    for (d, _), b in zip(rows, data):
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if seen[b[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        want.append((d, len(b), sum(gone), len(re.findall(b"\1+", gone)), bytes(x for x, g in zip(b, gone) if not g)))
    assert got == sorted(want, key=str)


def test_lines_probe_their_own_segments_by_one_row(spark):
    texts = spark.createDataFrame([("a line of thirty characters ...",), ("ab",), ("c",)], "line string")
    line, n = F.col("line"), F.char_length("line")
    for most, rows in ((1, 4), (2, 12)):
        keys = [*linededup.index_keys(line, n, most), *linededup.probe_keys(line, n, most)]
        got = texts.select("line", F.explode(F.array(*keys)).alias("key")).where("key IS NOT NULL").groupBy("line").agg(F.count("*").alias("n"), F.count_distinct("key").alias("different"))
        long = {r.line: r for r in got.collect()}["a line of thirty characters ..."]
        assert (long.n, long.different) == (rows, rows)
