"""Merkle manifest, learned partitions and lexical search against brute force on small rows."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from quarry.llm import lexical, merkle, neighbours

DOCS = "doc_id long, text string, lang string, source string, n_chars long, `group` int, rank int, m int, piece string"


def _docs(spark, rows):
    return spark.createDataFrame([(i, t, g, "s", c, 0, 0, 1, "p") for i, t, g, c in rows], DOCS)


def _digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def _tree(hashes, fan=8):
    """Root, and per leaf its siblings ``(left, right)`` level by level."""
    steps, place, level = [[] for _ in hashes], list(range(len(hashes))), list(hashes)
    while len(level) > 1:
        for i, p in enumerate(place):
            run = level[p // fan * fan : p // fan * fan + fan]
            steps[i].append(("".join(run[: p % fan]), "".join(run[p % fan + 1 :])))
        place = [p // fan for p in place]
        level = [_digest("".join(level[i : i + fan])) for i in range(0, len(level), fan)]
    return level[0], steps


def _manifest(rows):
    enc = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    hashed = lambda r, text: _digest("".join(enc(v) for v in (r[0], "s", r[2], r[3], text)))
    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append((r, hashed(r, r[1])))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for g in names:
        groups[g].sort(key=lambda x: (x[0][0] is not None, x[0][0] or 0, x[1]))
        trees[g] = _tree([h for _, h in groups[g]])
    root, crown = _tree([trees[g][0] for g in names])
    out = []
    for g, above in zip(names, crown):
        for (r, own), steps in zip(groups[g], trees[g][1]):
            proof, node = steps + above, own
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0 and r[1] is not None:
                node = hashed(r, re.sub("[A-Z]", lambda x: x[0].lower(), r[1]))
            for left, right in proof:
                node = _digest(left + node + right)
            out.append((r[0], own, trees[g][0], root, _digest("".join(a + b for a, b in proof)), node, node == root))
    return sorted(out, key=str)


def test_manifest_equals_brute_force(spark):
    rows = [(i, f"Text É {i}", g, i) for g in (None, "", "é", "de") for i in range(9)]  # two levels, the last run of one
    rows += [(None, None, None, None)] * 3 + [(5, "A", "lone", None), (6, "", "lang", 0), (12, "Z" * 300_000, "lang", 1)]
    rows += [(7, "Same row", "many", 1)] * 600 + [(i, "B", f"l{i}", 1) for i in range(30)]  # over a block of 512; many groups
    got = sorted(map(tuple, merkle.verified_manifest(_docs(spark, rows)).collect()), key=str)
    assert got == _manifest(rows)
    assert merkle.verified_manifest(_docs(spark, rows[:1]).limit(0)).count() == 0
    alone = merkle.verified_manifest(_docs(spark, rows[:1])).first()
    assert alone.leaf == alone.subroot == alone.root and alone.proof_sha256 == _digest("")


def test_a_changed_leaf_does_not_fold_to_the_root(spark):
    rows = merkle.manifest(_docs(spark, [(i, f"t{i}", "en", i) for i in range(70)]))
    other = F.sha2(F.lit("other"), 256)
    got = rows.select((merkle.folded(F.col("leaf"), F.col("proof")) == F.col("root")).alias("own"), (merkle.folded(other, F.col("proof")) == F.col("root")).alias("other"))
    assert {tuple(r) for r in got.collect()} == {(True, False)}


def test_block_steps_do_not_shuffle(spark):
    nodes = spark.createDataFrame([("=a", 0, 1, "h", 3)], "group string, rank long, n long, hash string, id long")
    plan = merkle.nested(nodes, 8, ["id"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def _exact_nearest(rows, mod, k):
    usable = lambda v: v is not None and all(x is not None and math.isfinite(x) for x in v) and any(v)
    ok, out = [(i, v) for i, v in rows if usable(v)], []
    for a, (query, q) in enumerate(ok):
        if query is None or query % mod:
            continue
        near = []
        for b, (i, c) in enumerate(ok):
            if a != b and len(c) == len(q):
                score = 0.0
                for x, y in zip(q, c):
                    score += x * y
                near.append((-score, i is not None, i or 0, i))
        out += [(query, n + 1, x[3], -x[0]) for n, x in enumerate(sorted(near, key=lambda x: x[:3])[:k])]
    return sorted(out, key=str)


def test_one_part_is_exact(spark):
    rng = np.random.default_rng(1)
    rows = [(i, [float(x) for x in rng.integers(-3, 4, 5)]) for i in range(150)] + [(20, [1.0, 2.0, 3.0, 4.0, 5.0])] * 3
    rows += [(None, [9.0] * 5), (40, None), (60, [0.0] * 5), (80, [1.0, None, 2.0, 3.0, 4.0]), (100, [float("nan")] * 5), (100, [math.inf] * 5)]
    rows += [(140, [1.0, 2.0]), (141, [1.0, 3.0]), (160, [])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumns({c: F.lit(1) for c in ("row", "part", "q", "length")})
    got = neighbours.nearest(table, F.col("vec_id") % 20 == 0)
    assert sorted(map(tuple, got.collect()), key=str) == _exact_nearest(rows, 20, 20)
    assert neighbours.nearest(table.limit(0), F.col("vec_id") % 20 == 0).count() == 0


def test_learned_partitions_reach_the_recall(spark):
    """Clusters of a known kind, a third of all rows copies of one vector; 4,000 rows are eight parts."""
    rng = np.random.default_rng(2)
    x = rng.normal(size=(40, 16))[rng.integers(0, 40, 4000)] + 0.3 * rng.normal(size=(4000, 16))
    x[::3] = x[0]
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    got = neighbours.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), F.col("vec_id") % 50 == 0, k=10).collect()
    x = x.astype(np.float32).astype(float)
    scores = x @ x.T
    hits = 0
    assert len(got) == 80 * 10
    for query in range(0, 4000, 50):
        own = sorted((r.rank, r.vec_id, r.score) for r in got if r.query_id == query)
        assert [r for r, *_ in own] == list(range(1, 11)) and query not in [v for _, v, _ in own]
        assert all(abs(s - scores[query, v]) < 1e-9 for _, v, s in own)
        assert own == sorted(own, key=lambda o: (-o[2], o[1]))
        floor = np.sort(np.delete(scores[query], query))[-10]
        hits += sum(s >= floor - 1e-9 for *_, s in own)
    assert hits >= 0.9 * 800


def test_router_visits_fewer_parts_than_there_are(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(64, 16))[rng.integers(0, 64, 4096)] + 0.2 * rng.normal(size=(4096, 16))
    router = neighbours.fit(x, 16, 10, 0.95)
    sizes = np.bincount(router.ranked(x)[:, 0], minlength=16)
    assert router.probes <= 6 and sizes.max() < 3 * 4096 / 16


TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def _terms(text):
    return [] if text is None else TERM.findall(re.sub("[A-Z]", lambda x: x[0].lower(), text))


def _ranking(docs, items, k=10):
    counts = [(i, Counter(_terms(t))) for i, t in docs]
    counts = [(i, c, sum(c.values())) for i, c in counts if c]
    n_docs, n_terms = len(counts), sum(n for *_, n in counts)
    df = Counter(t for _, c, _ in counts for t in c)
    asked = {}
    for i, t in items:
        asked.setdefault(i, set()).update(_terms(t))
    out = []
    for item, terms in asked.items():
        scored = []
        for i, c, n in counts:
            m = 10 + 90 * n * n_docs // n_terms
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t in terms if t in c)
            scored += [(-score, i is not None, i or 0, i)] if score > 0 else []
        out += [(item, n + 1, x[3], -x[0]) for n, x in enumerate(sorted(scored, key=lambda x: x[:3])[:k])]
    return sorted(out, key=str)


def test_lexical_search_equals_brute_force(spark, monkeypatch):
    rng = np.random.default_rng(4)
    words = [f"w{i}" for i in range(60)] + ["É", "é", "Straße", "10", "a_b"]
    text = lambda n: " ".join(words[min(int(x), 64)] for x in rng.exponential(12, n))
    docs = [(i, text(int(rng.integers(1, 80)))) for i in range(300)] + [(5, "W1 w2, w3")] * 400  # a hot stratum of equal rows
    docs += [(None, "w1 w2 w3"), (None, None), (900, None), (901, ""), (902, " _-! "), (903, "W1 " * 50_000 + "x w2"), (904, text(3000))]
    items = [(i, text(8)) for i in range(20)] + [(1, "W1 w1 W1"), (None, "é"), (None, "É straße"), (50, None), (51, "?"), (52, "unseen"), (53, text(400))]
    d = spark.createDataFrame([(i, t, "x", 1, 2) for i, t in docs], "doc_id long, text string, m string, id long, n long").repartition(3)
    q = spark.createDataFrame(items, "item_id long, text string").withColumn("doc_id", F.lit("z"))
    want = _ranking(docs, items)
    assert sorted(map(tuple, lexical.search(d, q).collect()), key=str) == want
    monkeypatch.setattr(lexical, "BLOCK_TERMS", 40)  # several blocks of queries
    assert sorted(map(tuple, lexical.search(d, q).collect()), key=str) == want
    assert lexical.search(d.limit(0), q).count() == 0 and lexical.search(d, q.limit(0)).count() == 0


def test_pieces_of_one_normaliser_are_bounded(spark):
    docs = spark.createDataFrame([(i, f"same size text {i % 7}") for i in range(3000)], "doc_id long, text string")
    index, n_docs, n_terms = lexical.build_index(docs)
    got = index.agg(F.sum(F.size("ids")), F.max(F.size("ids")), F.countDistinct("m")).first()
    assert (n_docs, n_terms) == (3000, 12000) and got[0] == 3000 and got[1] < 2 * lexical.PIECE_DOCS and got[2] == 1
