"""Merkle manifest of a table: hash trees per group, their roots in one tree, a proof per row.

A leaf is the SHA-256 (hex) of a row's fields, each ``-`` if null, else its UTF-8 byte count,
``:`` and its value. In a group the leaves stand by id; while more than one node remains,
every ``fan`` consecutive ones become the hash of their hex digests. The last node is the
group's root (``subroot``); the groups' roots, by group, make ``root`` the same way.

Rolling up. A row's rank in its group is written as digits of base ``fan``. ``fan ** DIGITS``
consecutive rows are a block, dealt to a task as a whole; inside a block the digits are grouped
away one after the other, each time nesting the child structs in their parent, so a
block ends as one nested row and no further shuffle takes place. The block roots are the rows of
the next, ``fan ** DIGITS`` times smaller table, until a group is one block. Proofs come back
down: a block row is opened digit by digit, every child with its siblings left and right of
it, without joins. Only what lies above a block is joined to it, one row per block.

No step holds more than one block, however large a group is. Ranks come from a range sort of
the leaves (ids and digests, not the texts).

Nulls, ties, repeats: null fields are ``-``; a null group is a group of its own and the first; null ids
come first in a group; rows that share an id stand by their digest, and equal rows are a leaf
each. An empty table gives no rows. Other columns are ignored unless carried.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.operators.models import materialize

FAN, DIGITS = 8, 3
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_NO_STEPS = "array<struct<left:string,right:string>>"
_PLACE_BITS = (1 << 33) - 1


def digest(*parts: Column) -> Column:
    """Lower-case hex SHA-256 of the parts put together."""
    return F.sha2(F.concat(*parts), 256)


def encoded(value: Column) -> Column:
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf(fields: Sequence[Column | str]) -> Column:
    return digest(*[encoded(F.col(f) if isinstance(f, str) else f) for f in fields])


def ranked(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """``rows`` with ``rank`` (from 0) and ``n`` (rows) in its ``group`` (no nulls), by ``order``.

    The range sort is written, since its boundaries come from a sample. A (task, group) run starts
    where the group's runs of earlier tasks end; there are fewer runs than tasks and groups together.
    Rows equal in ``order`` are told apart by their place in the input, so that they spread too.
    """
    by = ["group", *order, F.monotonically_increasing_id()]
    placed = materialize(
        rows.repartitionByRange(*by)
        .sortWithinPartitions("group", *order)
        .select("*", F.spark_partition_id().alias("task"), F.monotonically_increasing_id().bitwiseAND(F.lit(_PLACE_BITS)).alias("place")),
        "merkle-places",
    )
    runs = placed.groupBy("group", "task").agg(F.count(F.lit(1)).alias("rows"), F.min("place").alias("first"))
    by_task = Window.partitionBy("group").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    starts = runs.select(
        "group", "task", (F.coalesce(F.sum("rows").over(by_task), F.lit(0)) - F.col("first")).alias("shift"),
        F.sum("rows").over(Window.partitionBy("group")).alias("n"),
    )
    return placed.join(starts, ["group", "task"]).withColumn("rank", F.col("place") + F.col("shift")).drop("task", "place", "shift")


def nested(nodes: DataFrame, fan: int, carry: Sequence[str] = ()) -> DataFrame:
    """``group, n, block, node``: one row per block of ``nodes`` (``group, rank, n, hash`` and ``carry``).

    ``node`` has the block's ``hash`` and its ``kids``, nested as often as there are digits.
    """
    digits = [F.floor(F.col("rank") / fan**i) % fan for i in range(DIGITS)]
    rows = nodes.select(
        "group", "n", F.floor(F.col("rank") / fan**DIGITS).alias("block"),
        *[d.cast("int").alias(f"d{i}") for i, d in enumerate(digits)], F.struct("hash", *carry).alias("node"),
    ).repartition("group", "block")
    for i in range(DIGITS):
        left = [f"d{j}" for j in range(i + 1, DIGITS)]
        kids = F.transform(F.sort_array(F.collect_list(F.struct(f"d{i}", "node"))), lambda k: k["node"])
        rows = rows.groupBy("group", "n", "block", *left).agg(kids.alias("kids"))
        own = F.when(F.col("n") > fan**i, digest(F.array_join("kids.hash", ""))).otherwise(F.col("kids")[0]["hash"])
        rows = rows.select("group", "n", "block", *left, F.struct(own.alias("hash"), "kids").alias("node"))
    return rows


def opened(blocks: DataFrame, fan: int) -> DataFrame:
    """The lowest ``node`` of every block row and its ``steps`` up to the root, lowest first."""
    keep = [c for c in blocks.columns if c not in ("node", "steps")]
    for i in reversed(range(DIGITS)):
        kids = blocks.select(*keep, "steps", F.col("node.kids.hash").alias("hashes"), F.posexplode("node.kids").alias("at", "kid"))
        before = F.array_join(F.slice("hashes", F.lit(1), F.col("at")), "")
        after = F.array_join(F.slice("hashes", F.col("at") + 2, F.lit(fan)), "")
        step = F.array(F.struct(before.alias("left"), after.alias("right")))
        steps = F.when(F.col("n") > fan**i, F.concat(step, "steps")).otherwise(F.col("steps"))
        blocks = kids.select(*keep, steps.alias("steps"), F.col("kid").alias("node"))
    return blocks


def _climb(nodes: DataFrame, fan: int, carry: Sequence[str] = ()) -> list[DataFrame]:
    """Written block tables, from the lowest to the one with a single block per group."""
    levels, most = [], None
    while most is None or most > 1:
        blocks = materialize(nested(nodes, fan, carry if not levels else ["rank"]), "merkle-blocks")
        levels.append(blocks)
        most = (blocks.agg(F.max("block")).first()[0] or 0) + 1
        blocks_of = F.ceil(F.col("n") / fan**DIGITS).alias("n")
        nodes = blocks.select("group", F.col("block").alias("rank"), blocks_of, F.col("node.hash").alias("hash"))
    return levels


def _descend(levels: list[DataFrame], top: DataFrame, fan: int) -> DataFrame:
    """Every lowest node with its steps. ``top``: per group ``subroot, root`` and the steps between them."""
    above = levels[-1].join(top, "group")
    for lower in reversed(levels[:-1]):
        up = opened(above, fan).select("group", F.col("node.rank").alias("block"), "subroot", "root", "steps")
        above = lower.join(up, ["group", "block"])
    return opened(above, fan)


def manifest(
    docs: DataFrame,
    fields: Sequence[str] = FIELDS,
    id_col: str = "doc_id",
    group_col: str = "lang",
    carry: dict[str, Column] | None = None,
    fan: int = FAN,
) -> DataFrame:
    """One row per row: the id (as ``id_col``), ``leaf, subroot, root, proof``, and the columns of ``carry``.

    ``proof`` lists the siblings ``left`` and ``right`` of the row's node, level by level from the leaf to
    the root, as texts of hex digests; ``folded`` computes the root from it.
    """
    carry = carry or {}
    group = F.col(group_col).cast("string")
    names = [f"c{i}" for i in range(len(carry))]
    leaves = materialize(
        docs.select(
            F.when(group.isNull(), F.lit("")).otherwise(F.concat(F.lit("="), group)).alias("group"),
            F.col(id_col).alias("id"), leaf(fields).alias("hash"), *[c.alias(n) for n, c in zip(names, carry.values())],
        ),
        "merkle-leaves",
    )
    levels = _climb(ranked(leaves, ["id", "hash"]), fan, ["id", *names])
    roots = levels[-1].select(F.lit("").alias("group"), F.col("group").alias("name"), F.col("node.hash").alias("hash"))
    group_levels = _climb(ranked(roots, ["name"]), fan, ["name"])
    whole = group_levels[-1].select("group", F.col("node.hash").alias("root"), F.col("node.hash").alias("subroot"), F.array().cast(_NO_STEPS).alias("steps"))
    top = _descend(group_levels, whole, fan).select(F.col("node.name").alias("group"), F.col("node.hash").alias("subroot"), "root", "steps")
    rows = _descend(levels, materialize(top, "merkle-groups"), fan)
    return rows.select(
        F.col("node.id").alias(id_col), F.col("node.hash").alias("leaf"), "subroot", "root", F.col("steps").alias("proof"),
        *[F.col(f"node.{n}").alias(c) for n, c in zip(names, carry)],
    )


def folded(leaf_digest: Column, proof: Column) -> Column:
    """The root that a leaf's digest and its proof give."""
    return F.aggregate(proof, leaf_digest, lambda node, step: digest(step["left"], node, step["right"]))


def proof_digest(proof: Column) -> Column:
    return F.sha2(F.array_join(F.transform(proof, lambda s: F.concat(s["left"], s["right"])), ""), 256)


UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def tampered_leaf(fields: Sequence[str] = FIELDS, id_col: str = "doc_id", text_col: str = "text") -> Column:
    """The leaf of a row whose text was put in lower case (A-Z only), if 3 divides the CRC-32 of its id; else null."""
    hit = F.crc32(F.col(id_col).cast("string")) % 3 == 0
    lowered = F.translate(F.col(text_col), UPPER, LOWER)
    return F.when(hit, leaf([lowered if f == text_col else f for f in fields]))


def verified_manifest(docs: DataFrame) -> DataFrame:
    """The manifest's digests, and whether each row's (tampered, else own) leaf still folds to the root."""
    rows = manifest(docs, carry={"tampered": tampered_leaf()})
    again = folded(F.coalesce("tampered", "leaf"), F.col("proof"))
    return rows.select(
        "doc_id", "leaf", "subroot", "root", proof_digest(F.col("proof")).alias("proof_sha256"), again.alias("folded_root")
    ).withColumn("verified", F.col("folded_root") == F.col("root"))
