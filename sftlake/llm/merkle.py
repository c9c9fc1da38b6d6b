"""Merkle manifest of a dataset, and octopus multiproofs of all its rows.

Every row is a leaf: the digest of its fields. The leaves of a group (a language) stand by key and
fold in pairs, level by level, to the group's subroot; an odd last node folds alone. The subroots
fold the same way to the root. H is sha256 in lowercase hex of its inputs end to end, digests as
hex text.

**Leaf partitions.** One range sort of the leaf digests (not the texts) deals them out in order; a
run of at most ``1 << PART_BITS`` leaves of one group is a leaf partition [a, a + m) of its group's
n leaves. It computes the nodes that lie inside it and hands up only those whose parent does not:
two a level at most. Nodes across partitions are folded from these, 12 levels a round, in groups
of at most 4,096 nodes a level-12 ancestor. So the stored node table holds a few nodes a
partition, not one a leaf.

**Octopus multiproofs.** The proofs of all leaves of a partition together lack only the siblings
at both ends of its run, level by level. Those coordinates follow from (a, m, n); the partition
fetches their union in one join, derives all interior nodes that its leaves share, and expands the
proof of each leaf from them locally. A popular node near the root is asked for once a
partition, not once a leaf, and no task sees more than its partitions.

Results for odd rows: a null field counts as ``-``, an empty text as ``0:``. A null group is a
group of its own, before all others; other groups stand bytewise. Null keys come first; rows with
one key stand by their digest, and rows alike in all fields have like digests, so their places
can be swapped without a difference. A lone leaf is its group's subroot, a lone subroot the root.
Other columns are left out, and an empty table gives no rows."""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sftlake.llm.common import checkpointed, ship_package

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
PART_BITS = 14
ROUND_LEVELS = 12
_PROOF = "array<struct<side:tinyint,digest:string>>"


def leaf_digest(*fields: Column) -> Column:
    """H of the fields, each ``-`` if null, else its UTF-8 byte count, ``:`` and the value."""
    text = lambda c: F.coalesce(F.concat(F.octet_length(c.cast("string")).cast("string"), F.lit(":"), c.cast("string")), F.lit("-"))
    return F.sha2(F.concat(*map(text, fields)), 256)


def fold(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and its proof lead to."""
    step = lambda at, s: F.sha2(
        F.when(s["side"] < 0, F.concat(s["digest"], at)).when(s["side"] > 0, F.concat(at, s["digest"])).otherwise(at), 256
    )
    return F.aggregate(proof, leaf, step)


def proof_digest(proof: Column) -> Column:
    """H of the siblings, in the proof's order."""
    return F.sha2(F.array_join(F.transform(proof, lambda s: F.coalesce(s["digest"], F.lit(""))), ""), 256)


def _h(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def _parents(run: list[str], start: int, count: int) -> tuple[list[str], int]:
    """The parents of a run of nodes, ``start`` the index of the first, of a level of ``count``:
    those whose children are all in the run. A run that starts odd leaves its first node out, one
    that ends even, and not with the level, its last."""
    at = start & 1
    out = []
    while at < len(run):
        if at + 1 < len(run):
            out.append(_h(run[at], run[at + 1]))
        elif start + at + 1 == count:
            out.append(_h(run[at]))
        at += 2
    return out, (start + 1) >> 1


def cover(leaves: list[str], a: int, n: int) -> list[tuple[int, int, str]]:
    """(level, index, digest) of the largest nodes that lie inside the run of leaves from a."""
    out, run, start, count, level = [], leaves, a, n, 0
    while run:
        if count == 1:
            out.append((level, 0, run[0]))
            break
        last = start + len(run) - 1
        if start & 1:
            out.append((level, start, run[0]))
        if last & 1 == 0 and last + 1 < count and last >= start + (start & 1):
            out.append((level, last, run[-1]))
        run, start = _parents(run, start, count)
        count, level = (count + 1) >> 1, level + 1
    return out


def join_up(nodes: dict[tuple[int, int], str], n: int, top: int) -> list[tuple[int, int, str]]:
    """The nodes above a tiling of one subtree, up to level ``top`` or the root."""
    out = []
    known: dict[int, dict[int, str]] = {}
    for (level, idx), d in nodes.items():
        known.setdefault(level, {})[idx] = d
    for level in range(min(known), top):
        count = ((n - 1) >> level) + 1
        if count == 1:
            break
        here = known.get(level, {})
        for p in sorted({i >> 1 for i in here}):
            d = _h(*(here[c] for c in (2 * p, 2 * p + 1) if c < count))
            known.setdefault(level + 1, {})[p] = d
            out.append((level + 1, p, d))
    return out


@dataclass
class Tree:
    """``leaves``: (g, part, at, leaf, ...) with at in the group's order. ``ranges``: (g, part, a,
    m, n). ``nodes``: (g, level, idx, digest), what partitions may ask for. ``roots``: (g, n,
    digest)."""

    leaves: DataFrame
    ranges: DataFrame
    nodes: DataFrame
    roots: DataFrame


def build_tree(leaves: DataFrame) -> Tree:
    """The trees of all groups of rows (g, k, leaf, ...): g a string that is not null, k the key."""
    ship_package(leaves.sparkSession)
    leaves = checkpointed(leaves)
    order = [F.col("g"), F.col("k").asc_nulls_first(), F.col("leaf")]
    placed = leaves.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id())
    placed = checkpointed(placed.withColumn("part", F.shiftright("at", PART_BITS)))
    ranges = placed.groupBy("g", "part").agg(F.count("*").alias("m"))
    ranges = checkpointed(
        ranges.select("g", "part", "m", F.expr("sum(m) over (partition by g order by part) - m").alias("a"), F.expr("sum(m) over (partition by g)").alias("n"))
    )

    def covered(key: tuple[pa.Scalar, ...], rows: pa.Table, place: pa.Table) -> pa.Table:
        a, n = place.column("a")[0].as_py(), place.column("n")[0].as_py()
        found = cover(rows.sort_by("at").column("leaf").to_pylist(), a, n)
        return _nodes(key[0].as_py(), n, found)

    kind = "g string, n long, level int, idx long, digest string"
    own = placed.select("g", "part", "at", "leaf").groupBy("g", "part").cogroup(ranges.groupBy("g", "part"))
    tiles = checkpointed(own.applyInArrow(covered, kind))
    nodes = tiles
    highest = ((ranges.agg(F.max("n")).first()[0] or 1) - 1).bit_length()
    for top in range(ROUND_LEVELS, highest + ROUND_LEVELS, ROUND_LEVELS):
        joined = checkpointed(_round(tiles, top, kind))
        nodes = nodes.unionByName(joined)
        tiles = tiles.where(f"level >= {top}").unionByName(joined.where(f"level = {top}"))
    roots = nodes.where("idx = 0 and shiftright(n - 1, level) = 0").select("g", "n", "digest")
    return Tree(placed, ranges, nodes.select("g", "level", "idx", "digest"), checkpointed(roots))


def _round(tiles: DataFrame, top: int, kind: str) -> DataFrame:
    """The nodes over ``tiles`` up to level ``top``, each ancestor of that level by itself. A root
    below that level is done; a tile that is one by itself has nothing above it."""

    def joined(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        n = rows.column("n")[0].as_py()
        at = zip(rows.column("level").to_pylist(), rows.column("idx").to_pylist(), strict=True)
        return _nodes(key[0].as_py(), n, join_up(dict(zip(at, rows.column("digest").to_pylist(), strict=True)), n, top))

    low = tiles.where(f"level < {top} and shiftright(n - 1, level) > 0")
    return low.withColumn("up", F.expr(f"shiftright(idx, {top} - level)")).groupBy("g", "up").applyInArrow(joined, kind)


def _nodes(g: str, n: int, found: list[tuple[int, int, str]]) -> pa.Table:
    level, idx, digest = zip(*found, strict=True) if found else ((), (), ())
    cols = [pa.array([g] * len(found), pa.string()), pa.array([n] * len(found), pa.int64()), pa.array(level, pa.int32()), pa.array(idx, pa.int64()), pa.array(digest, pa.string())]
    return pa.Table.from_arrays(cols, ["g", "n", "level", "idx", "digest"])


def missing(ranges: DataFrame) -> DataFrame:
    """(g, part, level, idx): the siblings that the proofs of each partition's leaves need and
    that its own leaves do not give."""
    levels = F.expr("case when n > 1 then sequence(0, length(bin(n - 1)) - 1) else array() end")
    at = ranges.select("*", F.explode(levels).alias("level"))
    at = at.selectExpr("g", "part", "level", "shiftright(a, level) as lo", "shiftright(a + m - 1, level) as hi", "shiftright(n - 1, level) as last")
    ends = F.array(F.expr("case when lo % 2 = 1 then lo - 1 end"), F.expr("case when hi % 2 = 0 and hi < last then hi + 1 end"))
    return at.select("g", "part", "level", F.explode(ends).alias("idx")).where("idx is not null")


def expand(leaves: list[str], a: int, n: int, fetched: dict[tuple[int, int], str]) -> tuple[list[np.ndarray], list[pa.Array], str]:
    """Per level the side of each leaf's sibling (-1 left, 1 right, 0 none) and its digest; and
    the root that follows."""
    pos = np.arange(a, a + len(leaves))
    run, start, count, level = list(leaves), a, n, 0
    sides, digests = [], []
    while count > 1:
        last = start + len(run) - 1
        if start & 1:
            run.insert(0, fetched[level, start - 1])
            start -= 1
        if last & 1 == 0 and last + 1 < count:
            run.append(fetched[level, last + 1])
        sibling = pos ^ 1
        there = sibling < count
        sides.append(np.where(there, np.where(pos & 1, -1, 1), 0).astype(np.int8))
        digests.append(pa.array(run, pa.string()).take(pa.array(np.where(there, sibling - start, 0), mask=~there)))
        run, start = _parents(run, start, count)
        pos, count, level = pos >> 1, (count + 1) >> 1, level + 1
    return sides, digests, run[0]


def prove(tree: Tree, extra: DataFrame | None = None) -> DataFrame:
    """The columns of the leaves, without part and at, with ``proof`` (side and digest, bottom up) and
    ``root`` of the group added. ``extra``: (g, more proof, total root) of groups whose roots are
    leaves of another tree; the proofs then go on through it and a column ``total`` is added."""
    asked = missing(tree.ranges).join(tree.nodes, ["g", "level", "idx"])
    fetched = asked.groupBy("g", "part").agg(F.collect_list(F.struct("level", "idx", "digest")).alias("known"))
    plan = tree.ranges.join(fetched, ["g", "part"], "left")
    if extra is not None:
        plan = plan.join(extra.selectExpr("g", "proof as more", "root as total"), "g")
    keep = [f for f in tree.leaves.schema.fields if f.name not in ("part", "at")]
    names = [f.name for f in keep]

    def proofs(rows: pa.Table, place: pa.Table) -> pa.Table:
        rows = rows.sort_by("at")
        p = place.to_pylist()[0]
        fetched = {(x["level"], x["idx"]): x["digest"] for x in p["known"] or ()}
        sides, digests, root = expand(rows.column("leaf").to_pylist(), p["a"], p["n"], fetched)
        for x in p.get("more") or ():
            sides.append(np.full(rows.num_rows, x["side"], np.int8))
            digests.append(pa.array([x["digest"]], pa.string()).take(pa.array(np.zeros(rows.num_rows, np.int64))))
        m, width = rows.num_rows, len(sides)
        by_row = pa.array((np.arange(m)[:, None] + m * np.arange(width)[None, :]).ravel())
        items = pa.StructArray.from_arrays(
            [pa.array(np.stack(sides, 1).ravel() if width else [], pa.int8()), pa.concat_arrays(digests).take(by_row) if width else pa.array([], pa.string())], ["side", "digest"]
        )
        proof = pa.ListArray.from_arrays(pa.array(np.arange(m + 1, dtype=np.int32) * width), items)
        cols = [*(rows.column(c) for c in names), proof, pa.array([root] * m, pa.string())]
        more = [("total", pa.array([p["total"]] * m, pa.string()))] if "total" in p else []
        return pa.Table.from_arrays([*cols, *(c for _, c in more)], [*names, "proof", "root", *(c for c, _ in more)])

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in keep), f"proof {_PROOF}", "root string", *(["total string"] if extra is not None else [])])
    both = tree.leaves.groupBy("g", "part").cogroup(plan.groupBy("g", "part"))
    return both.applyInArrow(proofs, schema)


def manifest(docs: DataFrame, group: str = "lang", key: str = "doc_id", fields: tuple[str, ...] = FIELDS, **claimed: Column) -> DataFrame:
    """Per row: ``key``, ``group``, leaf, subroot, root and proof. ``claimed``: more columns of the
    rows, such as the digest of what somebody says a row holds, to be folded with its proof."""
    rows = docs.select(
        # Groups stand bytewise, null first, as their names behind a mark do.
        F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit("")).alias("g"),
        F.col(key).alias("k"), leaf_digest(*(F.col(c) for c in fields)).alias("leaf"), *(c.alias(n) for n, c in claimed.items()),
    )
    tree = build_tree(rows)
    top = build_tree(tree.roots.select(F.lit("").alias("g"), F.col("g").alias("k"), F.col("digest").alias("leaf")))
    out = prove(tree, checkpointed(prove(top).select(F.col("k").alias("g"), "proof", "root")))
    named = F.when(F.col("g") != "", F.expr("substring(g, 2)"))
    return out.select(F.col("k").alias(key), named.alias(group), "leaf", *claimed, F.col("root").alias("subroot"), F.col("total").alias("root"), "proof")
