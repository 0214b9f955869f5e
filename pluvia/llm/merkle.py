"""Merkle manifest of a dataset: a tree per source, and a tree over the sources' roots.

A leaf is the digest of a row's fields.  Leaves are numbered within their source by ranges, without a task that sees a
whole source.  Every level is then an equijoin: the nodes in slot zero of a run compute the indices of their siblings by
the slots' offsets, meet them by (tree, index), and emit the parent.  Indices are spread by their hash, so that a source
that holds most rows takes as many tasks as any other rows.  Proofs go the other way: a parent knows its children, and so
what stands left and right of each; a child joins its parent by (tree, index / arity) and puts that before the parent's
own path.  Paths are carried by runs of leaves, not by leaves.

Levels are written to the shared folder, so that a lost executor costs a level's tasks at most.

Defined cases: null fields are ``-``, so that null, empty and ``-`` differ; a null source is a source of its own, the
first; rows without an id come first in their source; rows that share an id go by their digest, and repeated rows have
equal digests, so that their order does not show; a lone leaf is its source's root; an empty table has no rows; other
columns are not looked at unless they are named as fields.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import written

ARITY = 16
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: The tree over the sources' roots.
WHOLE = ""


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def field(value: Column) -> Column:
    """``-`` for null, else the number of UTF-8 bytes, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(fields: Sequence[str], changed: dict[str, Column] | None = None) -> Column:
    """The digest of a row, or of the row with some of its values ``changed``."""
    return digest(*(field((changed or {}).get(name, F.col(name))) for name in fields))


def lower_ascii(text: str = "text") -> Column:
    return F.translate(text, UPPER, LOWER)


def tree_of(source: str = "source") -> Column:
    """A source's key: never null, and in the order of the sources, null first."""
    return F.coalesce(F.concat(F.lit("="), F.col(source)), F.lit(""))


def number_nodes(nodes: DataFrame, order: Sequence[Column], purpose: str) -> DataFrame:
    """``nodes`` with their index ``idx`` in their ``tree`` by ``order``, and ``n``, the tree's number of nodes.

    Sorted by ranges and written; what a partition holds of a tree is a run, and runs are added up per tree.  Rows that
    agree in ``order`` may fall into different ranges.
    """
    tie = F.monotonically_increasing_id()
    ranged = nodes.withColumn("tie", tie).repartitionByRange(F.col("tree"), *order, F.col("tie"))
    sorted_ = ranged.sortWithinPartitions(F.col("tree"), *order).withColumn("at", F.monotonically_increasing_id())
    placed = written(sorted_.drop("tie").withColumn("part", F.shiftright("at", 33)), purpose)
    runs = placed.groupBy("tree", "part").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("size"))
    tree = Window.partitionBy("tree")
    before = F.sum("size").over(tree.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    shifts = runs.select(
        "tree", "part", (F.coalesce(before, F.lit(0)) - F.col("first")).alias("shift"), F.sum("size").over(tree).alias("n")
    )
    found = placed.join(shifts, ["tree", "part"]).withColumn("idx", F.col("at") + F.col("shift"))
    return found.drop("part", "at", "shift")


def parents(nodes: DataFrame, arity: int = ARITY) -> DataFrame:
    """(tree, idx, n, digest, children) of the next level; a tree of one node passes on, without ``children``."""
    idx, n = F.col("idx"), F.col("n")
    heads = nodes.where(idx % arity == 0).select(
        "tree", idx.alias("head"), "n", F.explode(F.sequence(F.lit(0), F.least(F.lit(arity - 1), n - 1 - idx))).alias("slot")
    )
    siblings = heads.withColumn("idx", F.col("head") + F.col("slot"))
    met = siblings.join(nodes.select("tree", "idx", "digest"), ["tree", "idx"])
    runs = met.groupBy("tree", "head", "n").agg(F.array_sort(F.collect_list(F.struct("slot", "digest"))).alias("run"))
    single, children = n == 1, F.col("run.digest")
    return runs.select(
        "tree",
        F.expr(f"head div {arity}").alias("idx"),
        F.expr(f"(n + {arity - 1}) div {arity}").alias("n"),
        F.when(single, children[0]).otherwise(F.sha2(F.concat_ws("", children), 256)).alias("digest"),
        F.when(~single, children).alias("children"),
    )


def levels(nodes: DataFrame, arity: int, purpose: str) -> list[DataFrame]:
    """All levels above ``nodes``, up to the one in which every tree has one node."""
    most = nodes.agg(F.max("n")).first()[0] or 0
    above: list[DataFrame] = []
    while most > 1:
        below = above[-1] if above else nodes
        above.append(written(parents(below, arity), f"{purpose}-{len(above) + 1}"))
        most = -(-most // arity)
    return above


def _beside(slot: Column) -> Column:
    """What a node's siblings are hashed as: those before it and those after it, put together."""
    before = F.concat_ws("", F.slice("children", F.lit(1), slot))
    after = F.concat_ws("", F.slice("children", slot + 2, F.greatest(F.size("children") - slot - 1, F.lit(0))))
    return F.struct(before.alias("before"), after.alias("after"))


def paths(nodes: DataFrame, above: list[DataFrame], top: DataFrame, arity: int = ARITY) -> DataFrame:
    """``nodes`` with ``path``, the siblings' digests from their level to the root, and the columns of ``top``.

    ``top`` has a row per tree: ``path`` from the tree's own root on, and what else all its nodes are to have.
    """
    kept = [name for name in top.columns if name not in ("tree", "path")]
    known = above[-1].drop("n", "digest").join(top, "tree") if above else None
    slot = (F.col("idx") % arity).cast("int")
    own = F.when(F.col("children").isNull(), F.col("path")).otherwise(F.concat(F.array(_beside(slot)), "path"))
    for below in [*above[-2::-1], nodes]:
        if known is None:
            return nodes.join(top, "tree")
        held = [name for name in below.columns if name not in ("tree", "idx", "n", "children")]
        mine = below.withColumn("up", F.expr(f"idx div {arity}"))
        if "children" in below.columns:
            mine, held = mine.withColumnRenamed("children", "mine").drop("digest"), []
        met = mine.join(known.withColumnRenamed("idx", "up"), ["tree", "up"])
        children = [F.col("mine").alias("children")] if "children" in below.columns else []
        known = met.select("tree", "idx", *held, *children, own.alias("path"), *kept)
    return known


def proof() -> Column:
    """The digest of all siblings, level by level, left to right."""
    steps = F.transform(F.col("path"), lambda step: F.concat(step["before"], step["after"]))
    return F.sha2(F.concat_ws("", steps), 256)


def fold(start: Column) -> Column:
    """The root that follows from a leaf and its siblings."""
    return F.aggregate("path", start, lambda node, step: F.sha2(F.concat(step["before"], node, step["after"]), 256))


def manifest(
    docs: DataFrame,
    fields: Sequence[str] = FIELDS,
    id_col: str = "doc_id",
    source: str = "source",
    arity: int = ARITY,
    found: Column | None = None,
) -> DataFrame:
    """(doc_id, source's ``tree``, leaf, found, path, subroot, root), a row per row.

    ``path`` proves a leaf: an array of (before, after), the digests beside it from its own level to the root.  ``found``
    is the digest of what a check now finds in the row's place, null where nothing else is found (see ``fold``).
    """
    nothing = F.lit(None).cast("string")
    leaves = docs.select(
        F.col(id_col).alias("doc_id"),
        tree_of(source).alias("tree"),
        leaf(fields).alias("digest"),
        (nothing if found is None else found).alias("found"),
    )
    thin = written(leaves, "merkle-leaves")
    nodes = number_nodes(thin, [F.col("doc_id").asc_nulls_first(), F.col("digest").asc()], "merkle-order")
    above = levels(nodes, arity, "merkle-level")
    roots = (above[-1] if above else nodes).select("tree", "digest")

    # The tree over the sources: its nodes are the roots, in the order of the sources.
    members = number_nodes(
        roots.select(F.lit(WHOLE).alias("tree"), F.col("tree").alias("member"), "digest"), [F.col("member")], "merkle-roots"
    )
    over = levels(members, arity, "merkle-top")
    whole = (over[-1] if over else members).select(
        "tree", F.col("digest").alias("root"), F.expr("cast(array() as array<struct<before: string, after: string>>)").alias("path")
    )
    top = paths(members, over, whole, arity).select(
        F.col("member").alias("tree"), F.col("digest").alias("subroot"), "root", "path"
    )
    return paths(nodes, above, top, arity).withColumnRenamed("digest", "leaf")


def check_tampering(
    docs: DataFrame, tampered: Column, fields: Sequence[str] = FIELDS, id_col: str = "doc_id", **options
) -> DataFrame:
    """Each row's proof, and whether it still leads to the root when the texts of some rows were lower-cased."""
    now = F.when(tampered, leaf(fields, {"text": lower_ascii()}))
    proven = manifest(docs, fields, id_col, found=now, **options)
    folded = proven.select(
        "doc_id", "leaf", "subroot", "root", proof().alias("proof_sha256"),
        fold(F.coalesce("found", "leaf")).alias("folded_root"),
    )
    return folded.withColumn("verified", F.col("folded_root") == F.col("root"))


def every_fifth(id_col: str = "doc_id") -> Column:
    """5 divides the CRC-32 of the id in decimal digits; never where there is no id."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 5 == 0, F.lit(False))


def _sql_field(name: str) -> str:
    text = f"cast({name} as varchar)"
    return f"coalesce(strlen({text}) || ':' || {text}, '-')"


def _sql_leaf(**changed: str) -> str:
    return f"sha256({' || '.join(_sql_field(changed.get(name, name)) for name in FIELDS)})"


# DuckDB has no CRC-32: bit by bit over the digits of the id.
_SQL_CRC = """
    xor(4294967295, list_reduce(
        list_transform(string_split(cast(doc_id as varchar), ''), lambda digit: cast(ascii(digit) as bigint)),
        lambda crc, byte: list_reduce([0, 0, 0, 0, 0, 0, 0, 0],
            lambda bits, none: case when bits & 1 = 1 then xor(bits >> 1, 3988292384) else bits >> 1 end, xor(crc, byte)),
        4294967295))
"""


def _sql_levels(name: str, nodes: str) -> str:
    """``name``: every level of the trees of ``nodes``; ``name_runs``: the children of every parent, in order."""
    return f"""
    {name}(level, tree, idx, n, digest) as (
        select 0, tree, idx, n, digest from {nodes}
        union all
        select level + 1, tree, idx // {ARITY}, (n + {ARITY - 1}) // {ARITY}, sha256(string_agg(digest, '' order by idx))
        from {name} where n > 1 group by level, tree, idx // {ARITY}, n),
    {name}_runs as (
        select level, tree, idx // {ARITY} as run, list(digest order by idx) as children
        from {name} where n > 1 group by all)"""


def _sql_fold(name: str, levels: str, start: str) -> str:
    """``name``: the rows of ``start`` on every level, with the node that follows and the siblings met so far."""
    before = f"array_to_string(children[1 : idx % {ARITY}], '')"
    after = f"array_to_string(children[idx % {ARITY} + 2 : ], '')"
    return f"""
    {name}(row, level, tree, idx, node, proof) as (
        select row, 0, tree, idx, node, proof from {start}
        union all
        select f.row, f.level + 1, f.tree, f.idx // {ARITY}, sha256({before} || f.node || {after}), f.proof || {before} || {after}
        from {name} f join {levels}_runs r on r.level = f.level and r.tree = f.tree and r.run = f.idx // {ARITY})"""


SQL = f"""
with recursive leaves as (
    select *, row_number() over (partition by tree order by doc_id nulls first, digest) - 1 as idx,
           count(*) over (partition by tree) as n, row_number() over () as row
    from (select doc_id, coalesce('=' || source, '') as tree, {_sql_leaf()} as digest,
                 case when {_SQL_CRC} % 5 = 0 then {_sql_leaf(text=f"translate(text, '{UPPER}', '{LOWER}')")} end as found
          from documents) d),
    {_sql_levels("below", "leaves")},
    members as (
        select '' as tree, tree as member, digest, row_number() over (order by tree) - 1 as idx, count(*) over () as n
        from below where n = 1),
    {_sql_levels("above", "members")},
    starts as (select row, tree, idx, coalesce(found, digest) as node, '' as proof from leaves),
    {_sql_fold("up", "below", "starts")},
    arrived as (
        select u.row, m.tree, m.idx, u.node, u.proof
        from (select row, tree, arg_max(node, level) as node, arg_max(proof, level) as proof from up group by row, tree) u
        join members m on m.member = u.tree),
    {_sql_fold("over_all", "above", "arrived")},
    ends as (select row, arg_max(node, level) as node, arg_max(proof, level) as proof from over_all group by row)
select l.doc_id, l.digest as leaf, m.digest as subroot, t.digest as root, sha256(e.proof) as proof_sha256,
       e.node as folded_root, e.node = t.digest as verified
from leaves l join ends e on e.row = l.row join members m on m.member = l.tree cross join (select digest from above where n = 1) t
"""
