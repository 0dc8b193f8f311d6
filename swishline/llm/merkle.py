"""Merkle manifest of a dataset by nested intervals.

Rows are ranked once over the whole table, by group and id. Every node of the tree is
labelled with the interval [lo, hi) of leaf ranks that it covers, so containment of
intervals is ancestry: a node's parent is the one node of the next level whose interval
holds its own. Levels are tables of their own, and containment is looked up in buckets of
a level's width, so each join is on a key of at most ``FANOUT`` nodes. The siblings of
a node are those children of its parent that lie in the difference of the two
intervals, left and right of it. A proof is the list of these siblings from the leaf up to the
root: within the tree of its group first, then within the tree of the groups' roots.

The tree is built from below, a table per level, each a fanout smaller than the last.
Proofs come down the same levels: a parent's proof reaches its children with the join
that finds their siblings, so proofs are only as many as nodes until the last join.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from swishline.llm.tables import lookup_side
from swishline.sources.scratch import written

FANOUT = 8
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
STEP = "struct<left:string,right:string>"
LABEL = ["first", "n", "lo", "hi"]


def digest(*parts: Column) -> Column:
    """Lowercase hex SHA-256 of strings one after another."""
    return F.sha2(F.concat(*parts), 256)


def field(value: Column) -> Column:
    """A value such that no two rows of values read alike: its size in bytes, ':', its text."""
    text = value.cast("string")
    sized = F.concat(F.octet_length(text).cast("string"), F.lit(":"), text)
    return F.when(value.isNull(), F.lit("-")).otherwise(sized)


def leaf_digest(text: Column | None = None) -> Column:
    """The digest of a row of documents; ``text`` may stand in for its text."""
    own = {"text": text if text is not None else F.col("text")}
    return digest(*[field(own.get(name, F.col(name))) for name in FIELDS])


def lowered(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def ranked(leaves: DataFrame, group: str, order: Sequence[str]) -> DataFrame:
    """``leaves`` with first, n, lo, hi: the ranks [first, first + n) of its group, and its own.

    Ranks run over the whole table by group (null first) and ``order`` (null first). Rows
    are dealt by ranges and numbered within them; a row per range, as many as there are
    tasks, says how many rows are before it.
    """
    keys = [group, *order]
    dealt = leaves.repartitionByRange(*keys).sortWithinPartitions(*keys)
    dealt = written(dealt.withColumn("at", F.monotonically_increasing_id()), "merkle_order")
    dealt = dealt.withColumn("part", F.shiftright("at", 33))
    parts = dealt.groupBy("part").agg(F.min("at").alias("begin"), F.count(F.lit(1)).alias("rows"))
    in_order = Window.partitionBy(F.lit(0)).orderBy("part")
    before = F.sum("rows").over(in_order.rowsBetween(Window.unboundedPreceding, -1))
    shift = (F.coalesce(before, F.lit(0)) - F.col("begin")).alias("shift")
    parts = lookup_side(written(parts.select("part", shift), "merkle_parts"))
    rank = F.col("at") + F.col("shift")
    placed = dealt.join(parts, "part").select(
        *leaves.columns, rank.alias("lo"), (rank + 1).alias("hi")
    )
    groups = placed.groupBy(F.col(group).alias("own")).agg(
        F.min("lo").alias("first"), F.count(F.lit(1)).alias("n")
    )
    groups = lookup_side(written(groups, "merkle_groups"))
    found = placed.join(groups, F.col(group).eqNullSafe(F.col("own")))
    return found.select(*leaves.columns, *LABEL)


def _bucket(width: int) -> Column:
    """The interval of the level of that width which holds a node's own, by its number."""
    return F.floor((F.col("lo") - F.col("first")) / F.lit(width)).cast("bigint")


def _parents(nodes: DataFrame, width: int) -> DataFrame:
    """Nodes of the next level, each with its children, of groups that still have several."""
    open_nodes = nodes.where(F.col("n") > width // FANOUT)
    kids = F.sort_array(F.collect_list(F.struct("lo", "hi", "digest")))
    grouped = open_nodes.groupBy("first", "n", _bucket(width).alias("bucket")).agg(
        kids.alias("kids")
    )
    joined = F.array_join(F.transform("kids", lambda k: k["digest"]), "")
    return grouped.select(
        "first",
        "n",
        F.get("kids", F.lit(0))["lo"].alias("lo"),
        F.element_at("kids", -1)["hi"].alias("hi"),
        digest(joined).alias("digest"),
        "kids",
    )


def levels(leaves: DataFrame) -> list[DataFrame]:
    """The levels above ``leaves`` (first, n, lo, hi, digest), as stored tables."""
    found, nodes, width = [], leaves, FANOUT
    most = leaves.agg(F.max("n")).first()[0] or 0
    while width < most * FANOUT:
        nodes = written(_parents(nodes, width), "merkle_level")
        found.append(nodes)
        width *= FANOUT
    return found


def _step() -> Column:
    """The siblings of a node: its parent's children without its own interval."""

    def side(holds) -> Column:
        return F.array_join(F.transform(F.filter("p_kids", holds), lambda k: k["digest"]), "")

    left = side(lambda k: k["hi"] <= F.col("lo"))
    right = side(lambda k: k["lo"] >= F.col("hi"))
    return F.struct(left.alias("left"), right.alias("right"))


def _attached(nodes: DataFrame, parents: DataFrame, width: int) -> DataFrame:
    """``nodes`` with ``path``, by way of the parent (kids, path) whose interval holds theirs."""
    above = parents.select(
        F.col("first").alias("p_first"),
        F.col("lo").alias("p_lo"),
        F.col("hi").alias("p_hi"),
        _bucket(width).alias("p_bucket"),
        F.col("kids").alias("p_kids"),
        F.col("path").alias("p_path"),
    )
    held = (
        (F.col("first") == F.col("p_first"))
        & (_bucket(width) == F.col("p_bucket"))
        & (F.col("p_lo") <= F.col("lo"))
        & (F.col("hi") <= F.col("p_hi"))
    )
    path = F.concat(F.array(_step()), F.col("p_path"))
    return nodes.join(above, held).withColumn("path", path).select(*nodes.columns, "path")


def with_paths(leaves: DataFrame, tree: list[DataFrame], tops: DataFrame) -> DataFrame:
    """``leaves`` with the path to the end of ``tops``: a row per group with first, path."""

    def complete(nodes: DataFrame, width: int) -> DataFrame:
        return nodes.where(F.col("n") <= width).join(tops, "first").select(*nodes.columns, "path")

    below = None
    for level in range(len(tree), -1, -1):
        width = FANOUT**level
        nodes = tree[level - 1] if level else leaves
        found = complete(nodes, width)
        if below is not None:
            rest = nodes.where(F.col("n") > width)
            found = found.unionByName(_attached(rest, below, width * FANOUT))
        below = found
    return below


@dataclass(frozen=True)
class Manifest:
    """``proofs``: the rows with first, n, lo, hi, subroot, root and path (steps from the
    leaf up, each with the digests left and right). ``nodes``: level (0: leaves), group
    interval, own interval and digest of every node within the groups; ``subroots``: a
    row per group. ``root``: of the whole table, None if it is empty."""

    proofs: DataFrame
    nodes: DataFrame
    subroots: DataFrame
    root: str | None


def manifest(rows: DataFrame, group: str, order: Sequence[str], leaf: str = "leaf") -> Manifest:
    """The tree over ``rows``, whose column ``leaf`` holds their digests.

    Leaves ascend by ``order`` within a group, null first; rows equal in it go by their
    digest, and rows equal in all of it are interchangeable leaves of their own. Groups
    go by their value, null first. Every FANOUT consecutive nodes become one, also a
    single node that is left over, until one remains; a lone leaf is its group's root.
    An empty table has no rows, no nodes and no root.
    """
    spark = rows.sparkSession
    leaves = written(ranked(rows, group, [*order, leaf]), "merkle_leaves")
    bottom = leaves.select(*LABEL, F.col(leaf).alias("digest"))
    tree = levels(bottom)
    nodes = bottom.select(F.lit(0).alias("level"), *LABEL, "digest")
    for level, table in enumerate(tree, 1):
        nodes = nodes.unionByName(table.select(F.lit(level).alias("level"), *LABEL, "digest"))
    width = F.pow(F.lit(float(FANOUT)), "level")
    last = (F.col("n") <= width) & ((F.col("level") == 0) | (F.col("n") > width / FANOUT))
    subroots = written(
        nodes.where(last).select(
            F.col("first").alias("group_first"), F.col("digest").alias("subroot")
        ),
        "merkle_subroots",
    )
    over = ranked(subroots.withColumn("of", F.lit(0)), "of", ["group_first"])
    over = written(over, "merkle_tops")
    top_leaves = over.select(*LABEL, F.col("subroot").alias("digest"), "group_first")
    top_tree = levels(top_leaves.select(*LABEL, "digest"))
    top = top_tree[-1] if top_tree else top_leaves
    found = top.select("digest").first()
    root = found["digest"] if found else None
    end = spark.range(1).select(
        F.col("id").alias("first"), F.array().cast(f"array<{STEP}>").alias("path")
    )
    tops = with_paths(top_leaves, top_tree, end).select(
        F.col("group_first").alias("first"), F.col("digest").alias("subroot"), "path"
    )
    tops = written(tops, "merkle_paths")
    carried = leaves.withColumn("digest", F.col(leaf))
    proofs = with_paths(carried, tree, tops.drop("subroot")).drop("digest")
    proofs = proofs.join(lookup_side(tops.select("first", "subroot")), "first")
    return Manifest(proofs.withColumn("root", F.lit(root).cast("string")), nodes, subroots, root)


def proof_digest() -> Column:
    """One digest over all siblings of ``path``, left to right, level by level."""
    whole = F.array_join(F.transform("path", lambda s: F.concat(s["left"], s["right"])), "")
    return digest(whole)


def folded(leaf: Column) -> Column:
    """The root that ``leaf`` and the siblings of ``path`` lead to."""
    return F.aggregate("path", leaf, lambda acc, s: digest(s["left"], acc, s["right"]))


def verified_documents(docs: DataFrame, every: int = 3) -> DataFrame:
    """The manifest of documents by lang, and what becomes of it when texts are changed.

    Rows whose crc32 of the decimal doc_id is divisible by ``every`` have A-Z of their text
    lower-cased before their leaf is folded up to the root again; others, and rows
    with a null doc_id, are folded as they are. Null fields are '-' in a leaf. Returns a
    row per document, repeated ones too; columns other than FIELDS take no part.
    """
    changed = F.crc32(F.col("doc_id").cast("string").cast("binary")) % every == 0
    tampered = leaf_digest(F.when(changed, lowered(F.col("text"))).otherwise(F.col("text")))
    rows = docs.select("doc_id", "lang", leaf_digest().alias("leaf"), tampered.alias("tampered"))
    made = manifest(written(rows, "merkle_rows"), "lang", ["doc_id"]).proofs
    found = made.select(
        "doc_id", "leaf", "subroot", "root",
        proof_digest().alias("proof_sha256"), folded(F.col("tampered")).alias("folded_root"),
    )
    return found.withColumn("verified", F.col("folded_root") == F.col("root"))


# crc32 of a decimal number in SQL: 256 + byte to take one in, then 8 shifts
_CRC = """(xor(list_reduce(list_concat([4294967295], flatten(
    [[256 + ascii(c), 0, 0, 0, 0, 0, 0, 0, 0] FOR c IN string_split(CAST(doc_id AS VARCHAR), '')])),
    lambda a, x: CASE WHEN x > 0 THEN xor(a, x - 256)
      ELSE xor(a >> 1, 3988292384 * (a & 1)) END), 4294967295))"""


def _sql_field(name: str) -> str:
    text = f"CAST({name} AS VARCHAR)"
    return f"CASE WHEN {name} IS NULL THEN '-' ELSE strlen({text}) || ':' || {text} END"


def _sql_leaf(text: str) -> str:
    fields = [_sql_field(x) for x in FIELDS[:-1]] + [_sql_field(text)]
    return f"sha256({' || '.join(fields)})"


def _sql_tree(name: str, height: int) -> list[str]:
    """Levels of a tree from ``{name}0``: grp, n (nodes of the level), i, d."""
    steps = []
    for k in range(height):
        steps.append(f"""{name}{k + 1} AS (
  SELECT grp, (any_value(n) + {FANOUT - 1}) // {FANOUT} AS n, i // {FANOUT} AS i,
    CASE WHEN any_value(n) = 1 THEN any_value(d) ELSE sha256(string_agg(d, '' ORDER BY i)) END AS d
  FROM {name}{k} GROUP BY grp, i // {FANOUT})""")
    return steps


def _sql_sides(name: str, k: int, own: str) -> str:
    """Left and right siblings of node ``own`` of level ``k`` in the frame ``me``."""
    sides = []
    for sign in ("<", ">"):
        sides.append(f"""coalesce((SELECT string_agg(s.d, '' ORDER BY s.i) FROM {name}{k} s
      WHERE s.grp = me.grp AND s.i // {FANOUT} = {own} // {FANOUT} AND s.i {sign} {own}), '')""")
    return f"[{sides[0]}, {sides[1]}]"


def _oracle(height: int = 12, top: int = 3) -> str:
    """``height`` levels hold FANOUT**height rows of a lang; ``top``: FANOUT**top langs."""
    fold = """list_reduce(list_prepend([t, '', ''], path), lambda a, s:
      [CASE WHEN s[3] = '1' THEN a[1] ELSE sha256(s[1] || a[1] || s[2]) END, '', ''])[1]"""
    steps = [f"""leaves AS (
  SELECT doc_id, lang, {_sql_leaf("text")} AS leaf,
    {_sql_leaf(f"(CASE WHEN {_CRC} % 3 = 0 THEN translate(text, '{UPPER}', '{LOWER}') ELSE text END)")} AS t
  FROM documents)""", """ordered AS (
  SELECT *, dense_rank() OVER (ORDER BY lang NULLS FIRST) AS grp,
    row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i,
    count(*) OVER (PARTITION BY lang) AS n
  FROM leaves)""", "a0 AS (SELECT grp, n, i, leaf AS d FROM ordered)"]
    steps += _sql_tree("a", height)
    steps.append(f"""b0 AS (
  SELECT 0 AS grp, count(*) OVER () AS n, row_number() OVER (ORDER BY grp) - 1 AS i, d,
    grp AS of FROM a{height})""")
    steps += _sql_tree("b", top)
    for name, start, rows, count in (
        ("up_a", "SELECT grp, i, n FROM a0", "a", height),
        ("up_b", "SELECT grp, of, i, n FROM b0", "b", top),
    ):
        steps.append(f"{name}0 AS (SELECT *, [] :: VARCHAR[][] AS path FROM ({start}))")
        for k in range(count):
            steps.append(f"""{name}{k + 1} AS (
  SELECT me.* REPLACE (list_append(path, list_append({_sql_sides(rows, k, f"(me.i // {FANOUT**k})")},
    CASE WHEN me.n <= {FANOUT**k} THEN '1' ELSE '' END)) AS path) FROM {name}{k} AS me)""")
    steps.append(f"""whole AS (
  SELECT o.doc_id, o.leaf, o.t, s.d AS subroot, r.d AS root, list_concat(x.path, y.path) AS path
  FROM ordered o JOIN up_a{height} x ON x.grp = o.grp AND x.i = o.i
  JOIN a{height} s ON s.grp = o.grp JOIN up_b{top} y ON y.of = o.grp CROSS JOIN b{top} r)""")
    steps.append(f"""proved AS (
  SELECT doc_id, leaf, subroot, root,
    sha256(coalesce(list_aggregate([s[1] || s[2] FOR s IN path], 'string_agg', ''), ''))
      AS proof_sha256,
    {fold} AS folded_root
  FROM whole)""")
    return "WITH " + ", ".join(steps) + "\nSELECT *, folded_root = root AS verified FROM proved"


#: The same from the documents table alone, for DuckDB.
ORACLE = _oracle()
