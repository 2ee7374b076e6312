"""Merkle manifest of a dataset, its upper proofs by a butterfly exchange.

Leaves are put in order and cut into aligned blocks of ``FANOUT ** BLOCK_LEVELS``. A
block is a subtree that one row holds. The blocks then swap roots in aligned groups of
``FANOUT``, round by round: in round r a block meets those whose number differs from its
own in digit r only. Each of them hashes the common ancestor for itself and keeps the
roots it was sent, which are its siblings at that level. After the last round every
block has the root and its whole upper proof; nothing is handed down the tree.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallybrook.llm.common import table
from tallybrook.scratch import written

FANOUT = 2
BLOCK_LEVELS = 10
#: Rows of a range while the leaves are numbered, and the most ranges.
RANGE_ROWS, MOST_RANGES = 32_768, 10_000
EVERY = 7
_PROOF = "array<struct<place:int,others:array<string>>>"
_SALTS = 16


def hashed(parts: Column) -> Column:
    """Lowercase hexadecimal SHA-256 of an array of strings, joined."""
    return F.sha2(F.array_join(parts, ""), 256)


def field(value: Column) -> Column:
    """A value with its length in front, so that fields can't run into each other; NULL is a dash."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(*values: Column) -> Column:
    return F.sha2(F.concat(*[field(value) for value in values]), 256)


def folded(leaf: Column, proof: Column, fanout: int = FANOUT) -> Column:
    """The root that a leaf and its proof lead to."""

    def up(node: Column, step: Column) -> Column:
        left = F.slice(step["others"], F.lit(1), step["place"])
        right = F.slice(step["others"], step["place"] + 1, F.lit(fanout))
        return hashed(F.concat(left, F.array(node), right))

    return F.aggregate(proof, leaf, up)


def proof_digest(proof: Column) -> Column:
    """One digest of all siblings, from the leaf up and from left to right."""
    return hashed(F.flatten(F.transform(proof, lambda step: step["others"])))


def _numbered(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` with ``at``, the place from 0 within ``part``, and ``size``, the rows of that part.

    A part may hold any share of the rows: they are dealt by ranges of part and order,
    and each range adds the number of rows that its part has in the ranges before.
    """
    ranges = max(1, min(MOST_RANGES, -(-rows.count() // RANGE_ROWS)))
    dealt = rows.repartitionByRange(ranges, "part", *order).withColumn("range", F.spark_partition_id())
    dealt = written(dealt, "ranges")
    counts = dealt.groupBy("part", "range").agg(F.count(F.lit(1)).alias("rows"))
    whole = Window.partitionBy("part")
    before = whole.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(
        F.col("part").alias("counted"),
        F.col("range").alias("within"),
        F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("before"),
        F.sum("rows").over(whole).alias("size"),
    )
    place = F.row_number().over(Window.partitionBy("part", "range").orderBy(*order)) - 1
    same = F.col("part").eqNullSafe(F.col("counted")) & (F.col("range") == F.col("within"))
    joined = dealt.withColumn("place", place).join(counts, same)
    return joined.select(*rows.columns, (F.col("before") + F.col("place")).alias("at"), "size")


def _levels_over(size: Column, fanout: int) -> Column:
    """How many times ``size`` nodes have to be put together until one is left."""
    powers = [F.lit(fanout**level).cast("long") for level in range(63) if fanout**level < 2**63]
    return F.size(F.filter(F.array(*powers), lambda power: power < size))


def _above(nodes: Column, fanout: int) -> Column:
    runs = F.ceil(F.size(nodes) / fanout).cast("int")
    return F.transform(
        F.sequence(F.lit(0), runs - 1), lambda run: hashed(F.slice(nodes, run * fanout + 1, F.lit(fanout)))
    )


def _tree(leaves: Column, depth: Column, levels: int, fanout: int) -> Column:
    """The levels of a block from its leaves up to its root."""
    if not levels:
        return F.array(leaves)
    steps = F.slice(F.sequence(F.lit(1), F.lit(levels)), F.lit(1), depth)
    return F.aggregate(steps, F.array(leaves), lambda known, _: F.concat(known, F.array(_above(F.element_at(known, -1), fanout))))


def _lower_proof(tree: Column, depth: Column, at: Column, levels: int, fanout: int) -> Column:
    """The siblings of the leaf ``at`` a place in its block, level by level."""
    powers = F.array(*[F.lit(fanout**level).cast("int") for level in range(levels + 1)])

    def step(nodes: Column, level: Column) -> Column:
        own = F.floor(at / F.get(powers, level)).cast("int")
        run = F.slice(nodes, own - own % fanout + 1, F.lit(fanout))
        others = F.concat(F.slice(run, F.lit(1), own % fanout), F.slice(run, own % fanout + 2, F.lit(fanout)))
        return F.struct((own % fanout).alias("place"), others.alias("others"))

    return F.transform(F.slice(tree, F.lit(1), depth), step)


def _exchanged(nodes: DataFrame, fanout: int) -> DataFrame:
    """``part, at, top, path`` of ``nodes`` (``part, at, node, size``), by swapping with partners.

    Parts are filled up to a power of ``fanout`` with places that have no node, so each
    place has a partner for every digit: a row is sent ``fanout`` times in each round and
    no place is asked by more than that many. Hashes leave out what isn't there.
    """
    rounds = _levels_over(F.col("size"), fanout)
    state = nodes.withColumn("rounds", rounds).withColumn("full", F.pow(F.lit(fanout), "rounds").cast("long"))
    most = state.agg(F.max("rounds")).first()[0] or 0
    copies = F.transform(F.sequence(F.lit(0), F.lit(fanout - 1)), lambda turn: F.col("at") + turn * F.col("size"))
    state = state.withColumn("to", F.explode(F.filter(copies, lambda place: place < F.col("full"))))
    state = state.select(
        "part",
        "rounds",
        (F.col("to") < F.col("size")).alias("real"),
        F.when(F.col("to") == F.col("at"), F.col("node")).alias("node"),
        F.col("to").alias("at"),
        F.array().cast(_PROOF).alias("path"),
    )
    for number in range(most):
        stride = fanout**number
        digit = (F.floor(F.col("at") / stride) % fanout).cast("int")
        going = F.col("rounds") > number
        partners = F.transform(
            F.sequence(F.lit(0), F.lit(fanout - 1)), lambda other: F.col("at") + (other - F.col("digit")) * stride
        )
        sent = state.withColumn("digit", digit).withColumn(
            "to", F.explode(F.when(going, partners).otherwise(F.array("at")))
        )
        own = F.col("to") == F.col("at")
        met = sent.groupBy("part", F.col("to").alias("at")).agg(
            F.max("rounds").alias("rounds"),
            F.max(F.when(own, F.col("real"))).alias("real"),
            F.first(F.when(own, F.col("path")), ignorenulls=True).alias("path"),
            F.sort_array(F.collect_list(F.struct("digit", "node"))).alias("run"),
        )
        there = F.filter("run", lambda one: one["node"].isNotNull())
        met = met.withColumn("digit", digit).withColumn("there", there)
        before = F.size(F.filter("there", lambda one: one["digit"] < F.col("digit")))
        others = F.transform(F.filter("there", lambda one: one["digit"] != F.col("digit")), lambda one: one["node"])
        step = F.struct(before.alias("place"), others.alias("others"))
        parent = F.when(F.size("there") > 0, hashed(F.transform("there", lambda one: one["node"])))
        state = met.select(
            "part",
            "rounds",
            "real",
            F.when(going, parent).otherwise(F.get("run", F.lit(0))["node"]).alias("node"),
            "at",
            F.when(going, F.concat("path", F.array(step))).otherwise(F.col("path")).cast(_PROOF).alias("path"),
        )
    return state.filter("real").select("part", "at", F.col("node").alias("top"), "path")


def manifest(
    rows: DataFrame,
    part: Column,
    order: Column,
    leaf: Column,
    carried: Mapping[str, Column] | None = None,
    fanout: int = FANOUT,
    block_levels: int = BLOCK_LEVELS,
) -> DataFrame:
    """Each row's leaf, the roots above it and its proof.

    Returns the columns of ``carried`` and ``leaf, subroot, root, proof``. The leaves of a
    ``part`` are in the order of ``order``, NULL first, rows with equal ones in that of their
    leaves; repeated rows are leaves each. Every ``fanout`` nodes in a row become one, the
    last ones also if they are fewer, until one is left: the ``subroot``, which is the leaf
    itself if it's alone. Subroots, in the order of their parts with NULL first, give the
    ``root`` in the same way. ``proof`` has for each level, from the leaf to the root, the
    other nodes of the run and the place of the own one among them. Columns of ``rows``
    may have any names. No rows have no root.
    """
    kept = dict(carried or {})
    inside = rows.select(
        part.alias("part"), order.alias("key"), leaf.alias("leaf"), F.struct(F.lit(0).alias("_"), *[c.alias(n) for n, c in kept.items()]).alias("row")
    )
    numbered = _numbered(written(inside, "leaves"), ["key", "leaf"])
    width = fanout**block_levels
    blocks = numbered.groupBy("part", F.floor(F.col("at") / width).alias("block")).agg(
        F.max("size").alias("size"),
        F.sort_array(F.collect_list(F.struct((F.col("at") % width).cast("int").alias("at"), "leaf", "row"))).alias("items"),
    )
    blocks = written(blocks, "blocks")
    several = F.ceil(F.col("size") / width)
    depth = F.when(several > 1, block_levels).otherwise(_levels_over(F.col("size"), fanout)).cast("int")
    tree = _tree(F.transform("items", lambda item: item["leaf"]), F.col("depth"), block_levels, fanout)
    grown = blocks.withColumn("depth", depth).withColumn("tree", tree)
    roots = grown.select(
        "part", F.col("block").alias("at"), several.alias("size"), F.get(F.element_at("tree", -1), F.lit(0)).alias("node")
    )
    paths = written(_exchanged(written(roots, "block-roots"), fanout), "block-paths")
    # The same over the roots of the parts.
    parts = paths.filter("at = 0").select(F.lit(0).alias("part"), F.col("part").alias("of"), F.col("top").alias("node"))
    parts = written(_numbered(parts, ["of"]), "parts")
    tops = _exchanged(parts.select("part", "at", "size", "node"), fanout).select("at", F.col("top").alias("root"), F.col("path").alias("upper"))
    tops = parts.select("at", "of", F.col("node").alias("subroot")).join(tops, "at").drop("at")
    tops = tops.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1))))
    named = paths.join(tops, F.col("part").eqNullSafe(F.col("of")) & (F.col("at") % _SALTS == F.col("salt")))
    named = named.select(
        F.col("part").alias("of"), F.col("at").alias("number"), "subroot", "root", F.concat("path", "upper").alias("path")
    )
    whole = grown.join(named, F.col("part").eqNullSafe(F.col("of")) & (F.col("block") == F.col("number")))
    lower = lambda at: _lower_proof(F.col("tree"), F.col("depth"), at, block_levels, fanout)
    proofs = F.transform(
        "items",
        lambda item: F.struct(
            item["row"].alias("row"), item["leaf"].alias("leaf"), F.concat(lower(item["at"]), F.col("path")).alias("proof")
        ),
    )
    found = whole.select("subroot", "root", F.explode(proofs).alias("item"))
    return found.select(*[F.col("item.row")[name].alias(name) for name in kept], "item.leaf", "subroot", "root", "item.proof")


def op11_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The manifest of ``documents`` by language, checked against a copy with some lengths changed.

    A NULL ``doc_id`` comes first and isn't tampered with; a NULL length stays NULL.
    """
    documents = table(spark, sf_dir, "documents")
    names = ["doc_id", "source", "lang", "n_chars", "text"]
    leaf = leaf_digest(*[F.col(name) for name in names])
    longer = (F.col("n_chars").cast("decimal(20,0)") + 1).cast("string")
    forged = leaf_digest(*[longer if name == "n_chars" else F.col(name) for name in names])
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % EVERY == 0
    found = manifest(
        documents, F.col("lang"), F.col("doc_id"), leaf, {"doc_id": F.col("doc_id"), "offered": F.when(chosen, forged)}
    )
    root = folded(F.coalesce("offered", "leaf"), F.col("proof"))
    checked = found.withColumn("proof_sha256", proof_digest(F.col("proof"))).withColumn("folded_root", root)
    return checked.select(
        "doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", (F.col("folded_root") == F.col("root")).alias("verified")
    )


def _field_sql(name: str, plus: int = 0) -> str:
    text = f"({name} + {plus})::VARCHAR" if plus else f"{name}::VARCHAR"
    return f"coalesce(strlen({text}) || ':' || {text}, '-')"


def _leaf_sql(plus: int) -> str:
    fields = [_field_sql(name, plus if name == "n_chars" else 0) for name in ("doc_id", "source", "lang", "n_chars", "text")]
    return f"sha256({' || '.join(fields)})"


#: CRC-32 bit by bit: a byte is mixed in by an exclusive or, each -1 is a shift.
_CRC_SQL = """xor(list_reduce(
    list_prepend(4294967295::BIGINT, flatten(list_transform(string_split(doc_id::VARCHAR, ''),
      lambda c: [ascii(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
    lambda c, e: CASE WHEN e >= 0 THEN xor(c, e) ELSE xor(c >> 1, (c & 1) * 3988292384) END), 4294967295::BIGINT)"""

_TREE_SQL = f"""
  SELECT {{part}}, level + 1 AS level, pos // {FANOUT} AS pos, sha256(string_agg(node, '' ORDER BY pos)) AS node,
         any_value((size + {FANOUT - 1}) // {FANOUT}) AS size
  FROM {{tree}} WHERE size > 1 GROUP BY {{part}}, level, pos // {FANOUT}"""

ORACLES = {
    "op11_manifest": f"""
WITH RECURSIVE leaves AS (
  SELECT doc_id, lang, {_leaf_sql(0)} AS leaf,
         CASE WHEN {_CRC_SQL} % {EVERY} = 0 THEN {_leaf_sql(1)} ELSE {_leaf_sql(0)} END AS offered
  FROM documents
), numbered AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
         count(*) OVER (PARTITION BY lang) AS size FROM leaves
), tree AS (
  SELECT lang, 0 AS level, pos, leaf AS node, size FROM numbered
  UNION ALL ({_TREE_SQL.format(part="lang", tree="tree")})
), parts AS (
  SELECT lang, node AS subroot, level AS height, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS pos, count(*) OVER () AS size
  FROM tree WHERE size = 1
), upper_tree AS (
  SELECT 0 AS part, 0 AS level, pos, subroot AS node, size FROM parts
  UNION ALL ({_TREE_SQL.format(part="part", tree="upper_tree")})
), ways AS (
  SELECT n.doc_id, n.leaf, n.offered, n.lang, n.pos, p.subroot, p.height, p.pos AS part_pos FROM numbered n JOIN parts p ON n.lang IS NOT DISTINCT FROM p.lang
), steps AS (
  SELECT w.lang, w.pos AS leaf_pos, t.level, t.pos, t.node, w.pos // ({FANOUT} ** t.level)::BIGINT AS own
  FROM ways w JOIN tree t ON w.lang IS NOT DISTINCT FROM t.lang AND t.size > 1
   AND t.pos // {FANOUT} = (w.pos // ({FANOUT} ** t.level)::BIGINT) // {FANOUT}
  UNION ALL
  SELECT w.lang, w.pos, w.height + u.level, u.pos, u.node, w.part_pos // ({FANOUT} ** u.level)::BIGINT
  FROM ways w JOIN upper_tree u ON u.size > 1 AND u.pos // {FANOUT} = (w.part_pos // ({FANOUT} ** u.level)::BIGINT) // {FANOUT}
), sides AS (
  SELECT lang, leaf_pos, level, coalesce(string_agg(node, '' ORDER BY pos) FILTER (pos < own), '') AS l,
         coalesce(string_agg(node, '' ORDER BY pos) FILTER (pos > own), '') AS r
  FROM steps GROUP BY lang, leaf_pos, level
), proofs AS (
  SELECT lang, leaf_pos, list({{'l': l, 'r': r}} ORDER BY level) AS proof, string_agg(l || r, '' ORDER BY level) AS joined
  FROM sides GROUP BY lang, leaf_pos
), folds AS (
  SELECT w.doc_id, w.leaf, w.subroot, w.offered AS node, coalesce(p.proof, []) AS proof, coalesce(p.joined, '') AS joined, 1 AS step
  FROM ways w LEFT JOIN proofs p ON w.lang IS NOT DISTINCT FROM p.lang AND w.pos = p.leaf_pos
  UNION ALL
  SELECT doc_id, leaf, subroot, sha256(proof[step].l || node || proof[step].r), proof, joined, step + 1
  FROM folds WHERE step <= len(proof)
)
SELECT doc_id, leaf, subroot, top.node AS root, sha256(joined) AS proof_sha256, f.node AS folded_root, f.node = top.node AS verified
FROM folds f, (SELECT node FROM upper_tree WHERE size = 1) top WHERE step = len(proof) + 1
"""
}
