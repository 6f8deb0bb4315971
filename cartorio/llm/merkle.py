"""Merkle manifest of a table: built levels are stored as parent-linked rows, and a recursive query climbs from each leaf."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartorio.llm.frames import parts, reliable
from cartorio.operators.joins import small

#: Columns of a document that its leaf covers, in order.
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
#: Levels of the tree that one link climbs, so one step of the recursion: a leaf of 10^12 takes five.
STRIDE = 8
#: Climbing rows that meet at one stored row at most; rows above more leaves are stored that many times over, each for a share of them.
MEET = 4096
#: Upper links of some 400 bytes each that are broadcast at most.
FEW = 100_000
#: The tree of subroots.
TOP = -1


class Manifest(NamedTuple):
    """leaves: t, idx, leaf, the columns given with it, and the leaf's own link (path, siblings, top, up); links: t, level, idx, salt and
    the same for all nodes above that a link starts at. `path` has a letter for each level, L or R where the sibling is left or
    right and - where there is none, `siblings` their bytes from below, `up` the row to go on at, `top` the root of a tree that ends."""

    leaves: DataFrame
    links: DataFrame


def _bytes(digest: Column) -> Column:
    return F.unhex(digest)


def text_of(digest: Column) -> Column:
    """Lowercase hex of stored digests."""
    return F.lower(F.hex(digest))


def _field(c: Column) -> Column:
    value = c.cast("string")
    return F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value))


def leaf_digest(*columns: Column) -> Column:
    """SHA-256 over the fields, each `-` if null, else its UTF-8 byte count, a colon and its text."""
    return _bytes(F.sha2(F.concat(*(_field(c) for c in columns)), 256))


def _joined(left: Column, right: Column) -> Column:
    """The digest of one or two nodes; a missing right one counts as nothing."""
    return _bytes(F.sha2(F.concat(text_of(left), F.coalesce(text_of(right), F.lit(""))), 256))


def placed(df: DataFrame, tree: str, order: list[str]) -> DataFrame:
    """df with `t` (a number for each tree, ascending with its value, null first), `idx` (0, 1, ... within the tree by `order`)
    and `n` (the tree's rows).

    Rows are sorted over all tasks by range; each task numbers its own, and sums of the counts of the tasks before it say
    where they begin. A tree of any size is spread over as many tasks as it fills.
    """
    by = [tree, *order]
    sorted_ = reliable(df.repartitionByRange(parts(df.sparkSession), *by).sortWithinPartitions(*by)
                       .withColumns({"_at": F.monotonically_increasing_id(), "_part": F.spark_partition_id()}))
    # One row for each tree and task that has it: as many as there are tasks and trees together.
    runs = reliable(sorted_.groupBy(tree, "_part").agg(F.min("_at").alias("_first"), F.count("*").alias("_rows")))
    before = (runs.groupBy(tree).agg(F.min("_first").alias("t"), F.sum("_rows").alias("n"), F.sort_array(F.collect_list(F.struct("_part", "_first", "_rows"))).alias("_runs"))
              .select(F.col(tree).alias("_tree"), "t", "n", F.posexplode("_runs").alias("_k", "_run"), "_runs")
              .select("_tree", "t", "n", F.col("_run._part").alias("_of"), F.col("_run._first").alias("_first"),
                      F.aggregate(F.slice("_runs", 1, F.col("_k")), F.lit(0).cast("long"), lambda s, r: s + r["_rows"]).alias("_before")))
    joined = sorted_.join(small(before), (F.col("_part") == F.col("_of")) & F.col(tree).eqNullSafe(F.col("_tree")))
    return joined.withColumn("idx", F.col("_at") - F.col("_first") + F.col("_before")).drop("_at", "_part", "_tree", "_of", "_first", "_before")


def _next_layer(layer: Column) -> Column:
    halves = F.sequence(F.lit(0), F.shiftright(F.size(layer) - 1, 1))
    return F.transform(halves, lambda i: _joined(F.get(layer, 2 * i), F.get(layer, 2 * i + 1)))


def _groups(nodes: DataFrame, level: int, stride: int) -> DataFrame:
    """nodes (t, n, idx, digest, below, given), 2**stride consecutive ones in a row: `layers` holds their digests and those of
    each level above them, up to the group's one ancestor. The last group of a tree that has no other climbs to its root only."""
    wide = nodes.groupBy("t", "n", F.shiftright("idx", stride).alias("g")).agg(
        F.sort_array(F.collect_list(F.struct("idx", "digest", "below", "given"))).alias("own"), F.sum("below").alias("all_below"))
    height = F.lit(0)
    for k in range(stride):
        height = height + (F.col("n") > (1 << k)).cast("int")
    out = wide.select("t", "n", "g", "own", "all_below", height.alias("height"), F.col("own.digest").alias("layer0"))
    for k in range(1, stride + 1):
        out = out.withColumn(f"layer{k}", F.when(F.col("height") >= k, _next_layer(F.col(f"layer{k - 1}"))))
    layers = F.array(*(F.col(f"layer{k}") for k in range(stride + 1)))
    return out.select("t", "n", "g", F.lit(level).alias("level"), "own", "all_below", "height", F.slice(layers, 1, F.col("height") + 1).alias("layers"))


def _salts(below: Column) -> Column:
    return F.ceil(below / MEET).cast("long")


def _nodes(groups: DataFrame, stride: int, above: DataFrame | None) -> DataFrame:
    """Each node of the groups with its link: in the same tree, or from a subroot to its place in the tree above, or nowhere."""
    rows = groups.select("t", "n", "g", "level", "height", "all_below", "layers", F.posexplode("own").alias("k", "node"))
    levels = F.when(F.col("height") > 0, F.sequence(F.lit(0), F.col("height") - 1)).otherwise(F.array().cast("array<int>"))
    at = lambda j: F.call_function("shiftright", F.col("k"), j)
    sibling = lambda j: F.get(F.get("layers", j), at(j).bitwiseXOR(F.lit(1)))
    side = lambda j: F.when(sibling(j).isNull(), "-").when(at(j).bitwiseAND(F.lit(1)) == 1, "L").otherwise("R")
    siblings = F.aggregate(levels, F.lit(b""), lambda s, j: F.concat(s, F.coalesce(sibling(j), F.lit(b""))))
    rows = rows.select("t", "level", "node.idx", "node.digest", "node.below", "node.given", "g", "all_below", F.array_join(F.transform(levels, side), "").alias("path"),
                       siblings.alias("siblings"), F.when(F.col("n") <= (1 << stride), F.get(F.get("layers", F.col("height")), F.lit(0))).alias("top"))
    up = F.when(F.col("top").isNull(), F.struct(F.col("t").alias("t"), (F.col("level") + stride).alias("level"), F.col("g").alias("idx"), _salts(F.col("all_below")).alias("salts")))
    if above is not None:
        places = above.select(F.col("of").alias("_of"), F.struct(F.lit(TOP).cast("long").alias("t"), F.lit(0).alias("level"), "idx", _salts(F.col("below")).alias("salts")).alias("_place"))
        rows = rows.join(small(places), F.col("top").isNotNull() & (F.col("t") == F.col("_of")), "left")
        up = F.coalesce(up, F.col("_place"))
    return rows.select("t", "level", "idx", "digest", "below", "given", "path", "siblings", "top", up.alias("up"))


def _built(nodes: DataFrame, stride: int) -> tuple[list[DataFrame], DataFrame]:
    """(groups of each stored level, subroots: t, digest, below) of all trees; a row of nodes is one leaf."""
    stored, roots, level = [], [], 0
    while True:
        groups = reliable(_groups(nodes, level, stride))
        stored.append(groups)
        last = F.col("n") <= (1 << stride)
        ancestor = F.get(F.get("layers", F.col("height")), F.lit(0))
        roots.append(groups.filter(last).select("t", ancestor.alias("digest"), F.col("all_below").alias("below")))
        if groups.filter(~last).isEmpty():
            break
        nodes = groups.filter(~last).select("t", F.ceil(F.col("n") / (1 << stride)).cast("long").alias("n"), F.col("g").alias("idx"),
                                            ancestor.alias("digest"), F.col("all_below").alias("below"), F.lit(None).cast("int").alias("given"))
        level += stride
    out = roots[0]
    for r in roots[1:]:
        out = out.unionByName(r)
    return stored, out


def build(leaves: DataFrame, stride: int = STRIDE) -> Manifest:
    """The manifest of leaves (tree, key, row, leaf and further columns): in each tree they ascend by key (null first; equal
    keys by digest, equal digests by row), every two consecutive nodes have one digest, a last single one its own, until one
    remains; these subroots, by their trees' values, are the leaves of the top tree.

    Each stored level is one shuffle of the ancestors below it, a 256th of their rows. No rows give no links.
    """
    own = placed(leaves, "tree", ["key", "leaf", "row"])
    given = F.struct(*(c for c in leaves.columns if c not in ("tree", "leaf")))
    one = F.lit(1).cast("long").alias("below")
    stored, subroots = _built(own.select("t", "n", "idx", F.col("leaf").alias("digest"), one, given.alias("given")), stride)
    tops = placed(subroots.select(F.lit(TOP).alias("_top"), F.col("t").alias("of"), "digest", "below"), "_top", ["of"])
    above, _ = _built(tops.select(F.lit(TOP).cast("long").alias("t"), "n", "idx", "digest", "below", F.lit(None).cast("int").alias("given")), stride)
    links = None
    for groups, places in [*((g, tops) for g in stored[1:]), *((g, None) for g in above)]:
        nodes = _nodes(groups, stride, places)
        nodes = nodes.select("t", "level", "idx", F.explode(F.sequence(F.lit(0).cast("long"), _salts(F.col("below")) - 1)).alias("salt"), "path", "siblings", "top", "up")
        links = nodes if links is None else links.unionByName(nodes)
    first = _nodes(stored[0], stride, tops).select("t", "idx", F.col("digest").alias("leaf"), "given.*", "path", "siblings", "top", "up")
    return Manifest(first, reliable(links))


#: A digest folded with the siblings of one link, from below.
FOLD = """if(length({path}) = 0, {of}, aggregate(sequence(1, length({path})), named_struct('h', {of}, 'at', 1), (s, i) -> named_struct(
  'h', unhex(sha2(concat(if(substr({path}, i, 1) = 'L', lower(hex(substring({siblings}, s.at, 32))), ''), lower(hex(s.h)),
                         if(substr({path}, i, 1) = 'R', lower(hex(substring({siblings}, s.at, 32))), '')), 256)),
  'at', if(substr({path}, i, 1) = '-', s.at, s.at + 32)), s -> s.h))"""
CLIMB = f"""
with recursive climb(row, key, leaf, t, level, idx, salt, folded, siblings, subroot, root, done) as (
  select row, key, leaf, up.t, up.level, up.idx, pmod(row, up.salts), {FOLD.format(of="claimed", path="path", siblings="siblings")}, siblings, top, top, up is null from {{leaves}}
  union all
  select c.row, c.key, c.leaf, l.up.t, l.up.level, l.up.idx, pmod(c.row, l.up.salts), {FOLD.format(of="c.folded", path="l.path", siblings="l.siblings")},
    concat(c.siblings, l.siblings), coalesce(c.subroot, l.top), l.top, l.up is null
  from climb c join {{links}} l on c.t = l.t and c.level = l.level and c.idx = l.idx and c.salt = l.salt)
select row, key, leaf, folded, {{proof}}, subroot, root from climb where done
"""

#: Spark's own bound of rows in a recursion, off while one runs: it follows the table here.
ROW_LIMIT = "spark.sql.cteRecursionRowLimit"


def climb(spark: SparkSession, manifest: Manifest, whole_proofs: bool = False) -> DataFrame:
    """(row, key, leaf, folded, proof, subroot, root): from each leaf its `claimed` digest is folded with the stored siblings up
    to the root, by a recursive query of as many steps as the tallest tree has links. `proof` is the digest of the texts of
    all siblings met, or with whole_proofs their bytes one after the other.

    The links are broadcast only where a count shows that they are few; else the rows are dealt by the node they have reached,
    at which no more than MEET of them come together.
    """
    links = small(manifest.links, FEW)
    proof = "siblings as proof" if whole_proofs else "unhex(sha2(lower(hex(siblings)), 256)) as proof"
    before = spark.conf.get(ROW_LIMIT)
    spark.conf.set(ROW_LIMIT, "-1")
    try:
        return reliable(spark.sql(CLIMB.replace("{proof}", proof), leaves=manifest.leaves, links=links))
    finally:
        spark.conf.set(ROW_LIMIT, before)


def audit(docs: DataFrame, tampered: dict[str, Column], columns: tuple[str, ...] = COLUMNS, tree: str = "lang", key: str = "doc_id",
          stride: int = STRIDE, whole_proofs: bool = False) -> DataFrame:
    """(key, leaf, subroot, root, proof, folded_root, verified) of each row of docs: digests as lowercase hex, `proof` as in
    `climb`, and whether the leaf with `tampered` columns in place folds to the root.

    Null columns have a mark of their own in the leaf, null trees are one tree, which comes first, and null keys come first in it; a
    text of any length is hashed as one value. Rows that repeat have a leaf each, no rows give none, and further columns don't matter.
    """
    changed = [tampered.get(c, F.col(f"`{c}`")) for c in columns]
    same = F.lit(True)
    for c in tampered:
        same = same & F.col(f"`{c}`").eqNullSafe(tampered[c])
    leaf = leaf_digest(*(F.col(f"`{c}`") for c in columns))
    # The leaves are written once: numbers of rows stay what they are when a task runs again.
    leaves = reliable(docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{tree}`").alias("tree"), leaf.alias("leaf"), F.when(~same, leaf_digest(*changed)).alias("other"))
                      .withColumn("row", F.monotonically_increasing_id()))
    manifest = build(leaves, stride)
    out = climb(docs.sparkSession, manifest._replace(leaves=manifest.leaves.withColumn("claimed", F.coalesce("other", "leaf"))), whole_proofs)
    return out.select(F.col("key").alias(key), text_of(F.col("leaf")).alias("leaf"), text_of(F.col("subroot")).alias("subroot"), text_of(F.col("root")).alias("root"),
                      text_of(F.col("proof")).alias("proof"), text_of(F.col("folded")).alias("folded_root"), (F.col("folded") == F.col("root")).alias("verified"))


def one_more(id_col: str = "doc_id", count_col: str = "n_chars", every: int = 7) -> dict[str, Column]:
    """The tampering of the audit: where `every` divides the unsigned crc32 of the id as text, the count is one more; nulls stay."""
    hit = F.crc32(F.col(id_col).cast("string").cast("binary")) % every == 0
    n = F.col(count_col)
    return {count_col: F.when(hit, n.cast("decimal(20,0)") + 1).otherwise(n.cast("decimal(20,0)"))}
