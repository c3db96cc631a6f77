"""A Merkle manifest of a dataset: every row's leaf, its language's root, the root, and proofs.

Leaves of a language are in order of doc_id, and runs of FANOUT nodes become one node until
one is left. A language's leaves are cut into aligned blocks of BLOCK; a block's authentication
paths are made leaf by leaf: for each level the run that the leaf is under is held, and a
treehash stack works on the next run of that level, a leaf a step, so that it is there when it
is needed. What is held besides the block's leaves grows with the logarithm of the block. The
roots of blocks are the leaves of the tree above them, which is walked alike, and its paths,
which all leaves of a block share, are appended.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import lower_ascii, materialized, partitions, table

FANOUT = 8
#: Levels that are walked in one task: blocks of 4096 leaves.
BLOCK_LEVELS = 4
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: A step of a path: what of the run stands before the node, and after it.
Step = tuple[str, str]


def node_hash(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def depth(n: int) -> int:
    """Levels above n nodes until one is left."""
    levels = 0
    while FANOUT**levels < n:
        levels += 1
    return levels


class Treehash:
    """Hashes leaves up by `levels` levels as they come; of each level less than a run is held."""

    def __init__(self, levels: int):
        self.held: list[list[str]] = [[] for _ in range(levels)]
        self.nodes: list[str] = []

    def push(self, node: str) -> None:
        for run in self.held:
            run.append(node)
            if len(run) < FANOUT:
                return
            node = node_hash("".join(run))
            run.clear()
        self.nodes.append(node)

    def close(self) -> list[str]:
        """The nodes, once the runs that aren't full are hashed up too."""
        for at, run in enumerate(self.held):
            if run:
                above = self.held[at + 1] if at + 1 < len(self.held) else self.nodes
                above.append(node_hash("".join(run)))
                run.clear()
        return self.nodes


def block_root(leaves: list[str], levels: int) -> str:
    tree = Treehash(levels)
    for leaf in leaves:
        tree.push(leaf)
    return tree.close()[0]


def auth_paths(leaves: list[str], levels: int) -> Iterator[list[Step]]:
    """Each leaf's path up to the root of its block, leaf by leaf."""

    def run_of(level: int, begin: int, end: int) -> Treehash:
        tree = Treehash(level)
        for leaf in leaves[begin:end]:
            tree.push(leaf)
        return tree

    spans = [FANOUT ** (level + 1) for level in range(levels)]  # leaves under a run
    runs = [run_of(level, 0, span).close() for level, span in enumerate(spans)]
    ahead = [Treehash(level) for level in range(levels)]
    for i in range(len(leaves)):
        for level, span in enumerate(spans):
            if i and i % span == 0:
                runs[level], ahead[level] = ahead[level].close(), Treehash(level)
            if i + span < len(leaves):
                ahead[level].push(leaves[i + span])
        yield [("".join(run[:j]), "".join(run[j + 1 :])) for run, j in zip(runs, (i // (span // FANOUT) % FANOUT for span in spans))]


def fold(node: str, path: list[Step]) -> str:
    for before, after in path:
        node = node_hash(before + node + after)
    return node


def cut_path(siblings: str, pos: int, n: int) -> list[Step]:
    """The steps of the path of node `pos` of n, from its siblings' hashes in a row."""
    steps, at = [], 0
    while n > 1:
        j = pos % FANOUT
        size = min(FANOUT, n - (pos - j))
        width = len("0" * 64)
        steps.append((siblings[at : at + j * width], siblings[at + j * width : at + (size - 1) * width]))
        at += (size - 1) * width
        pos, n = pos // FANOUT, -(-n // FANOUT)
    return steps


def numbered(rows: DataFrame, tree: str, *order: str) -> DataFrame:
    """rows with pos, from 0 in the order of `order` in each tree, and n, the rows of the tree.

    Rows are dealt and sorted by ranges, numbered where they lie, and only the number of
    rows of each range and tree is summed up. `tree` is a string without nulls; in `order`,
    nulls come first.
    """
    parts = partitions(rows)

    def count(batches):
        part, tree_now, at = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            index = []
            for t in batch.column(tree).to_pylist():
                if t != tree_now:
                    tree_now, at = t, 0
                index.append(at)
                at += 1
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([part] * batch.num_rows, pa.int32()), pa.array(index, pa.int64())], [*batch.schema.names, "_part", "_index"]
            )

    schema = f"{', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in rows.schema)}, _part int, _index long"
    ranged = materialized(rows.repartitionByRange(parts, tree, *order).sortWithinPartitions(tree, *order).mapInArrow(count, schema))
    # a row for each range and tree in it
    in_tree = Window.partitionBy(tree)
    spans = ranged.groupBy(tree, "_part").agg(F.count("*").alias("_rows")).select(
        tree, "_part", F.sum("_rows").over(in_tree).alias("n"),
        F.coalesce(F.sum("_rows").over(in_tree.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"),
    )
    return ranged.join(spans, [tree, "_part"]).withColumn("pos", F.col("_before") + F.col("_index")).drop("_part", "_index", "_before")


def _by_block(batches, names: list[str]):
    """Columns (as lists) of each block's rows, which follow each other; a block is bounded."""
    key, held = None, None
    for batch in batches:
        for row in zip(*(batch.column(c).to_pylist() for c in names)):
            if row[:2] != key:
                if held:
                    yield list(zip(*held))
                key, held = row[:2], []
            held.append(row)
    if held:
        yield list(zip(*held))


def _block(pos: str = "pos") -> Column:
    return F.expr(f"{pos} div {FANOUT**BLOCK_LEVELS}")


def _dealt(rows: DataFrame) -> DataFrame:
    return rows.repartition("tree", "block").sortWithinPartitions("tree", "block", "pos")


def node_paths(nodes: DataFrame) -> DataFrame:
    """tree, pos, n, siblings (hashes in a row, up to the tree's root), root, of nodes (tree, pos, n, node)."""

    def walk(batches):
        for trees, blocks, pos, n, node in _by_block(batches, ["tree", "block", "pos", "n", "node"]):
            levels = min(BLOCK_LEVELS, depth(n[0]))
            siblings = ["".join(before + after for before, after in path) for path in auth_paths(list(node), levels)]
            columns = [pa.array(c, t) for c, t in zip((trees, blocks, pos, n, siblings), (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string()))]
            root = pa.array([block_root(list(node), levels)] * len(pos), pa.string())
            yield pa.RecordBatch.from_arrays([*columns, root], ["tree", "block", "pos", "n", "siblings", "root"])

    dealt = _dealt(nodes.select("tree", _block().alias("block"), "pos", "n", "node"))
    walked = materialized(dealt.mapInArrow(walk, "tree string, block long, pos long, n long, siblings string, root string"))
    if walked.filter("block > 0").isEmpty():
        return walked.drop("block")
    above = node_paths(_above(walked.select("tree", "block", "n", "root").distinct()))
    above = above.select("tree", F.col("pos").alias("block"), F.col("siblings").alias("_siblings"), F.col("root").alias("_root"))
    return walked.join(above, ["tree", "block"]).select("tree", "pos", "n", F.concat("siblings", "_siblings").alias("siblings"), F.col("_root").alias("root"))


def _above(roots: DataFrame) -> DataFrame:
    """Roots of blocks as the nodes of the tree above."""
    size = FANOUT**BLOCK_LEVELS
    return roots.select("tree", F.col("block").alias("pos"), F.expr(f"(n + {size - 1}) div {size}").alias("n"), F.col("root").alias("node"))


def leaf_hash(text: Column | None = None) -> Column:
    """A row's leaf, with another text if one is given."""
    fields = []
    for name in FIELDS:
        c = (F.col(name) if name != "text" or text is None else text).cast("string")
        fields.append(F.coalesce(F.concat(F.octet_length(c).cast("string"), F.lit(":"), c), F.lit("-")))
    return F.sha2(F.concat(*fields), 256)


def manifest(docs: DataFrame, tampered: Column | None = None) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified of each row.

    `tampered` is the text of a row that someone changed, null where no one did; only
    folded_root, from that row's leaf up its original path, and verified know of it. Rows of
    one language and doc_id are in the order of their leaves; null doc_ids come first, null
    lang before all others and apart from ''. Equal rows have a leaf each. An empty table
    gives no rows. Texts are read once and don't shuffle.
    """
    other = F.lit(None).cast("string") if tampered is None else F.when(tampered.isNotNull(), leaf_hash(tampered))
    # languages in order, null first
    tree = F.when(F.col("lang").isNull(), F.lit("0")).otherwise(F.concat(F.lit("1"), F.col("lang")))
    leaves = materialized(numbered(docs.select(tree.alias("tree"), "doc_id", leaf_hash().alias("leaf"), other.alias("other")), "tree", "doc_id", "leaf").withColumn("block", _block()))

    def roots(batches):
        for trees, blocks, _, n, leaf in _by_block(batches, ["tree", "block", "pos", "n", "leaf"]):
            root = block_root(list(leaf), min(BLOCK_LEVELS, depth(n[0])))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(([trees[0]], [blocks[0]], [n[0]], [root]), (pa.string(), pa.int64(), pa.int64(), pa.string()))], ["tree", "block", "n", "root"])

    blocks = materialized(_dealt(leaves.select("tree", "block", "pos", "n", "leaf")).mapInArrow(roots, "tree string, block long, n long, root string"))
    above = node_paths(_above(blocks)).select("tree", F.col("pos").alias("block"), F.col("n").alias("n_up"), "siblings", F.col("root").alias("subroot"))
    langs = above.select("tree", "subroot").distinct().select(F.lit("").alias("top"), "tree", "subroot")
    top = numbered(langs, "top", "tree").select("tree", F.col("pos").alias("pos_top"), F.col("n").alias("n_top"), F.col("subroot").alias("node"))
    top = top.join(
        node_paths(top.select(F.lit("").alias("tree"), F.col("pos_top").alias("pos"), F.col("n_top").alias("n"), "node")).select(F.col("pos").alias("pos_top"), F.col("siblings").alias("siblings_top"), "root"),
        "pos_top",
    )
    # a row before each block's leaves, with what all their paths share
    shared = above.join(top.drop("node"), "tree").select(
        "tree", "block", F.lit(-1).cast("long").alias("pos"), F.struct("n_up", "siblings", "subroot", "pos_top", "n_top", "siblings_top", "root").alias("up")
    )
    rows = leaves.select("tree", "block", "pos", "n", "doc_id", "leaf", "other").unionByName(shared, allowMissingColumns=True)
    kind = docs.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]

    def prove(batches):
        doc_type = None

        def typed():
            nonlocal doc_type
            for batch in batches:
                doc_type = batch.schema.field("doc_id").type
                yield batch

        for _, block, _, n, doc, leaf, other, up in _by_block(typed(), ["tree", "block", "pos", "n", "doc_id", "leaf", "other", "up"]):
            up, out = up[0], []
            shared = cut_path(up["siblings"], block[0], up["n_up"]) + cut_path(up["siblings_top"], up["pos_top"], up["n_top"])
            appended = "".join(before + after for before, after in shared)
            leaves = list(leaf[1:])
            for at, path in enumerate(auth_paths(leaves, min(BLOCK_LEVELS, depth(n[1]))), 1):
                proof = node_hash("".join(before + after for before, after in path) + appended)
                folded = fold(fold(other[at] or leaf[at], path), shared)
                out.append((doc[at], leaf[at], up["subroot"], up["root"], proof, folded, folded == up["root"]))
            types = [doc_type, *[pa.string()] * 5, pa.bool_()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)

    return _dealt(rows).mapInArrow(prove, f"doc_id {kind}, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean")


def op12_merkle_manifest(spark, sf_dir):
    """The manifest of documents; where 3 divides the doc_id's CRC-32, someone lower-cased the text."""
    picked = F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    return manifest(table(spark, sf_dir, "documents"), F.when(picked, lower_ascii(F.col("text"))))


def _sql(levels: int = 12) -> str:
    """Levels are written out; a tree that has one node left stays as it is."""
    field = lambda c: f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || {c}, '-')"
    leaf = lambda text: "sha256(" + " || ".join(field(c) for c in FIELDS[:-1]) + " || " + field(text) + ")"
    low = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    crc = """(xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda ch: ascii(ch)::BIGINT)),
      lambda c, b: list_reduce(list_concat([xor(c, b)], [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]), lambda x, y: xor(x >> 1, (x & 1) * 3988292384))), 4294967295::BIGINT))"""
    parts = [f"""
WITH docs AS MATERIALIZED (
  SELECT doc_id, coalesce('1' || lang, '0') AS tree, {leaf('text')} AS leaf, CASE WHEN {crc} % 3 = 0 THEN {leaf(low)} ELSE {leaf('text')} END AS other FROM documents),
l AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM docs)"""]

    def climb(prefix: str, last: str) -> str:
        for i in range(levels):
            up, down = f"{prefix}{i + 1}", f"{prefix}{i}"
            parts.append(f"""{up} AS MATERIALIZED (
  SELECT tree, pos // 8 AS pos, CASE WHEN any_value(n) = 1 THEN any_value(node) ELSE sha256(string_agg(node, '' ORDER BY pos)) END AS node, (any_value(n) + 7) // 8 AS n
  FROM {down} GROUP BY tree, pos // 8)""")
            runs = f"r_{down}"
            parts.append(f"""{runs} AS MATERIALIZED (
  SELECT a.tree, a.pos, coalesce(string_agg(b.node, '' ORDER BY b.pos) FILTER (b.pos < a.pos), '') AS b, coalesce(string_agg(b.node, '' ORDER BY b.pos) FILTER (b.pos > a.pos), '') AS c
  FROM {down} a JOIN {down} b ON a.tree = b.tree AND a.pos // 8 = b.pos // 8 WHERE a.n > 1 GROUP BY a.tree, a.pos)""")
            pos, on = ("p.pos", "p.tree") if prefix == "t" else ("p.top_pos", "''")
            parts.append(f"""p_{up} AS MATERIALIZED (
  SELECT p.* EXCLUDE (proof, folded), p.proof || coalesce(r.b || r.c, '') AS proof, CASE WHEN r.b IS NULL THEN p.folded ELSE sha256(r.b || p.folded || r.c) END AS folded
  FROM {last} p LEFT JOIN {runs} r ON r.tree = {on} AND r.pos = {pos} // {8**i})""")
            last = f"p_{up}"
        return last

    parts.append("t0 AS MATERIALIZED (SELECT tree, pos, leaf AS node, count(*) OVER (PARTITION BY tree) AS n FROM l)")
    parts.append("p0 AS (SELECT tree, pos, doc_id, leaf, other AS folded, '' AS proof FROM l)")
    last = climb("t", "p0")
    parts.append(f"u0 AS MATERIALIZED (SELECT '' AS tree, row_number() OVER (ORDER BY tree) - 1 AS pos, node, count(*) OVER () AS n, tree AS lang FROM t{levels})")
    parts.append(f"q0 AS (SELECT p.*, u.pos AS top_pos, u.node AS subroot FROM {last} p JOIN u0 u ON u.lang = p.tree)")
    last = climb("u", "q0")
    return ",\n".join(parts) + f"""
SELECT doc_id, leaf, subroot, (SELECT node FROM u{levels}) AS root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = (SELECT node FROM u{levels}) AS verified
FROM {last}"""


SQL = {"op12_merkle_manifest": _sql()}
