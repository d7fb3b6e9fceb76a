"""A Merkle tree over all rows of a dataset, with a proof for each: time-forward processing over blocks of leaves.

A tree has three children a node. Its nodes are labelled (level, place), so that children
come before their parents, and digests travel as messages to the label of the parent. The
queue of messages is ordered by label. What fits a task, a block of 3 to the `climb` leaves,
is delivered there from a heap; beyond a block the queue is a written table, which Spark
sorts by label (spilling to disk) for the next round. The reversed sweep goes the same way
back: each node sends to its children what follows of their proofs.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable, Iterator
from hashlib import sha256

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import fresh, saved, ship

# Fixed value: children of a node.
_FAN = 3


def row_digest(doc_id: Column, source: Column, lang: Column, n_chars: Column, text: Column) -> Column:
    """SHA-256 of a row as lowercase hex: per column its UTF-8 byte count, `:` and value, or `-` for NULL."""

    def field(value: Column) -> Column:
        value = value.cast("string")
        return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))

    fields = F.concat(*map(field, (doc_id, source, lang, n_chars, text)))
    return F.sha2(fields.cast("binary"), 256)


def manifest(docs: DataFrame, keep: tuple[str, ...] = (), climb: int = 7) -> DataFrame:
    """(doc_id, leaf, subroot, root, siblings, shape, *keep): every row of `docs` with its proof.

    The leaves of one source ascend by doc_id and form a tree of their own; its root is
    the subroot. Subroots ascend by source, NULL first, and form the tree of
    the root. `siblings` holds the digests that `proved` needs, level by level up to the
    root, left to right in a level; `shape` has two digits a level: how many of
    the siblings stand to the left, and how many there are.

    NULL doc_ids come first. Rows alike in doc_id and source stand in order of their
    digest; rows alike in everything are leaves each, in any order, with equal
    digests. An empty table gives no rows. Columns named in `keep` go along.

    Texts are read once, for their digests. Places are found by ranges of keys: rows of a
    range are numbered in their task, and the numbers before it are added, so one source or
    doc_id with a large part of all rows is spread over many tasks. Trees of any size
    take blocks of 3 to the `climb` leaves; a task holds one at a time.
    """
    ship(docs.sparkSession)
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        # The order of these keys is that of the sources, with NULL before all.
        F.coalesce(F.concat(F.lit("1"), F.col("source").cast("string")), F.lit("0")).alias("tree"),
        F.unhex(row_digest(*(F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text")))).alias("digest"),
        *[F.col(c).alias(f"keep{i}") for i, c in enumerate(keep)],
    )
    kept = [f"keep{i}" for i in range(len(keep))]
    rows = saved(rows.withColumn("row", F.monotonically_increasing_id()))
    leaves = saved(placed(rows, "doc_id", "digest", "row"))
    rounds = _up(leaves.select("tree", "pos", "n", "digest"), climb)
    subroots = rounds.pop().select(F.col("tree").alias("source_key"), "digest")
    over = saved(placed(subroots.withColumn("tree", F.lit("")), "source_key"))
    upper = _up(over.select("tree", "pos", "n", "digest"), climb)
    root = upper.pop()

    nothing = F.lit("")
    messages = root.select(
        "tree", F.col("pos").alias("block"), *[nothing.alias(c) for c in ("siblings", "shape", "subroot")]
    )
    for nodes in reversed(upper[1:]):
        messages = saved(_down(nodes, messages, climb))
    messages = _down(over, messages, climb, ["source_key", "digest"]).select(
        F.col("source_key").alias("tree"),
        F.lit(0).cast("long").alias("block"),
        "siblings",
        "shape",
        _hex("digest").alias("subroot"),
    )
    messages = saved(messages)
    for nodes in reversed(rounds[1:]):
        messages = saved(_down(nodes, messages, climb))
    found = _down(leaves, messages, climb, ["doc_id", "digest", *kept])
    digest = root.select(_hex("digest")).first()  # one row
    return found.select(
        "doc_id",
        _hex("digest").alias("leaf"),
        "subroot",
        F.lit(digest[0] if digest else None).cast("string").alias("root"),
        "siblings",
        "shape",
        *[F.col(k).alias(c) for k, c in zip(kept, keep)],
    )


def _hex(column: str) -> Column:
    return F.lower(F.hex(column))


def proved(leaf: Column, siblings: Column, shape: Column) -> Column:
    """The root that follows from a leaf and its proof, as lowercase hex."""
    binary = siblings.cast("binary")

    def level(done: Column, i: Column) -> Column:
        left = F.substr(shape, 2 * i + 1, F.lit(1)).cast("int") * 64
        both = F.substr(shape, 2 * i + 2, F.lit(1)).cast("int") * 64
        joined = F.concat(
            F.substr(binary, done["at"] + 1, left),
            done["digest"].cast("binary"),
            F.substr(binary, done["at"] + left + 1, both - left),
        )
        return F.struct(F.sha2(joined, 256).alias("digest"), (done["at"] + both).alias("at"))

    levels = F.when(F.length(shape) > 0, F.sequence(F.lit(0), F.floor(F.length(shape) / 2).cast("int") - 1))
    start = F.struct(leaf.alias("digest"), F.lit(0).alias("at"))
    return F.coalesce(F.aggregate(levels, start, level)["digest"], leaf)


def manifest_digests(docs: DataFrame) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified): proofs held against a changed copy.

    Where 2 divides the crc32 of the decimal doc_id (of nothing, if that is NULL), the changed
    copy of a text has lost its line breaks; other rows are as they were.
    """
    number = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    hit = (F.crc32(number.cast("binary")) % 2 == 0) & F.contains("text", F.lit("\n"))
    name = fresh(docs, "changed")
    columns = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    changed = row_digest(*columns, F.replace("text", F.lit("\n"), F.lit("")))
    found = manifest(docs.withColumn(name, F.unhex(F.when(hit, changed))), (name,))
    leaf = F.coalesce(F.lower(F.hex(name)), F.col("leaf"))
    folded = proved(leaf, F.col("siblings"), F.col("shape"))
    return found.select(
        "doc_id",
        "leaf",
        "subroot",
        "root",
        F.sha2(F.col("siblings").cast("binary"), 256).alias("proof_sha256"),
        folded.alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


def placed(rows: DataFrame, *order: str) -> DataFrame:
    """`rows` with pos, the place within their tree in the given order, and n, the rows of the tree."""
    at = fresh(rows, "at")
    keys = ("tree", *order)
    dealt = rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
    dealt = saved(dealt.withColumn(at, F.monotonically_increasing_id()))
    # The number of a row holds that of its task, and counts the task's rows.
    dealt = dealt.withColumn("range", F.shiftright(at, 33))
    spans = dealt.groupBy("tree", "range").agg(F.min(at).alias("first"), F.count(at).alias("rows"))
    tree = Window.partitionBy("tree")
    before = F.sum("rows").over(tree.orderBy("range").rowsBetween(Window.unboundedPreceding, -1))
    spans = spans.select(
        "tree",
        "range",
        (F.coalesce(before, F.lit(0)) - F.col("first")).alias("shift"),
        F.sum("rows").over(tree).alias("n"),
    )
    found = dealt.join(spans, ["tree", "range"])
    return found.withColumn("pos", F.col(at) + F.col("shift")).drop(at, "range", "shift")


def _up(nodes: DataFrame, climb: int) -> list[DataFrame]:
    """The nodes of each round (tree, pos, n, digest), last those of trees that are one node each."""
    rounds = [nodes]
    while True:
        nodes = saved(_dealt(nodes, climb).mapInPandas(_climber(climb), "tree string, pos long, n long, digest binary"))
        rounds.append(nodes)
        if (nodes.agg(F.max("n")).first()[0] or 1) == 1:
            return rounds


def _dealt(rows: DataFrame, climb: int) -> DataFrame:
    """Rows by block, and within a block by place."""
    rows = rows.withColumn("block", F.floor(F.col("pos") / F.lit(_FAN**climb)).cast("long"))
    return rows.repartition("tree", "block").sortWithinPartitions("tree", "block", "pos")


def _climber(climb: int):
    def climbed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for (tree, block, n), rows in _runs(batches, ["tree", "block", "n"], ["digest"]):
            digests = [r[0].hex() for r in rows]
            top = deliver(digests, height(n, climb))[-1][0]
            blocks = -(-n // _FAN**climb)
            yield pd.DataFrame({"tree": [tree], "pos": [block], "n": [blocks], "digest": [bytes.fromhex(top)]})

    return climbed


def height(n: int, climb: int) -> int:
    """The levels that a block of a tree of `n` nodes climbs: to its root, or `climb`."""
    levels = 0
    while levels < climb and n > 1:
        n, levels = -(-n // _FAN), levels + 1
    return levels


def deliver(digests: list[str], levels: int) -> list[list[str]]:
    """The digests of a block, level by level, from messages delivered in order of label.

    A message is (level, place) of the parent, place of the child, digest.
    """
    found = [digests] + [[] for _ in range(levels)]
    queue = [(1, i // _FAN, i, d) for i, d in enumerate(digests)] if levels else []
    while queue:
        level, place, _, digest = heapq.heappop(queue)
        children = [digest]
        while queue and queue[0][:2] == (level, place):
            children.append(heapq.heappop(queue)[3])
        own = sha256("".join(children).encode()).hexdigest()
        found[level].append(own)
        if level < levels:
            heapq.heappush(queue, (level + 1, place // _FAN, place, own))
    return found


def send_back(levels: list[list[str]], siblings: str, shape: str) -> list[tuple[str, str]]:
    """The proofs of a block's leaves, from that of its root: the sweep reversed, parents before children."""
    queue = [(1 - len(levels), 0, siblings, shape)]
    found = []
    while queue:
        level, place, siblings, shape = heapq.heappop(queue)
        if level == 0:
            found.append((siblings, shape))
            continue
        below = levels[-level - 1]
        run = below[_FAN * place : _FAN * place + _FAN]
        for i in range(len(run)):
            rest = "".join(run[:i] + run[i + 1 :])
            message = (level + 1, _FAN * place + i, rest + siblings, f"{i}{len(run) - 1}{shape}")
            heapq.heappush(queue, message)
    return found


def _down(nodes: DataFrame, messages: DataFrame, climb: int, keep: list[str] | None = None) -> DataFrame:
    """(tree, block, siblings, shape, subroot): proofs of `nodes`, from those of the roots of their blocks.

    `messages` has one such row a block, which comes to the task before the block's
    nodes. The result has a row a node, `block` being its place, or `keep` columns instead.
    """
    rows = nodes.select(
        "tree",
        F.floor(F.col("pos") / F.lit(_FAN**climb)).cast("long").alias("block"),
        "pos",
        "n",
        "digest",
        *[F.col(c).alias(f"own{i}") for i, c in enumerate(keep or ["pos"])],
    )
    own = rows.columns[5:]
    first = messages.withColumn("pos", F.lit(-1).cast("long"))
    both = rows.unionByName(first, allowMissingColumns=True)
    both = both.repartition("tree", "block").sortWithinPartitions("tree", "block", "pos")

    def sent(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        columns = ["n", "digest", "siblings", "shape", "subroot", *own]
        for (tree, _), (message, *nodes) in _runs(batches, ["tree", "block"], columns):
            siblings, shape, subroot = message[2:5]
            levels = deliver([r[1].hex() for r in nodes], height(int(nodes[0][0]), climb))
            proofs = send_back(levels, siblings, shape)
            for begin in range(0, len(nodes), 2000):
                some = nodes[begin : begin + 2000]
                frame = pd.DataFrame([r[5:] for r in some], columns=own, dtype=object)
                frame["siblings"], frame["shape"] = zip(*proofs[begin : begin + 2000])
                yield frame.assign(tree=tree, subroot=subroot)

    kinds = ", ".join(f"{c} {kind}" for c, kind in rows.dtypes[5:])
    found = both.mapInPandas(sent, f"{kinds}, siblings string, shape string, tree string, subroot string")
    names = [F.col(o).alias(c) for o, c in zip(own, keep or ["block"])]
    return found.select("tree", *names, "siblings", "shape", "subroot")


def _runs(batches: Iterable[pd.DataFrame], keys: list[str], columns: list[str]) -> Iterator[tuple[tuple, list[tuple]]]:
    """Rows with equal keys that follow each other, as tuples of `columns`, whatever batches they come in."""
    now, rows = None, []
    for batch in batches:
        for key, row in zip(zip(*(batch[c] for c in keys)), zip(*(batch[c] for c in columns))):
            if key != now:
                if rows:
                    yield now, rows
                now, rows = key, []
            rows.append(row)
    if rows:
        yield now, rows


# The same in SQL. The crc32 is folded over the digits of doc_id, bit by bit.
MANIFEST_SQL = r"""
WITH RECURSIVE given AS (
  SELECT doc_id, source, text, coalesce(octet_length(encode(doc_id::VARCHAR)) || ':' || doc_id, '-')
         || coalesce(octet_length(encode(source)) || ':' || source, '-')
         || coalesce(octet_length(encode(lang)) || ':' || lang, '-')
         || coalesce(octet_length(encode(n_chars::VARCHAR)) || ':' || n_chars, '-') AS head,
         xor(list_reduce(list_transform(range(1, length(doc_id::VARCHAR) + 1), lambda i: ascii(substr(doc_id::VARCHAR, i, 1))::BIGINT),
             lambda crc, byte: list_reduce(range(8),
               lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, xor(crc, byte)),
             4294967295::BIGINT), 4294967295) AS crc
  FROM documents
), changed AS (
  SELECT *, CASE WHEN crc % 2 = 0 THEN replace(text, chr(10), '') ELSE text END AS other FROM given
), rows_ AS (
  SELECT doc_id, coalesce('1' || source, '0') AS tree,
         sha256(head || coalesce(octet_length(encode(text)) || ':' || text, '-')) AS leaf,
         sha256(head || coalesce(octet_length(encode(other)) || ':' || other, '-')) AS tampered
  FROM changed
), leaves AS (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
         count(*) OVER (PARTITION BY tree) AS n
  FROM rows_
), lower_ AS (
  SELECT tree, 0 AS level, pos, n, leaf AS digest FROM leaves
  UNION ALL
  SELECT tree, level + 1, pos // 3, (n + 2) // 3, sha256(string_agg(digest, '' ORDER BY pos))
  FROM lower_ WHERE n > 1 GROUP BY tree, level, pos // 3, n
), subroots AS (
  SELECT tree, digest, row_number() OVER (ORDER BY tree) - 1 AS pos, count(*) OVER () AS n FROM lower_ WHERE n = 1
), upper_ AS (
  SELECT 0 AS level, pos, n, digest FROM subroots
  UNION ALL
  SELECT level + 1, pos // 3, (n + 2) // 3, sha256(string_agg(digest, '' ORDER BY pos))
  FROM upper_ WHERE n > 1 GROUP BY level, pos // 3, n
), nodes AS (
  SELECT tree, level, pos, n, digest FROM lower_ UNION ALL SELECT NULL, level, pos, n, digest FROM upper_
), siblings AS (
  SELECT a.tree, a.level, a.pos, coalesce(string_agg(b.digest, '' ORDER BY b.pos) FILTER (b.pos < a.pos), '') AS lefts,
         coalesce(string_agg(b.digest, '' ORDER BY b.pos) FILTER (b.pos > a.pos), '') AS rights
  FROM nodes a JOIN nodes b ON a.tree IS NOT DISTINCT FROM b.tree AND a.level = b.level AND a.pos // 3 = b.pos // 3
  WHERE a.n > 1 GROUP BY a.tree, a.level, a.pos
), walk AS (
  SELECT doc_id, tree AS own, tree, leaf, pos AS first, 0 AS level, pos, tampered AS now, '' AS proof, 0 AS stage FROM leaves
  UNION ALL
  SELECT doc_id, own, CASE WHEN w.stage = 0 AND s.tree IS NULL THEN NULL ELSE w.tree END, leaf, first,
         CASE WHEN s.level IS NULL THEN 0 ELSE w.level + 1 END,
         CASE WHEN s.level IS NULL THEN (SELECT x.pos FROM subroots x WHERE x.tree = own) ELSE w.pos // 3 END,
         CASE WHEN s.level IS NULL THEN now ELSE sha256(lefts || now || rights) END,
         CASE WHEN s.level IS NULL THEN proof ELSE proof || lefts || rights END,
         CASE WHEN s.level IS NULL THEN stage + 1 ELSE stage END
  FROM walk w LEFT JOIN siblings s ON w.tree IS NOT DISTINCT FROM s.tree AND w.level = s.level AND w.pos = s.pos
  WHERE w.stage < 2
)
SELECT doc_id, leaf, (SELECT x.digest FROM subroots x WHERE x.tree = own) AS subroot,
       (SELECT digest FROM upper_ WHERE n = 1) AS root, sha256(proof) AS proof_sha256, now AS folded_root,
       now = (SELECT digest FROM upper_ WHERE n = 1) AS verified
FROM walk WHERE stage = 2"""
