"""Prefix trie of conversations, from ternary search trees over shards of a range.

Turns become numbers of a dictionary of distinct (role, text), in their order. A
conversation is the list of its turns' numbers; equal lists are one sequence with a
count, its smallest conversation and the checksum of all its ids. Sequences are dealt
by range, so that a shard holds neighbours, and each shard's sequences go into a
ternary search tree, the median first and then the medians of both halves, which keeps
it balanced. A traversal without recursion adds up members, leaves and savings from the
ends to the root.

Only the prefixes of a shard's first and last sequence can also occur in other shards.
These boundary nodes come with what lies below them short of other boundary nodes; the
shards' shares are added up by node, and one pass over this skeleton, a few nodes for
each shard, completes them. All other nodes are complete in their shard.

Checksums of the ids that end at a node: ids are dealt by range, folded into long
strings where they lie, and each node's strings are then hashed in order, one at a
time; a hot node's ids thus never meet as rows or in memory.

Defined cases: rows without a conv_id are left out; null role or text is empty; turns
without a number come first, ties follow role and text, and repeated rows are turns of
their own; texts of any length are compared whole, once, for the dictionary; a
conversation without turns ends at the root; extra columns do no harm; an empty table
gives no node. A conversation is one list, bounded by what a row can hold.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.llm.common import small_side, table
from shelfline.session import materialize

# A shard's tree holds at most so many turns, more only for a single longer sequence.
SHARD_TURNS = 200_000
FOLDED_IDS = 8_000
NO_ENDS = hashlib.sha256().hexdigest()
NODES = ("node string, parent string, boundary boolean, parent_boundary boolean, conv_id long, depth int, parent_conv_id long, "
         "n_convs long, n_children long, n_leaves long, saved_tokens long, words long, ends string")

RESULT = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends"]
SKELETON = ("node string, parent string, conv_id long, depth int, parent_conv_id long, n_convs long, n_children long, "
            "n_leaves long, saved_tokens long, words long, ends string")


def arrow_schema(columns: str) -> pa.Schema:
    kinds = {"string": pa.string(), "boolean": pa.bool_(), "long": pa.int64(), "int": pa.int32()}
    return pa.schema([(c.split()[0], kinds[c.split()[1]]) for c in columns.split(", ")])


def numbered_turns(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, id, words): turns with the numbers of their (role, text), which follow the order of both."""
    clean = turns.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn",
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    words = F.size(F.regexp_extract_all("text", F.lit(r"([^\x20\x09-\x0D]+)"), 1)).cast("long")
    # Both sides of the join are written tables, whose hot turns Spark can split.
    numbers = materialize(clean.select("role", "text").distinct().orderBy("role", "text").select(
        F.monotonically_increasing_id().alias("id"), "role", "text", words.alias("words")), "turn-numbers")
    return clean.join(numbers, ["role", "text"]).select("conv_id", "turn", "id", "words")


def own_sequences(numbered: DataFrame) -> DataFrame:
    """(conv_id, ids, words): each conversation's turns in order."""
    in_order = F.sort_array(F.collect_list(F.struct(F.col("turn").isNotNull().alias("known"), "turn", "id", "words")))
    return numbered.groupBy("conv_id").agg(in_order.alias("t")).selectExpr("conv_id", "t.id AS ids", "t.words AS words")


def rebuilt(sequences: DataFrame, family: int = 20, spread: int = 4) -> DataFrame:
    """Conversations whose first turns are those of the first of their ``family``, as many as their id's checksum says."""
    heads = sequences.where(F.col("conv_id") % family == 0).select(
        F.col("conv_id").alias("head_id"), *[F.slice(c, 1, spread - 1).alias(f"head_{c}") for c in ("ids", "words")])
    joined = sequences.withColumn("h", (F.crc32(F.col("conv_id").cast("string").cast("binary")) % spread).cast("int")).join(
        heads, F.col("conv_id") - F.col("conv_id") % family == F.col("head_id"), "left")
    return joined.selectExpr("conv_id", *[
        f"concat(coalesce(slice(head_{c}, 1, h), array()), slice({c}, h + 1, greatest(size({c}) - h, 0))) AS {c}" for c in ("ids", "words")])


def fold_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ordered (leader, conv_id) to (leader, first, text): ids of one leader, joined by commas."""
    def row(leader, ids: list[int]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([leader], pa.int64()), pa.array([ids[0]], pa.int64()), pa.array([",".join(map(str, ids))], pa.large_string())],
            names=["leader", "first", "text"]).cast(pa.schema([("leader", pa.int64()), ("first", pa.int64()), ("text", pa.string())]))

    last, held = None, []
    for batch in batches:
        rows: list[pa.RecordBatch] = []
        for leader, conv_id in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if held and (leader != last or len(held) >= FOLDED_IDS):
                rows.append(row(last, held))
                held = []
            last = leader
            held.append(conv_id)
        if rows:
            yield from pa.Table.from_batches(rows).combine_chunks().to_batches()
    if held:
        yield row(last, held)


def hash_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ordered (leader, first, text) to (leader, ends): the checksum of each leader's strings, joined by commas."""
    last, state = None, None
    leaders, digests = [], []
    for batch in batches:
        for leader, text in zip(batch.column(0).to_pylist(), batch.column(2), strict=True):
            if state is not None and leader == last:
                state.update(b",")
            else:
                if state is not None:
                    leaders.append(last)
                    digests.append(state.hexdigest())
                last, state = leader, hashlib.sha256()
            state.update(text.as_buffer())
        yield pa.RecordBatch.from_arrays([pa.array(leaders, pa.int64()), pa.array(digests, pa.string())], names=["leader", "ends"])
        leaders, digests = [], []
    if state is not None:
        yield pa.RecordBatch.from_arrays([pa.array([last], pa.int64()), pa.array([state.hexdigest()])], names=["leader", "ends"])


def distinct_sequences(conversations: DataFrame) -> DataFrame:
    """(ids, words, leader, n, ends): sequences with their smallest conversation, their number and their ids' checksum."""
    written = materialize(conversations, "conversations")
    kinds = materialize(written.groupBy("ids").agg(
        F.min("words").alias("words"), F.min("conv_id").alias("leader"), F.count(F.lit(1)).alias("n")), "sequences")
    members = materialize(written.select("ids", "conv_id").join(kinds.select("ids", "leader"), "ids").select("leader", "conv_id"), "members")
    folded = members.repartitionByRange("leader", "conv_id").sortWithinPartitions("leader", "conv_id").mapInArrow(
        fold_ids, "leader long, first long, text string")
    ends = folded.repartition("leader").sortWithinPartitions("leader", "first").mapInArrow(hash_ids, "leader long, ends string")
    return kinds.join(ends, "leader")


class SearchTree:
    """Ternary search tree: each node has a turn's number, smaller and larger siblings, and the turns that follow it."""

    def __init__(self) -> None:
        self.turn: list[int] = []
        self.less: list[int] = []
        self.more: list[int] = []
        self.next: list[int] = []
        self.words: list[int] = []
        self.end: list[int] = []  # the sequence that ends here, or -1
        self.first = -1           # the top of the first turns

    def add(self, turn: int, words: int) -> int:
        for values, value in ((self.turn, turn), (self.less, -1), (self.more, -1), (self.next, -1), (self.words, words), (self.end, -1)):
            values.append(value)
        return len(self.turn) - 1

    def insert(self, ids: list[int], words: list[int], number: int) -> None:
        """Add sequence ``number``, of one turn or more."""
        above, node = -1, self.first
        for turn, many in zip(ids, words, strict=True):
            side, parent = None, -1
            while node >= 0 and self.turn[node] != turn:
                side, parent = (self.less if turn < self.turn[node] else self.more), node
                node = side[node]
            if node < 0:
                node = self.add(turn, many)
                if parent >= 0:
                    side[parent] = node
                elif above >= 0:
                    self.next[above] = node
                else:
                    self.first = node
            above, node = node, self.next[node]
        self.end[above] = number

    def children_first(self) -> list[tuple[int, int]]:
        """(node, the node that it follows or -1) of all nodes, each after all that follow it."""
        order, stack = [], [(self.first, -1)] if self.first >= 0 else []
        while stack:
            node, parent = stack.pop()
            order.append((node, parent))
            stack += [(s, parent) for s in (self.less[node], self.more[node]) if s >= 0]
            if self.next[node] >= 0:
                stack.append((self.next[node], node))
        return order[::-1]


def medians(count: int) -> Iterator[int]:
    """0 to count - 1, the middle one first, then the middles of both halves."""
    stack = [(0, count)]
    while stack:
        low, high = stack.pop()
        if low < high:
            middle = (low + high) // 2
            yield middle
            stack += [(low, middle), (middle + 1, high)]


def node_key(above: str, turn: int) -> str:
    return hashlib.blake2b(f"{above},{turn}".encode(), digest_size=16).hexdigest()


def shard_nodes(sequences: list[tuple[list[int], list[int], int, int, str]]) -> Iterator[dict]:
    """The nodes of sorted distinct sequences (ids, words, leader, n, ends), as rows of NODES."""
    tree = SearchTree()
    for number in medians(len(sequences)):
        if sequences[number][0]:
            tree.insert(*sequences[number][:2], number)
    # Keys of the prefixes of the first and the last sequence, the root's first; -1 stands for the root.
    keys = {-1: ""}
    for ids in (sequences[0][0], sequences[-1][0]):
        above, node = -1, tree.first
        for turn in ids:
            while tree.turn[node] != turn:
                node = tree.less[node] if turn < tree.turn[node] else tree.more[node]
            keys[node] = node_key(keys[above], turn)
            above, node = node, tree.next[node]
    size = len(tree.turn) + 1  # the last slot is the root's, as index -1
    depth, convs, least = [0] * size, [0] * size, [None] * size
    children, leaves, saved, ends = [0] * size, [0] * size, [0] * size, [None] * size
    root_ends = sequences[0] if not sequences[0][0] else None
    if root_ends:
        convs[-1], least[-1], ends[-1] = root_ends[3], root_ends[2], root_ends[4]
    order = tree.children_first()
    for node, parent in reversed(order):
        depth[node] = depth[parent] + 1
    for node, parent in order:
        if tree.end[node] >= 0:
            _, _, leader, n, digest = sequences[tree.end[node]]
            convs[node] += n
            least[node] = leader if least[node] is None else min(least[node], leader)
            ends[node] = digest
        convs[parent] += convs[node]
        least[parent] = least[node] if least[parent] is None else min(least[parent], least[node])
        if node not in keys:
            # Boundary nodes keep what lies below them; they are completed when shards meet.
            leaves[node] = leaves[node] or 1
            saved[node] += (convs[node] - 1) * tree.words[node]
            children[parent] += 1
            leaves[parent] += leaves[node]
            saved[parent] += saved[node]
    for node, parent in [*order, (-1, None)]:
        inner = node not in keys
        yield {
            "node": None if inner else keys[node], "parent": keys.get(parent), "boundary": not inner,
            "parent_boundary": parent in keys, "conv_id": least[node], "depth": depth[node],
            "parent_conv_id": None if parent is None or parent in keys else least[parent], "n_convs": convs[node],
            "n_children": children[node], "n_leaves": leaves[node], "saved_tokens": saved[node],
            "words": tree.words[node] if node >= 0 else 0, "ends": ends[node]}


def grow(shard_turns: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (ids, words, leader, n, ends) to nodes, a tree at a time."""
    schema = arrow_schema(NODES)

    def rows(held: list) -> Iterator[pa.RecordBatch]:
        yield from pa.Table.from_pylist(list(shard_nodes(held)), schema).to_batches(max_chunksize=10_000)

    held, turns = [], 0
    for batch in batches:
        for row in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            if held and turns + len(row[0]) > shard_turns:
                yield from rows(held)
                held, turns = [], 0
            held.append(row)
            turns += len(row[0])
    if held:
        yield from rows(held)


def complete(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The skeleton of boundary nodes, summed over shards, in order of depth: each with its whole subtree."""
    rows = [row for batch in batches for row in batch.to_pylist()]
    at = {row["node"]: row for row in rows}
    for row in reversed(rows):
        row["n_leaves"] = row["n_leaves"] if row["n_children"] else 1
        row["saved_tokens"] += (row["n_convs"] - 1) * row["words"]
        parent = at.get(row["parent"])
        row["parent_conv_id"] = parent["conv_id"] if parent else None
        if parent:
            parent["n_children"] += 1
            parent["n_leaves"] += row["n_leaves"]
            parent["saved_tokens"] += row["saved_tokens"]
    for n in range(0, len(rows), 10_000):
        yield pa.RecordBatch.from_pylist(rows[n:n + 10_000], arrow_schema(SKELETON))


def prefix_trie(conversations: DataFrame, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """The nodes of the trie of (conv_id, ids, words), as RESULT; ``ends`` is null where no conversation ends."""
    sequences = distinct_sequences(conversations).select("ids", "words", "leader", "n", "ends")
    nodes = materialize(sequences.repartitionByRange("ids").sortWithinPartitions("ids").mapInArrow(
        lambda batches: grow(shard_turns, batches), NODES), "trie-nodes")
    shares = nodes.where("boundary").groupBy("node", "parent", "depth", "words").agg(
        F.min("conv_id").alias("conv_id"), F.max("ends").alias("ends"),
        *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")])
    # One task: a node for each turn of the first and the last sequence of a shard.
    skeleton = materialize(shares.withColumn("parent_conv_id", F.lit(None).cast("long")).select(
        *[c.split()[0] for c in SKELETON.split(", ")]).coalesce(1).sortWithinPartitions("depth").mapInArrow(complete, SKELETON), "trie-skeleton")
    inner = nodes.where("NOT boundary")
    parents = skeleton.select(F.col("node").alias("parent"), F.col("conv_id").alias("above"))
    below = inner.where("parent_boundary").join(small_side(parents), "parent").withColumn("parent_conv_id", F.col("above"))
    return inner.where("NOT parent_boundary").select(*RESULT).unionByName(below.select(*RESULT)).unionByName(skeleton.select(*RESULT))


def op12_tries(spark, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    nodes = prefix_trie(rebuilt(own_sequences(numbered_turns(turns))))
    return nodes.select(*[F.col(c).cast("long").alias(c) for c in RESULT[:-1]], F.coalesce("ends", F.lit(NO_ENDS)).alias("ends_sha256"))


# crc32 of a decimal id, a bit at a time over its characters.
CRC32 = """list_reduce(
      list_prepend(4294967295, list_transform(string_split(conv_id::VARCHAR, ''), lambda c: ord(c)::BIGINT)),
      lambda crc, b: list_reduce(list_prepend(xor(crc, b), [0, 1, 2, 3, 4, 5, 6, 7]::BIGINT[]),
        lambda x, i: xor(x >> 1, 3988292384 * (x & 1))))"""

OP12_SQL = rf"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations WHERE conv_id IS NOT NULL),
own AS (
  SELECT conv_id, list({{'role': role, 'text': text}} ORDER BY turn NULLS FIRST, encode(role), encode(text)) AS t,
    xor({CRC32}, 4294967295) % 4 AS h
  FROM turns GROUP BY conv_id),
built AS (
  SELECT o.conv_id, list_concat(coalesce(b.t[1:o.h], []), o.t[o.h + 1:]) AS t
  FROM own o LEFT JOIN own b ON b.conv_id = o.conv_id - o.conv_id % 20),
prefixes AS (
  SELECT conv_id, len(t) AS size, unnest(range(len(t) + 1)) AS depth, t FROM built),
nodes AS (
  SELECT t[1:depth] AS p, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
    coalesce(string_agg(CASE WHEN size = depth THEN conv_id::VARCHAR END, ',' ORDER BY conv_id), '') AS ends
  FROM prefixes GROUP BY 1, 2),
measured AS (
  SELECT *, CASE WHEN depth = 0 THEN 0
    ELSE len(list_filter(regexp_split_to_array(p[depth].text, '[\x20\x09-\x0D]+'), lambda w: w <> '')) END AS words
  FROM nodes),
parents AS (SELECT p AS parent, count(*) AS n_children FROM (SELECT p[1:depth - 1] AS p FROM nodes WHERE depth > 0) GROUP BY 1),
linked AS (
  SELECT m.*, coalesce(c.n_children, 0) AS n_children, u.conv_id AS parent_conv_id
  FROM measured m LEFT JOIN parents c ON c.parent = m.p
  LEFT JOIN nodes u ON m.depth > 0 AND u.depth = m.depth - 1 AND u.p = m.p[1:m.depth - 1]),
sums AS (
  SELECT p[1:d] AS p, sum((n_children = 0)::INT)::BIGINT AS n_leaves, sum((n_convs - 1) * words)::BIGINT AS saved_tokens
  FROM (SELECT *, unnest(range(depth + 1)) AS d FROM linked) GROUP BY 1)
SELECT l.conv_id, l.depth::BIGINT AS depth, l.parent_conv_id, l.n_convs, l.n_children, s.n_leaves, s.saved_tokens,
  sha256(l.ends) AS ends_sha256
FROM linked l JOIN sums s ON s.p = l.p
"""
