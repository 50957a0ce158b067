"""The prefix trie of conversations, by ternary search trees over range shards.

Turns are encoded by a dictionary, conversations become sequences of its ids, and the sequences are
sorted into range shards.  Each shard enters its sequences into a ternary search tree, medians
first, so that it is balanced, and one iterative traversal adds up members, leaves and savings
of every node.  Only nodes on the path of a shard's first or last sequence can continue in
another shard.  What a shard says of these is corrected by what its neighbours begin and end with,
after which the parts of a node simply add up.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pricetrail.llm.common import stored

TURNS_PER_SHARD = 500_000  # what one task holds as a tree
IDS_PER_CHUNK = 1024
ROWS_AT_ONCE = 5_000

CLOSED, BOUNDARY, ENDS, EDGES = range(4)
PART = (
    "kind int, shard int, conv_id long, depth long, parent_conv_id long, parent_key string, key string, n_convs long, "
    "n_children long, n_leaves long, saved_tokens long, ends_sha256 string, first boolean, last boolean, "
    "chars long, path_chars long, chunk long, ids binary, "
    "first_seq array<long>, last_seq array<long>, first_chars array<long>"
)
NODE = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
NO_ENDS = hashlib.sha256(b"").hexdigest()


def _hashes() -> list[Column]:
    """128 bits of a turn, as two columns."""
    return [F.xxhash64("role", "text").alias("h1"), F.xxhash64(F.lit("second half"), "role", "text").alias("h2")]


def coded_turns(conversations: DataFrame) -> DataFrame:
    """conv_id, ``at`` (what its turns are sorted by), tid and ``chars`` of every turn.

    Ids are dense and stored; texts stay where they are read, only their hashes are shuffled.  Texts
    are part of ``at`` only for turns that share their number with others of the conversation.
    """
    blank = [F.coalesce(c, F.lit("")).alias(c) for c in ("role", "text")]
    turns = conversations.filter(F.col("conv_id").isNotNull()).select(F.col("conv_id").cast("long"), "turn", *blank)
    hashed = turns.select("*", *_hashes(), F.length("text").cast("long").alias("chars"))
    words = hashed.groupBy("h1", "h2").agg(F.max("chars").alias("chars"))
    words = stored(words.select("h1", "h2", F.monotonically_increasing_id().alias("tid"), "chars"), "dictionary")
    tied = turns.groupBy("conv_id", "turn").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)
    tied = stored(tied.select(F.col("conv_id").alias("tied_id"), F.col("turn").alias("tied_turn")), "tied")
    if tied.isEmpty():  # the result is the same either way; texts need not move
        hashed = hashed.withColumns({"tie_role": F.lit(""), "tie_text": F.lit("")})
    else:
        same = (F.col("conv_id") == F.col("tied_id")) & F.col("turn").eqNullSafe(F.col("tied_turn"))
        hashed = hashed.join(tied, same, "left").withColumns(
            {f"tie_{c}": F.when(F.col("tied_id").isNotNull(), F.col(c)).otherwise("") for c in ("role", "text")}
        )
    at = F.struct(F.col("turn").isNotNull().alias("known"), "turn", "tie_role", "tie_text")
    return hashed.drop("chars").join(words, ["h1", "h2"]).select("conv_id", at.alias("at"), "tid", "chars")


def sequences(coded: DataFrame) -> DataFrame:
    """conv_id, ``donor``, ``seq`` and ``chars`` of every conversation."""
    donor = F.col("conv_id") - F.col("conv_id") % 100
    # One shuffle serves the grouping and the join of the donors: a donor has at most 199 conversations.
    dealt = coded.withColumn("donor", donor).repartition("donor")
    whole = dealt.groupBy("donor", "conv_id").agg(F.sort_array(F.collect_list(F.struct("at", "tid", "chars"))).alias("own"))
    return whole.select("conv_id", "donor", F.col("own.tid").alias("seq"), F.col("own.chars").alias("chars"))


def rebuilt(own: DataFrame, most: int = 5) -> DataFrame:
    """conv_id, ``seq`` and ``chars`` of the conversations with the first turns of their donor."""
    heads = own.filter(F.col("conv_id") == F.col("donor")).select(
        "donor", *[F.slice(c, 1, most).alias(f"head_{c}") for c in ("seq", "chars")]
    )
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % (most + 1)).cast("int")
    none = F.array().cast("array<long>")
    joined = own.join(heads, "donor", "left").withColumn("h", h)

    def whole(name: str) -> Column:
        head = F.slice(F.coalesce(f"head_{name}", none), F.lit(1), F.col("h"))
        return F.concat(head, F.slice(name, F.col("h") + 1, F.size(name))).alias(name)

    return joined.select("conv_id", whole("seq"), whole("chars"))


class Tree:
    """A ternary search tree of sequences; node 0 is the trie's root, whose turns begin at ``eq[0]``."""

    def __init__(self):
        self.turn, self.chars, self.end = [-1], [0], [-1]
        self.lo, self.eq, self.hi = [-1], [-1], [-1]

    def _new(self, turn: int, chars: int) -> int:
        for column, value in ((self.turn, turn), (self.chars, chars), (self.end, -1)):
            column.append(value)
        for column in (self.lo, self.eq, self.hi):
            column.append(-1)
        return len(self.turn) - 1

    def insert(self, seq: list[int], chars: list[int], index: int) -> None:
        at = 0
        for turn, n in zip(seq, chars, strict=True):
            node, side, above = self.eq[at], self.eq, at
            while node >= 0 and self.turn[node] != turn:
                side, above = (self.lo if turn < self.turn[node] else self.hi), node
                node = side[node]
            if node < 0:
                node = side[above] = self._new(turn, n)
            at = node
        self.end[at] = index

    def path(self, seq: list[int]) -> list[int]:
        """The nodes of a sequence that is in the tree, root first."""
        nodes = [0]
        for turn in seq:
            node = self.eq[nodes[-1]]
            while self.turn[node] != turn:
                node = (self.lo if turn < self.turn[node] else self.hi)[node]
            nodes.append(node)
        return nodes

    def parents_first(self) -> Iterator[tuple[int, int]]:
        """Every node with its parent in the trie (root: -1), parents before children."""
        yield 0, -1
        stack = [(self.eq[0], 0)]
        while stack:
            node, parent = stack.pop()
            if node >= 0:
                yield node, parent
                stack += [(self.lo[node], parent), (self.hi[node], parent), (self.eq[node], node)]


def median_order(n: int) -> Iterator[int]:
    """0 to n - 1, the middle first, then the middles of both halves, and so on."""
    stack = [(0, n)]
    while stack:
        low, high = stack.pop()
        if low < high:
            middle = (low + high) // 2
            yield middle
            stack += [(middle + 1, high), (low, middle)]


class Shard:
    """The distinct sequences of one shard, which come sorted, and who ends with them."""

    def __init__(self, number: int):
        self.number = number
        self.seqs: list[list[int]] = []
        self.chars: list[list[int]] = []
        self.least: list[int] = []
        self.count: list[int] = []
        self.digest: list[str | None] = []  # of those that certainly end here only
        self.chunks: dict[int, list[bytes]] = {}  # of the first and the newest sequence
        self.waiting: list[int] = []

    def add(self, conv_id: int, seq: list[int], chars: list[int]) -> None:
        if not self.seqs or self.seqs[-1] != seq:
            self._close(last=False)
            self.seqs.append(seq)
            self.chars.append(chars)
            self.least.append(conv_id)
            self.count.append(0)
            self.digest.append(None)
            self.chunks[len(self.seqs) - 1] = []
        self.count[-1] += 1
        self.waiting.append(conv_id)
        if len(self.waiting) == IDS_PER_CHUNK:
            self._flush()

    def _flush(self) -> None:
        if self.waiting:
            self.chunks[len(self.seqs) - 1].append(",".join(map(str, self.waiting)).encode())
            self.waiting = []

    def _close(self, last: bool) -> None:
        """Sequences between the first and the last have all their ends here."""
        if self.seqs:
            self._flush()
            i = len(self.seqs) - 1
            if 0 < i and not last:
                self.digest[i] = hashlib.sha256(b",".join(self.chunks.pop(i))).hexdigest()

    def rows(self) -> Iterator[dict]:
        if not self.seqs:
            return
        self._close(last=True)
        tree = Tree()
        for i in median_order(len(self.seqs)):
            tree.insert(self.seqs[i], self.chars[i], i)
        order = list(tree.parents_first())
        n = len(tree.turn)
        parent, depth = [-1] * n, [0] * n
        members, least, children, leaves, saved = [0] * n, [None] * n, [0] * n, [0] * n, [0] * n
        for node, above in order:
            parent[node] = above
            depth[node] = depth[above] + 1 if above >= 0 else 0
            if tree.end[node] >= 0:
                members[node], least[node] = self.count[tree.end[node]], self.least[tree.end[node]]
        for node, above in reversed(order):
            leaves[node] += children[node] == 0
            saved[node] += (members[node] - 1) * tree.chars[node]
            if above >= 0:
                members[above] += members[node]
                least[above] = least[node] if least[above] is None else min(least[above], least[node])
                children[above] += 1
                leaves[above] += leaves[node]
                saved[above] += saved[node]

        first, last = tree.path(self.seqs[0]), tree.path(self.seqs[-1])
        keys: dict[int, str] = {}
        path_chars: dict[int, int] = {}
        for path in (first, last):
            digest, total = hashlib.blake2b(digest_size=16), 0
            for node in path:
                if node:
                    digest.update(tree.turn[node].to_bytes(8, "little", signed=True))
                    total += tree.chars[node]
                keys[node], path_chars[node] = digest.copy().hexdigest(), total
        on_first, on_last = set(first), set(last)
        for node, above in order:
            end = tree.end[node]
            row = {
                "kind": CLOSED, "shard": self.number, "conv_id": least[node], "depth": depth[node],
                "n_convs": members[node], "n_children": children[node], "n_leaves": leaves[node],
                "saved_tokens": saved[node], "ends_sha256": self.digest[end] if end >= 0 else None,
                "parent_key": keys.get(above),
            }
            if node in keys:
                row |= {
                    "kind": BOUNDARY, "key": keys[node], "first": node in on_first, "last": node in on_last,
                    "chars": tree.chars[node], "path_chars": path_chars[node],
                }
                for i, chunk in enumerate(self.chunks.get(end, [])):
                    yield {"kind": ENDS, "shard": self.number, "key": keys[node], "chunk": i, "ids": chunk}
            else:
                row["ends_sha256"] = row["ends_sha256"] or NO_ENDS
                if above not in keys:
                    row["parent_conv_id"] = least[above]
            yield row
        yield {
            "kind": EDGES, "shard": self.number, "first_seq": self.seqs[0], "last_seq": self.seqs[-1],
            "first_chars": self.chars[0],
        }


def _arrow_schema() -> pa.Schema:
    kinds = {"int": pa.int32(), "long": pa.int64(), "string": pa.string(), "boolean": pa.bool_(), "binary": pa.binary(),
             "array<long>": pa.list_(pa.int64())}
    return pa.schema([(name, kinds[kind]) for name, kind in (field.split() for field in PART.split(", "))])


def shard_parts(sorted_rows: DataFrame) -> DataFrame:
    """The rows that every shard (a sorted range partition) has to say of its nodes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = Shard(TaskContext.get().partitionId())
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "seq", "chars")), strict=True):
                shard.add(*row)
        schema, waiting = _arrow_schema(), []
        for row in shard.rows():
            waiting.append(row)
            if len(waiting) == ROWS_AT_ONCE:
                yield pa.RecordBatch.from_pylist(waiting, schema)
                waiting = []
        yield pa.RecordBatch.from_pylist(waiting, schema)

    return sorted_rows.mapInArrow(run, PART)


def _shared(x: Column, y: Column) -> Column:
    """How many first elements two arrays share; -1 where one of them is null."""
    differ = F.array_position(F.zip_with(x, y, lambda a, b: a.eqNullSafe(b)), False)
    return F.coalesce(F.when(differ > 0, differ - 1).when(differ == 0, F.size(x)), F.lit(-1))


def merged_boundary(parts: DataFrame) -> DataFrame:
    """The boundary nodes, one row per key, from what the shards say of them."""
    in_order = Window.orderBy("shard")  # one row per shard
    edges = parts.filter(F.col("kind") == EDGES).select(
        "shard",
        _shared(F.col("first_seq"), F.lag("last_seq").over(in_order)).alias("before"),
        _shared(F.col("last_seq"), F.lead("first_seq").over(in_order)).alias("after"),
        F.size("last_seq").alias("last_depth"),
        "first_chars",
    )
    total = F.aggregate(F.slice("first_chars", F.lit(1), F.greatest("before", F.lit(0))), F.lit(0).cast("long"), lambda a, x: a + x)
    edges = edges.select("shard", "before", (F.col("after") >= F.col("last_depth")).alias("goes_on"), total.alias("before_chars"))
    said = parts.filter(F.col("kind") == BOUNDARY).join(edges, "shard")
    # Of a node that began in an earlier shard, the copy that is no saving is counted there, and so is the child.
    again = F.col("first") & (F.col("depth") <= F.col("before"))
    child_again = F.col("first") & (F.col("depth") < F.col("before"))
    saved = F.col("saved_tokens") + F.when(again, F.col("before_chars") - F.col("path_chars") + F.col("chars")).otherwise(0)
    # The last sequence is a leaf here, but the next shard has it again or goes on from it.
    leaves = F.col("n_leaves") - (F.col("last") & F.col("goes_on")).cast("long")
    nodes = said.groupBy("key").agg(
        F.max("depth").alias("depth"),
        F.max("parent_key").alias("parent_key"),
        F.min("conv_id").alias("conv_id"),
        F.sum("n_convs").alias("n_convs"),
        F.sum(F.col("n_children") - child_again.cast("long")).alias("n_children"),
        F.sum(leaves).alias("n_leaves"),
        F.sum(saved).alias("saved_tokens"),
        F.max("ends_sha256").alias("known_sha256"),
    )
    return nodes.join(_chunk_digests(parts), "key", "left").select(
        "*", F.coalesce("known_sha256", "chunks_sha256", F.lit(NO_ENDS)).alias("ends_sha256")
    ).drop("known_sha256", "chunks_sha256")


def _chunk_digests(parts: DataFrame) -> DataFrame:
    """key and the digest of its ends, which may lie in many shards, a thousand ids in a row.

    A digest reads its bytes in order, so the chunks of one node are streamed through one task, which holds one batch.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, digest, done = None, None, []
        for batch in batches:
            for k, ids in zip(batch.column("key").to_pylist(), batch.column("ids").to_pylist(), strict=True):
                if k != key:
                    if key is not None:
                        done.append((key, digest.hexdigest()))
                    key, digest = k, hashlib.sha256(ids)
                else:
                    digest.update(b",")
                    digest.update(ids)
        if key is not None:
            done.append((key, digest.hexdigest()))
        yield pa.RecordBatch.from_pydict(
            {"key": pa.array([k for k, _ in done], pa.string()), "chunks_sha256": pa.array([d for _, d in done], pa.string())}
        )

    chunks = parts.filter(F.col("kind") == ENDS).select("key", "shard", "chunk", "ids")
    chunks = chunks.repartition("key").sortWithinPartitions("key", "shard", "chunk")
    return chunks.select("key", "ids").mapInArrow(run, "key string, chunks_sha256 string")


def prefix_trie(sequenced: DataFrame, shards: int | None = None) -> DataFrame:
    """One row per distinct prefix of the sequences (conv_id, ``seq`` of turn ids, ``chars`` of each turn).

    Columns: conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256.  Ids are distinct and not null.  Without ``shards`` their number grows with the turns.
    """
    if shards is None:
        spark = sequenced.sparkSession
        turns = sequenced.agg(F.sum(F.size("seq") + F.lit(1)).alias("n")).first()["n"] or 0
        shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-turns // TURNS_PER_SHARD))
    dealt = sequenced.repartitionByRange(shards, "seq", "conv_id").sortWithinPartitions("seq", "conv_id")
    parts = stored(shard_parts(dealt.select("conv_id", "seq", "chars")), "parts")
    boundary = stored(merged_boundary(parts), "boundary")
    named = boundary.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("parent"))
    closed = parts.filter(F.col("kind") == CLOSED)
    inner = closed.filter(F.col("parent_key").isNull()).select(*NODE)
    below = closed.filter(F.col("parent_key").isNotNull()).drop("parent_conv_id").join(named, "parent_key")
    around = boundary.join(named, "parent_key", "left")
    return inner.unionByName(below.withColumnRenamed("parent", "parent_conv_id").select(*NODE)).unionByName(
        around.withColumnRenamed("parent", "parent_conv_id").select(*NODE)
    )


def conversation_trie(conversations: DataFrame, most: int = 5) -> DataFrame:
    """One row per prefix of the rebuilt conversations (conv_id, turn, role, text); see ``prefix_trie``.

    A conversation c takes its first h turns, h = crc32(c) modulo ``most`` + 1, from conversation c - c % 100
    (as in SQL, the remainder has the sign of c), where that has them; the others are its own from the (h + 1)th on, so it may have none.
    Turns go by their number, null first; of equal numbers by role and text, so repeated rows
    stand side by side and count.  Null role and text are empty.  Rows without conv_id belong to no
    conversation and are left out.  Texts of any length count by their code points; further
    columns are ignored.  An empty table gives no rows, not even a root.  What a task holds is a
    conversation (turn ids, no texts) and one shard of them.
    """
    own = stored(sequences(coded_turns(conversations)), "sequences")
    return prefix_trie(stored(rebuilt(own, most), "rebuilt"))
