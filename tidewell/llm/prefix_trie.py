"""The trie of shared beginnings of conversations, by sorted arrays of turns and their longest common prefixes.

A conversation is the array of its turns' digests (MD5 of role and text), joined to one binary value, whose order is
that of the arrays. All arrays are sorted over the whole cluster by ranges; equal ones are split by their id, so
a hot conversation has as many partitions as it needs. In each partition, the common prefix with the array before says
which open nodes end: a stack sweep turns the intervals of common prefixes into nodes. Nodes that are beginnings of a
partition's first or last array may go on in the partitions beside it; they are left open. The two open stacks of
each partition, with what has been summed in them, are swept once more in order (two rows a partition, one
stack in memory), which stitches them. Digests of members are streamed: a node that crosses partitions passes
on its ids in pieces of ``PIECE`` characters, in order; a digest that is complete is passed on with the stack.

Defined results for odd input: null roles and texts are empty; rows of one conversation and turn (null goes first) are ordered
by their digests, repeated rows stay; rows without a conversation's id belong to none and are not read; an empty table gives
an empty table, without a root; other columns are not read. A conversation is one row, 24 bytes a turn.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import settle

#: Bytes of a turn's digest; characters of a piece of ids; turns that a partition should hold at most, rows of a batch.
DIGEST, PIECE, PER_PARTITION, BATCH = 16, 4096, 250_000, 20_000
NONE = (1 << 63) - 1
SUMS = ("n_convs", "first", "n_children", "n_leaves", "saved")


def conversation_turns(conversations: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """id and turns (key: digest in hexadecimal; n: code points of the text), in order."""
    role, text = (F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in (role_col, text_col))
    key = F.md5(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text))
    rows = conversations.filter(F.col(f"`{id_col}`").isNotNull()).select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{turn_col}`").alias("turn"), key.alias("key"), F.char_length(text).cast("long").alias("n"))
    sorted_ = F.array_sort(F.collect_list(F.struct(F.col("turn").isNotNull().alias("known"), "turn", "key", "n")))
    return rows.groupBy("id").agg(F.transform(sorted_, lambda t: F.struct(t["key"].alias("key"), t["n"].alias("n"))).alias("turns"))


def common(x: bytes, y: bytes) -> int:
    """How many turns two arrays share at their beginning."""
    if x == y:
        return len(x) // DIGEST
    low, high = 0, min(len(x), len(y)) // DIGEST
    while low < high:
        mid = (low + high + 1) // 2
        if x[: mid * DIGEST] == y[: mid * DIGEST]:
            low = mid
        else:
            high = mid - 1
    return low


class Run:
    """The ids of equal arrays, in pieces."""

    def __init__(self):
        self.pieces, self.open, self.chars = [], [], 0

    def add(self, id_: int) -> None:
        self.open.append(str(id_))
        self.chars += len(self.open[-1]) + 1
        if self.chars > PIECE:
            self.cut()

    def cut(self) -> None:
        if self.open:
            self.pieces.append(",".join(self.open))
            self.open, self.chars = [], 0

    def digest(self) -> str:
        self.cut()
        found = hashlib.sha256()
        for k, p in enumerate(self.pieces):
            found.update((b"," if k else b"") + p.encode())
        return found.hexdigest()


EMPTY = Run().digest()


class Sweep:
    """Nodes of one partition's sorted arrays."""

    def __init__(self):
        self.sums = {k: array("q") for k in SUMS}
        self.depth, self.size, self.parent = array("q"), array("q"), array("q")
        self.ends: dict[int, str] = {}
        self.stack: list[int] = []
        self.before: bytes | None = None
        self.led = 0  # nodes of the first array
        self.first_seq, self.first_run, self.run = b"", None, Run()

    def open(self, size: int) -> None:
        self.depth.append(len(self.stack))
        self.parent.append(self.stack[-1] if self.stack else -1)
        self.size.append(size)
        for k, x in self.sums.items():
            x.append(NONE if k == "first" else 0)
        self.stack.append(len(self.depth) - 1)

    def close(self) -> None:
        """Ends the top node; what doesn't belong to the first array is complete and goes to its parent."""
        at, s = self.stack.pop(), self.sums
        if at < self.led:
            return
        up = self.parent[at]
        s["n_leaves"][at] = s["n_leaves"][at] or 1
        s["saved"][at] += (s["n_convs"][at] - 1) * self.size[at]
        s["n_children"][up] += 1
        s["first"][up] = min(s["first"][up], s["first"][at])
        for k in ("n_convs", "n_leaves", "saved"):
            s[k][up] += s[k][at]

    def add(self, seq: bytes, id_: int, sizes: list[int]) -> None:
        if self.before is None:
            self.open(0)
            for n in sizes:
                self.open(n)
            self.led, self.first_seq = len(self.stack), seq
        elif seq != self.before:
            self.end_run()
            shared = common(self.before, seq)
            while len(self.stack) > shared + 1:
                self.close()
            for n in sizes[shared:]:
                self.open(n)
        self.before, top = seq, self.stack[-1]
        self.run.add(id_)
        self.sums["n_convs"][top] += 1
        self.sums["first"][top] = min(self.sums["first"][top], id_)

    def end_run(self) -> None:
        if self.first_run is None:
            self.first_run = self.run
        else:
            self.ends[self.stack[-1]] = self.run.digest()
        self.run = Run()

    def stacks(self) -> list[tuple[bytes, list[int], Run]]:
        """The open stacks with their array and its members: the first array's, and the last one's where it's another."""
        first = (self.first_seq, list(range(self.led)), self.first_run or self.run)
        return [first] if self.before == self.first_seq else [first, (self.before, list(self.stack), self.run)]


NODE = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
PASS = f"kind int, pid long, side int, {NODE}, seq binary, k long, piece string, size array<long>, ends array<string>, " + ", ".join(f"{x} array<long>" for x in ("s_n_convs", "s_first", "s_n_children", "s_n_leaves", "s_saved"))


def schema_of(ddl: str) -> pa.Schema:
    kinds = {"int": pa.int32(), "long": pa.int64(), "string": pa.string(), "binary": pa.binary(), "array<long>": pa.list_(pa.int64()), "array<string>": pa.list_(pa.string())}
    return pa.schema([(name, kinds[kind]) for name, kind in (x.split(" ") for x in ddl.split(", "))])


def swept(sequences: DataFrame) -> DataFrame:
    """Closed nodes (kind 0), open stacks (1) and pieces of the ids of the stacks' arrays (2)."""
    kept = settle(sequences.select("id", F.unhex(F.array_join("turns.key", "")).alias("seq"), F.col("turns.n").alias("sizes")), "trie-arrays")
    turns = kept.agg(F.sum(F.size("sizes") + 1)).first()[0] or 0
    n = max(int(kept.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-turns // PER_PARTITION))
    schema = schema_of(PASS)

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        pid, found = TaskContext.get().partitionId(), Sweep()
        for batch in batches:
            for row in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                found.add(*row)
        if found.before is None:
            return
        rows, s = [], found.sums
        open_ = [found.led, set(found.stack)]
        side = lambda at: 0 if at < open_[0] else 1 if at in open_[1] else None
        for at in range(found.led, len(found.depth)):
            if at in open_[1]:
                continue
            up = found.parent[at]
            names = {"parent_conv_id": s["first"][up]} if side(up) is None else {"side": side(up)}
            names |= {"conv_id": s["first"][at], "saved_tokens": s["saved"][at]} | {k: s[k][at] for k in ("n_convs", "n_children", "n_leaves")}
            rows.append({"kind": 0, "pid": pid, "depth": found.depth[at], "ends_sha256": found.ends.get(at, EMPTY)} | names)
            if len(rows) >= BATCH:
                yield pa.RecordBatch.from_pylist(rows, schema=schema)
                rows = []
        for k, (seq, nodes, run) in enumerate(found.stacks()):
            # what the last array shares with the first is in the first one's stack already
            mine = [at for at in nodes if k == 0 or at >= found.led]
            blank = len(nodes) - len(mine)
            sums = {f"s_{x}": [NONE if x == "first" else 0] * blank + [s[x][at] for at in mine] for x in SUMS}
            rows.append({"kind": 1, "pid": pid, "side": k, "seq": seq, "size": [found.size[at] for at in nodes], "ends": [found.ends.get(at) if at >= found.led else None for at in nodes]} | sums)
            run.cut()
            rows += [{"kind": 2, "pid": pid, "side": k, "k": i, "piece": p} for i, p in enumerate(run.pieces)]
        for k in range(0, len(rows), BATCH):
            yield pa.RecordBatch.from_pylist(rows[k : k + BATCH], schema=schema)

    ordered = kept.repartitionByRange(n, "seq", "id").sortWithinPartitions("seq", "id")
    return settle(ordered.select("seq", "id", "sizes").mapInArrow(of, PASS), "trie-swept")


STITCH = "pid long, side int, depth long, node long, parent long, conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string, last boolean"


def stitched(found: DataFrame) -> DataFrame:
    """Complete nodes of the open stacks (pid is null), and which node each stack has at each depth (conv_id is null)."""
    names = [x.split(" ")[0] for x in STITCH.split(", ")]

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([(x, {"side": pa.int32(), "last": pa.bool_(), "ends_sha256": pa.string()}.get(x, pa.int64())) for x in names])
        stack, rows, before, number = [], [], None, 0

        def close() -> None:
            node = stack.pop()
            node["n_leaves"] = node["n_leaves"] or 1
            if stack:
                up = stack[-1]
                node["saved"] += (node["n_convs"] - 1) * node["size"]
                up["n_children"] += 1
                up["first"] = min(up["first"], node["first"])
                for k in ("n_convs", "n_leaves", "saved"):
                    up[k] += node[k]
            rows.append({"node": node["node"], "parent": stack[-1]["node"] if stack else None, "depth": len(stack), "conv_id": node["first"], "saved_tokens": node["saved"], "ends_sha256": node["ends"]} | {k: node[k] for k in ("n_convs", "n_children", "n_leaves")})

        for batch in batches:
            for row in batch.to_pylist():
                shared = -1 if before is None else common(before, row["seq"])
                while len(stack) > shared + 1:
                    close()
                for n in row["size"][shared + 1 :]:
                    stack.append({k: 0 for k in SUMS} | {"first": NONE, "size": n, "node": number, "ends": None})
                    number += 1
                for d, node in enumerate(stack):
                    node["first"] = min(node["first"], row["s_first"][d])
                    node["ends"] = node["ends"] or row["ends"][d]
                    for k in SUMS:
                        if k != "first":
                            node[k] += row[f"s_{k}"][d]
                    rows.append({"pid": row["pid"], "side": row["side"], "depth": d, "node": node["node"], "last": d == len(stack) - 1})
                before = row["seq"]
                if len(rows) >= BATCH:
                    yield pa.RecordBatch.from_pylist(rows, schema=schema)
                    rows.clear()
        while stack:
            close()
        yield pa.RecordBatch.from_pylist(rows, schema=schema)

    stacks = found.filter("kind = 1").select("pid", "side", "seq", "size", "ends", *[f"s_{k}" for k in SUMS])
    return settle(stacks.repartition(1).sortWithinPartitions("pid", "side").mapInArrow(of, STITCH), "trie-stitched")


def digests(pieces: DataFrame) -> DataFrame:
    """node and ends_sha256, from rows node, pid, side, k, piece."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state = None, None
        for batch in batches:
            done: list[tuple[int, str]] = []
            for n, piece in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if n != node:
                    if node is not None:
                        done.append((node, state.hexdigest()))
                    node, state = n, hashlib.sha256(piece.encode())
                else:
                    state.update(b"," + piece.encode())
            yield pa.RecordBatch.from_pydict({"node": pa.array([x for x, _ in done], pa.int64()), "ends_sha256": pa.array([x for _, x in done], pa.string())})
        if node is not None:
            yield pa.RecordBatch.from_pydict({"node": pa.array([node], pa.int64()), "ends_sha256": pa.array([state.hexdigest()], pa.string())})

    dealt = pieces.repartition("node").sortWithinPartitions("node", "pid", "side", "k")
    return dealt.select("node", "piece").mapInArrow(of, "node long, ends_sha256 string")


def prefix_trie(sequences: DataFrame) -> DataFrame:
    """A row for each distinct beginning of the rows id, turns (see conversation_turns; a row for each id).

    conv_id: the least member's; depth; parent_conv_id; n_convs: members; n_children; n_leaves: of its subtree; saved_tokens:
    code points that its subtree's sharing saves; ends_sha256: of the ids that end in it.
    """
    found = swept(sequences)
    both = stitched(found)
    nodes = both.filter("conv_id IS NOT NULL").drop("pid", "side", "last")
    at = both.filter("conv_id IS NULL").select("pid", "side", "depth", "node", "last")
    of_stack = at.join(nodes.select("node", F.col("conv_id").alias("of")), "node")
    pieces = found.filter("kind = 2").select("pid", "side", "k", "piece").join(at.filter("last").select("pid", "side", "node"), ["pid", "side"])
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    closed = found.filter("kind = 0").select("pid", "side", (F.col("depth") - 1).alias("up"), *columns)
    inner = closed.filter("side IS NULL").select(columns)
    above = of_stack.select("pid", "side", F.col("depth").alias("up"), "of")
    outer = closed.filter("side IS NOT NULL").join(above, ["pid", "side", "up"]).withColumn("parent_conv_id", F.col("of")).select(columns)
    open_ = nodes.join(nodes.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id")), "parent", "left").join(digests(pieces).withColumnRenamed("ends_sha256", "of_pieces"), "node", "left")
    open_ = open_.withColumn("ends_sha256", F.coalesce("of_pieces", "ends_sha256", F.lit(EMPTY))).select(columns)
    return inner.unionByName(outer).unionByName(open_)
