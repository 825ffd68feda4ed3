"""The prefix trie of conversations, from adaptive radix trees over fixed-width turn ids.

A turn is known by 16 bytes, so a conversation is a byte string, its path, and equal
beginnings are equal prefixes. Paths are dealt by ranges and sorted; each task takes them
in blocks of bounded size and builds one adaptive radix tree per block: inner nodes grow
from 4 to 16, 48 and 256 children and hold the bytes that all their paths share. Only byte
depths at the end of a turn are nodes of the result.

What a block knows is final for all nodes but those on its first and its last path, which
neighbours may share. These two paths go on, with sums over what is below them, as rows of
the next level, which is built the same way; a level has at most a quarter of the rows of
the one before, and the last one is a single block.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vectorferry.llm.mixing import word_count
from vectorferry.llm.store import materialize

WIDTH = 16  # bytes of a turn id
BLOCK_TURNS = 1 << 17  # turns of a block's paths
LEAST_PATHS = 8  # but at least so many paths, so that each level shrinks
TASK_PATHS = 512  # least paths of a task beyond the first level
MAX_BROADCAST_ROWS = 200_000

EMPTY = hashlib.sha256(b"").hexdigest()
SUMS = ["counts", "children", "leaves", "saved"]
PATH = ("path binary, counts array<bigint>, firsts array<bigint>, children array<bigint>, leaves array<bigint>, "
        "saved array<bigint>, words array<bigint>, ends array<string>")
NODE = ("conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, "
        "saved_tokens bigint, ends_sha256 string, node string, parent string")


# -- adaptive radix tree ----------------------------------------------------------


class Inner:
    """An inner node: shared bytes, children by next byte, and the path that ends here.

    Up to 4 and 16 children the bytes stand in a short sorted list, up to 48 a table of 256
    places points into a list of children, beyond that it holds them itself.
    """

    __slots__ = ("shared", "size", "bytes", "below", "ending")

    def __init__(self, shared: bytes):
        self.shared = shared
        self.size = 4
        self.bytes: bytearray = bytearray()
        self.below: list = []
        self.ending: int | None = None

    def get(self, byte: int):
        if self.size <= 16:
            at = self.bytes.find(byte)
            return None if at < 0 else self.below[at]
        if self.size == 48:
            at = self.bytes[byte]
            return self.below[at - 1] if at else None
        return self.below[byte]

    def put(self, byte: int, child) -> None:
        if self.size <= 16:
            at = self.bytes.find(byte)
            if at >= 0:
                self.below[at] = child
                return
            if len(self.below) < self.size:
                at = sum(b < byte for b in self.bytes)
                self.bytes.insert(at, byte)
                self.below.insert(at, child)
                return
            self._grow()
            self.put(byte, child)
        elif self.size == 48:
            at = self.bytes[byte]
            if at:
                self.below[at - 1] = child
            elif len(self.below) < 48:
                self.below.append(child)
                self.bytes[byte] = len(self.below)
            else:
                self._grow()
                self.put(byte, child)
        else:
            self.below[byte] = child

    def _grow(self) -> None:
        if self.size == 4:
            self.size = 16
        elif self.size == 16:
            table = bytearray(256)
            for place, byte in enumerate(self.bytes):
                table[byte] = place + 1
            self.size, self.bytes = 48, table
        else:
            children: list = [None] * 256
            for byte in range(256):
                if self.bytes[byte]:
                    children[byte] = self.below[self.bytes[byte] - 1]
            self.size, self.bytes, self.below = 256, bytearray(), children

    def children(self) -> list:
        """Children in the order of their bytes."""
        if self.size <= 16:
            return self.below
        if self.size == 48:
            return [self.below[at - 1] for at in self.bytes if at]
        return [c for c in self.below if c is not None]


def _common(a: bytes, b: bytes, start: int) -> int:
    """How many bytes of ``a`` equal those of ``b`` from ``start`` on."""
    n = min(len(a), len(b) - start)
    if a[:n] == b[start: start + n]:
        return n
    low, high = 0, n
    while low < high:  # the longest equal part by halves
        middle = (low + high + 1) // 2
        if a[:middle] == b[start: start + middle]:
            low = middle
        else:
            high = middle - 1
    return low


class RadixTree:
    """Paths by their place in a list; a place stands for a leaf."""

    def __init__(self, paths: list[bytes]):
        self.paths = paths
        self.root = Inner(b"")
        for place in range(len(paths)):
            self._insert(place)

    def _insert(self, place: int) -> None:
        path, node, depth = self.paths[place], self.root, 0
        above, byte = None, 0
        while True:
            same = _common(node.shared, path, depth)
            if same < len(node.shared):
                fork = Inner(node.shared[:same])
                fork.put(node.shared[same], node)
                node.shared = node.shared[same + 1:]
                above.put(byte, fork)
                node = fork
            depth += same
            if depth == len(path):
                node.ending = place
                return
            above, byte = node, path[depth]
            child = node.get(byte)
            if child is None:
                node.put(byte, place)
                return
            depth += 1
            if not isinstance(child, Inner):  # a leaf makes way for a node that both paths share
                other = self.paths[child]
                same = _common(other[depth:], path, depth)
                fork = Inner(path[depth: depth + same])
                if depth + same == len(other):
                    fork.ending = child
                else:
                    fork.put(other[depth + same], child)
                node.put(byte, fork)
                child = fork
            node = child

    def nodes(self) -> tuple[list[int], list[int], list[int], list[int]]:
        """Turn-aligned nodes, each before those below it: depth, parent, first path, number of paths."""
        depths, parents, first, paths = [], [], [], []
        stack: list[tuple] = [(self.root, 0, -1, -1)]
        seen = 0
        while stack:
            item, start, reached, parent = stack.pop()
            inner = isinstance(item, Inner)
            end = start + len(item.shared) if inner else len(self.paths[item])
            for depth in range(reached // WIDTH + 1 if reached >= 0 else 0, end // WIDTH + 1):
                depths.append(depth)
                parents.append(parent)
                first.append(seen)
                paths.append(0)
                parent = len(depths) - 1
            if not inner:
                seen += 1
                paths[parent] += 1
                continue
            if item.ending is not None:
                seen += 1
                paths[parent] += 1
            for child in reversed(item.children()):
                stack.append((child, end + 1, end, parent))
        for node in range(len(depths) - 1, 0, -1):
            paths[parents[node]] += paths[node]
        return depths, parents, first, paths


# -- blocks -----------------------------------------------------------------------


def _names(path: bytes, depth: int) -> list[str]:
    """A name for each node along a path."""
    digest, names = hashlib.md5(), []
    for turn in range(depth + 1):
        names.append(digest.hexdigest())
        digest.update(path[turn * WIDTH: (turn + 1) * WIDTH])
    return names


def _block(rows: list[dict], last: bool, named: bool) -> tuple[list[tuple], list[dict]]:
    """Final nodes of sorted paths, and the first and last path for the next level.

    ``last``: no other block is left, so all nodes are final. ``named``: the paths come from
    an earlier level, where children of theirs may have been left without a parent.
    """
    depth, parent, first, paths = RadixTree([r["path"] for r in rows]).nodes()
    n = len(depth)
    sums = {name: [0] * n for name in SUMS}
    least, ends, words = [0] * n, [None] * n, [0] * n
    for node in range(n):
        d, own = depth[node], rows[first[node]: first[node] + paths[node]]
        for name in SUMS:
            sums[name][node] = sum(r[name][d] for r in own)
        least[node] = min(r["firsts"][d] for r in own)
        ends[node] = next((r["ends"][d] for r in own if r["ends"][d] is not None), None)
        words[node] = own[0]["words"][d - 1] if d else 0
    open_ = [not last and (first[i] == 0 or first[i] + paths[i] == len(rows)) for i in range(n)]
    for node in range(n - 1, -1, -1):
        if open_[node]:
            continue
        if not sums["children"][node]:
            sums["leaves"][node] = 1
        sums["saved"][node] += (sums["counts"][node] - 1) * words[node]
        if node:
            above = parent[node]
            sums["children"][above] += 1
            sums["leaves"][above] += sums["leaves"][node]
            sums["saved"][above] += sums["saved"][node]

    label: dict[int, str] = {}
    ancestors: dict[int, list[str]] = {}
    if named or not last:
        for node in range(n):
            if named or open_[node]:
                place = first[node] if first[node] == 0 or named else len(rows) - 1
                if place not in ancestors:
                    ancestors[place] = _names(rows[place]["path"], len(rows[place]["path"]) // WIDTH)
                label[node] = ancestors[place][depth[node]]
    found = [
        (least[i], depth[i], least[parent[i]] if i and not open_[parent[i]] else None, sums["counts"][i],
         sums["children"][i], sums["leaves"][i], sums["saved"][i], ends[i] or EMPTY, label.get(i) if named else None,
         label[parent[i]] if i and open_[parent[i]] else None)
        for i in range(n) if not open_[i]
    ]
    onward: list[dict] = []
    if not last:
        for place in sorted({0, len(rows) - 1}):
            along = [i for i in range(n) if open_[i] and first[i] <= place < first[i] + paths[i]]
            mine = [place == 0 or first[i] > 0 for i in along]
            row = {name: [sums[name][i] if m else 0 for i, m in zip(along, mine)] for name in SUMS}
            row |= {
                "path": rows[place]["path"], "firsts": [least[i] for i in along], "words": rows[place]["words"],
                "ends": [ends[i] if m else None for i, m in zip(along, mine)],
            }
            onward.append(row)
    return found, onward


def _level_task(last: bool, named: bool, block_turns: int):
    node_schema = pa.schema([(c.split()[0], pa.string() if c.endswith("string") else pa.int64()) for c in NODE.split(", ")])
    list_of = {"array<bigint>": pa.list_(pa.int64()), "array<string>": pa.list_(pa.string()), "binary": pa.binary()}
    path_schema = pa.schema([(c.split()[0], list_of[c.split()[1]]) for c in PATH.split(", ")])
    schema = pa.schema([*node_schema, *path_schema])

    def batch(found: list[tuple], onward: list[dict]) -> pa.RecordBatch:
        columns = [pa.array([*(r[i] for r in found), *[None] * len(onward)], f.type) for i, f in enumerate(node_schema)]
        columns += [pa.array([*[None] * len(found), *(r[f.name] for r in onward)], f.type) for f in path_schema]
        return pa.RecordBatch.from_arrays(columns, schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        turns = 0
        for incoming in batches:
            for start in range(0, incoming.num_rows, 256):
                for row in incoming.slice(start, 256).to_pylist():
                    size = len(row["path"]) // WIDTH + 1
                    if not last and len(held) >= LEAST_PATHS and turns + size > block_turns:
                        yield batch(*_block(held, last, named))
                        held, turns = [], 0
                    held.append(row)
                    turns += size
        if held:
            yield batch(*_block(held, last, named))

    return run


# -- conversations ----------------------------------------------------------------


def conversation_turns(rows: DataFrame) -> DataFrame:
    """``(conv_id, turns)``: the turns of each conversation as ``array<struct<turn, id, words>>``.

    Turns stand by their number, null first, equal ones by id. A null role or text is
    empty; rows without a conversation are left out. An id is the MD5 of role and text, so
    texts do not travel; a conversation's turns meet in one row of some 50 bytes a turn.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    turn = F.struct(
        F.col("turn"), F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text)).alias("id"),
        word_count(text).cast("bigint").alias("words"))
    return rows.filter("conv_id is not null").groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))


def _digest_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Number, smallest and SHA-256 of the ids of each path; rows come by path and id."""
    current, digest, n, least = None, None, 0, 0

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        kinds = (pa.string(), pa.int64(), pa.int64(), pa.string())
        return pa.RecordBatch.from_arrays(
            [pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=["name", "n", "least", "ends"])

    for incoming in batches:
        names, ids = incoming.column("name").to_pylist(), incoming.column("conv_id").to_pylist()
        done, at = [], 0
        while at < len(names):
            end = at
            while end < len(names) and names[end] == names[at]:
                end += 1
            if names[at] != current:
                if current is not None:
                    done.append((current, n, least, digest.hexdigest()))
                current, digest, n, least = names[at], hashlib.sha256(), 0, ids[at]
            digest.update((("," if n else "") + ",".join(map(str, ids[at:end]))).encode())
            n += end - at
            at = end
        if done:
            yield batch(done)
    if current is not None:
        yield batch([(current, n, least, digest.hexdigest())])


def prefix_trie(conversations: DataFrame, block_turns: int = BLOCK_TURNS) -> DataFrame:
    """One row per distinct beginning of ``(conv_id, turns)``, the empty one included.

    ``turns`` is an array of structs with ``id`` (32 hex digits) and ``words``; ``conv_id``
    must be given once. Returns ``conv_id`` (the smallest conversation that begins so),
    ``depth``, ``parent_conv_id`` (null for the root), ``n_convs``, ``n_children``,
    ``n_leaves``, ``saved_tokens`` (over the subtree, words that all conversations but one
    need not store) and ``ends_sha256`` of the ids that end there, in order, with commas.

    Conversations without turns end at the root; an empty table has no nodes. Copies of a
    conversation are counted before the trees are built. Only for their digest, which is
    sequential by its definition, are their ids streamed, sorted, through one task.
    """
    rows = conversations.select(
        "conv_id", F.array_join(F.transform("turns", lambda t: t["id"]), "").alias("path"),
        F.transform("turns", lambda t: t["words"]).alias("words"))
    rows = materialize(rows.withColumn("name", F.md5("path")), "conversation-paths")
    ids = rows.select("name", "conv_id").repartition("name").sortWithinPartitions("name", "conv_id")
    ending = ids.mapInArrow(_digest_task, "name string, n bigint, least bigint, ends string")
    distinct = rows.groupBy("name").agg(F.first("path").alias("path"), F.first("words").alias("words"))
    size = F.size("words") + 1

    def repeated(column: str):
        return F.array_repeat(F.col(column), size)

    nothing = F.array_repeat(F.lit(0).cast("bigint"), size)
    level = materialize(distinct.join(ending, "name").select(
        F.unhex("path").alias("path"), repeated("n").alias("counts"), repeated("least").alias("firsts"),
        nothing.alias("children"), nothing.alias("leaves"), nothing.alias("saved"), "words",
        F.concat(F.array_repeat(F.lit(None).cast("string"), F.size("words")), F.array("ends")).alias("ends"),
    ), "trie-level")
    schema = f"{NODE}, {PATH}"
    found: list[DataFrame] = []
    while True:
        n, turns = level.agg(F.count("path"), F.sum(F.size("counts"))).first()
        last = n <= LEAST_PATHS or turns <= block_turns
        named = bool(found)
        if last:
            dealt = level.coalesce(1)
        else:
            tasks = turns // block_turns + 1
            dealt = level.repartitionByRange(max(1, min(tasks, n // TASK_PATHS)) if named else tasks, "path")
        built = materialize(
            dealt.sortWithinPartitions("path").mapInArrow(_level_task(last, named, block_turns), schema), "trie-level")
        found.append(built.filter("path is null"))
        if last:
            break
        level = built.filter("path is not null").select(*level.columns)
    nodes = found[0]
    for more in found[1:]:
        nodes = nodes.unionByName(more)
    return _with_parents(nodes)


def _with_parents(nodes: DataFrame) -> DataFrame:
    """Fill in the parents of nodes that were final before their parent was."""
    columns = [c.split()[0] for c in NODE.split(", ")][:-2]
    late = nodes.filter("node is not null").select(F.col("node").alias("parent"), F.col("conv_id").alias("_above"))
    if late.count() <= MAX_BROADCAST_ROWS:
        late = F.broadcast(late)
    waiting = nodes.filter("parent is not null").join(late, "parent").withColumn("parent_conv_id", F.col("_above"))
    return nodes.filter("parent is null").select(*columns).unionByName(waiting.select(*columns))
