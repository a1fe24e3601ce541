"""Prefix trie of conversations, burst into containers.

A conversation is a path of turns from the textless root; a turn's id is the MD5 of its role and text, and a prefix is known
by two hashes that exclusive-or the hashed (place, turn id) pairs of its turns. So every prefix of every conversation is one
row with its own key, made by running aggregates, and nothing is collected per conversation.

Heads: a node whose subtree holds more than `container_rows` rows is too large for one task and bursts by next turn. As a
subtree's size is one sum per key, all bursts are found by one aggregation, however deep. What hangs under the heads are
containers of suffixes, each at most that large. A task sorts a container's suffixes and sweeps over them: neighbours share
their common prefix's nodes, nodes that the next suffix leaves are finished.

Heads are finished from sums: a node belongs to its smallest member, so a head's subtree is what its members own from its
depth on. These are running sums from the end of each path, taken over heads' rows alone, and added up per head.

Long conversations are numbered and summed in chunks of CHUNK places, with one carried total per chunk, so that no task
holds a whole one. The ids of the conversations that end in a head are joined piece by piece in order, and one task per node
feeds the pieces to the digest, holding only its state.

Defined results: rows with a NULL conversation id take no part. Turns with equal numbers, and repeated rows, are separate
turns in the order of their ids (hexadecimal MD5 of role length, colon, role, text). Other columns are ignored. An empty
table gives no rows, not even a root.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from peernet.llm.common import drop_staged, stage

CHUNK, SHARED, STRIDE = 4096, 6, 100
ROOT_ID = b"\x00" * 16
NO_ENDS = hashlib.sha256(b"").hexdigest()
NODES = (
    "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, "
    "ends_sha256 string"
)
SWEPT = f"{NODES}, is_top boolean"
SWEPT_ARROW = pa.schema(
    [*((c, pa.int64()) for c in ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens")),
     ("ends_sha256", pa.string()), ("is_top", pa.bool_())]
)
PIECE = "p1 long, p2 long, first long, ids string"
PIECE_ARROW = pa.schema([("p1", pa.int64()), ("p2", pa.int64()), ("first", pa.int64()), ("ids", pa.string())])
ENDS = "p1 long, p2 long, ends_sha256 string"
ENDS_ARROW = pa.schema([("p1", pa.int64()), ("p2", pa.int64()), ("ends_sha256", pa.string())])


def running(rows: DataFrame, place: Column, values: dict[str, tuple[str, Column]], order: list[Column] | None = None) -> DataFrame:
    """`rows` with running aggregates per `conv` in the order of `place` (then `order`).

    `values` maps a new column to ("sum" or "xor", value). A window holds one chunk of places; what earlier chunks of the
    same conversation add is carried as one row per chunk, which only conversations of several chunks have.
    """
    kinds = {"sum": F.sum, "xor": F.bit_xor}
    rows = rows.withColumn("chunk", F.floor(place / CHUNK))
    totals = rows.groupBy("conv", "chunk").agg(*[kinds[k](v).alias(f"t_{c}") for c, (k, v) in values.items()])
    earlier = Window.partitionBy("conv").orderBy(F.asc_nulls_first("chunk")).rowsBetween(Window.unboundedPreceding, -1)
    carried = totals.select(
        F.col("conv").alias("o_conv"),
        F.col("chunk").alias("o_chunk"),
        F.row_number().over(Window.partitionBy("conv").orderBy(F.asc_nulls_first("chunk"))).alias("nth"),
        *[kinds[k](f"t_{c}").over(earlier).alias(f"t_{c}") for c, (k, _) in values.items()],
    ).where("nth > 1").drop("nth")
    within = (
        Window.partitionBy("conv", "chunk")
        .orderBy(place.asc_nulls_first(), *order or [])
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    inner = rows.withColumns({c: kinds[k](v).over(within) for c, (k, v) in values.items()})
    met = inner.join(carried, (F.col("conv") == F.col("o_conv")) & F.col("chunk").eqNullSafe(F.col("o_chunk")), "left")
    zero = F.lit(0).cast("long")
    add = {"sum": lambda a, b: a + b, "xor": lambda a, b: a.bitwiseXOR(b)}
    done = {c: add[k](F.col(c), F.coalesce(f"t_{c}", zero)) for c, (k, _) in values.items()}
    return met.withColumns(done).drop("chunk", "o_conv", "o_chunk", *[f"t_{c}" for c in values])


def numbered_turns(conversations: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """(conv, pos, id, chars): turns numbered from 1."""
    said, who = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (text, role))
    turns = conversations.where(F.col(conv).isNotNull()).select(
        F.col(conv).cast("long").alias("conv"),
        F.col(turn).cast("long").alias("turn"),
        F.md5(F.concat(F.length(who).cast("string"), F.lit(":"), who, said)).alias("id"),
        F.length(said).cast("long").alias("chars"),
    )
    one = F.lit(1).cast("long")
    placed = running(turns, F.col("turn"), {"pos": ("sum", one)}, [F.col("id")])
    return placed.select("conv", "pos", F.unhex("id").alias("id"), "chars")


def rebuilt(turns: DataFrame, stride: int = STRIDE, shared: int = SHARED) -> tuple[DataFrame, DataFrame]:
    """Turns of the rebuilt conversations, and (conv, len) of each: the first h turns of conversation c - c % stride, then
    the own ones after the first h, where h is the CRC-32 of c in decimal, modulo `shared`."""
    sizes = turns.groupBy("conv").agg(F.max("pos").alias("n"))
    base = F.col("conv") - F.col("conv") % stride
    h = F.crc32(F.col("conv").cast("string").cast("binary")) % shared
    convs = sizes.select("conv", "n", base.alias("base"), h.alias("h"))
    base_sizes = sizes.where(F.col("conv") % stride == 0).select(F.col("conv").alias("base"), F.col("n").alias("base_n"))
    got = F.least("h", F.coalesce("base_n", F.lit(0).cast("long")))
    convs = convs.join(base_sizes, "base", "left").select("conv", "base", "h", got.alias("got"), (got + F.greatest(F.lit(0), F.col("n") - F.col("h"))).alias("len"))
    heads = turns.where((F.col("conv") % stride == 0) & (F.col("pos") < shared))
    heads = heads.select(F.col("conv").alias("base"), "pos", "id", "chars")
    lent = convs.join(heads, "base").where(F.col("pos") <= F.col("got")).select("conv", "pos", "id", "chars")
    # Few turns move: only those whose base is shorter than what they were to take from it.
    moved = convs.where(F.col("got") < F.col("h")).select(F.col("conv").alias("o_conv"), (F.col("h") - F.col("got")).alias("by"))
    skipped = F.crc32(F.col("conv").cast("string").cast("binary")) % shared
    own = turns.where(F.col("pos") > skipped).join(moved, F.col("conv") == F.col("o_conv"), "left")
    own = own.select("conv", (F.col("pos") - F.coalesce("by", F.lit(0).cast("long"))).alias("pos"), "id", "chars")
    return lent.unionByName(own), convs.select("conv", "len")


def prefixes(turns: DataFrame, lengths: DataFrame) -> DataFrame:
    """(conv, pos, id, chars, p1, p2, q1, q2, len): a row per conversation and prefix, from the empty one; p is the
    prefix's key and q that of the one before."""
    root = lengths.select("conv", F.lit(0).cast("long").alias("pos"), F.lit(ROOT_ID).alias("id"), F.lit(0).cast("long").alias("chars"))
    keys = {
        "e1": F.when(F.col("pos") > 0, F.xxhash64("pos", "id")).otherwise(F.lit(0)),
        "e2": F.when(F.col("pos") > 0, F.xxhash64(F.lit("second"), "pos", "id")).otherwise(F.lit(0)),
    }
    rows = root.unionByName(turns).withColumns(keys)
    rows = running(rows, F.col("pos"), {"p1": ("xor", F.col("e1")), "p2": ("xor", F.col("e2"))})
    before = {f"q{i}": F.col(f"p{i}").bitwiseXOR(F.col(f"e{i}")) for i in (1, 2)}
    return rows.withColumns(before).drop("e1", "e2").join(lengths, "conv")


class _Node:
    __slots__ = ("chars", "children", "ends", "leaves", "members", "owner", "saved", "told")

    def __init__(self, chars: int):
        self.chars, self.members, self.owner, self.children, self.leaves, self.saved = chars, 0, None, 0, 0, 0
        self.ends: list[int] = []
        self.told: list[int] = []  # numbers of its children's rows


def sweep(suffixes: list[tuple[bytes, int, list[int]]], depth: int, parent: int | None) -> list[list]:
    """SWEPT rows of a container: (turn ids, conversation, code points per turn) suffixes that share their first turn, which
    is the container's top at `depth`."""
    out: list[list] = []
    open_nodes: list[_Node] = []

    def meet(node: _Node, owner: int) -> None:
        node.owner = owner if node.owner is None else min(node.owner, owner)

    def close() -> None:
        node = open_nodes.pop()
        node.leaves = node.leaves or 1
        node.saved += (node.members - 1) * node.chars
        for i in node.told:
            out[i][2] = node.owner
        digest = hashlib.sha256(",".join(map(str, node.ends)).encode()).hexdigest() if node.ends else NO_ENDS
        row = [node.owner, depth + len(open_nodes), parent, node.members, node.children, node.leaves, node.saved, digest, not open_nodes]
        out.append(row)
        if open_nodes:
            above = open_nodes[-1]
            meet(above, node.owner)
            above.members += node.members
            above.children += 1
            above.leaves += node.leaves
            above.saved += node.saved
            above.told.append(len(out) - 1)

    last = b""
    for ids, conv, chars in sorted(suffixes, key=lambda s: s[:2]):
        common, most = 0, min(len(ids), len(last)) // 16
        while common < most and ids[16 * common : 16 * common + 16] == last[16 * common : 16 * common + 16]:
            common += 1
        while len(open_nodes) > common:
            close()
        open_nodes += map(_Node, chars[common:])
        end = open_nodes[-1]
        meet(end, conv)
        end.members += 1
        end.ends.append(conv)
        last = ids
    while open_nodes:
        close()
    return out


def _batch(rows: list, schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(schema)
    return pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def _rows(batches: Iterable[pa.RecordBatch], names: list[str]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(batch.column(c).to_pylist() for c in names), strict=True)


def _sweep_containers(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by container, conversation and place; one container is held at a time."""
    names, out = ["top", "p1", "p2", "parent", "conv", "id", "chars"], []
    for (top, _, _, parent), rows in groupby(_rows(batches, names), key=lambda r: r[:4]):
        suffixes = []
        for conv, path in groupby(rows, key=lambda r: r[4]):
            turns = list(path)
            suffixes.append((b"".join(t[5] for t in turns), conv, [t[6] for t in turns]))
        out += sweep(suffixes, top, parent)
        if len(out) >= 10_000:
            yield _batch(out, SWEPT_ARROW)
            out = []
    yield _batch(out, SWEPT_ARROW)


def ends_digests(ended: DataFrame, piece_ids: int = 4096) -> DataFrame:
    """ENDS per (p1, p2) of `ended`: SHA-256 of its ascending `conv`s, joined by commas."""

    def pieces(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, rows in groupby(_rows(batches, ["p1", "p2", "conv"]), key=lambda r: r[:2]):
            some = []
            for row in rows:
                some.append(row[2])
                if len(some) == piece_ids:
                    yield _batch([(*key, some[0], ",".join(map(str, some)))], PIECE_ARROW)
                    some = []
            if some:
                yield _batch([(*key, some[0], ",".join(map(str, some)))], PIECE_ARROW)

    def digests(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = []
        for key, rows in groupby(_rows(batches, ["p1", "p2", "ids"]), key=lambda r: r[:2]):
            digest = hashlib.sha256(next(rows)[2].encode())
            for row in rows:
                digest.update(b"," + row[2].encode())
            out.append((*key, digest.hexdigest()))
        yield _batch(out, ENDS_ARROW)

    keyed = ended.select("p1", "p2", "conv").repartitionByRange("p1", "p2", "conv").sortWithinPartitions("p1", "p2", "conv")
    parts = keyed.mapInArrow(pieces, PIECE).repartition("p1", "p2").sortWithinPartitions("p1", "p2", "first")
    return parts.mapInArrow(digests, ENDS)


def prefix_trie(
    conversations: DataFrame,
    conv_column: str = "conv_id",
    turn_column: str = "turn",
    role_column: str = "role",
    text_column: str = "text",
    container_rows: int = 50_000,
) -> DataFrame:
    """NODES of the trie over the rebuilt conversations."""
    turns, lengths = rebuilt(numbered_turns(conversations, conv_column, turn_column, role_column, text_column))
    rows = stage(prefixes(turns, lengths), "prefixes")
    key, parent_key = ["pos", "p1", "p2"], [F.col("pos") - 1, F.col("q1"), F.col("q2")]
    nodes = rows.groupBy(*key).agg(
        F.count(F.lit(1)).alias("n"),
        F.min("conv").alias("owner"),
        F.max("len").alias("longest"),
        F.sum(F.col("len") - F.col("pos") + 1).alias("size"),
        *[F.min(c).alias(c) for c in ("chars", "q1", "q2")],
    )
    heads = stage(nodes.where(F.col("size") > container_rows).drop("size"), "heads")
    of_head = heads.select(*[F.col(c).alias(f"h_{c}") for c in (*key, "owner", "n", "longest")])
    same_node = [F.col(c) == F.col(f"h_{c}") for c in key]
    marked = stage(rows.join(of_head, same_node, "left").drop(*[f"h_{c}" for c in key]), "marked")
    drop_staged(rows)

    # Containers: from the first node of each path that is no head.
    loose = marked.where(F.col("h_owner").isNull())
    tops = loose.groupBy("conv").agg(F.min(F.struct(*key, "q1", "q2")).alias("top")).select("conv", "top.*")
    parents = heads.select(*[F.col(c).alias(f"h_{c}") for c in key], F.col("owner").alias("parent"))
    above = [a == F.col(f"h_{c}") for a, c in zip(parent_key, key, strict=True)]
    tops = stage(tops.join(parents, above, "left").select("conv", F.col("pos").alias("top"), "p1", "p2", "q1", "q2", "parent"), "tops")
    contained = loose.select("conv", "pos", "id", "chars").join(tops.drop("q1", "q2"), "conv")
    dealt = contained.repartition("top", "p1", "p2").sortWithinPartitions("top", "p1", "p2", "conv", "pos")
    swept = stage(dealt.mapInArrow(_sweep_containers, SWEPT), "swept")

    # Heads: what every conversation owns of them, and of the container below, from each depth on.
    of_container = swept.where("is_top").select(F.col("conv_id").alias("conv"), "n_leaves", "saved_tokens")
    hanging = of_container.join(tops, "conv")
    mine = F.col("conv") == F.col("h_owner")
    zero = F.lit(0).cast("long")
    path = marked.where(F.col("h_owner").isNotNull()).select(
        "conv", *key,
        F.when(mine & (F.col("h_longest") == F.col("pos")), F.lit(1).cast("long")).otherwise(zero).alias("leaves"),
        F.when(mine, (F.col("h_n") - 1) * F.col("chars")).otherwise(zero).alias("saved"),
    )
    below = hanging.select("conv", F.col("top").alias("pos"), "p1", "p2", F.col("n_leaves").alias("leaves"), F.col("saved_tokens").alias("saved"))
    owned = running(path.unionByName(below), -F.col("pos"), {c: ("sum", F.col(c)) for c in ("leaves", "saved")})
    sums = owned.groupBy(*key).agg(F.sum("leaves").alias("n_leaves"), F.sum("saved").alias("saved_tokens"))
    child_of = heads.select("pos", "q1", "q2").unionByName(hanging.select(F.col("top").alias("pos"), "q1", "q2"))
    child_of = child_of.where("pos > 0").groupBy(*[c.alias(k) for c, k in zip(parent_key, key, strict=True)])
    children = child_of.agg(F.count(F.lit(1)).alias("n_children"))
    ends = ends_digests(marked.where(F.col("h_owner").isNotNull() & (F.col("pos") == F.col("len"))))
    finished = (
        heads.join(sums, key)
        .join(children, key, "left")
        .join(ends, ["p1", "p2"], "left")
        .join(parents, above, "left")
        .select(
            F.col("owner").alias("conv_id"),
            F.col("pos").alias("depth"),
            F.col("parent").alias("parent_conv_id"),
            F.col("n").alias("n_convs"),
            F.coalesce("n_children", zero).alias("n_children"),
            "n_leaves",
            "saved_tokens",
            F.coalesce("ends_sha256", F.lit(NO_ENDS)).alias("ends_sha256"),
        )
    )
    return swept.drop("is_top").unionByName(finished)


def oracle(stride: int = STRIDE, shared: int = SHARED) -> str:
    """The same in DuckDB SQL: prefixes as lists, subtrees by their nodes' ancestors."""
    bit = "(s >> 1)::BIGINT, CASE WHEN s & 1 = 1 THEN 3988292384 ELSE 0 END"
    byte = f"list_reduce(list_concat([xor(a, b)], [0, 0, 0, 0, 0, 0, 0, 0]), lambda s, _: xor({bit}))"
    codes = "list_transform(string_split(c::VARCHAR, ''), lambda x: ascii(x)::BIGINT)"
    crc = f"xor(4294967295, list_reduce(list_concat([4294967295::BIGINT], {codes}), lambda a, b: {byte}))"
    return f"""
WITH t AS (SELECT conv_id AS c, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
     o AS (SELECT c, list({{'role': role, 'text': text}} ORDER BY turn NULLS FIRST, md5(length(role) || ':' || role || text)) AS l FROM t GROUP BY c),
     h AS (SELECT c, l, ({crc}) % {shared} AS h FROM o),
     r AS (SELECT h.c, list_concat(coalesce(b.l[1:h.h], []), h.l[h.h + 1:]) AS l FROM h LEFT JOIN o b ON b.c = h.c - h.c % {stride}),
     p AS (SELECT c, len(l) = d AS ends, d, l[1:d] AS l FROM (SELECT c, l, unnest(range(len(l) + 1)) AS d FROM r)),
     n AS (SELECT l, d, min(c) AS c, count(*) AS n, (count(*) - 1) * coalesce(length(l[d].text), 0) AS saved,
                  sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (ends), '')) AS ends FROM p GROUP BY l, d),
     k AS (SELECT l[1:d - 1] AS l, count(*) AS n FROM n WHERE d > 0 GROUP BY 1),
     s AS (SELECT l[1:a] AS l, count(*) FILTER (NOT EXISTS (SELECT 1 FROM k WHERE k.l = x.l)) AS leaves, sum(saved) AS saved
           FROM (SELECT l, saved, unnest(range(d + 1)) AS a FROM n) x GROUP BY 1)
SELECT n.c AS conv_id, n.d::BIGINT AS depth, u.c AS parent_conv_id, n.n AS n_convs, coalesce(k.n, 0) AS n_children,
       s.leaves AS n_leaves, s.saved::BIGINT AS saved_tokens, n.ends AS ends_sha256
FROM n JOIN s ON s.l = n.l LEFT JOIN k ON k.l = n.l LEFT JOIN n u ON n.d > 0 AND u.l = n.l[1:n.d - 1]"""
