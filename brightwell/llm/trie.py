"""Prefix trie of rebuilt conversations, from composable fingerprints.

Conversation c is rebuilt as the first h turns of a base conversation and its own
turns after its first h. A run of turns is an element of a monoid: its length n
and, for two bases B, the number F = t0 + t1 B + t2 B^2 + ... modulo 2^61 - 1, t
being hashes of the turns. (n, F) and (m, G) combine to (n + m, F + B^n G), so

* prefixes of stored conversations are scanned slice by slice, and what earlier
  slices hold of a conversation is one element, whatever its length;
* prefixes of rebuilt conversations follow from two stored prefixes by
  arithmetic: F_base(m) + B^(m - h) (F_own(i) - F_own(h)). No text is moved or
  put together; each rebuilt turn refers to a stored one.

Rebuilt prefixes with equal depth and fingerprint are a node. That equal
fingerprints mean equal prefixes is verified, not assumed: all members of a node
must have the same parent and turn hash, and where their references differ, the
stored turns with that hash must hold one role and text. By induction over the
depth, members are then equal turn by turn. If a fingerprint or hash ever fails,
everything is done again with other bases and hashes.

Sums over subtrees use that a node's smallest member passes through all its
ancestors: a node's value stands at its smallest member, is summed from the deep
end along that conversation, and each node adds up what its members have.

Turns go by ``turn`` (null first); ties by a hash of role and text. Null roles and
texts are empty. Rows without a conv_id belong to no conversation and are left
out. Rows that repeat are turns each for itself. An empty table gives no rows,
not even a root. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brightwell.llm.common import cut_lineage
from brightwell.operators.ordered import Wanted, ordered_columns
from brightwell.operators.skew import attach

P = (1 << 61) - 1
#: Largest table of turn hashes that is broadcast, by its counted rows (16 bytes each).
FEW = 100_000
#: Ids put together before a node's digest is taken.
CHUNK = 10_000
NODE = ["depth", "f1", "f2"]
STORED = ("summary boolean, slice int, conv_id long, position long, t1 long, t2 long, bytes long, "
          "f1 long, f2 long, e1 long, e2 long")


@dataclass(frozen=True)
class Rule:
    """How a conversation is rebuilt: its base and how many head turns, below ``heads``."""

    base: Callable[[Column], Column] = lambda c: c - c % 5
    head: Callable[[Column], Column] = lambda c: F.crc32(c.cast("string").cast("binary")) % 9
    heads: int = 9


# Numbers modulo 2^61 - 1

def bases(seed: int) -> tuple[int, int]:
    return tuple(int.from_bytes(hashlib.sha256(f"{seed}:{k}".encode()).digest()[:8], "big") % (P - 1000) + 500 for k in (1, 2))


def times(a, b) -> np.ndarray:
    """Product of whole numbers below 2^61 - 1, as uint64."""
    a, b = np.asarray(a, "u8"), np.asarray(b, "u8")
    low31, low30 = np.uint64((1 << 31) - 1), np.uint64((1 << 30) - 1)
    ah, al, bh, bl = a >> np.uint64(31), a & low31, b >> np.uint64(31), b & low31
    middle = al * bh + ah * bl
    return _below(ah * bh * np.uint64(2) + (middle >> np.uint64(30)) + ((middle & low30) << np.uint64(31)) + al * bl)


def _below(a: np.ndarray) -> np.ndarray:
    a = (a & np.uint64(P)) + (a >> np.uint64(61))
    return np.where(a >= P, a - np.uint64(P), a)


def plus(a, b) -> np.ndarray:
    return _below(np.asarray(a, "u8") + np.asarray(b, "u8"))


def minus(a, b) -> np.ndarray:
    return _below(np.asarray(a, "u8") + np.uint64(P) - np.asarray(b, "u8"))


def powers(base: int, n: int) -> np.ndarray:
    """base^0 to base^(n - 1)."""
    out = np.ones(max(n, 1), "u8")
    done = 1
    while done < n:
        more = min(done, n - done)
        out[done:done + more] = times(out[:more], pow(base, done, P))
        done += more
    return out


def prefix_sums(values: np.ndarray, starts: np.ndarray, group: np.ndarray) -> np.ndarray:
    """Sums within groups up to and including each value, modulo 2^61 - 1."""
    high, low = np.cumsum(values >> np.uint64(31)), np.cumsum(values & np.uint64((1 << 31) - 1))
    total = plus(times(_below(high), 1 << 31), _below(low))
    return minus(total, np.where(starts > 0, total[starts - 1], np.uint64(0))[group])


def combine(one: tuple, other: tuple, base: tuple[int, int]) -> tuple:
    """(n, F1, F2) of two runs one after the other."""
    return (one[0] + other[0], *((f + pow(b, one[0], P) * g) % P for f, g, b in zip(one[1:], other[1:], base)))


# Stored turns

def _hashes(seed: int) -> list[Column]:
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    return [F.pmod(F.xxhash64(F.lit(f"{seed}:{k}"), role, text), F.lit(P)).alias(f"t{k}") for k in (1, 2)]


def _column(batch: pa.RecordBatch, name: str, kind: str = "i8") -> np.ndarray:
    return batch.column(name).to_numpy(zero_copy_only=False).astype(kind)


def _scan(batches: Iterator[pa.RecordBatch], base: tuple[int, int]) -> Iterator[pa.RecordBatch]:
    """Positions and prefixes inside one slice, then the elements of its first and last conversation."""
    part, conv, held, ends = TaskContext.get().partitionId(), None, (0, 0, 0), []
    for batch in batches:
        if not batch.num_rows:
            continue
        convs, t = _column(batch, "conv_id"), [_column(batch, f"t{k}", "u8") for k in (1, 2)]
        fresh = np.r_[True, convs[1:] != convs[:-1]]
        starts = np.flatnonzero(fresh)
        group = np.cumsum(fresh) - 1
        if conv is None or convs[0] != conv:
            if conv is not None and not ends:
                ends.append((conv, held))
            held = (0, 0, 0)
        first, at = group == 0, np.arange(len(convs)) - starts[group]
        upto, before = [], []
        for k in (0, 1):
            value = times(t[k], powers(base[k], len(convs))[at])
            sums = prefix_sums(value, starts, group)
            shift, start = np.where(first, np.uint64(pow(base[k], held[0], P)), np.uint64(1)), np.where(first, np.uint64(held[1 + k]), np.uint64(0))
            upto.append(plus(start, times(shift, sums)))
            before.append(plus(start, times(shift, minus(sums, value))))
        position = at + np.where(first, held[0], 0)
        if len(starts) > 1 and not ends:
            end = starts[1] - 1
            ends.append((int(convs[0]), (int(position[end]) + 1, int(upto[0][end]), int(upto[1][end]))))
        conv, held = int(convs[-1]), (int(position[-1]) + 1, int(upto[0][-1]), int(upto[1][-1]))
        yield _stored(False, part, convs, position, *t, _column(batch, "bytes"), *upto, *before)
    if conv is not None:
        ends.append((conv, held))
        some = [np.array(v) for v in zip(*((c, *e) for c, e in ends))]
        zero = np.zeros(len(ends), "i8")
        yield _stored(True, part, some[0], some[1], zero, zero, zero, some[2], some[3], zero, zero)


def _stored(summary: bool, part: int, *columns: np.ndarray) -> pa.RecordBatch:
    n = len(columns[0])
    lead = [pa.array(np.full(n, summary)), pa.array(np.full(n, part, "i4"))]
    return pa.RecordBatch.from_arrays([*lead, *[pa.array(c.astype("i8")) for c in columns]], [f.split()[0] for f in STORED.split(", ")])


def carried(summaries: list[tuple], base: tuple[int, int]) -> dict[int, tuple]:
    """By slice: the conversation that began before it and the element of what lies before.

    ``summaries`` has (slice, conv, n, F1, F2) of each slice's first and last conversation."""
    found, conv, held = {}, None, (0, 0, 0)
    by = {}
    for part, *rest in summaries:
        by.setdefault(part, []).append(tuple(rest))
    for part in sorted(by):
        ends = by[part]
        if ends[0][0] == conv:
            found[part] = (conv, *held)
            if len(ends) == 1:
                held = combine(held, ends[0][1:], base)
                continue
        conv, held = ends[-1][0], ends[-1][1:]
    return found


def stored_turns(conversations: DataFrame, seed: int, slices: int | None = None) -> DataFrame:
    """conv_id, position, t1, t2, bytes, f1, f2 (through the turn), e1, e2 (before it), without texts."""
    base = bases(seed)
    slices = slices or int(conversations.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("bytes")
    rows = conversations.where(F.col("conv_id").isNotNull()).select(F.col("conv_id").cast("long").alias("conv_id"), "turn", *_hashes(seed), size)
    sort = ["conv_id", "turn", "t1", "t2"]
    scanned = cut_lineage(rows.repartitionByRange(slices, *sort).sortWithinPartitions(*sort).mapInArrow(lambda b: _scan(b, base), STORED))
    # Two rows at most of each slice: bounded by the number of slices.
    ends = scanned.where("summary").select("slice", "conv_id", "position", "f1", "f2").collect()
    before = carried([tuple(r) for r in _in_order(ends)], base)

    def place(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            names = ["conv_id", "position", "t1", "t2", "bytes", "f1", "f2", "e1", "e2"]
            have = {name: _column(batch, name) for name in names}
            part = _column(batch, "slice")
            for one in np.unique(part):
                if int(one) in before:
                    conv, n, *start = before[int(one)]
                    mine = (part == one) & (have["conv_id"] == conv)
                    have["position"][mine] += n
                    for name in ("f1", "f2", "e1", "e2"):
                        k = int(name[1]) - 1
                        have[name][mine] = plus(start[k], times(have[name][mine], pow(base[k], n, P))).astype("i8")
            yield pa.RecordBatch.from_arrays([pa.array(have[name]) for name in names], names)
    kind = "conv_id long, position long, t1 long, t2 long, bytes long, f1 long, f2 long, e1 long, e2 long"
    return scanned.where("NOT summary").mapInArrow(place, kind)


def _in_order(ends: list) -> list:
    """First before last; a slice's conversations rise."""
    return sorted(ends, key=lambda r: (r.slice, r.conv_id))


# Rebuilt conversations

def rebuilt(stored: DataFrame, rule: Rule, seed: int) -> DataFrame:
    """One row per rebuilt turn, and one for the root: conv_id, depth, f1, f2, p1, p2 (the
    parent's), t1, t2, bytes, from_conv, from_position (the stored turn), ends."""
    base = bases(seed)
    head = F.when(F.col("position") < rule.heads - 1, F.struct("position", "f1", "f2", "e1", "e2", "t1", "t2", "bytes"))
    # At most heads - 1 turns of a conversation are collected.
    heads = cut_lineage(stored.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"), F.array_sort(F.collect_list(head)).alias("head")))
    base_id, most = rule.base(F.col("conv_id")), rule.head(F.col("conv_id")).cast("int")
    own = heads.select("conv_id", "n", "head", base_id.alias("base"), most.alias("h"))
    of_base = heads.select(F.col("conv_id").alias("base"), F.col("n").alias("base_n"), F.col("head").alias("base_head"))
    def prefix(turns, n, name):
        return F.when(n > 0, F.element_at(turns, F.greatest(n, F.lit(1)))[name]).otherwise(0)
    spliced = own.join(of_base, "base", "left").withColumn("m", F.least("h", F.coalesce("base_n", F.lit(0))).cast("int"))
    spliced = spliced.select(
        "conv_id", "base", "h", "m", "base_head", (F.col("m") + F.greatest(F.lit(0), F.col("n") - F.col("h"))).alias("length"),
        *[prefix(F.col("base_head"), F.col("m"), f"f{k}").alias(f"b{k}") for k in (1, 2)],
        *[F.when(F.col("n") > F.col("h"), prefix(F.col("head"), F.col("h"), f"f{k}")).alias(f"o{k}") for k in (1, 2)])
    spliced = cut_lineage(spliced)

    zero = F.lit(0).cast("long")
    roots = spliced.select("conv_id", zero.alias("depth"), zero.alias("f1"), zero.alias("f2"), zero.alias("p1"), zero.alias("p2"),
                           zero.alias("t1"), zero.alias("t2"), zero.alias("bytes"), zero.alias("from_conv"), zero.alias("from_position"),
                           (F.col("length") == 0).cast("long").alias("ends"))
    turn = F.explode(F.slice("base_head", F.lit(1), F.col("m"))).alias("turn")
    first = spliced.where("m > 0").select("conv_id", "base", "length", turn)
    depth = F.col("turn.position") + 1
    first = first.select("conv_id", depth.alias("depth"), "turn.f1", "turn.f2", F.col("turn.e1").alias("p1"), F.col("turn.e2").alias("p2"),
                         "turn.t1", "turn.t2", "turn.bytes", F.col("base").alias("from_conv"), F.col("turn.position").alias("from_position"),
                         (depth == F.col("length")).cast("long").alias("ends"))
    facts = spliced.where(F.col("length") > F.col("m")).select("conv_id", "h", "m", "length", "b1", "b2", "o1", "o2")
    rest = attach(stored, facts, ["conv_id"]).where(F.col("position") >= F.col("h"))
    names, reach = roots.columns, rule.heads
    kind = ", ".join(f"{name} long" for name in names)

    def splice(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            h, m, position = (_column(batch, name) for name in ("h", "m", "position"))
            made = {"conv_id": _column(batch, "conv_id"), "depth": m + position - h + 1}
            for k in (1, 2):
                shifts = np.array([pow(base[k - 1], int(e), P) for e in range(-reach, 1)], "u8")[m - h + reach]
                start, own = _column(batch, f"b{k}", "u8"), _column(batch, f"o{k}", "u8")
                for name, of in (("f", "f"), ("p", "e")):
                    made[f"{name}{k}"] = plus(start, times(shifts, minus(_column(batch, f"{of}{k}", "u8"), own))).astype("i8")
            made |= {name: _column(batch, name) for name in ("t1", "t2", "bytes")}
            made |= {"from_conv": made["conv_id"], "from_position": position, "ends": (made["depth"] == _column(batch, "length")).astype("i8")}
            yield pa.RecordBatch.from_arrays([pa.array(made[name]) for name in names], names)
    return roots.union(first).union(rest.mapInArrow(splice, kind))


# Nodes

def grouped(members: DataFrame) -> DataFrame:
    """Nodes by depth and fingerprint, with what ``verified`` looks at."""
    same = [F.max(name) != F.min(name) for name in ("p1", "p2", "t1", "t2")]
    apart = (F.max("from_conv") != F.min("from_conv")) | (F.max("from_position") != F.min("from_position"))
    return members.groupBy(*NODE).agg(
        F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.sum("ends").alias("n_ends"),
        *[F.min(name).alias(name) for name in ("p1", "p2", "t1", "t2")], F.max("bytes").alias("bytes"),
        (same[0] | same[1] | same[2] | same[3]).alias("mixed"), apart.alias("apart"))


def verified(nodes: DataFrame, conversations: DataFrame, seed: int) -> bool:
    """Whether every node holds one prefix only: see the module's text."""
    if not nodes.where("mixed").isEmpty():
        return False
    shared = cut_lineage(nodes.where("apart AND depth > 0").select("t1", "t2").distinct())
    some = shared.count()
    if not some:
        return True
    turns = conversations.where(F.col("conv_id").isNotNull()).select(
        *_hashes(seed), F.struct(F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))).alias("content"))
    meant = turns.join(F.broadcast(shared) if some <= FEW else shared, ["t1", "t2"], "left_semi")
    return meant.groupBy("t1", "t2").agg((F.min("content") != F.max("content")).alias("differ")).where("differ").isEmpty()


def _end_digests(members: DataFrame) -> DataFrame:
    """NODE, ends_sha256 of nodes at which conversations end. Ids are put in order in slices of
    any size and joined there; a node's task only reads the joined pieces one by one."""
    ends = members.where("ends = 1").select(*NODE, "conv_id")
    slices = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sort = [*NODE, "conv_id"]

    def runs(batches):
        for batch in batches:
            keys, ids = np.stack([_column(batch, name) for name in NODE], 1), _column(batch, "conv_id")
            if not len(ids):
                continue
            fresh = np.r_[True, (keys[1:] != keys[:-1]).any(axis=1)]
            starts = np.flatnonzero(fresh)
            cuts = np.concatenate([np.arange(a, b, CHUNK) for a, b in zip(starts, np.r_[starts[1:], len(ids)])])
            texts = [",".join(map(str, ids[a:b].tolist())) for a, b in zip(cuts, np.r_[cuts[1:], len(ids)])]
            yield pa.RecordBatch.from_arrays([*[pa.array(keys[cuts, i]) for i in range(3)], pa.array(ids[cuts]), pa.array(texts)], [*sort, "ids"])

    def digest(batches):
        key, state = None, None
        for batch in batches:
            out = []
            for row in zip(*[batch.column(name).to_pylist() for name in (*NODE, "ids")]):
                if row[:3] == key:
                    state.update(b",")
                else:
                    if key:
                        out.append((*key, state.hexdigest()))
                    key, state = row[:3], hashlib.sha256()
                state.update(row[3].encode())
            yield _digests(out)
        yield _digests([(*key, state.hexdigest())] if key else [])
    joined = (ends.repartitionByRange(slices, *sort).sortWithinPartitions(*sort)
              .mapInArrow(runs, "depth long, f1 long, f2 long, conv_id long, ids string"))
    return joined.repartition(*NODE).sortWithinPartitions(*sort).mapInArrow(digest, "depth long, f1 long, f2 long, ends_sha256 string")


def _digests(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string())
    columns = list(zip(*rows)) or [()] * 4
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], [*NODE, "ends_sha256"])


def trie(conversations: DataFrame, rule: Rule = Rule(), seed: int = 0, slices: int | None = None) -> DataFrame:
    """One row per node: conv_id (smallest member), depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens (bytes that sharing saves in the subtree), ends_sha256."""
    while True:
        members = cut_lineage(rebuilt(stored_turns(conversations, seed, slices), rule, seed))
        nodes = cut_lineage(grouped(members))
        if verified(nodes, conversations, seed):
            break
        seed += 1
    parents = nodes.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("p1").alias("f1"), F.col("p2").alias("f2"))
    children = parents.agg(F.count(F.lit(1)).alias("n_children"))
    nodes = cut_lineage(nodes.join(children, NODE, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)).cast("long")))

    # A node's own values stand at its smallest member; the node of a (conv_id, depth) is one at most.
    own = nodes.select("conv_id", "depth", (F.col("n_children") == 0).cast("long").alias("leaf"), ((F.col("n_convs") - 1) * F.col("bytes")).alias("save"))
    path = members.select("conv_id", *NODE).join(own, ["conv_id", "depth"], "left")
    path = path.select("conv_id", *NODE, *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("leaf", "save")])
    summed = ordered_columns(path, [F.desc("depth")], Wanted(running_sum={"leaves": "leaf", "saved": "save"}), ["conv_id"], slices)
    below = summed.groupBy(*NODE).agg(F.sum("leaves").alias("n_leaves"), F.sum("saved").alias("saved_tokens"))
    above = nodes.select((F.col("depth") + 1).alias("depth"), F.col("f1").alias("p1"), F.col("f2").alias("p2"), F.col("conv_id").alias("parent_conv_id"))
    named = attach(nodes, above, ["depth", "p1", "p2"])
    whole = named.join(below, NODE).join(_end_digests(members), NODE, "left")
    return whole.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"))
