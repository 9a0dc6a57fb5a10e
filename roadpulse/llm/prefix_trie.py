"""The trie of conversation prefixes, its subtree totals by parallel tree contraction.

Every prefix has a 127-bit number: a polynomial over the digests of its turns. Such numbers can be
put together from those of their parts, so a conversation may be spread over any number of tasks,
and the head of one conversation can be set before the rest of another without its turns meeting.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadpulse.llm.common import stored

# A Mersenne prime, and a base below it taken from a digest.
PRIME = (1 << 127) - 1
BASE = int.from_bytes(hashlib.sha256(b"conversation prefix").digest()[:16], "big") % PRIME
ROOT = 1
# Heads of at most 8 turns are taken over from the first of every 5 conversations.
HEAD, EVERY = 8, 5
# Ids of one open piece of a list that several tasks hash one after the other.
PIECE_IDS = 50_000
ROWS = 20_000
NO_ENDS = hashlib.sha256(b"").hexdigest()


def _halves(numbers: list[int]) -> tuple[np.ndarray, np.ndarray]:
    data = b"".join(n.to_bytes(16, "big") for n in numbers)
    pairs = np.frombuffer(data, ">i8").astype(np.int64).reshape(-1, 2)
    return pairs[:, 0], pairs[:, 1]


def _numbers(high: pa.Array, low: pa.Array) -> list[int]:
    return [(h << 64) | (x & 0xFFFFFFFFFFFFFFFF) for h, x in zip(high.to_pylist(), low.to_pylist(), strict=True)]


_TURNS = "kind int, part int, run int, conv_id long, place long, high long, low long, before_high long, before_low long, bytes long"


def numbered_turns(turns: DataFrame) -> DataFrame:
    """conv_id, place (from 1), high and low (the number of the prefix that ends there), before_high
    and before_low (of the prefix before it) and bytes of the text of every turn.

    Turns are in the order of ``turn``, null first, then of a digest of role and text. Null roles
    and texts are empty. Rows without conv_id belong to no conversation. Turns are dealt by ranges
    of (conv_id, turn, digest), so a long conversation fills several tasks; each numbers its part,
    and what the parts before it hold is put in front. The driver sees two rows per task."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    digest = F.unhex(F.substring(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256), 1, 32))
    rows = turns.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn"), digest.alias("digest"), F.octet_length(text).cast("long").alias("bytes"))
    rows = rows.repartitionByRange("conv_id", "turn", "digest").sortWithinPartitions("conv_id", "turn", "digest")

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, run, conv, place, now, first = TaskContext.get().partitionId(), -1, None, 0, ROOT, None
        for batch in batches:
            runs, places, numbers = [], [], []
            before = []
            for own, digest in zip(batch["conv_id"].to_pylist(), batch["digest"].to_pylist(), strict=True):
                if own != conv:
                    if run == 0:
                        first = (conv, place, now)
                    run, conv, place, now = run + 1, own, 0, ROOT
                before.append(now)
                now = (now * BASE + int.from_bytes(digest, "big") + 1) % PRIME
                place += 1
                runs.append(run)
                places.append(place)
                numbers.append(now)
            n = batch.num_rows
            yield pa.RecordBatch.from_arrays([
                pa.array(np.zeros(n, np.int32)), pa.array(np.full(n, part, np.int32)), pa.array(runs, pa.int32()), batch["conv_id"],
                pa.array(places, pa.int64()), *map(pa.array, _halves(numbers)), *map(pa.array, _halves(before)), batch["bytes"],
            ], schema=_TURN_SCHEMA)
        for number, edge in ((0, first or (conv, place, now)), (run, (conv, place, now))):
            if run >= 0:
                high, low = _halves([edge[2]])
                yield pa.RecordBatch.from_arrays([
                    pa.array(v, t) for v, t in zip(([1], [part], [number], [edge[0]], [edge[1]], high, low, [0], [0], [0]), _TURN_SCHEMA.types, strict=True)
                ], schema=_TURN_SCHEMA)

    found = stored(rows.mapInArrow(number, _TURNS), "turns")
    carried = _carried(found.where("kind = 1").collect())  # two rows per task

    def complete(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch[c] for c in ("conv_id", "place", "high", "low", "before_high", "before_low", "bytes")]
            open_rows = np.flatnonzero((batch["run"].to_numpy() == 0) & np.isin(batch["part"].to_numpy(), list(carried)))
            if len(open_rows):
                values = [c.to_numpy().copy() for c in columns]
                parts, places = batch["part"].to_numpy()[open_rows].tolist(), values[1][open_rows].tolist()
                for at in (2, 4):
                    numbers = _numbers(pa.array(values[at][open_rows]), pa.array(values[at + 1][open_rows]))
                    # The prefix before a turn is one turn shorter.
                    sizes = places if at == 2 else [p - 1 for p in places]
                    put = [_joined(carried[p][1], n, size) for p, n, size in zip(parts, numbers, sizes, strict=True)]
                    values[at][open_rows], values[at + 1][open_rows] = _halves(put)
                values[1][open_rows] += np.array([carried[p][0] for p in parts])
                columns = list(map(pa.array, values))
            yield pa.RecordBatch.from_arrays(columns, names=["conv_id", "place", "high", "low", "before_high", "before_low", "bytes"])

    schema = "conv_id long, place long, high long, low long, before_high long, before_low long, bytes long"
    rows = found.where("kind = 0").drop("kind")
    return rows.mapInArrow(complete, schema) if carried else rows.drop("part", "run")


_TURN_SCHEMA = pa.schema([
    ("kind", pa.int32()), ("part", pa.int32()), ("run", pa.int32()), ("conv_id", pa.int64()), ("place", pa.int64()),
    ("high", pa.int64()), ("low", pa.int64()), ("before_high", pa.int64()), ("before_low", pa.int64()), ("bytes", pa.int64()),
])


def _joined(head: int, rest: int, size: int) -> int:
    """The number of a head followed by ``size`` turns that alone have the number ``rest``."""
    return ((head - ROOT) * pow(BASE, size, PRIME) + rest) % PRIME


def _carried(edges: list) -> dict[int, tuple[int, int]]:
    """part: (turns, number) of what earlier parts hold of its first conversation, if anything.
    ``edges``: the first and the last conversation of every part, the same row twice where it is one."""
    by_part: dict[int, list] = {}
    for e in edges:
        by_part.setdefault(e.part, []).append(e)
    carried, conv, place, now = {}, None, 0, ROOT
    for part, own in sorted(by_part.items()):
        first, last = sorted(own, key=lambda e: e.run)
        if first.conv_id == conv:
            carried[part] = (place, now)
        (number,) = _numbers(pa.array([last.high]), pa.array([last.low]))
        if last.run == 0 and first.conv_id == conv:
            place, now = place + last.place, _joined(now, number, last.place)
        else:
            conv, place, now = last.conv_id, last.place, number
    return carried


def rebuilt_visits(turns: DataFrame) -> DataFrame:
    """Every prefix of every rebuilt conversation but the empty one: high, low, before_high,
    before_low, depth, conv_id, bytes, and whether the conversation ends there; conversations without turns
    have one row of depth 0.

    Conversation c is the first h turns of conversation c - c % 5, then its own after the first h."""
    turns = stored(numbered_turns(turns), "turns")
    one = [F.max(F.when(F.col("place") == k, F.col(c))).alias(f"{c}{k}") for k in range(1, HEAD + 1) for c in ("high", "low", "bytes")]
    heads = turns.groupBy("conv_id").agg(F.max("place").alias("n"), *one)
    heads = stored(heads.select("conv_id", "n", *(
        F.array(F.lit(start), *(F.col(f"{c}{k}") for k in range(1, HEAD + 1))).alias(c)
        for c, start in (("high", ROOT >> 64), ("low", ROOT), ("bytes", 0)))), "heads")
    givers = heads.select(F.col("conv_id").alias("giver"), F.col("n").alias("giver_n"), *(F.col(c).alias(f"giver_{c}") for c in ("high", "low", "bytes")))
    plan = heads.join(givers, F.col("conv_id") - F.col("conv_id") % EVERY == F.col("giver"), "left")
    taken = (F.crc32(F.col("conv_id").cast("string")) % (HEAD + 1)).cast("int")
    plan = plan.withColumn("h", taken).withColumn("m", F.least("h", F.coalesce("giver_n", F.lit(0))).cast("int")).withColumn("whole", F.col("n") <= F.col("h"))
    plan = stored(plan, "plan")
    at = lambda c, k: F.coalesce(F.get(F.col(f"giver_{c}"), k), F.lit({"high": ROOT >> 64, "low": ROOT, "bytes": 0}[c]))
    head = plan.withColumn("k", F.explode(F.when(F.col("m") > 0, F.sequence(F.lit(1), "m")).when(F.col("whole"), F.array(F.lit(0))))).select(
        at("high", F.col("k")).alias("high"), at("low", F.col("k")).alias("low"),
        at("high", F.col("k") - 1).alias("before_high"), at("low", F.col("k") - 1).alias("before_low"),
        F.col("k").cast("long").alias("depth"), "conv_id", at("bytes", F.col("k")).cast("long").alias("bytes"),
        (F.col("whole") & (F.col("k") == F.col("m"))).alias("ends"))
    # Own turns after the first h: the number of a prefix without its head, put after the new head.
    rest = plan.where("NOT whole").select(
        F.col("conv_id").alias("c"), "n", "h", "m", at("high", F.col("m")).alias("new_high"), at("low", F.col("m")).alias("new_low"),
        F.get("high", F.col("h")).alias("old_high"), F.get("low", F.col("h")).alias("old_low"))
    own = turns.join(rest, F.col("conv_id") == F.col("c")).where("place > h")

    def moved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            new, old = (_numbers(batch[f"{k}_high"], batch[f"{k}_low"]) for k in ("new", "old"))
            sizes = (batch["place"].to_numpy() - batch["h"].to_numpy()).tolist()
            both = []
            for name, less in (("", 0), ("before_", 1)):
                numbers = _numbers(batch[f"{name}high"], batch[f"{name}low"])
                both += _halves([
                    n if a == b else ((a - b) * pow(BASE, size - less, PRIME) + n) % PRIME
                    for n, a, b, size in zip(numbers, new, old, sizes, strict=True)])
            depth = batch["place"].to_numpy() - batch["h"].to_numpy() + batch["m"].to_numpy()
            yield pa.RecordBatch.from_arrays(
                [*map(pa.array, both), pa.array(depth.astype(np.int64)), batch["conv_id"], batch["bytes"],
                 pa.array(batch["place"].to_numpy() == batch["n"].to_numpy())],
                names=["high", "low", "before_high", "before_low", "depth", "conv_id", "bytes", "ends"])

    schema = "high long, low long, before_high long, before_low long, depth long, conv_id long, bytes long, ends boolean"
    return head.unionByName(own.mapInArrow(moved, schema))


def _coin(conv_id: Column, depth: Column, number: int) -> Column:
    """A fixed draw per node and round; never for a root."""
    return (depth > 0) & (F.xxhash64(conv_id, depth, F.lit(number)) % 2 == 0)


def subtree_totals(tree: DataFrame) -> DataFrame:
    """conv_id, depth, n_leaves and saved, summed over the subtree of every node.

    ``tree``: conv_id, depth (together the name of a node; roots alone have depth 0), up_conv_id and
    up_depth (its parent, null for a root), n_children, n_leaves and saved (the node's own).

    Parallel tree contraction. A round first rakes: all leaves go, their totals are final and are
    added to the parents. Then it compresses: nodes with one child left go if a coin fell for them
    and not for their parent, so no two neighbours go; the child hangs on the grandparent and keeps,
    as a load, what it must add there. Rounds grow with the logarithm of the nodes, however deep
    the tree is. Last, in reverse order, every compressed node gets its child's total and the load.
    Each round is a written table."""
    tree = tree.withColumns({"load_leaves": F.lit(0).cast("long"), "load_saved": F.lit(0).cast("long")})
    finished, passed, number = [], [], 0
    names = ["conv_id", "depth", "up_conv_id", "up_depth", "n_children", "n_leaves", "saved", "load_leaves", "load_saved"]
    while True:
        leaves, rest = tree.where("n_children = 0"), tree.where("n_children > 0")
        finished.append(leaves.select("conv_id", "depth", "n_leaves", "saved"))
        if rest.isEmpty():
            break
        gains = leaves.where("up_depth IS NOT NULL").groupBy(F.col("up_conv_id").alias("c"), F.col("up_depth").alias("d")).agg(
            F.count("*").alias("gone"), F.sum(F.col("n_leaves") + F.col("load_leaves")).alias("more_leaves"),
            F.sum(F.col("saved") + F.col("load_saved")).alias("more_saved"))
        more = {"n_children": -F.coalesce("gone", F.lit(0)), "n_leaves": F.coalesce("more_leaves", F.lit(0)), "saved": F.coalesce("more_saved", F.lit(0))}
        raked = rest.join(gains, (F.col("conv_id") == F.col("c")) & (F.col("depth") == F.col("d")), "left")
        raked = stored(raked.select(*(F.col(c) + more[c] if c in more else F.col(c) for c in names)).toDF(*names), "raked")
        own, above = (_coin(F.col(c), F.col(d), number) for c, d in (("conv_id", "depth"), ("up_conv_id", "up_depth")))
        goes = F.coalesce((F.col("n_children") == 1) & F.col("up_depth").isNotNull() & own & ~above, F.lit(False))
        gone = raked.where(goes).select(*(F.col(c).alias(f"gone_{c}") for c in names))
        stays = raked.where(~goes)
        under = F.coalesce(above, F.lit(False))
        hung = stays.where(under).join(
            gone, (F.col("up_conv_id") == F.col("gone_conv_id")) & (F.col("up_depth") == F.col("gone_depth")), "left")
        found = F.col("gone_depth").isNotNull()
        hung = hung.select(
            "conv_id", "depth", *(F.when(found, F.col(f"gone_{c}")).otherwise(F.col(c)).alias(c) for c in ("up_conv_id", "up_depth")),
            "n_children", "n_leaves", "saved",
            (F.col("load_leaves") + F.when(found, F.col("gone_n_leaves") + F.col("gone_load_leaves")).otherwise(0)).alias("load_leaves"),
            (F.col("load_saved") + F.when(found, F.col("gone_saved") + F.col("gone_load_saved")).otherwise(0)).alias("load_saved"),
            F.col("gone_conv_id").alias("for_conv_id"), F.col("gone_depth").alias("for_depth"),
            (F.col("load_leaves") + F.col("gone_n_leaves")).alias("add_leaves"), (F.col("load_saved") + F.col("gone_saved")).alias("add_saved"))
        tree = stored(stays.where(~under).unionByName(hung, allowMissingColumns=True), "compressed")
        passed.append(tree.where("for_depth IS NOT NULL").select("conv_id", "depth", "for_conv_id", "for_depth", "add_leaves", "add_saved"))
        tree = tree.select(*names)
        number += 1
    totals = stored(reduce(DataFrame.unionByName, finished), "totals")
    for links in reversed(passed):
        known = totals.select(F.col("conv_id").alias("c"), F.col("depth").alias("d"), "n_leaves", "saved")
        again = links.join(known, (F.col("conv_id") == F.col("c")) & (F.col("depth") == F.col("d"))).select(
            F.col("for_conv_id").alias("conv_id"), F.col("for_depth").alias("depth"),
            (F.col("n_leaves") + F.col("add_leaves")).alias("n_leaves"), (F.col("saved") + F.col("add_saved")).alias("saved"))
        totals = totals.unionByName(stored(again, "totals"))
    return totals


def ends_digests(ends: DataFrame) -> DataFrame:
    """high, low and ends_sha256: of the comma-joined ids of the conversations (high, low, conv_id)
    that end at a prefix, in ascending order.

    Ids are sorted over all tasks, so those of one prefix may lie in several; each task makes the
    text of its part. SHA-256 has to be taken in order, so only the parts of lists that reach over
    a task's edge, as texts of up to 50,000 ids a row, meet in one task, which keeps none of them."""
    rows = ends.repartitionByRange("high", "low", "conv_id").sortWithinPartitions("high", "low", "conv_id")
    out = pa.schema([("high", pa.int64()), ("low", pa.int64()), ("seq", pa.int64()), ("ends_sha256", pa.string()), ("ids", pa.string())])

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # The first list may have begun in the task before, the last one may go on in the next.
        key, ids, cut, done = None, [], True, []

        def end(whole: bool) -> None:
            text = ",".join(map(str, ids))
            done.append((*key, ids[0], hashlib.sha256(text.encode()).hexdigest() if whole else None, None if whole else text))

        def flushed() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(map(list, zip(*done, strict=True)), out.types, strict=True)], schema=out)
            done.clear()
            return batch

        for batch in batches:
            for h, low, c in zip(*(batch[n].to_pylist() for n in ("high", "low", "conv_id")), strict=True):
                if (h, low) != key:
                    if ids:
                        end(whole=not cut)
                        cut = False
                    key, ids = (h, low), []
                elif len(ids) == PIECE_IDS:
                    end(whole=False)
                    cut, ids = True, []
                    yield flushed()
                ids.append(c)
            if len(done) >= ROWS:
                yield flushed()
        if ids:
            end(whole=False)
        if done:
            yield flushed()

    def chained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, digest, done = None, None, []
        for batch in batches:
            for h, low, ids in zip(*(batch[n].to_pylist() for n in ("high", "low", "ids")), strict=True):
                if (h, low) == key:
                    digest.update(b"," + ids.encode())
                else:
                    if key is not None:
                        done.append((*key, digest.hexdigest()))
                    key, digest = (h, low), hashlib.sha256(ids.encode())
        if key is not None:
            done.append((*key, digest.hexdigest()))
        for n in range(0, len(done), ROWS):
            yield pa.RecordBatch.from_pydict(dict(zip(("high", "low", "ends_sha256"), map(list, zip(*done[n : n + ROWS], strict=True)), strict=True)))

    found = stored(rows.mapInArrow(runs, "high long, low long, seq long, ends_sha256 string, ids string"), "ends")
    parts = found.where("ids IS NOT NULL").select("high", "low", "seq", "ids").repartition("high", "low").sortWithinPartitions("high", "low", "seq")
    return found.where("ids IS NULL").select("high", "low", "ends_sha256").unionByName(
        parts.mapInArrow(chained, "high long, low long, ends_sha256 string"))


def prefix_trie(turns: DataFrame) -> DataFrame:
    """One row per distinct prefix of the rebuilt conversations, the empty one included: conv_id (its
    smallest member), depth, parent_conv_id (null for the root), n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256.

    Nulls: a null role or text is empty, a null turn comes first, a row without conv_id belongs to
    no conversation and takes no part. Turns of equal number, repeated rows included, all stay,
    ordered by a digest of role and text. Empty texts make nodes like others. A very long text is
    only digested; a conversation of very many turns, or a prefix of very many conversations, is
    spread over tasks. No conversation at all gives no rows. Other columns are not looked at."""
    visits = stored(rebuilt_visits(turns), "visits")
    nodes = visits.where("depth > 0").groupBy("high", "low").agg(
        F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"),
        *(F.max(c).alias(c) for c in ("depth", "bytes", "before_high", "before_low")))
    nodes = stored(nodes, "nodes")
    names = ["high", "low", "conv_id", "depth", "up_conv_id", "up_depth", "n_convs", "bytes"]
    smallest, members = turns.agg(F.min(F.col("conv_id").cast("long")), F.count_distinct(F.col("conv_id"))).first()
    root = turns.sparkSession.createDataFrame(
        [(ROOT >> 64, ROOT, smallest, 0, None, None, members, 0)] if members else [], ", ".join(f"{n} long" for n in names))
    # Nodes of depth 1 need no look-up of their parent, the root, which would be a hot key.
    top = nodes.where("depth = 1").withColumns({"up_conv_id": F.lit(smallest).cast("long"), "up_depth": F.lit(0).cast("long")})
    ups = nodes.select(F.col("high").alias("h"), F.col("low").alias("l"), F.col("conv_id").alias("up_conv_id"), F.col("depth").alias("up_depth"))
    deep = nodes.where("depth > 1").join(ups, (F.col("before_high") == F.col("h")) & (F.col("before_low") == F.col("l")))
    nodes = stored(root.unionByName(top.select(*names)).unionByName(deep.select(*names)), "nodes")
    children = nodes.where("up_depth IS NOT NULL").groupBy(F.col("up_conv_id").alias("c"), F.col("up_depth").alias("d")).agg(F.count("*").alias("n_children"))
    tree = nodes.join(children, (F.col("conv_id") == F.col("c")) & (F.col("depth") == F.col("d")), "left").select(
        *names, F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children"))
    tree = stored(tree.withColumns({
        "n_leaves": (F.col("n_children") == 0).cast("long"), "saved": (F.col("n_convs") - 1) * F.col("bytes")}), "tree")
    totals = subtree_totals(tree.select("conv_id", "depth", "up_conv_id", "up_depth", "n_children", "n_leaves", "saved"))
    totals = totals.select(F.col("conv_id").alias("c"), F.col("depth").alias("d"), F.col("n_leaves").alias("all_leaves"), F.col("saved").alias("saved_tokens"))
    ends = ends_digests(visits.where("ends").select("high", "low", "conv_id")).select(F.col("high").alias("h"), F.col("low").alias("l"), "ends_sha256")
    found = tree.join(totals, (F.col("conv_id") == F.col("c")) & (F.col("depth") == F.col("d"))).join(
        ends, (F.col("high") == F.col("h")) & (F.col("low") == F.col("l")), "left")
    return found.select(
        "conv_id", "depth", F.col("up_conv_id").alias("parent_conv_id"), "n_convs", "n_children", F.col("all_leaves").alias("n_leaves"),
        "saved_tokens", F.coalesce("ends_sha256", F.lit(NO_ENDS)).alias("ends_sha256"))
