"""Counting pairs where their members meet, without a row per pair and key.

Members are dealt into blocks of about ``BLOCK_ROWS`` rows. A block is stored once, packed in two orders: by member and by
key. A cell opens two blocks where they are stored (Spark brings them where tasks cannot, as in folders that are no mounted
file system), so its counts are final, no pair is shuffled, and what is shuffled
and stored grows with the rows, however many blocks there are. Where a block is much larger, because of members with very
many keys, keys are dealt into parts as well, whose counts are summed.
"""

from __future__ import annotations

import glob
import re
import struct
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from minelark.plans.lineage import new_path, settle

BLOCK_ROWS = 4_000_000
LEAST_ROWS = 65_536  # a block has fewer only where there are few rows
LEAST_BLOCKS = 12
BUFFER_ROWS = 1_000_000
CHUNK_PAIRS = 1_000_000
LEVELS = 64  # counts told apart when looking for the best


def pack_integers(arrays: Sequence[np.ndarray]) -> bytes:
    """Arrays of whole numbers as compressed bytes, each in the narrowest type that holds it; also of doubles."""
    parts = []
    for a in arrays:
        if a.dtype.kind == "f":
            parts += [struct.pack("<qq", 0, len(a)), a.astype("<f8").tobytes()]
            continue
        low, high = (int(a.min()), int(a.max())) if len(a) else (0, 0)
        width = next(w for w in (1, 2, 4, 8) if -(1 << 8 * w - 1) <= low and high < 1 << 8 * w - 1)
        parts += [struct.pack("<qq", width, len(a)), a.astype(f"<i{width}").tobytes()]
    data = b"".join(parts)
    return struct.pack("<q", len(data)) + pa.compress(data, codec="zstd", asbytes=True)


def _narrow(packed: bytes) -> list[np.ndarray]:
    data = pa.decompress(packed[8:], decompressed_size=struct.unpack_from("<q", packed)[0], codec="zstd", asbytes=True)
    out, at = [], 0
    while at < len(data):
        width, n = struct.unpack_from("<qq", data, at)
        out.append(np.frombuffer(data, f"<i{width}" if width else "<f8", n, at + 16))
        at += 16 + (width or 8) * n
    return out


def unpack_integers(packed: bytes) -> list[np.ndarray]:
    """The arrays of :func:`pack_integers`, as 64-bit numbers."""
    return [a.astype(np.float64 if a.dtype.kind == "f" else np.int64) for a in _narrow(packed)]


def _steps(a: np.ndarray) -> np.ndarray:
    return np.diff(a, prepend=a.dtype.type(0))


def _dealt(ids: np.ndarray, among: int) -> np.ndarray:
    """A number below ``among`` for each id, from a hash of it."""
    mixed = (ids.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    mixed = (mixed ^ mixed >> np.uint64(29)) * np.uint64(0xBF58476D1CE4E5B9)
    return ((mixed ^ mixed >> np.uint64(32)) % np.uint64(among)).astype(np.int64)


def opened_by_tasks(path: str) -> bool:
    """Whether the shared folder is a mounted file system, on which tasks can open files."""
    return re.match("(file:)?/", path) is not None


def _packed_rows(floats: Sequence[str]):
    """Chunks ``n, data`` of rows of two whole numbers, sorted; a float has its nulls in an array of its own."""

    def emit(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(held)
        one, other = (table[c].to_numpy().astype(np.int64) for c in (0, 1))
        order = np.lexsort((other, one))
        columns = [_steps(one[order]), other[order]]
        for c in floats:
            missing = table[c].is_null().to_numpy()
            columns += [np.where(missing, 0.0, table[c].fill_null(0.0).to_numpy())[order], missing[order].astype(np.int64)]
        return pa.RecordBatch.from_pydict({
            "n": pa.array([len(order)], pa.int64()), "data": pa.array([pack_integers(columns)], pa.binary()),
        })

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for batch in batches:
            held.append(batch)
            rows += batch.num_rows
            if rows >= BUFFER_ROWS:
                yield emit(held)
                held, rows = [], 0
        if rows:
            yield emit(held)

    return chunks


def _pieces(blocks: int, parts: int, barring: bool):
    """Chunks cut by the block and part that their rows belong to; pairs to leave out by both of their blocks, in every part."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for data in (d for batch in batches for d in batch["data"].to_pylist()):
            steps, other, *floats = unpack_integers(data)
            one = np.cumsum(steps)
            p = _dealt(one, blocks)
            if barring:
                q = _dealt(other, blocks)
                turned = (p > q) | ((p == q) & (one > other))
                one, other = np.where(turned, other, one), np.where(turned, one, other)
                code = np.minimum(p, q) * blocks + np.maximum(p, q)
                order = np.lexsort((other, one, code))
            else:
                code = p * parts + _dealt(other, parts)
                order = np.argsort(code, kind="stable")
            code = code[order]
            edges = np.flatnonzero(np.append(True, code[1:] != code[:-1]))[: len(code)]
            rows = []
            for start, some in zip(edges, np.split(order, edges[1:])):
                packed = pack_integers([_steps(one[some]), other[some], *[f[some] for f in floats]])
                at = int(code[start])
                if barring:
                    rows += [(at // blocks, r, at % blocks, packed) for r in range(parts)]
                else:
                    rows.append((at // parts, at % parts, -1, packed))
            p, r, q, packed = zip(*rows)
            yield pa.RecordBatch.from_pydict({
                "p": pa.array(p, pa.int32()), "r": pa.array(r, pa.int32()), "q": pa.array(q, pa.int32()), "data": pa.array(packed, pa.binary()),
            })

    return cut


def _stored_block(blocks: int, weighted: bool):
    """All pieces of a block as one row: its rows by member, its rows by key, and the pairs to leave out by the other block."""

    def whole(pieces: list[bytes]) -> list[np.ndarray]:
        columns = [np.concatenate(c) for c in zip(*[(np.cumsum(steps), *rest) for steps, *rest in map(unpack_integers, pieces)])]
        return columns

    def block(table: pa.Table) -> pa.Table:
        pieces: dict[int, list[bytes]] = {}
        for q, data in zip(table["q"].to_pylist(), table["data"].to_pylist()):
            pieces.setdefault(q, []).append(data)
        out = {"p": table["p"][:1], "r": table["r"][:1]}
        if -1 not in pieces:
            return pa.table({**out, "members": pa.array([], pa.binary()), "keys": pa.array([], pa.binary()), "barred": pa.array([], pa.list_(pa.binary()))} | {c: v[:0] for c, v in out.items()})
        member, key, *floats = whole(pieces.pop(-1))
        names, keys = np.unique(member), np.unique(key)
        code = np.searchsorted(names, member) * len(keys) + np.searchsorted(keys, key)
        del member, key
        if floats:
            order = np.argsort(code, kind="stable")
            code, floats = code[order], [f[order] for f in floats]
        else:
            code.sort()
        own, at = code // len(keys), code % len(keys)
        first = np.flatnonzero(np.append(True, own[1:] != own[:-1]))
        weights, extra = (floats[:2], floats[2:]) if weighted else ([], floats)
        extra = [f[first] for f in extra]
        members = pack_integers([_steps(names), np.bincount(own, minlength=len(names)), _steps(keys), _steps(at), *weights, *extra])
        order = np.argsort(at, kind="stable")
        by_key = pack_integers([
            _steps(names), np.bincount(at, minlength=len(keys)), _steps(keys), _steps(own[order]), *[w[order] for w in weights], *extra
        ])
        barred: list[bytes | None] = [None] * (blocks if pieces else 0)
        for q, some in pieces.items():
            one, other = whole(some)
            place = np.minimum(np.searchsorted(names, one), len(names) - 1)
            known = names[place] == one
            place, other = place[known], other[known]
            order = np.lexsort((other, place))
            place, other = place[order], other[order]
            first = np.append(True, (place[1:] != place[:-1]) | (other[1:] != other[:-1]))[: len(place)]
            barred[q] = pack_integers([_steps(place[first]), other[first]])
        return pa.table({**out, "members": pa.array([members], pa.binary()), "keys": pa.array([by_key], pa.binary()), "barred": pa.array([barred], pa.list_(pa.binary()))})

    return block


class _Side:
    """A block: its members, how many rows each member (or key) has, its keys, and the place of the key (or member) in each row."""

    def __init__(self, packed: bytes, weighted: bool):
        names, counts, keys, places, *floats = _narrow(packed)
        self.names, self.keys = np.cumsum(names, dtype=np.int64), np.cumsum(keys, dtype=np.int64)
        self.places, self.counts = np.cumsum(places, dtype=np.int32), counts.astype(np.int32)
        self.first = np.cumsum(counts, dtype=np.int64) - counts
        self.weights, self.extra = (floats[:2], floats[2:]) if weighted else ([], floats)


def _counted(code: np.ndarray, span: int, products: np.ndarray | None, lost: np.ndarray | None) -> list[np.ndarray]:
    """Distinct codes, how often each occurs, the sum of its products and how many of these are not null."""
    if span <= 8 * len(code) + 65_536:
        n = np.bincount(code, minlength=span)
        at = np.flatnonzero(n)
        if products is None:
            return [at, n[at]]
        dot = np.bincount(code, products, span)[at]
        return [at, n[at], dot, n[at] if lost is None else n[at] - np.bincount(code, lost, span)[at].astype(np.int64)]
    if products is None:
        code = np.sort(code)
    else:
        order = np.argsort(code)
        code = code[order]
    first = np.flatnonzero(np.append(True, code[1:] != code[:-1]))[: len(code)]
    n = np.diff(np.append(first, len(code)))
    code = code[first].astype(np.int64)
    if products is None:
        return [code, n]
    dot = np.add.reduceat(products[order], first) if len(first) else np.empty(0)
    left = n if lost is None else n - np.add.reduceat(lost[order], first).astype(np.int64)
    return [code, n, dot, left]


def _merged(parts: list[list[np.ndarray]]) -> list[np.ndarray]:
    if len(parts) == 1:
        return parts[0]
    code, at = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
    out = [code]
    for k in range(1, len(parts[0])):
        values = np.concatenate([p[k] for p in parts])
        sums = np.zeros(len(code), values.dtype)
        np.add.at(sums, at, values)
        out.append(sums)
    return out


def _cell(x: _Side, y: _Side, own: str, barred: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
    """``x code, y code, n`` and with weights ``dot, products``, of every pair of x by member and y by key, in parts of whole
    members of x. With ``own`` both are the same block, and a pair comes once (``once``) or from both ends (``twice``)."""
    if not len(x.names) or not len(y.names):
        return
    place = np.minimum(np.searchsorted(y.keys, x.keys), len(y.keys) - 1)
    shared, where = np.where(y.keys[place] == x.keys, y.counts[place], np.int32(0)), y.first[place]
    group = np.cumsum(np.add.reduceat(shared[x.places], x.first, dtype=np.int64)) // CHUNK_PAIRS
    cuts = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
    many = len(y.names)
    for low, high in zip(cuts, [*cuts[1:], len(x.names)]):
        begin = x.first[low]
        places = x.places[begin : x.first[high - 1] + x.counts[high - 1]]
        width = shared[places]
        rows = np.flatnonzero(width)
        if not len(rows):
            continue
        of_row, start = np.repeat(np.arange(high - low), x.counts[low:high]), where[places]
        span = int(high - low) * many
        kind = np.int32 if span < 1 << 31 else np.int64
        parts = []
        for some in np.array_split(rows, max(1, int(width[rows].sum(dtype=np.int64)) // (4 * CHUNK_PAIRS))):
            n = width[some]
            yi = np.arange(n.sum(dtype=np.int64)) + np.repeat(start[some] - (np.cumsum(n, dtype=np.int64) - n), n)
            at = y.places[yi]
            code = np.repeat(of_row[some].astype(kind) * kind(many), n) + at
            kept = None
            if own:
                me = np.repeat(of_row[some] + low, n)
                kept = me < at if own == "once" else me != at
                code = code[kept]
            products = lost = None
            if x.weights:
                (w, no), (v, none) = ((np.repeat(f[begin + some], n) for f in x.weights), (f[yi] for f in y.weights))
                products, lost = w * v * 1.0, np.maximum(no, none)
                if kept is not None:
                    products, lost = products[kept], lost[kept]
                if lost.any():
                    products = np.where(lost > 0, 0.0, products)
                else:
                    lost = None
            parts.append(_counted(code, span, products, lost))
        found = _merged(parts)
        code = found[0] + low * many
        out = barred[np.searchsorted(barred, low * many) : np.searchsorted(barred, high * many)]
        if len(out) and len(code):
            at = np.minimum(np.searchsorted(code, out), len(code) - 1)
            kept = np.ones(len(code), bool)
            kept[at[code[at] == out]] = False
            code, found = code[kept], [f[kept] for f in found]
        if len(code):
            i = code // many
            yield (i, code - i * many, *found[1:])


def _leading(group: np.ndarray, other: np.ndarray, n: np.ndarray, best: int) -> tuple[np.ndarray, ...]:
    """The rows of each group with the greatest ``n``, equal ones by ``other``."""
    if not len(group):
        return group, other, n
    low = group.min()
    level = np.minimum(n, LEVELS - 1)
    rows = np.bincount((group - low) * LEVELS + level, minlength=(int(group.max() - low) + 1) * LEVELS).reshape(-1, LEVELS)
    enough = (rows[:, ::-1].cumsum(axis=1)[:, ::-1] >= best).sum(axis=1) - 1  # of a group, the greatest count that so many reach
    kept = level >= enough[group - low]
    group, other, n = group[kept], other[kept], n[kept]
    order = np.lexsort((other, -n, group))
    group, other, n = group[order], other[order], n[order]
    kept = np.arange(len(group)) - np.searchsorted(group, group) < best
    return group[kept], other[kept], n[kept]


class _Best:
    """The ``best`` of each member of a block, while its cells come one after another."""

    def __init__(self, members: int, best: int):
        self.best, self.rows, self.least = best, 0, np.ones(members, np.int64)
        self.held: list[tuple[np.ndarray, ...]] = []

    def add(self, i: np.ndarray, other: np.ndarray, n: np.ndarray) -> None:
        kept = n >= self.least[i]
        found = _leading(i[kept], other[kept], n[kept], self.best)
        self.held.append(found)
        self.rows += len(found[0])

    def gather(self) -> tuple[np.ndarray, ...]:
        group, other, n = _leading(*(np.concatenate(c) for c in zip(*self.held)), self.best)
        self.held, self.rows = [(group, other, n)], 0
        last = np.flatnonzero(np.append(group[1:] != group[:-1], True))[: len(group)]
        full = np.bincount(group, minlength=len(self.least))[group[last]] == self.best
        self.least[group[last[full]]] = n[last[full]]
        return group, other, n


def totals(
    rows: DataFrame,
    keys: list[str],
    member: str,
    weight: str | None = None,
    without: DataFrame | None = None,
    of_member: Sequence[str] = (),
    best: int | None = None,
) -> DataFrame:
    """``a, b, n``, with a weight ``dot``, and ``a_<name>, b_<name>`` of :func:`minelark.plans.skew.pair_totals`, for integer members.

    With ``best``, which takes no weight, pairs come in both orders, and only the ``best`` of a member ``a``, by ``n`` and
    then by the lowest ``b``: a task meets a block with all others in turn. For few blocks, the others are shared by a few
    tasks, each of which gives its best. Where counts have to be summed, all pairs are given.
    """
    kind = dict(rows.dtypes)[member]
    spark = rows.sparkSession
    weighted, extra = weight is not None, list(of_member)
    floats = ([weight] if weight else []) + extra
    names = [f"_f{at}" for at in range(len(floats))]
    values = [F.col(member).cast("bigint").alias("_m"), F.col("_k"), *[F.col(c).cast("double").alias(f) for c, f in zip(floats, names)]]
    kept = hasattr(rows, "_settled_at")  # stored by the caller, so it need not be stored again
    rows = rows.where(F.col(member).isNotNull())
    if len(keys) == 1 and dict(rows.dtypes)[keys[0]] in ("bigint", "int"):
        held = rows.where(F.col(keys[0]).isNotNull()).withColumn("_k", F.col(keys[0]).cast("bigint")).select(*values)
    else:  # number the keys
        numbers = settle(rows.select(*keys).distinct().withColumn("_k", F.monotonically_increasing_id()))
        held = rows.join(numbers, keys).select(*values)
    chunks = held.mapInArrow(_packed_rows(names), "n bigint, data binary")
    if not kept:
        chunks = settle(chunks)
    count = held.count() if kept else chunks.agg(F.sum("n")).first()[0] or 0
    blocks = int(max(-(-count // BLOCK_ROWS), min(LEAST_BLOCKS, -(-count // LEAST_ROWS)), 1))

    def sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(blocks, np.int64)
        for data in (d for batch in batches for d in batch["data"].to_pylist()):
            n += np.bincount(_dealt(np.cumsum(unpack_integers(data)[0]), blocks), minlength=blocks)
        yield pa.RecordBatch.from_pydict({"p": pa.array(range(blocks), pa.int32()), "n": pa.array(n)})

    if kept:  # by another hash, which a member with very many keys makes as uneven
        sized = held.groupBy(F.pmod(F.xxhash64("_m"), F.lit(blocks)).alias("p")).agg(F.count(F.lit(1)).alias("n"))
    else:
        sized = chunks.mapInArrow(sizes, "p int, n bigint").groupBy("p").agg(F.sum("n").alias("n"))
    most = sized.agg(F.max("n")).first()[0] or 0
    parts = int(max(1, -(-most // (2 * BLOCK_ROWS))))
    shape = "p int, r int, q int, data binary"
    pieces = chunks.mapInArrow(_pieces(blocks, parts, False), shape)
    if without is not None:
        ends = without.where("a is not null and b is not null").select(F.col("a").cast("bigint"), F.col("b").cast("bigint"))
        ends = ends.mapInArrow(_packed_rows([]), "n bigint, data binary")
        pieces = pieces.unionByName(ends.mapInArrow(_pieces(blocks, parts, True), shape))
    many = blocks * parts
    dealt = pieces.repartition(min(4 * many, max(many, 256)), "p", "r").groupBy("p", "r")
    layout = "p int, r int, members binary, keys binary, barred array<binary>"
    path = new_path(spark)
    dealt.applyInArrow(_stored_block(blocks, weighted), layout).write.partitionBy("p", "r").parquet(path)

    # x is read by member and meets every y, which is read by key; no block is shuffled
    slots = 3 * spark.sparkContext.defaultParallelism
    shares = 1 if best is None else min(blocks, -(-slots // many))  # of the blocks that one meets, for each of a few tasks
    opened = opened_by_tasks(path)
    if opened:
        cells = blocks * (blocks + 1) // 2 * parts if best is None else many * shares
        tasks = spark.range(0, cells, 1, min(cells, 6 * slots))
    else:
        stored = spark.read.schema(layout).parquet(path)
        x = stored.select(F.col("p").alias("lo"), F.col("r").alias("part"), "members", F.col("barred").alias("_out"))
        y = stored.select(F.col("p").alias("hi"), "r", "keys", F.col("barred").alias("_in"))
        met = F.col("part") == F.col("r")
        if best is None:
            met = met & (F.col("lo") <= F.col("hi"))
        else:
            y = y.coalesce(shares)
        out = F.when(F.col("lo") <= F.col("hi"), F.get("_out", F.col("hi"))).otherwise(F.get("_in", F.col("lo")))
        tasks = y.join(x.hint("shuffle_replicate_nl"), met).select("lo", "hi", "r", "members", "keys", out.alias("barred"))
    barring = without is not None
    types = {"a": kind, "b": kind, "n": "bigint"} | ({"dot": "double"} if weighted else {})
    types |= {f"{end}_{c}": "double" for c in extra for end in "ab"}
    width = pa.int64() if kind == "bigint" else pa.int32()

    def left_out(x: _Side, y: _Side, lo: int, hi: int, packed: bytes | None) -> np.ndarray:
        """Codes of the pairs to leave out: they are stored with the lower block, as places in it and ids of the other."""
        if packed is None or not len(x.names) or not len(y.names):
            return np.empty(0, np.int64)
        steps, ids = unpack_integers(packed)
        place = np.cumsum(steps)
        other = (y if lo <= hi else x).names
        at = np.minimum(np.searchsorted(other, ids), len(other) - 1)
        known = other[at] == ids
        place, at = place[known], at[known]
        one, two = (place, at) if lo <= hi else (at, place)
        codes = [one * len(y.names) + two] + ([two * len(y.names) + one] if lo == hi else [])
        return np.unique(np.concatenate(codes))

    def batches_of(columns: dict[str, pa.Array]) -> Iterator[pa.RecordBatch]:
        whole = pa.RecordBatch.from_arrays([columns[c] for c in types], names=list(types))
        yield from (whole.slice(s, 1 << 18) for s in range(0, whole.num_rows, 1 << 18))

    def ids(a: np.ndarray, b: np.ndarray, n: np.ndarray) -> dict[str, pa.Array]:
        return {"a": pa.array(a, width), "b": pa.array(b, width), "n": pa.array(n, pa.int64())}

    def numbered(ids: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """``lo, hi, r`` of the cells of numbered tasks, those of one block after another."""
        first, other = np.triu_indices(blocks)
        for at in map(int, ids):
            if best is None:
                cell, r = at % len(first), at // len(first)
                yield int(first[cell]), int(other[cell]), r
            else:
                block, share = divmod(at, shares)
                lo, r = divmod(block, parts)
                yield from ((lo, hi, r) for hi in range(share, blocks, shares))

    def stored_in(p: int, r: int, column: str):
        """What is stored of a block, or nothing for an empty one."""
        files = glob.glob(f"{glob.escape(re.sub('^file:/*', '/', path))}/p={p}/r={r}/*.parquet")
        return pq.ParquetFile(files[0]).read(columns=[column])[column][0] if files else None

    def sides(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int, _Side, _Side, np.ndarray]]:
        """The cells of a task; a block that comes again at once is kept."""
        held: dict[str, tuple] = {"members": (None, None), "keys": (None, None)}

        def side(name: str, at: tuple[int, int], packed) -> _Side | None:
            if held[name][0] != at:
                held[name] = (None, None)
                value = packed()
                held[name] = (at, None if value is None else _Side(value.as_py(), weighted))
            return held[name][1]

        for batch in batches:
            if opened:
                for lo, hi, r in numbered(batch["id"].to_numpy()):
                    x, y = (side(name, (p, r), lambda: stored_in(p, r, name)) for name, p in (("members", lo), ("keys", hi)))
                    if x is None or y is None:
                        continue
                    listed = stored_in(min(lo, hi), r, "barred") if barring else ()
                    barred = listed[max(lo, hi)].as_py() if len(listed) else None
                    yield lo, hi, x, y, left_out(x, y, lo, hi, barred)
                continue
            for at in range(batch.num_rows):
                lo, hi, r = (batch[c][at].as_py() for c in ("lo", "hi", "r"))
                x, y = (side(name, (p, r), lambda: batch[name][at]) for name, p in (("members", lo), ("keys", hi)))
                yield lo, hi, x, y, left_out(x, y, lo, hi, batch["barred"][at].as_py())

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lo, hi, x, y, barred in sides(batches):
            for i, j, n, *dots in _cell(x, y, "once" if lo == hi else "", barred):
                left, right = x.names[i], y.names[j]
                swap = left > right
                columns = ids(np.where(swap, right, left), np.where(swap, left, right), n)
                if weighted:
                    columns["dot"] = pa.array(dots[0], mask=dots[1] == 0)
                for at, c in enumerate(extra):
                    (v, v_lost), (w, w_lost) = ([s.extra[2 * at + k][codes] for k in (0, 1)] for s, codes in ((x, i), (y, j)))
                    columns[f"a_{c}"] = pa.array(np.where(swap, w, v), mask=np.where(swap, w_lost, v_lost) > 0)
                    columns[f"b_{c}"] = pa.array(np.where(swap, v, w), mask=np.where(swap, v_lost, w_lost) > 0)
                yield from batches_of(columns)

    def lead(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple[np.ndarray, _Best]] = {}
        for lo, hi, x, y, barred in sides(batches):
            if parts == 1:
                own = held.setdefault(lo, (x.names, _Best(len(x.names), best)))[1]
            for i, j, n in _cell(x, y, "twice" if lo == hi else "", barred):
                if parts == 1:
                    own.add(i, y.names[j], n)
                    if own.rows > 4 * CHUNK_PAIRS:
                        own.gather()
                else:
                    yield from batches_of(ids(x.names[i], y.names[j], n))
            if parts == 1 and own.held:
                own.gather()
        for known, own in held.values():
            if own.held:
                group, other, n = own.gather()
                yield from batches_of(ids(known[group], other, n))

    found = tasks.mapInArrow(meet if best is None else lead, ", ".join(f"`{c}` {t}" for c, t in types.items()))
    if parts == 1:
        return found
    sums = [F.sum(c).alias(c) for c in types if c in ("n", "dot")]
    return found.groupBy("a", "b", *[c for c in types if c[:2] in ("a_", "b_")]).agg(*sums)
