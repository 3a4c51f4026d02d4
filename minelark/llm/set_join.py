"""A similarity join of documents on word n-grams: rare-first prefixes, with length, positional and suffix filters."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from minelark.llm.components import components
from minelark.llm.ngram_model import pack, summed, unpack
from minelark.llm.texts import distinct, quoted, shingle_sets, slices, whole, with_columns
from minelark.plans.lineage import new_path, release, settle

WORDS = 3
PERCENT = 90
CHUNK_SHINGLES = 300_000
SHARD_SHINGLES = 500_000
HASH_BITS = 48
STRAYS, MEMBERS = 256, 1024
SALTS = 32
PIVOTS = 32

_CHUNK = pa.schema([
    ("chunk", pa.int64()), ("shard", pa.int32()), ("doc_id", pa.int64()), ("n", pa.int64()), ("print", pa.binary()), ("data", pa.binary()),
    ("part", pa.string()),
])


def least_overlap(n: np.ndarray, m: int, percent: int) -> np.ndarray:
    """How many shingles sets of these sizes must share to be similar."""
    return -(-percent * (n + m) // (100 + percent))


def prefix_length(n: int, percent: int) -> int:
    """How many of its rarest shingles a set is joined on: one of them is shared with every similar set."""
    return n - -(-percent * n // 100) + 1


def pack_places(places: np.ndarray) -> bytes:
    """Sorted places as differences of two bytes each, or four where one does not fit."""
    steps = np.diff(places, prepend=0)
    wide = len(steps) and int(steps.max()) >= 1 << 16
    return bytes([wide]) + steps.astype("<u4" if wide else "<u2").tobytes()


def unpack_places(blob: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(blob, "<u4" if blob[0] else "<u2", offset=1).astype(np.int64))


def chunks(docs: DataFrame, shards: int, chunk_shingles: int = CHUNK_SHINGLES) -> DataFrame:
    """Documents as chunks of about ``chunk_shingles`` shingles, in rows of two kinds.

    Per document (``part`` is ``sets``): the size ``n`` of its set, a 128-bit ``print`` of it, and the places of its shingles
    among those of the chunk. Per range of hashes (``part`` is ``shards``): the chunk's sorted shingles in it, and in how
    many documents of the chunk each is.
    """
    width = (1 << HASH_BITS) // shards

    def rows(chunk: int, ids: list, sets: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        every, counts = summed(np.concatenate(sets), np.ones(sum(map(len, sets)), np.uint64)) if sets else (np.empty(0, np.uint64),) * 2
        out = [
            (chunk, None, i, len(s), hashlib.blake2b(s.tobytes(), digest_size=16).digest(), pack_places(np.searchsorted(every, s)), "sets")
            for i, s in zip(ids, sets)
        ]
        bounds = np.searchsorted(every, np.arange(shards, dtype=np.uint64) * np.uint64(width)).tolist()
        for shard, (a, b) in enumerate(zip(bounds, [*bounds[1:], len(every)])):
            if a < b:
                out.append((chunk, shard, None, None, None, pack(every[a:b], counts[a:b]), "shards"))
        yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*out), _CHUNK.types)], schema=_CHUNK) if out else _CHUNK.empty_table().to_batches()[0]

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = TaskContext.get().partitionId() << 32
        ids, sets, held = [], [], 0
        for batch in batches:
            names = iter(batch.column("doc_id").to_pylist())
            for texts in slices(batch.column("text")):
                for own in shingle_sets(texts, WORDS):
                    name, own = next(names), distinct(own >> np.uint64(64 - HASH_BITS))
                    if len(own) and name is not None:
                        ids.append(name), sets.append(own)
                        held += len(own)
                if held >= chunk_shingles:
                    yield from rows(chunk, ids, sets)
                    chunk, ids, sets, held = chunk + 1, [], [], 0
        if sets:
            yield from rows(chunk, ids, sets)
        pa.default_memory_pool().release_unused()

    return docs.mapInArrow(build, "chunk bigint, shard int, doc_id bigint, n bigint, print binary, data binary, part string")


def frequency_class(documents: np.ndarray) -> np.ndarray:
    """A class of how many documents have a shingle, in quarters of a doubling: 0 for a single one."""
    return np.minimum(np.floor(4 * np.log2(documents.astype(np.float64))), 255).astype(np.uint8)


def classes(shards: DataFrame) -> DataFrame:
    """``chunk, shard, classes, shared``: the frequency class of each shingle of a chunk, and those in two documents or more.

    A shard is a range of hashes, with as many shingles as any other, so no frequent one matters. It goes through one
    task, which answers each chunk by itself.
    """

    def count(table: pa.Table) -> pa.Table:
        parts = [unpack(blob) for blob in table["data"].to_pylist()]
        every, documents = summed(*(np.concatenate([p[k] for p in parts]) for k in (0, 1)))
        grades = frequency_class(documents)
        packer, found, shared = zstandard.ZstdCompressor(level=1), [], []
        for shingles, _ in parts:
            own = grades[np.searchsorted(every, shingles)]
            found.append(packer.compress(own.tobytes()))
            shared.append(pack(shingles[own > 0]))
        pa.default_memory_pool().release_unused()
        return pa.table({"chunk": table["chunk"], "shard": table["shard"], "classes": pa.array(found, pa.binary()), "shared": pa.array(shared, pa.binary())})

    return shards.select("shard", "chunk", "data").groupBy("shard").applyInArrow(count, "chunk bigint, shard int, classes binary, shared binary")


_ORDERED = pa.schema([("id", pa.int64()), ("n", pa.int64()), ("alone", pa.int64()), ("shared", pa.binary()), ("prefix", pa.list_(pa.int64()))])


def ordered(sets: DataFrame, reps: DataFrame, graded: DataFrame, percent: int) -> DataFrame:
    """``id, n, alone, shared, prefix`` of those of the ``sets`` named in ``reps`` that can have similar ones.

    ``alone`` counts the shingles that no other document has; they come first. ``shared`` are the others, rarest first.
    ``prefix`` are those of the set's prefix that are shared. Sets whose prefix has none are similar to no other.
    """

    def order(documents: pa.Table, shards: pa.Table) -> pa.Table:
        parts = sorted(zip(*(shards[c].to_pylist() for c in ("shard", "classes", "shared"))))
        opener = zstandard.ZstdDecompressor()
        grade = np.concatenate([np.frombuffer(opener.decompress(c), np.uint8) for _, c, _ in parts])
        shingle = np.zeros(len(grade), np.uint64)
        shingle[grade > 0] = np.concatenate([unpack(s)[0] for *_, s in parts])
        out = []
        rows = list(zip(*(documents[c].to_pylist() for c in ("doc_id", "n", "print", "data"))))
        wanted = {(name, own) for name, _, own, data in rows if data is None}
        for name, n, own, data in rows:
            if data is None or (name, own) not in wanted:
                continue
            wanted.discard((name, own))
            places = unpack_places(data)
            places = places[grade[places] > 0]
            alone = n - len(places)
            take = prefix_length(n, percent) - alone
            if take > 0 and len(places):
                own = shingle[places[np.argsort(grade[places], kind="stable")]]
                out.append((name, n, alone, packed(own), own[:take].view(np.int64)))
        if not out:
            return _ORDERED.empty_table()
        return pa.table([pa.array(c, t) for c, t in zip(zip(*out), _ORDERED.types)], schema=_ORDERED)

    columns = ("chunk", "doc_id", "n", "print", "data")
    marks = reps.select("chunk", F.col("id").alias("doc_id"), "print").withColumns({c: F.lit(None).cast(t) for c, t in (("n", "bigint"), ("data", "binary"))})
    left = sets.select(*columns).unionByName(marks.select(*columns)).groupBy("chunk")
    return left.cogroup(graded.groupBy("chunk")).applyInArrow(order, "id bigint, n bigint, alone bigint, shared binary, prefix array<bigint>")


def packed(hashes: np.ndarray) -> bytes:
    """Hashes as little-endian numbers of ``HASH_BITS``."""
    return hashes.view(np.uint8).reshape(-1, 8)[:, : HASH_BITS // 8].tobytes()


def tokens(blob: bytes) -> np.ndarray:
    """The inverse of :func:`packed`."""
    out = np.zeros((len(blob) * 8 // HASH_BITS, 8), np.uint8)
    out[:, : HASH_BITS // 8] = np.frombuffer(blob, np.uint8).reshape(len(out), -1)
    return out.view(np.uint64).ravel()


def similar(a: np.ndarray, n: int, b: np.ndarray, m: int, percent: int) -> bool:
    """Whether two sets, of sizes ``n`` and ``m`` with these shared shingles, are similar: the full check."""
    both = np.sort(np.concatenate([a, b]))
    inter = int((both[1:] == both[:-1]).sum())
    return 100 * inter >= percent * (n + m - inter)


def met(rows: DataFrame, table: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """``rows`` joined to the one row that ``table`` has for ``keys``, which many rows may share.

    Rows have a salt from their ``id`` or ``u``, and the table a copy for each salt that its keys occur with.
    """
    salted = rows.withColumn("_sj_salt", F.pmod(F.xxhash64("id" if "id" in rows.columns else "u"), F.lit(SALTS)))
    copies = salted.select(*keys, "_sj_salt").distinct().join(table, keys)
    return salted.join(copies, [*keys, "_sj_salt"], how).drop("_sj_salt")


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs ``u, v`` that are similar; ``v`` may be in many."""

    @arrow_udf("boolean")
    def check(a: pa.Array, n: pa.Array, b: pa.Array, m: pa.Array) -> pa.Array:
        rows = zip(a.to_pylist(), n.to_pylist(), b.to_pylist(), m.to_pylist())
        return pa.array([similar(tokens(x), k, tokens(y), j, percent) for x, k, y, j in rows], pa.bool_())

    left, right = (sets.select(F.col("id").alias(c), F.col("n").alias(f"n{c}"), F.col("shared").alias(f"s{c}")) for c in "uv")
    both = met(pairs.join(left, "u"), right, ["v"])
    near = F.greatest("nu", "nv") * percent <= F.least("nu", "nv") * 100
    return settle(both.where(near).where(check("su", "nu", "sv", "nv")).select("u", "v"))


def probe(strays: list[tuple], members: list[tuple], percent: int) -> list[tuple]:
    """``u, v`` of similar sets of different parts, for each stray one per part; rows are (id, part, n, alone, shared).

    The prefixes of the members are indexed. A stray meets a member at the first shingle that both prefixes hold, and it
    is checked on the full sets only if their lengths, what is left behind that place in both, and how the shingles behind
    it are spread between pivots, allow enough in common.
    """
    if not members or not strays:
        return []
    sizes = np.array([m[2] for m in members])
    alone = np.array([m[3] for m in members])
    heads = [m[4][: prefix_length(m[2], percent) - m[3]] for m in members]
    index = np.concatenate(heads)
    owners = np.repeat(np.arange(len(heads)), [len(h) for h in heads])
    places = np.concatenate([np.arange(len(h)) for h in heads]) + alone[owners]
    order = np.argsort(index, kind="stable")
    index, owners, places = index[order], owners[order], places[order]
    shift = np.uint64(HASH_BITS - int(math.log2(PIVOTS)))
    parts = np.unique([m[1] for m in members] + [s[1] for s in strays], return_inverse=True)[1]
    member_part, found = parts[: len(members)], []
    for (name, _, n, first, own), part in zip(strays, parts[len(members) :]):
        head = own[: prefix_length(n, percent) - first]
        start, end = (np.searchsorted(index, head, side) for side in ("left", "right"))
        count = end - start
        hits = np.arange(count.sum()) + np.repeat(start - (np.cumsum(count) - count), count)
        i = np.repeat(np.arange(len(head)) + first, count)
        who, at = np.unique(owners[hits], return_index=True)  # the first in both orders
        i, j = i[at], places[hits][at]
        m = sizes[who]
        need = least_overlap(m, n, percent)
        likely = (100 * np.minimum(n, m) >= percent * np.maximum(n, m)) & (member_part[who] != part)  # length
        likely &= 1 + np.minimum(n - i - 1, m - j - 1) >= need  # position
        linked = set()
        for k in np.flatnonzero(likely).tolist():
            other = members[who[k]]
            if member_part[who[k]] in linked:
                continue
            a, b = own[i[k] - first + 1 :], other[4][j[k] - other[3] + 1 :]
            spread = np.bincount((a >> shift).astype(np.int64), minlength=PIVOTS) - np.bincount((b >> shift).astype(np.int64), minlength=PIVOTS)
            if i[k] + j[k] + int(np.abs(spread).sum()) > n + m[k] - 2 * need[k]:  # suffix
                continue
            if similar(own, n, other[4], other[2], percent):
                linked.add(member_part[who[k]])
                found.append((name, other[0]))
    return found


def links_across(rows: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links between members of one group, ``main``, that are of different parts; ``rows`` has ``main, id, part, length``.

    Members of a group meet in cells of about ``STRAYS`` by ``MEMBERS``, by classes of length of which only neighbours
    can be similar. What is outside the main part meets everything, the main part itself nothing of its own.
    """
    strays = rows.where("part != main").withColumn("length", F.explode(F.array(*[F.col("length") + d for d in (-1, 0, 1)])))
    strays = strays.select("main", "length", "id", "part", F.lit(True).alias("stray"))
    members = rows.select("main", "length", "id", "part", F.lit(False).alias("stray"))
    both = strays.unionByName(members)
    size = both.groupBy("main", "length").agg(
        F.ceil(F.count_if("stray") / STRAYS).alias("across"), F.ceil(F.count_if(~F.col("stray")) / MEMBERS).alias("down")
    ).where("across > 0 and down > 0")
    placed = met(both, size, ["main", "length"])
    slot = F.xxhash64("id", F.lit(1))
    own = F.pmod(slot, F.when(F.col("stray"), F.col("across")).otherwise(F.col("down")))
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.when(F.col("stray"), F.col("down")).otherwise(F.col("across")) - 1))
    placed = placed.withColumn("own", own).withColumn("every", every)
    across, down = (F.when(F.col("stray"), F.col(a)).otherwise(F.col(b)) for a, b in (("own", "every"), ("every", "own")))
    cells = placed.select("main", "length", across.alias("at_across"), down.alias("at_down"), "id", "part", "stray")

    def compare(table: pa.Table) -> pa.Table:
        columns = [table[c].to_pylist() for c in ("id", "part", "n", "alone", "shared", "stray")]
        every = sorted(((i, p, n, a, tokens(s), x) for i, p, n, a, s, x in zip(*columns)), key=lambda row: row[0])
        found = probe([r[:5] for r in every if r[5]], [r[:5] for r in every if not r[5]], percent)
        return pa.table({c: pa.array([pair[k] for pair in found], pa.int64()) for k, c in enumerate("uv")})

    filled = cells.join(sets.select("id", "n", "alone", "shared"), "id")
    return settle(filled.groupBy("main", "length", "at_across", "at_down").applyInArrow(compare, "u bigint, v bigint"))


def with_least(known: DataFrame, rows: DataFrame, column: str, name: str) -> DataFrame:
    """Add the least id of the component that ``column`` is in."""
    found = known.select(F.col("u").alias(column), F.col("v").alias("_sj_v"))
    joined = rows.join(found, column, "left") if column != "v" else met(rows, found, ["v"], "left")
    return joined.withColumn(name, F.coalesce("_sj_v", column)).drop("_sj_v")


def links(sets: DataFrame, percent: int) -> DataFrame:
    """The components of the similar sets of :func:`ordered`, as ``u, v`` (see :func:`minelark.llm.components.components`).

    Sets are joined on the shingles of their prefixes. Those that share one and are of like length have a centre, the
    least of them; each is first checked with the centre it shares most with, then with its other centres outside its
    component. Shingles that still join several components have a main one; what is outside it is compared with all.
    """
    length = F.floor(F.log(F.col("n")) / (1.001 * math.log(100 / percent))).cast("int").alias("length")
    postings = sets.select("id", length, F.explode("prefix").alias("shingle"))
    alike = postings.groupBy("shingle", "length").agg(F.min("id").alias("centre"), F.max("id").alias("last"))
    several = alike.groupBy("shingle").agg(F.min("centre").alias("a"), F.max("last").alias("b")).where("a < b").select("shingle")
    centres = settle(alike.join(several, "shingle").select("shingle", "length", "centre"))
    postings = settle(met(postings, centres, ["shingle", "length"]))
    stars = settle(postings.where("id != centre").groupBy("id", "centre").agg(F.count(F.lit(1)).alias("shared")))
    best = stars.groupBy("id").agg(F.max_by("centre", F.struct("shared", (-F.col("centre")).alias("least"))).alias("v"))
    best = settle(best.select(F.col("id").alias("u"), "v"))
    known = components(confirmed(best, sets, percent))
    others = stars.select(F.col("id").alias("u"), F.col("centre").alias("v")).join(best, ["u", "v"], "left_anti")
    others = with_least(known, with_least(known, others, "u", "cu"), "v", "cv").where("cu != cv").select("u", "v")
    known = components(known.unionByName(confirmed(settle(others), sets, percent)))

    placed = settle(with_least(known, postings.drop("centre"), "id", "part"))
    parts = placed.groupBy("shingle", "part").agg(F.count(F.lit(1)).alias("n"))
    split = parts.groupBy("shingle").agg(F.max_by("part", F.struct("n", "part")).alias("main"), F.count(F.lit(1)).alias("parts"))
    split = settle(split.where("parts > 1").select("shingle", "main"))
    if split.isEmpty():
        return known
    groups = settle(met(placed, split, ["shingle"]).select("main", "id", "part", "length").distinct())
    return components(known.unionByName(links_across(groups, sets, percent)))


def similar_documents(
    docs: DataFrame, percent: int = PERCENT, chunk_shingles: int = CHUNK_SHINGLES, shard_shingles: int = SHARD_SHINGLES
) -> DataFrame:
    """Add ``n_shingles`` and ``component_id`` to the columns of ``docs`` but for ``text``.

    Documents are linked if their distinct three-word shingles (A-Z lower-cased) in common are at least ``percent`` of
    both together; ``component_id`` is the least ``doc_id`` that links lead to. No similar pair is missed, and links are
    confirmed on the full sets (of 48-bit hashes).

    Fewer than three words: the whole sequence is the one shingle. No words, or null text: an empty set, linked with
    nothing. Null ``doc_id``: linked with nothing, both columns null. Rows that repeat a ``doc_id`` (a whole number) are
    one document with the links of all its texts and the size of the largest set. Very long texts count whole; no rows
    give no rows. Columns of the added names give way; names starting with ``_sj_`` are reserved.

    Documents are read once. Their shingles are counted in shards of equal size; equal sets fold to one; only sets that
    share a rare shingle travel, each once per cell of its group and not once per pair. A chunk and a shard take about
    20 bytes per shingle of memory, and a chunk sends each shard a row: let both grow with the root of the input.
    """
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = 1 + size // (6 * shard_shingles)
    chunked = chunks(docs.select(F.col("doc_id").cast("long"), "text"), shards, chunk_shingles)
    path = new_path(docs.sparkSession)
    chunked.write.partitionBy("part").parquet(path)
    stored = docs.sparkSession.read.schema(chunked.schema).parquet(path)
    sets, by_shard = (stored.where(F.col("part") == part) for part in ("sets", "shards"))
    graded = settle(classes(by_shard))
    by_shard._settled_at = f"{path}/part=shards"
    release(by_shard)
    least = F.min(F.struct(F.col("doc_id").alias("id"), "chunk"))
    reps = settle(sets.groupBy("print").agg(least.alias("s")).select("print", "s.*"))
    found = links(settle(ordered(sets, reps, graded, percent)), percent)
    classed = with_least(found, reps.select("print", "id"), "id", "_sj_class").select("print", "_sj_class")
    of = sets.select("doc_id", "n", "print").join(classed, "print")
    of = of.groupBy("doc_id").agg(F.max("n").alias("_sj_n"), F.min("_sj_class").alias("_sj_class"))
    others = [c for c in docs.columns if c.lower() not in ("text", "n_shingles", "component_id")]
    joined = docs.select(*quoted(others)).join(of.withColumnRenamed("doc_id", "_sj_id"), F.col("doc_id") == F.col("_sj_id"), "left")
    known = F.col("doc_id").isNotNull()
    done = with_columns(joined, {
        "n_shingles": F.when(known, F.coalesce("_sj_n", F.lit(0).cast("long"))),
        "component_id": F.when(known, F.coalesce("_sj_class", F.col("doc_id").cast("long"))),
    })
    return done.drop(*[c for c in done.columns if c.startswith("_sj_")])
