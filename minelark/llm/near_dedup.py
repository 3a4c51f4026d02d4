"""Near-duplicate documents: min-hash banding, checks of signatures and of full sets, connected components."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from minelark.llm.components import components
from minelark.llm.texts import distinct, quoted, shingle_sets, slices, whole, with_columns
from minelark.plans.lineage import settle

WORDS = 5
PERCENT = 75
BANDS = 36
ROWS = 4
CHECK_DEVIATIONS = 6
CHUNK = 200
STRAYS, MEMBERS = 256, 1024
FILTER_BITS = 1 << 24

_RANDOM = np.random.default_rng(7)
_A = _RANDOM.integers(1, 2**63, size=BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_B = _RANDOM.integers(0, 2**63, size=BANDS * ROWS, dtype=np.uint64)
_HIGH = np.uint64(32)


def minima(sets: list[np.ndarray]) -> np.ndarray:
    """Per non-empty set the least value of each universal hash ``(a * x + b mod 2**64) >> 32``."""
    values = np.concatenate(sets)
    starts = np.cumsum([0, *map(len, sets[:-1])])
    least = np.empty((len(sets), len(_A)), dtype=np.uint64)
    for k in range(len(_A)):
        least[:, k] = np.minimum.reduceat(values * _A[k] + _B[k], starts)
    return (least >> _HIGH).astype(np.uint32)


_SKETCH = pa.struct([("n", pa.int64()), ("print", pa.binary()), ("bands", pa.list_(pa.int64())), ("signature", pa.binary())])


def sketches(text: Column) -> Column:
    """Of a text's shingle set: its size, a 128-bit print, a key per band, and the signature, one byte per hash."""

    @arrow_udf("struct<n:bigint,print:binary,bands:array<bigint>,signature:binary>")
    def sketch(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        place = np.arange(1, BANDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        fold = _A[:ROWS]
        for column in columns:
            rows = []
            for texts in slices(column):
                sets = shingle_sets(texts, WORDS)
                filled = [s for s in sets if len(s)]
                least = iter(minima(filled)) if filled else iter(())
                for s in sets:
                    if not len(s):
                        rows.append({"n": 0})
                        continue
                    mins = next(least)
                    keys = (mins.reshape(BANDS, ROWS) * fold).sum(axis=1, dtype=np.uint64) + place
                    keys = (keys ^ (keys >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
                    rows.append({
                        "n": len(s),
                        "print": hashlib.blake2b(s.tobytes(), digest_size=16).digest(),
                        "bands": (keys ^ (keys >> np.uint64(32))).view(np.int64),
                        "signature": mins.astype(np.uint8).tobytes(),
                    })
            yield pa.array(rows, _SKETCH)

    return sketch(text)


def agreeing(left: str, right: str) -> Column:
    """In how many places two signatures agree."""

    @arrow_udf("int")
    def agree(a: pa.Array, b: pa.Array) -> pa.Array:
        pairs = zip(a.to_pylist(), b.to_pylist())
        return pa.array([int((np.frombuffer(x, np.uint8) == np.frombuffer(y, np.uint8)).sum()) for x, y in pairs], pa.int32())

    return agree(left, right)


def enough_agreement(percent: int) -> int:
    """The least agreement that signatures of similar sets have, but for a chance below one in 10**8."""
    k, j = BANDS * ROWS, percent / 100
    return int(k * j - CHECK_DEVIATIONS * (k * j * (1 - j)) ** 0.5)


def similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether the share of common elements of two sorted distinct arrays is at least ``percent``."""
    union = len(distinct(np.concatenate([a, b])))
    return 100 * (len(a) + len(b) - union) >= percent * union


def confirmed(pairs: DataFrame, reps: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """The pairs ``u, v`` that are similar: by their signatures first, then by their full sets.

    The partners ``u`` of one ``v`` are checked in chunks of about ``CHUNK`` texts; ``v`` goes to each of its chunks.
    """
    signed = reps.select("id", "signature")
    left, right = (signed.select(F.col("id").alias(c), F.col("signature").alias(f"s{c}")) for c in "uv")
    pairs = pairs.join(left, "u").join(right, "v").where(agreeing("su", "sv") >= enough_agreement(percent))
    pairs = settle(pairs.select("u", "v").distinct())
    chunks = pairs.groupBy("v").agg(F.ceil(F.count(F.lit(1)) / CHUNK).alias("chunks"))
    placed = pairs.join(chunks, "v").select("u", "v", F.pmod(F.xxhash64("u"), "chunks").alias("chunk"))
    centres = chunks.select("v", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)).alias("chunk"))
    rows = placed.unionByName(centres.withColumn("u", F.col("v"))).join(texts.withColumnRenamed("id", "u"), "u")

    def check(table: pa.Table) -> pa.Table:
        ids, centre = table["u"].to_pylist(), table["v"][0].as_py()
        sets = [s for part in table["text"].chunks for some in slices(part) for s in shingle_sets(some, WORDS)]
        own = [s for i, s in zip(ids, sets) if i == centre]
        hits = {i for i, s in zip(ids, sets) if i != centre and any(similar(s, c, percent) for c in own)}
        return pa.table({"u": pa.array(sorted(hits), pairs_type), "v": pa.array([centre] * len(hits), pairs_type)})

    pairs_type = pa.string() if dict(pairs.dtypes)["u"] == "string" else pa.int64()
    schema = ", ".join(f"{c} {dict(pairs.dtypes)[c]}" for c in "uv")
    return settle(rows.groupBy("v", "chunk").applyInArrow(check, schema))


def links_between(strays: list[tuple], others: list[tuple], percent: int) -> list[tuple]:
    """``u, v`` of similar texts of different parts, one for each stray and part; both lists hold (id, part, set).

    An index from the shingles of the others to their places counts what a stray shares with all of them at once.
    """
    if not others:
        return []
    shingles = np.concatenate([s for *_, s in others])
    order = np.argsort(shingles)
    lengths = np.array([len(s) for *_, s in others])
    owners, shingles = np.repeat(np.arange(len(others)), lengths)[order], shingles[order]
    found = []
    for id_, part, own in strays:
        first, last = (np.searchsorted(shingles, own, side) for side in ("left", "right"))
        n = last - first
        places = np.arange(n.sum()) + np.repeat(first - (np.cumsum(n) - n), n)
        shared = np.bincount(owners[places], minlength=len(others))
        hits = np.flatnonzero(100 * shared >= percent * (len(own) + lengths - shared))
        least = {others[k][1]: others[k][0] for k in hits[::-1].tolist() if others[k][1] != part}
        found += [(id_, other) for other in least.values()]
    return found


def links_across(rows: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """Links between members of one group, ``main``, that are of different parts; ``rows`` has ``main, id, part``.

    A group has one large part, and strays of other parts: only these are compared, with all members, in cells of about
    ``STRAYS`` by ``MEMBERS`` texts. So a group costs its strays times its members, and hardly any rows that travel.
    """
    strays = rows.where("part != main")
    size = rows.groupBy("main").agg(
        F.ceil(F.count_if(F.expr("part != main")) / STRAYS).alias("across"), F.ceil(F.count(F.lit(1)) / MEMBERS).alias("down")
    )

    def placed(some: DataFrame, own: str, other: str, stray: bool) -> DataFrame:
        every = F.explode(F.sequence(F.lit(0).cast("long"), F.col(other) - 1)).alias(f"at_{other}")
        at = F.pmod(F.xxhash64("id"), F.col(own)).alias(f"at_{own}")
        return some.join(size, "main").select("main", "id", "part", F.lit(stray).alias("stray"), at, every)

    cells = placed(strays, "across", "down", True).unionByName(placed(rows, "down", "across", False))
    kind = dict(rows.dtypes)["id"]

    def compare(table: pa.Table) -> pa.Table:
        sets = [s for part in table["text"].chunks for some in slices(part) for s in shingle_sets(some, WORDS)]
        every = list(zip(table["id"].to_pylist(), table["part"].to_pylist(), sets, table["stray"].to_pylist()))
        some, others = ([row[:3] for row in sorted(every, key=lambda r: r[0]) if row[3] == side] for side in (True, False))
        found = links_between(some, others, percent)
        return pa.table({c: pa.array([pair[k] for pair in found], id_type) for k, c in enumerate("uv")})

    id_type = pa.string() if kind == "string" else pa.int64()
    cell = ("main", "at_across", "at_down")
    return settle(cells.join(texts, "id").groupBy(*cell).applyInArrow(compare, f"u {kind}, v {kind}"))


def likely_among(ids: DataFrame, of: Column, bits: int = FILTER_BITS) -> Column:
    """A filter of fixed size on the ids ``of``: true for all given ids, and for few others while there are few ids.

    It only spares a shuffle; an exact join has to follow, whose outcome does not depend on the filter.
    """

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(bits, dtype=bool)
        for batch in batches:
            seen[batch.column(0).to_numpy()] = True
        yield pa.record_batch({"bits": pa.array([np.packbits(seen).tobytes()], pa.binary())})

    parts = ids.select(F.pmod(F.xxhash64("id"), F.lit(bits)).alias("slot")).coalesce(4).mapInArrow(build, "bits binary").collect()
    packed = np.zeros(bits // 8, dtype=np.uint8)
    for part in parts:
        packed |= np.frombuffer(part.bits, dtype=np.uint8)

    @arrow_udf("boolean")
    def among(slots: pa.Array) -> pa.Array:
        at = slots.to_numpy()
        return pa.array((packed[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 == 1)

    return among(F.pmod(F.xxhash64(of), F.lit(bits)))


def least_of(components_: DataFrame, rows: DataFrame, column: str, name: str) -> DataFrame:
    """Add the least id of the component that ``column`` is in."""
    found = components_.select(F.col("u").alias(column), F.col("v").alias("_least"))
    return rows.join(found, column, "left").withColumn(name, F.coalesce("_least", column)).drop("_least")


def links(reps: DataFrame, docs: DataFrame, percent: int) -> DataFrame:
    """The components of the similar representatives, as ``u, v`` (see :func:`components`).

    Representatives that share a band meet in a bucket. Each is first checked with one centre, the least of the bucket
    it shares most bands with; then with its other centres that are not yet in its component. A bucket that still has
    members of several components has a main one, of most members; the others in it are strays of the main one, and
    are compared with everything that met it. So every pair that shares a band is checked, unless it is already known to
    be connected: copies of one text cost one check each, not one per pair.
    """
    bands = reps.select("id", F.explode("bands").alias("key"))
    centres = bands.groupBy("key").agg(F.min("id").alias("centre"), F.max("id").alias("last")).where("centre < last")
    members = settle(bands.join(centres.drop("last"), "key"))
    stars = settle(members.where("id != centre").groupBy("id", "centre").agg(F.count(F.lit(1)).alias("shared")))
    if stars.isEmpty():  # no two share a band
        return stars.select(F.col("id").alias("u"), F.col("centre").alias("v"))
    needed = settle(stars.select("id").unionByName(stars.select(F.col("centre").alias("id"))).distinct())
    texts = docs.where(likely_among(needed, F.col("id"))).join(needed, "id", "left_semi")
    texts = settle(texts.select("id", "text"))

    best = stars.groupBy("id").agg(F.max_by("centre", F.struct("shared", (-F.col("centre")).alias("least"))).alias("v"))
    edges = confirmed(best.select(F.col("id").alias("u"), "v"), reps, texts, percent)
    known = components(edges)

    others = stars.select("id", "centre").join(best.select("id", F.col("v").alias("centre")), ["id", "centre"], "left_anti")
    others = least_of(known, least_of(known, others, "id", "cu"), "centre", "cv").where("cu != cv")
    more = confirmed(others.select(F.col("id").alias("u"), F.col("centre").alias("v")), reps, texts, percent)
    known = components(known.unionByName(more))

    placed = settle(least_of(known, members.select("key", "id"), "id", "part"))
    parts = placed.groupBy("key", "part").agg(F.count(F.lit(1)).alias("n"))
    split = parts.groupBy("key").agg(F.max_by("part", F.struct("n", "part")).alias("main"), F.count(F.lit(1)).alias("parts"))
    split = settle(split.where("parts > 1").select("key", "main"))
    if split.isEmpty():
        return known
    last = links_across(settle(placed.join(split, "key").select("main", "id", "part").distinct()), texts, percent)
    return components(known.unionByName(last))


def near_duplicates(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Add ``n_shingles``, ``component_id`` and ``kept`` to the columns of ``docs`` but for ``text``.

    Documents are linked if the shares of their distinct five-word shingles (A-Z lower-cased) in common are at least
    ``percent`` of both together; ``component_id`` is the least ``doc_id`` that links lead to, and the document of that
    id is kept. A pair at exactly 75 percent is missed with a chance of 1.1 in a million (36 bands of 4 rows), a more
    similar one with less; every link found is confirmed on the full sets.

    Fewer than five words: the whole sequence is the one shingle. No words, or null text: an empty set, linked with
    nothing. Null ``doc_id``: linked with nothing, kept, ``component_id`` null. Rows that repeat a ``doc_id`` are judged
    by their own texts. Columns of the added names give way; names starting with ``_nd_`` are reserved.

    Texts of equal sets fold to one by their print before banding, so groups of copies cost a partial minimum. What is
    shuffled are prints, band keys and the texts of documents that share a band with another one.
    """
    others = [c for c in docs.columns if c.lower() not in ("text", "n_shingles", "component_id", "kept")]
    sketched = docs.select(*quoted(others), sketches(whole(F.col("text"))).alias("_nd_s"))
    sketched = settle(sketched.select(*quoted(others), "_nd_s.*").withColumnsRenamed(
        {"n": "_nd_n", "print": "_nd_print", "bands": "_nd_bands", "signature": "_nd_signature"}
    ))
    named = sketched.where("doc_id is not null and _nd_print is not null")
    least = F.min(F.struct(F.col("doc_id").alias("id"), F.col("_nd_bands").alias("bands"), F.col("_nd_signature").alias("signature")))
    reps = settle(named.groupBy(F.col("_nd_print").alias("print")).agg(least.alias("s")).select("print", "s.*"))
    found = links(reps, docs.select(F.col("doc_id").alias("id"), "text"), percent)
    classes = least_of(found, reps.select("id", F.col("print").alias("_nd_p")), "id", "_nd_class").select("_nd_p", "_nd_class")
    joined = sketched.join(settle(classes), F.col("_nd_print") == F.col("_nd_p"), "left")
    done = with_columns(joined, {
        "n_shingles": F.col("_nd_n"),
        "component_id": F.when(F.col("doc_id").isNotNull(), F.coalesce("_nd_class", "doc_id")),
    })
    done = with_columns(done, {"kept": F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))})
    return done.drop(*[c for c in done.columns if c.startswith("_nd_")])
