"""Grouping spelling variants: words one code point apart, found in a trie of letter counts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from minelark.llm.texts import ascii_lower, whole
from minelark.plans.lineage import release, settle

MIN_CHARS = 7
MIN_COUNT = 2
RATIO = 10
NODE_WORDS = 32_768
LEAF_WORDS = 96
DENSE_LEVELS = 5
LONG = 64  # code points; longer words are compared one pair at a time
MAX_COUNT = 60  # counts above are held for this, which weakens the search and loses nothing
# Levels of the trie: letters by how telling their counts are; all other code points share one of these by their low bits.
LEVELS = "enatiohrslucdgmzvykfwbxjqp"

_LEVEL = np.array([LEVELS.index(chr(97 + (code & 31) - 1)) if 1 <= (code & 31) <= 26 else (code & 31) % 26 for code in range(256)], dtype=np.int64)


def letter_counts(words: list[str]) -> np.ndarray:
    """Per word how many of its code points are of each level's letter group."""
    codes = np.frombuffer("".join(words).encode("utf-32-le"), dtype=np.uint32)
    owners = np.repeat(np.arange(len(words)), [len(w) for w in words])
    flat = np.bincount(owners * len(LEVELS) + _LEVEL[codes & 255], minlength=len(words) * len(LEVELS))
    return np.minimum(flat, MAX_COUNT).astype(np.int8).reshape(len(words), len(LEVELS))


def paths(word: Column) -> Column:
    """The path of a word through the trie: one character per level, ``0`` and on."""

    @arrow_udf("string")
    def path(column: pa.Array) -> pa.Array:
        counts = letter_counts(column.to_pylist())
        return pa.array([bytes(row).decode() for row in (counts + 48).astype(np.uint8)], pa.string())

    return path(word)


def runs_counted(docs: DataFrame) -> DataFrame:
    """``word, n``: the runs of letters of all texts, each without the code point that its hash names, if any."""
    run = F.explode(F.regexp_extract_all(ascii_lower(whole(F.col("text"))), F.lit(f"([a-zÀ-ÿ]{{{MIN_CHARS},}})"), 1))
    runs = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), run.alias("run"))
    runs = runs.withColumn("h", F.crc32(F.concat("id", F.lit(":"), "run").cast("binary")))
    at = (F.col("h") % F.char_length("run")).cast("int")
    cut = F.concat(F.expr("substring(run, 1, at)"), F.expr("substring(run, at + 2)"))
    word = F.when(F.col("h") % 31 == 0, cut).otherwise(F.col("run"))
    words = runs.withColumn("at", at).select(word.alias("word")).where(F.char_length("word") >= MIN_CHARS)
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= MIN_COUNT)


def trie_nodes(words: DataFrame, node_words: int) -> DataFrame:
    """``node, blocks``: the nodes that the trie is cut at; each word is below one of them.

    A node of more than ``node_words`` words is replaced by its children, and at the last level cut into blocks.
    """
    depth = F.explode(F.sequence(F.lit(0), F.lit(len(LEVELS))))
    sizes = words.select("path", depth.alias("depth")).select(F.expr("substring(path, 1, depth)").alias("node"))
    sizes = settle(sizes.groupBy("node").agg(F.count(F.lit(1)).alias("size")))
    large = sizes.where(F.col("size") > node_words).select("node")
    parent = F.expr("substring(node, 1, length(node) - 1)")
    last = F.length("node") == len(LEVELS)
    below = sizes.where("node != ''").withColumn("parent", parent)
    below = below.join(large.withColumnRenamed("node", "parent"), "parent", "left_semi")
    ends = below.where((F.col("size") <= node_words) | last).unionByName(
        sizes.where((F.col("node") == "") & (F.col("size") <= node_words)).withColumn("parent", F.lit(""))
    )
    return settle(ends.select("node", F.ceil(F.col("size") / node_words).cast("int").alias("blocks")))


def cells(nodes: DataFrame) -> DataFrame:
    """``a, b``: the pairs of nodes, each as ``node, block``, whose words can be near; a node pairs with itself as well.

    The shorter path of the two differs from the start of the longer one by at most one count too many and one too few.
    Every start of a node's path is changed within that budget and joined to the nodes: a small table by construction.
    """

    @arrow_udf("array<string>")
    def reachable(column: pa.Array) -> pa.Array:
        out = []
        for node in column.to_pylist():
            own = [ord(c) for c in node]
            found = set()
            for depth in range(len(own) + 1):
                head = own[:depth]
                for up in range(-1, depth):
                    for down in range(-1, depth):
                        changed = list(head)
                        if up >= 0:
                            changed[up] += 1
                        if down >= 0:
                            changed[down] -= 1
                        found.add("".join(map(chr, changed)))
            out.append(sorted(found))
        return pa.array(out, pa.list_(pa.string()))

    blocks = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block")
    sides = nodes.select("node", blocks)
    near = nodes.select("node", F.explode(reachable("node")).alias("other")).join(nodes.select(F.col("node").alias("other")), "other")
    a, b = (sides.select(F.col("node").alias(name), F.struct("node", "block").alias(side)) for name, side in (("node", "a"), ("other", "b")))
    pairs = near.join(a, "node").join(b, "other")
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def search(queries: np.ndarray, counts: np.ndarray, leaf_words: int = LEAF_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Which rows of ``counts`` each row of ``queries`` may be near to, as two arrays of places.

    Depth-first over the trie of ``counts``, for all queries at once: at each level a query goes on to the children whose
    count it misses by no more than what is left of its budget, one count too many and one too few.
    """
    order = np.lexsort(counts.T[::-1])
    rows = counts[order]
    found: list[tuple[np.ndarray, np.ndarray]] = []
    every = np.arange(len(queries))
    stack = [(0, 0, len(rows), every, np.zeros(len(queries), np.int8), np.zeros(len(queries), np.int8))]
    while stack:
        level, start, end, who, over, under = stack.pop()
        if end - start <= leaf_words or level == rows.shape[1]:
            for piece in range(0, len(who), 4096):
                some = slice(piece, piece + 4096)
                much, few = over[some, None], under[some, None]
                close = min(level + DENSE_LEVELS, rows.shape[1])
                for at in range(level, close):  # all with all
                    apart = queries[who[some], at][:, None] - rows[start:end, at]
                    much, few = much + np.maximum(apart, 0), few + np.maximum(-apart, 0)
                shape = np.broadcast_shapes(much.shape, (1, end - start))
                q, r = np.nonzero(np.broadcast_to((much <= 1) & (few <= 1), shape))
                much, few = np.broadcast_to(much, shape)[q, r], np.broadcast_to(few, shape)[q, r]
                own, other = who[some][q], start + r
                for at in range(close, rows.shape[1]):  # those left, one by one
                    if not len(own):
                        break
                    apart = queries[own, at] - rows[other, at]
                    much, few = much + np.maximum(apart, 0), few + np.maximum(-apart, 0)
                    stay = (much <= 1) & (few <= 1)
                    own, other, much, few = own[stay], other[stay], much[stay], few[stay]
                found.append((own, order[other]))
            continue
        column = rows[start:end, level]
        firsts = np.flatnonzero(np.append(True, column[1:] != column[:-1]))
        theirs = queries[who, level]
        for first, last in zip(firsts, np.append(firsts[1:], len(column))):
            apart = theirs - column[first]
            much, few = over + np.maximum(apart, 0), under + np.maximum(-apart, 0)
            stay = np.flatnonzero((much <= 1) & (few <= 1))
            if len(stay):
                stack.append((level + 1, start + first, start + last, who[stay], much[stay], few[stay]))
    if not found:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def candidates(a: list[str], b: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The pairs of places in ``a`` and ``b`` that the search finds; words of equal counts are looked up as one."""
    sides = []
    for words in (a, b):
        rows, owner = np.unique(letter_counts(words), axis=0, return_inverse=True)
        order = np.argsort(owner, kind="stable")
        sides.append((rows, order, np.append(np.searchsorted(owner[order], np.arange(len(rows))), len(words))))
    (rows, order, starts), (others, other_order, other_starts) = sides
    left, right = search(rows, others)
    wide, high = np.diff(other_starts)[right], np.diff(starts)[left]
    total = wide * high
    which = np.repeat(np.arange(len(left)), total)
    at = np.arange(total.sum()) - np.repeat(np.cumsum(total) - total, total)
    down, across = np.divmod(at, wide[which])
    return order[starts[left][which] + down], other_order[other_starts[right][which] + across]


def one_apart(a: str, b: str) -> bool:
    """Whether two words differ by exactly one inserted, deleted or replaced code point."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    at = next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[at:] == b[at + 1 :] or a[at + 1 :] == b[at + 1 :]


def verified(a: list[str], b: list[str], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Which of the pairs ``a[left], b[right]`` are one code point apart; short words as rows of code points."""
    lengths = [np.array([len(w) for w in words]) for words in (a, b)]
    short = (lengths[0][left] <= LONG) & (lengths[1][right] <= LONG)
    near = np.zeros(len(left), dtype=bool)
    for k in np.flatnonzero(~short):
        near[k] = one_apart(a[left[k]], b[right[k]])
    codes = [np.array([w if len(w) <= LONG else "" for w in words]) for words in (a, b)]
    width = max(c.dtype.itemsize // 4 for c in codes)
    codes = [c.astype(f"<U{width}").view(np.uint32).reshape(len(c), width) for c in codes]
    places = np.arange(width)
    todo = np.flatnonzero(short)
    for piece in range(0, len(todo), 1 << 16):
        at = todo[piece : piece + (1 << 16)]
        x, y = codes[0][left[at]], codes[1][right[at]]
        n, m = lengths[0][left[at]], lengths[1][right[at]]
        same = n == m
        near[at[same]] = (x[same] != y[same]).sum(axis=1) == 1
        for first, second, k, size in ((x, y, np.flatnonzero(m == n + 1), n), (y, x, np.flatnonzero(n == m + 1), m)):
            if len(k):
                s, t, own = first[k], second[k], size[k][:, None]
                ahead = np.cumprod((s == t) & (places < own), axis=1).sum(axis=1)
                shifted = np.concatenate([t[:, 1:], np.zeros((len(k), 1), t.dtype)], axis=1)
                tail = ((s == shifted) | (places >= own))[:, ::-1]
                behind = np.cumprod(tail, axis=1).sum(axis=1) - (width - size[k])
                near[at[k]] = ahead + behind >= size[k]
    return near


_FOUND = pa.schema([("word", pa.string()), ("n_near", pa.int64()), ("form_n", pa.int64()), ("form", pa.string())])


def best_of(words: list[str], n: np.ndarray, own: np.ndarray, others: list[str], other_n: np.ndarray, other: np.ndarray) -> pa.Table:
    """Per word with near ones: their number, and the one of most occurrences, the first in code-point order among ties."""
    if not len(own):
        return _FOUND.empty_table()
    alphabetic = np.empty(len(others), dtype=np.int64)
    alphabetic[sorted(range(len(others)), key=others.__getitem__)] = np.arange(len(others))
    order = np.lexsort((alphabetic[other], -other_n[other], own))
    own, other = own[order], other[order]
    first = np.flatnonzero(np.append(True, own[1:] != own[:-1]))
    return pa.table([
        pa.array([words[k] for k in own[first].tolist()], pa.string()),
        pa.array(np.diff(np.append(first, len(own))), pa.int64()),
        pa.array(other_n[other[first]], pa.int64()),
        pa.array([others[k] for k in other[first].tolist()], pa.string()),
    ], schema=_FOUND)


def compare(table: pa.Table) -> pa.Table:
    """The near words of one cell: words of side 0 against the trie of side 1, or one node with itself."""
    sides = []
    for side in (0, 1):
        part = table.filter(pa.array(table["side"].to_numpy() == side))
        sides.append((part["word"].to_pylist(), part["n"].to_numpy().astype(np.int64)))
    (a, n), (b, m) = sides
    if table["alone"][0].as_py():  # a node with itself: each pair once, then both ways
        left, right = candidates(a, a)
        left, right = left[left < right], right[left < right]
        near = verified(a, a, left, right)
        left, right = left[near], right[near]
        return best_of(a, n, np.append(left, right), a, n, np.append(right, left))
    if not a or not b:
        return _FOUND.empty_table()
    left, right = candidates(a, b)
    near = verified(a, b, left, right)
    left, right = left[near], right[near]
    return pa.concat_tables([best_of(a, n, left, b, m, right), best_of(b, m, right, a, n, left)])


def near_words(words: DataFrame, node_words: int = NODE_WORDS) -> DataFrame:
    """Per word of ``word, n`` with near ones: ``n_near``, and ``form, form_n``, the near one of most occurrences.

    The trie is cut into nodes of at most ``node_words`` words; a task compares two of them that can hold near words, so
    its size is bounded whatever letters are frequent. Words travel once for each such pair of their node.
    """
    placed = settle(words.select("word", "n", paths(F.col("word")).alias("path")))
    nodes = trie_nodes(placed, node_words)
    starts = F.explode(F.sequence(F.lit(0), F.lit(len(LEVELS)))).alias("depth")
    homes = placed.select("word", "n", "path", starts).withColumn("node", F.expr("substring(path, 1, depth)"))
    homes = homes.join(nodes, "node").select("word", "n", "node", F.pmod(F.xxhash64("word"), "blocks").cast("int").alias("block"))
    homes = settle(homes)
    pairs = settle(cells(nodes).withColumn("cell", F.monotonically_increasing_id()))
    alone = (F.col("a") == F.col("b")).alias("alone")
    sides = pairs.select("cell", "a.*", F.lit(0).alias("side"), alone).unionByName(
        pairs.where("a != b").select("cell", "b.*", F.lit(1).alias("side"), alone)
    )
    members = homes.join(sides, ["node", "block"]).select("cell", "side", "alone", "word", "n")
    found = members.groupBy("cell").applyInArrow(compare, "word string, n_near bigint, form_n bigint, form string")
    best = F.min(F.struct((-F.col("form_n")).alias("less"), "form"))
    done = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("best"))
    return done.select("word", "n_near", (-F.col("best.less")).alias("form_n"), "best.form")


def roots(forms: DataFrame) -> DataFrame:
    """``word, root`` of ``word, form``: where the forms lead to in the end.

    A form occurs ten times as often as its word, so paths are short; their length halves each round.
    """
    known = settle(forms.select("word", F.col("form").alias("root")))
    while True:
        further = known.select(F.col("word").alias("root"), F.col("root").alias("next"))
        ahead = known.join(further, "root", "left")
        now = settle(ahead.select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        release(known)
        if now.where("moved").isEmpty():
            return now.drop("moved")
        known = settle(now.drop("moved"))
        release(now)


def spelling_variants(docs: DataFrame, ratio: int = RATIO, node_words: int = NODE_WORDS) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of each word of the texts, with the spelling that it is a variant of.

    Words are the runs of letters (A-Z lower-cased) of at least seven code points that occur twice or more; a run whose
    hash with its ``doc_id`` is divisible by 31 counts without one of its code points. Two words are near if they differ
    by exactly one inserted, deleted or replaced code point. ``form`` is the near word of most occurrences, ``form_n``,
    if these are at least ``ratio`` times the word's own; else both are null. ``root`` is where forms lead to.

    Null text: no words. Null ``doc_id``: hashed as an empty one. Repeated rows count each. Very long texts and words are
    worked on whole. No rows: no words. Other columns of ``docs``, whatever their names, are not looked at.
    """
    words = settle(runs_counted(docs.select("doc_id", "text")))
    near = settle(near_words(words, node_words))
    met = words.join(near, "word", "left")
    enough = F.col("form_n") >= ratio * F.col("n")
    met = settle(met.select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(enough, F.col("form")).alias("form"), F.when(enough, F.col("form_n")).alias("form_n"),
    ))
    led = roots(met.where("form is not null"))
    done = met.join(led, "word", "left").withColumn("root", F.coalesce("root", "word"))
    return done.select("word", "form", "root", "n", "n_near", "form_n")
