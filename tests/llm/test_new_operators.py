"""Spelling variants, the Merkle manifest and the n-gram join: whole tables, plain Python versions and odd input."""

import collections
import hashlib
import random
import re
import zlib
from itertools import combinations

import numpy as np
import pytest

from minelark.llm import manifest, set_join, spelling
from minelark.llm.queries import op12_manifest
from test_edges import SCHEMA, frame
from test_text_queries import QUERIES, SF_DIR, docs, pytestmark  # noqa: F401

ASCII_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def near(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def variants(rows, ratio=10):
    """``word: (form, root, n, n_near, form_n)`` of ``doc_id, text`` rows."""
    n = collections.Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(ASCII_LOWER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            n[run] += 1
    n = {w: k for w, k in n.items() if len(w) >= 7 and k >= 2}
    out = {}
    for word, own in n.items():
        others = [w for w in n if near(word, w)]
        form = min(others, key=lambda w: (-n[w], w), default=None)
        if form is not None and n[form] < ratio * own:
            form = None
        out[word] = (form, own, len(others), n[form] if form else None)

    def root(word):
        return root(out[word][0]) if out[word][0] else word

    return {w: (form, root(w), own, count, form_n) for w, (form, own, count, form_n) in out.items()}


def collected(found):
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in found.collect()}


def misspelt(seed, words=60, texts=200):
    """Texts of few words and many slips, so that forms have forms and nodes of the trie are crowded."""
    draw = random.Random(seed)
    base = ["".join(draw.choice("abént") for _ in range(draw.randrange(7, 11))) for _ in range(words)]

    def slip(word):
        at = draw.randrange(len(word))
        return draw.choice([word[:at] + word[at + 1 :], word[:at] + draw.choice("aét") + word[at + draw.randrange(2) :]])

    def one():
        word = draw.choice(base[: draw.randrange(1, words)])
        for _ in range(draw.choice([0] * 12 + [1, 1, 2])):
            word = slip(word)
        return word.title() if draw.random() < 0.1 else word

    return [(k, draw.choice([" ", "-", "\n"]).join(one() for _ in range(draw.randrange(40)))) for k in range(texts)]


@pytest.mark.parametrize("node_words", [3, 40, 32_768])
def test_variants(spark, node_words):
    rows = [*misspelt(1), (None, "Letterrun letterrun " * 4), (7, None), (8, ""), (9, "y" * 70 + " " + "y" * 70), (10, ("y" * 69 + " ") * 3)]
    rows += [(1000 + k, "abcdefghij") for k in range(500)] + [(2000 + k, "abcdefghix") for k in range(40)] + [(3000 + k, "abcdefghyx") for k in range(3)]
    table = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    want = variants(rows)
    assert any(form and root != form for form, root, *_ in want.values())
    assert collected(spelling.spelling_variants(table, node_words=node_words)) == want


def test_variants_of_whole_documents(spark, docs):
    assert collected(QUERIES["op11_spelling"](spark, SF_DIR)) == variants(zip(docs.doc_id.tolist(), docs.text))


def test_anagrams_beyond_the_last_level(spark):
    draw = random.Random(3)
    words = sorted({"".join(draw.sample("aaabbbcd", 8)) for _ in range(300)})
    table = spark.createDataFrame([(w, k + 1) for k, w in enumerate(words)], "word string, n bigint")
    got = {r.word: (r.n_near, r.form_n, r.form) for r in spelling.near_words(table, 20).collect()}
    assert got == {}  # equal letters, so none is one letter apart
    words.append("aaabbbc")
    table = spark.createDataFrame([(w, 5) for w in words], "word string, n bigint")
    got = {r.word: (r.n_near, r.form) for r in spelling.near_words(table, 20).collect()}
    close = [w for w in words if near(w, "aaabbbc")]
    assert got == {**{w: (1, "aaabbbc") for w in close}, "aaabbbc": (len(close), min(close))}


@pytest.mark.parametrize("leaf", [1, 4, 96])
def test_search_keeps_to_its_budget(leaf):
    draw = random.Random(leaf)
    words = ["".join(draw.choice("abcde") for _ in range(draw.randrange(3, 8))) for _ in range(150)] + ["z" * 90, "z" * 91]
    left, right = spelling.search(spelling.letter_counts(words), spelling.letter_counts(words), leaf)
    counts = spelling.letter_counts(words).astype(int)
    apart = counts[:, None, :] - counts[None, :, :]
    want = (np.maximum(apart, 0).sum(2) <= 1) & (np.maximum(-apart, 0).sum(2) <= 1)
    assert sorted(zip(left.tolist(), right.tolist())) == sorted(zip(*(x.tolist() for x in np.nonzero(want))))
    found = spelling.verified(words, words, left, right)
    assert {(words[a], words[b]) for a, b, ok in zip(left, right, found) if ok} == {(a, b) for a in words for b in words if near(a, b)}


def test_variants_of_odd_input(spark):
    docs = frame(spark)
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert collected(spelling.spelling_variants(docs)) == variants(rows)
    assert spelling.spelling_variants(docs.limit(0)).count() == 0
    assert spelling.spelling_variants(spark.createDataFrame([(None,) * 14], SCHEMA)).count() == 0


# manifest


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return sha(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])


def climb(nodes):
    """The root of these nodes, and per node its siblings on each level, as (before, behind)."""
    proofs, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for k, place in enumerate(at):
            start = place - place % 8
            proofs[k].append(("".join(nodes[start:place]), "".join(nodes[place + 1 : start + 8])))
            at[k] = place // 8
        nodes = [sha(*nodes[k : k + 8]) for k in range(0, len(nodes), 8)]
    return nodes[0], proofs


def tree(rows):
    """``leaf, subroot, root, proof`` of rows (doc_id, source, lang, n_chars, text), in their order."""
    groups = collections.defaultdict(list)
    for k, row in enumerate(rows):
        groups[row[2]].append(((row[0] is not None, row[0] or 0), leaf(row), k))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    below = {g: (members, *climb([m[1] for m in members])) for g, members in ((g, sorted(groups[g])) for g in order)}
    root, above = climb([below[g][1] for g in order])
    out = [None] * len(rows)
    for g, up in zip(order, above):
        members, subroot, proofs = below[g]
        for (_, own, k), proof in zip(members, proofs):
            out[k] = (own, subroot, root, [*proof, *up])
    return out


FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


@pytest.mark.parametrize(("n", "langs"), [(1, 1), (8, 1), (9, 2), (64, 1), (513, 1), (700, 2), (4200, 3), (1300, 1300)])
def test_manifest(spark, n, langs):
    draw = random.Random(n)
    rows = [(k * 7 % 10_007, draw.choice([None, "s"]), f"l{k % langs}" if k % langs else None, draw.choice([None, 3]), draw.choice([None, "", "Text", "é😀"])) for k in range(n)]
    table = spark.createDataFrame(rows, "doc_id bigint, source string, lang string, n_chars bigint, text string").repartition(5)
    got = {r.doc_id: r for r in manifest.manifest(table).collect()}
    assert len(got) == n
    for row, (own, subroot, root, proof) in zip(rows, tree(rows)):
        r = got[row[0]]
        assert (r.leaf, r.subroot, r.root, r.lang) == (own, subroot, root, row[2])
        assert [(p.before, p.behind) for p in r.proof] == proof


def test_manifest_of_whole_documents(spark, docs):
    rows = [tuple(None if v != v else v for v in row) for row in docs[list(FIELDS)].astype(object).itertuples(index=False)]
    got = {r.doc_id: r for r in op12_manifest(spark, SF_DIR).collect()}
    for row, (own, subroot, root, proof) in zip(rows, tree(rows), strict=True):
        changed = own
        if zlib.crc32(str(row[0]).encode()) % 3 == 0 and row[4] is not None:
            changed = leaf((*row[:4], row[4].translate(ASCII_LOWER)))
        for before, behind in proof:
            changed = sha(before, changed, behind)
        want = (own, subroot, root, sha(*[b + a for b, a in proof]), changed, changed == root)
        r = got[row[0]]
        assert (r.leaf, r.subroot, r.root, r.proof_sha256, r.folded_root, r.verified) == want


def test_manifest_of_odd_input(spark):
    docs = frame(spark)
    found = manifest.manifest(docs).collect()
    rows = [tuple(r) for r in docs.select(*FIELDS).collect()]
    want = tree(rows)
    assert sorted((r.leaf, r.subroot, r.root) for r in found) == sorted(w[:3] for w in want)
    proofs = collections.Counter((r.leaf, tuple(tuple(p) for p in r.proof)) for r in found)
    assert proofs == collections.Counter((w[0], tuple(w[3])) for w in want)  # repeated rows have a proof each
    checked = manifest.manifest(docs).select(manifest.folded(manifest.F.col("leaf"), manifest.F.col("proof")).alias("r"), "root")
    assert checked.where("r = root").count() == len(rows)
    assert {"Size", "a.b", "u", "kept"} <= set(manifest.manifest(docs).columns)
    assert manifest.manifest(docs.limit(0)).count() == 0
    assert manifest.manifest(spark.createDataFrame([(None,) * 14] * 3, SCHEMA)).count() == 3


# join


def triples(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(ASCII_LOWER))
    return {tuple(words[k : k + 3]) for k in range(max(1, len(words) - 2))} if words else set()


def joined(rows, percent=90):
    """``doc_id: (n_shingles, component_id)`` of rows with distinct ids."""
    sets = {i: triples(t) for i, t in rows}
    least = {i: i for i in sets}

    def find(i):
        while least[i] != i:
            i = least[i]
        return i

    for a, b in combinations(sorted(sets), 2):
        shared = len(sets[a] & sets[b])
        if shared and 100 * shared >= percent * (len(sets[a]) + len(sets[b]) - shared):
            x, y = sorted((find(a), find(b)))
            least[y] = x
    return {i: (len(s), find(i)) for i, s in sets.items()}


def alike(seed, groups=12, members=20):
    """Groups of texts around the threshold, some of them short, with a passage that all share."""
    draw = random.Random(seed)
    passage, rows = [f"p{k}" for k in range(12)], []
    for g in range(groups):
        base = [f"g{g}w{k}" if draw.random() < 0.8 else f"c{k % 9}" for k in range(draw.choice([1, 2, 3, 9, 11, 40, 130]))]
        for _ in range(draw.randrange(1, members)):
            words = list(base)
            for _ in range(draw.choice([0, 0, 1, 1, 2, 3])):
                words[draw.randrange(len(words))] = f"x{draw.randrange(50)}"
            rows.append(" ".join(words + passage * draw.choice([0, 0, 1])))
    draw.shuffle(rows)
    return list(enumerate(rows, 1))


@pytest.mark.parametrize("percent", [90, 60])
@pytest.mark.parametrize("small", [False, True])
def test_join(spark, monkeypatch, small, percent):
    rows = alike(percent) + [(5000, None), (5001, ""), (5002, " \n"), (5003, "ONE"), (5004, "one"), (5005, "one two")]
    if small:
        monkeypatch.setattr(set_join, "STRAYS", 3)
        monkeypatch.setattr(set_join, "MEMBERS", 4)
    table = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    sizes = {"chunk_shingles": 500, "shard_shingles": 200} if small else {}
    found = set_join.similar_documents(table, percent, **sizes)
    want = joined(rows, percent)
    assert len({c for _, c in want.values()}) < len(want) - 30
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found.collect()} == want


def test_filters_lose_nothing():
    draw = np.random.default_rng(5)
    for percent in (60, 90):
        for _ in range(20):
            base = draw.choice(1 << 40, 60, replace=False).astype(np.uint64)
            sets = []
            for k in range(24):
                own = base[draw.random(60) < draw.choice([0.85, 0.95, 1])]
                own = np.sort(np.append(own, draw.choice(1 << 40, draw.integers(0, 5)).astype(np.uint64)))
                sets.append((k, k, len(own), 0, own))
            got = {tuple(sorted(p)) for p in set_join.probe(sets, sets, percent)}
            want = {(a, b) for a, b in combinations(range(24), 2) if set_join.similar(sets[a][4], sets[a][2], sets[b][4], sets[b][2], percent)}
            assert got == want


def test_join_of_odd_input(spark):
    docs = frame(spark)
    found = set_join.similar_documents(docs)
    done = found.toPandas()
    assert len(done) == docs.count() and {"Size", "a.b", "u", "kept"} <= set(found.columns)
    want = joined({r.doc_id: r.text for r in docs.collect() if r.doc_id is not None}.items())
    named = done[done.doc_id.notna()]
    assert {int(r.doc_id): (r.n_shingles, r.component_id) for r in named.itertuples()} == want
    assert done[done.doc_id.isna()].component_id.isna().all()
    assert set_join.similar_documents(docs.limit(0)).count() == 0
    assert set_join.similar_documents(spark.createDataFrame([(None,) * 14] * 3, SCHEMA)).count() == 3


def test_rows_of_one_id_are_one_document(spark):
    text = " ".join(f"w{k}" for k in range(60))
    rows = [(5, text), (5, "quite another text here"), (3, text + " end"), (9, "quite another text here")]
    found = set_join.similar_documents(spark.createDataFrame(rows, "doc_id bigint, text string"))
    assert {(r.doc_id, r.n_shingles, r.component_id) for r in found.collect()} == {(5, 58, 3), (3, 59, 3), (9, 2, 3)}


def test_no_shingle_shared(spark):
    rows = [(k, f"a{k} b{k} c{k} d{k}") for k in range(5)]
    found = set_join.similar_documents(spark.createDataFrame(rows, "doc_id bigint, text string"))
    assert {(r.doc_id, r.n_shingles, r.component_id) for r in found.collect()} == {(k, 2, k) for k in range(5)}
