"""The registered queries over whole tables at the smallest scale, against SQL or a plain Python version."""

import html
import os
import re

import duckdb
import pandas as pd
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import brute
import corpus_pipeline
from minelark.llm import pii, secret_scan
from minelark.llm.oracles import ORACLES, QUALITY
from minelark.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables are absent")


def connection(documents=None):
    duck = duckdb.connect()
    for file in os.listdir(SF_DIR):
        duck.execute(f"CREATE VIEW {file[:-8]} AS SELECT * FROM '{SF_DIR}/{file}'")
    if documents is not None:
        duck.execute("DROP VIEW documents")
        duck.register("documents", documents)
    return duck


@pytest.fixture(scope="module")
def docs():
    return pd.read_parquet(f"{SF_DIR}/documents.parquet")


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_sql(spark, name):
    want, got = connection().execute(ORACLES[name]).df(), QUERIES[name](spark, SF_DIR).toPandas()
    columns = sorted(want.columns)
    assert sorted(got.columns) == columns
    a, b = (df[columns].sort_values(columns).reset_index(drop=True) for df in (got, want))
    pd.testing.assert_frame_equal(a, b, check_dtype=False)


def rows(spark, name, key="doc_id"):
    return QUERIES[name](spark, SF_DIR).toPandas().set_index(key, verify_integrity=True)


def mix_is_right(mixed):
    """``mixed`` has a row per document: source, size, source_size, target, taken."""
    sizes = mixed.groupby("source", dropna=False)["size"].sum()
    want = brute.targets({None if pd.isna(s) else s: int(n) for s, n in sizes.items()})
    for source, part in mixed.groupby("source", dropna=False):
        target = want[None if pd.isna(source) else source]
        assert (part.source_size == part["size"].sum()).all()
        assert part.target.tolist() == pytest.approx([target] * len(part))
        assert abs(part.taken.sum() - target) <= part["size"].max() + 1e-6
    assert (mixed.taken <= 3 * mixed["size"]).all()
    filled = mixed[mixed["size"] > 0]
    share, copies = filled.target / filled.source_size, filled.taken / filled["size"]
    assert ((copies - share).abs() < 1).all() and (copies == copies.round()).all()


def test_mixing(spark, docs):
    mixed, again = rows(spark, "op1_mixing"), rows(spark, "op1_mixing")
    pd.testing.assert_frame_equal(mixed.sort_index(), again.sort_index())
    assert mixed["size"].to_dict() == {r.doc_id: len(brute.words(r.text)) for r in docs.itertuples()}
    mix_is_right(mixed.join(docs.set_index("doc_id").source))


def test_language_model(spark, docs):
    got = rows(spark, "op3_lm_scoring")
    model = brute.KneserNey([r.text for r in docs.itertuples() if not brute.held_out(r.doc_id)])
    for r in docs.itertuples():
        tokens, known, base, score = model.scores(r.text)
        here = got.loc[r.doc_id]
        assert (here.held_out, here.n_tokens, here.n_known, here.train_tokens) == (brute.held_out(r.doc_id), tokens, known, model.n)
        assert here.base_score == pytest.approx(base, rel=1e-12) and here.score == pytest.approx(score, rel=1e-12)
    out = got[got.held_out]
    assert out.score.sum() > out.base_score.sum()  # less perplexed than the unigrams by texts it has not seen


def test_html(spark):
    pages = pd.read_parquet(f"{SF_DIR}/pages.parquet").set_index("page_id")
    got = rows(spark, "op4_html_extraction", "page_id")
    assert len(got) == len(pages)
    for page, source in pages.html.items():
        article = re.search(r"<article>(.*?)</article>", source, re.S)[1]
        parts = (html.unescape(re.sub("<[^>]*>", "", part.replace("<br>", " "))) for part in re.split(r"</?(?:p|h1)>", article))
        want = "\n\n".join(filter(None, (" ".join(part.split()) for part in parts)))
        assert (got.text[page], got.n_chars[page], got.url[page]) == (want, len(want), pages.url[page])


@pytest.mark.parametrize(
    ("name", "find", "kinds"),
    [("op9_pii", brute.pii, pii.BASE_KINDS), ("op5_secret_scan", brute.secrets, secret_scan.BASE_KINDS)],
)
def test_spans(spark, docs, name, find, kinds):
    got = rows(spark, name)
    assert len(got) == len(docs)
    for r in docs.itertuples():
        base, here = find(r.text), got.loc[r.doc_id]
        assert here.base_sha256 == brute.digest(base, kinds)
        assert [here[f"n_{k}"] for k in kinds] == [sum(s[0] == k for s in base) for k in kinds]
        assert {f"{k}:{a}:{b}" for k, a, b in base} <= set(here.spans.split(",")) | {""}


def test_token_counts(spark, docs):
    got = rows(spark, "op8_token_counts")
    library = Tokenizer.from_file(str(public_tokenizers.path("byte_bpe_50k.json")))
    for r, done in zip(docs.itertuples(), library.encode_batch(list(docs.text), add_special_tokens=False)):
        here = got.loc[r.doc_id]
        assert (here.n_bytes, here.n_tokens, here.over_limit) == (len(r.text.encode()), len(done), len(done) > 512)


def test_near_duplicates(spark, docs):
    got = rows(spark, "op10_near_dedup")
    texts = docs.set_index("doc_id").text.to_dict()
    want = brute.components(texts)
    assert got.component_id.to_dict() == want
    assert got.n_shingles.to_dict() == {i: len(brute.shingles(t)) for i, t in texts.items()}
    assert got.kept.to_dict() == {i: i == c for i, c in want.items()}


def brute_pipeline(docs):
    """The documents that go into the mix, by id."""
    kept = connection(docs).execute(f"SELECT doc_id FROM ({QUALITY}) WHERE kept").df().doc_id
    texts = docs[docs.doc_id.isin(kept)].set_index("doc_id").text.to_dict()
    texts = {i: text for i, (text, _, _) in brute.without_shared_lines(texts).items()}
    texts = {i: texts[i] for i, c in brute.components(texts).items() if i == c}
    items = pd.read_parquet(f"{SF_DIR}/benchmark.parquet").set_index("item_id").text.to_dict()
    leaked = {d for d, *_ in brute.held_items(texts, items)}
    return {i: text for i, text in texts.items() if i not in leaked}


def test_pipeline(spark, docs):
    mixed = corpus_pipeline.run(spark, SF_DIR).toPandas()
    left = brute_pipeline(docs)
    assert dict(zip(mixed.doc_id, mixed.text)).items() <= left.items()
    frame = docs[docs.doc_id.isin(left)][["doc_id", "source"]].copy()
    frame["size"] = [len(brute.words(left[i])) for i in frame.doc_id]
    frame["source_size"] = frame.groupby("source")["size"].transform("sum")
    frame["target"] = frame.source.map(brute.targets(frame.groupby("source")["size"].sum().to_dict()))
    copies = mixed.groupby("doc_id").size()
    frame["taken"] = frame.doc_id.map(copies).fillna(0) * frame["size"]
    mix_is_right(frame)
    assert (mixed.groupby("doc_id").copies.first() == copies).all()


def test_every_stage_but_the_last_returns_the_columns_of_documents(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SF_DIR).columns == docs.columns
