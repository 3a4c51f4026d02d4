"""Secrets in texts: fixed patterns, and strings in sensitive places that a primed compressor cannot shorten."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from minelark.llm.texts import slices, whole, with_columns
from minelark.plans.lineage import settle

BASE_KINDS = ("assign", "access", "hex")
KINDS = (*BASE_KINDS, "novel")
AROUND = 160
MIN_LENGTH = 16
NOVELTY = 0.7
LEVEL = 3
DICTIONARY_WORDS = 2_000
MIN_DOCUMENTS = 5

_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]++")
_HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{24,}+")
# fixed values: words that make a place sensitive
SENSITIVE = "access apikey auth authorization bearer credential credentials key passphrase password private pwd secret signature token"
_CHANGE = r"(?-i:(?<=[a-z])(?=[A-Z])|(?<=[A-Z])(?=[A-Z][a-z]))"  # where a word begins or ends in camelCase
_PLACE = re.compile(
    rf"""(?:(?<![A-Za-z])|{_CHANGE})(?:{"|".join(SENSITIVE.split())})(?:(?![a-z])|{_CHANGE})[^\n]{{0,24}}?[\x20"'=:]([A-Za-z0-9+/_=-]{{{MIN_LENGTH},}}+)""",
    re.ASCII | re.IGNORECASE,
)
_IDENTIFIER = r"[A-Za-z_]{4,24}"
# fixed values: identifiers and stand-ins that code and settings use everywhere
COMMON = (
    "changeme placeholder example sample dummy default undefined none null true false your_token_here your_api_key_here "
    "xxxxxxxxxxxxxxxx 0123456789abcdef abcdefghijklmnopqrstuvwxyz ABCDEFGHIJKLMNOPQRSTUVWXYZ import from return function "
    "class public private static const string config settings environment username password client_id client_secret "
    "access_token refresh_token authorization bearer signature credential database connection localhost https://www. .com/"
)


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans by the base rules; the span of an assignment is its whole match."""
    found = [("assign", *m.span()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [("access", *m.span()) for m in _ACCESS.finditer(text) if len(m[0]) >= 20]
    return found + [("hex", *m.span()) for m in _HEX.finditer(text)]


def surroundings(text: str, start: int, end: int) -> dict[str, str]:
    """The text on both sides of a value, without other copies of it, also such as the bounds would cut."""
    value, reach = text[start:end], AROUND + end - start
    before = text[max(0, start - reach) : start].replace(value, "")
    return {"before": before[-AROUND:], "after": text[end : end + reach].replace(value, "")[:AROUND]}


def find(text: str | None) -> list[dict]:
    """Base spans, and candidates with the text around them."""
    text = text or ""
    base = base_spans(text)
    out = [{"base": True, "kind": kind, "start": s, "end": e, "value": None, "before": None, "after": None} for kind, s, e in base]
    for m in _PLACE.finditer(text):
        s, e = m.span(1)
        if not any(start <= s and e <= end for _, start, end in base):
            out.append({"base": False, "kind": "novel", "start": s, "end": e, "value": m[1], **surroundings(text, s, e)})
    return out


_SEEN = [("base", pa.bool_()), ("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]
_CANDIDATE = pa.list_(pa.struct([*_SEEN, ("value", pa.string()), ("before", pa.string()), ("after", pa.string())]))
_FOUND = pa.list_(pa.struct([*_SEEN, ("novelty", pa.float64())]))


def candidates(text: Column) -> Column:
    @arrow_udf("array<struct<base:boolean,kind:string,start:int,end:int,value:string,before:string,after:string>>")
    def scan(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in columns:
            yield pa.array([find(text) for texts in slices(column) for text in texts], _CANDIDATE)

    return scan(text)


def identifiers(found: DataFrame, words: int = DICTIONARY_WORDS, min_documents: int = MIN_DOCUMENTS) -> list[str]:
    """The identifiers around candidates in the most rows, at most ``words`` of up to 24 characters: the dictionary's size.

    All candidates are counted, with partial sums before the shuffle; only the dictionary reaches the driver.
    """
    around = F.concat_ws(" ", F.transform("_ss", lambda s: F.concat_ws(" ", s.before, s.after)))
    seen = found.select(F.explode(F.array_distinct(F.regexp_extract_all(around, F.lit(_IDENTIFIER), F.lit(0)))).alias("word"))
    counts = seen.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_documents)
    return [row.word for row in counts.orderBy(F.desc("n"), "word").limit(words).collect()]


def novelties(found: Column, dictionary: bytes, threshold: float) -> Column:
    """The base spans, and the candidates whose marginal bytes per character reach ``threshold``."""

    @arrow_udf("array<struct<base:boolean,kind:string,start:int,end:int,novelty:double>>")
    def weigh(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        primed = zstandard.ZstdCompressionDict(dictionary, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        primed.precompute_compress(level=LEVEL)
        compressor = zstandard.ZstdCompressor(dict_data=primed, write_content_size=False)

        def size(text: str) -> int:
            return len(compressor.compress(text.encode("utf-8", "surrogatepass")))

        def novelty(s: dict) -> float:
            around = s["before"] + s["after"]
            return (size(around + s["value"]) - size(around)) / len(s["value"])

        for column in columns:
            rows = []
            for row in column.to_pylist():
                weighed = [{**s, "novelty": None if s["base"] else round(novelty(s), 3)} for s in row]
                rows.append([s for s in weighed if s["base"] or s["novelty"] >= threshold])
            yield pa.array([[{n: s[n] for n, _ in _SEEN} | {"novelty": s["novelty"]} for s in row] for row in rows], _FOUND)

    return weigh(found)


def scan_secrets(docs: DataFrame, threshold: float = NOVELTY) -> DataFrame:
    """The columns of ``docs`` but for the text, and ``secrets``: spans in code points, end exclusive.

    Base spans (assignments, access ids, long hex strings) are always there. Strings of 16 or more characters behind a
    sensitive word on the same line, which may be part of a camelCase name, are candidates: how many bytes each adds to
    the text around it, without other copies of the string, compressed with zstandard primed by a dictionary of common identifiers and of those the corpus uses around candidates. From
    ``threshold`` bytes per character on they are reported as ``novel``.

    Null text counts as empty: no spans. Repeated rows are each searched. An input column named ``secrets`` gives way;
    ``_ss`` is reserved. Texts are read once; candidates with their surroundings are stored and weighed from there.
    """
    found = with_columns(docs, {"_ss": candidates(whole(F.col("text")))})
    found = settle(found.drop(*[c for c in found.columns if c.lower() in ("text", "secrets")]))
    dictionary = " ".join([*COMMON.split(), *reversed(identifiers(found))])  # the most frequent ones come last
    return with_columns(found, {"secrets": novelties(F.col("_ss"), dictionary.encode(), threshold)}).drop("_ss")
