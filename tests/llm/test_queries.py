"""Registered queries on the given tables: against DuckDB where SQL can express them,
else against brute force, the library, or held-out labels."""

import os
import re
import zlib

import duckdb
import numpy as np
import pandas as pd
import pytest
import xxhash

import corpus_pipeline
from brute import near_components

from terrasheaf.llm import bpe, simhash, span_dedup
from terrasheaf.llm.common import merge_labels
from terrasheaf.llm.queries import ORACLES, QUERIES, vocabulary

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="needs the given tables")


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for name in ("documents", "benchmark", "pages", "labels", "embeddings"):
        con.execute(f"create view {name} as select * from '{SF}/{name}.parquet'")
    return con


@pytest.fixture(scope="module")
def docs():
    return pd.read_parquet(f"{SF}/documents.parquet").sort_values("doc_id")


def test_all_are_registered():
    assert [re.match(r"op\d+_", n)[0] for n in sorted(QUERIES, key=lambda n: int(n[2:].split("_")[0]))] == [f"op{k}_" for k in range(1, 14)]


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_against_sql(spark, con, name):
    got, want = QUERIES[name](spark, SF).toPandas(), con.execute(ORACLES[name]).df()
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    table = lambda df: sorted(map(repr, df[columns].astype(object).where(df[columns].notna(), None).itertuples(index=False, name=None)))
    assert table(got) == table(want)


def test_simhash_query(spark, docs):
    got = QUERIES["op8_simhash_dedup"](spark, SF).toPandas().set_index("doc_id")
    codes = []
    for text in docs.text:
        words = re.findall(rb"[^\x20\x09-\x0D]+", text.encode().lower())
        hs = [xxhash.xxh64_intdigest(b" ".join(words[i : i + 4]), 42) for i in range(max(1, len(words) - 3))]
        codes.append(sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs)) if words else 0)
    lab = np.arange(len(codes))
    arr = np.array(codes, np.uint64)
    merge_labels(lab, *np.nonzero(np.bitwise_count(arr[:, None] ^ arr) <= 4))
    ids = docs.doc_id.to_numpy()
    for k, (i, code) in enumerate(zip(ids, codes)):
        assert got.fingerprint[i] == f"{code:016x}" and got.component_id[i] == ids[lab == lab[k]].min()


def test_token_queries(spark, docs):
    from hashlib import sha256

    from tokenizers import Tokenizer

    word, byte = (Tokenizer.from_file(vocabulary(f)) for f in ("word_bpe_49k.json", "byte_bpe_50k.json"))
    words = QUERIES["op3_bpe"](spark, SF).toPandas().set_index("doc_id")
    files = QUERIES["op4_token_files"](spark, SF).toPandas().set_index("doc_id")
    start = 0
    for i, text in zip(docs.doc_id, docs.text):
        ids = word.encode(text, add_special_tokens=False).ids
        assert words.n_tokens[i] == len(ids) and words.ids_sha256[i] == sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert words.decoded_sha256[i] == sha256(word.decode(ids, skip_special_tokens=False).encode()).hexdigest()
        ids = [*byte.encode(text, add_special_tokens=False).ids, 0]
        assert tuple(files.loc[i, ["start", "n_tokens", "ids_crc32"]]) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)


def test_language_on_held_out_rows(spark, docs):
    got = QUERIES["op6_language_id"](spark, "/root/testdata/sf0.01").toPandas()
    truth = pd.read_parquet("/root/testdata/sf0.01/documents.parquet")[["doc_id", "lang"]].merge(got, on="doc_id")
    held = truth[truth.held_out]
    assert len(truth) == 1000 and (held.lang == held.lang_pred).mean() > 0.98
    assert all(h == (zlib.crc32(str(i).encode()) % 4 == 2) for i, h in zip(truth.doc_id, truth.held_out))


def test_html_query_gives_the_articles(spark):
    import html

    got = QUERIES["op7_html_text"](spark, SF).toPandas().set_index("page_id")
    pages = pd.read_parquet(f"{SF}/pages.parquet")
    for i, page in zip(pages.page_id, pages.html):
        article = page.split("<article>")[1].split("</article>")[0]
        blocks = [" ".join(html.unescape(re.sub("<[^>]*>", "", b)).split()) for b in re.split("</?(?:p|h1|br)>", article)]
        want = "\n\n".join(b for b in blocks if b)
        assert got.text[i] == want and got.n_chars[i] == len(want)


def test_importance_query_separates_labels(spark):
    sf = "/root/testdata/sf0.01"
    got = QUERIES["op10_importance"](spark, sf).toPandas().merge(pd.read_parquet(f"{sf}/labels.parquet"), on="doc_id")
    assert got[got.quality == 1].kept.mean() > 0.9 and got[got.quality == 0].kept.mean() < 0.2


def test_pipeline_against_brute_force(spark, con, docs):
    """Every stage again in plain Python, from the verdicts of the quality SQL on."""
    from tokenizers import Tokenizer

    good = set(con.execute(f"select doc_id from ({ORACLES['op2_quality_rules']}) where kept").df().doc_id)
    left = [(i, t) for i, t in zip(docs.doc_id, docs.text) if i in good]
    lab = near_components([t for _, t in left])
    left = [d for k, d in enumerate(left) if lab[k] == k]  # ids ascend, so roots are the smallest
    seen, drop = {}, {}
    for i, text in left:
        for first, n, mark in span_dedup.runs(text):
            if seen.setdefault(mark, (i, first)) != (i, first):
                drop.setdefault(i, set()).update(range(first, first + n))
    left = [
        (i, "".join(s for k, s in enumerate(span_dedup.sentences(t)) if k not in drop[i]).rstrip(" \t\n\x0b\x0c\r") if i in drop else t)
        for i, t in left
    ]
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t))
    windows = set()
    for text in con.execute("select text from benchmark").df().text:
        ws = words(text)
        windows |= {tuple(ws[k : k + 10]) for k in range(max(1, len(ws) - 9))}
    sizes = {len(w) for w in windows}
    hit = lambda ws: any(tuple(ws[k : k + n]) in windows for n in sizes for k in range(len(ws) - n + 1))
    left = [(i, t) for i, t in left if not hit(words(t))]
    library = Tokenizer.from_file(vocabulary("word_bpe_49k.json"))
    want = {i: library.encode(t, add_special_tokens=False).ids for i, t in left}
    got = {r["doc_id"]: np.frombuffer(bytes(r["ids"]), "<u4").tolist() for r in corpus_pipeline.run(spark, SF).collect()}
    assert got == want and 0 < len(got) < len(good)


def test_stages_keep_the_columns(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").selectExpr("*", "doc_id as n_removed", "'x' as row", "'y' as whole")
    for name, step in corpus_pipeline.STAGES[:-1]:
        assert step(spark, docs.limit(0), SF).columns == docs.columns, name
    cut = corpus_pipeline.repeated_spans(spark, docs, SF)
    assert cut.where("n_removed <> doc_id").count() == 0 and cut.where("n_chars <> length(text)").count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, docs.limit(0), SF).count() == 0
    assert bpe.load(vocabulary("word_bpe_49k.json")).encode([None]) == [b""]
