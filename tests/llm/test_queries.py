"""Every registered opN_ query on small tables, against brute force or its contract."""

import hashlib
import random
import re
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import types as T
from tokenizers import Tokenizer

from auditora.llm import licenses, media, pieces, queries, tokens
from tests.llm.test_operators import jaccard_components, kept_words, words_of
from tests.llm.test_phrases_draws_pieces import brute_collocations, brute_resample

CONTRACTS = {
    "op1_packing": "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long",
    "op2_substring_dedup": "doc_id long, n_words long, n_removed long, kept_sha256 string",
    "op3_token_ids": "doc_id long, start long, n_tokens long, ids_crc32 long",
    "op4_language_id": "doc_id long, held_out boolean, lang_pred string, score double",
    "op5_line_dedup": "doc_id long, n_lines long, n_removed long, kept_sha256 string",
    "op6_ngram_join": "doc_id long, n_shingles long, component_id long",
    "op7_source_mixing": "doc_id long, size long, source_size long, target double, taken long",
    "op8_media": "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string",
    "op9_permutation_search": "query_id long, rank int, vec_id long, score double",
    "op10_license_scan": "doc_id long, n_sentences long, licenses string, n_licenses long",
    "op11_collocations": "lang string, rank long, phrase string, a long, l long, r long, n long, score long",
    "op12_resampling": "doc_id long, n_features long, weight long, score long, rank long",
    "op13_sentencepiece": "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string",
}


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("tables")
    draw = random.Random(31)
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars").collect()][:150]
    top = max(r[0] for r in rows) + 1
    licence = "Released under the MIT License.\nmore"
    rows += [(top, None, None, None, None), (top + 1, "", "en", "a", 0), (top + 2, " \t\n <b>&amp; \"x\" \x0b", "en", "a", 16), (top + 3, licence, "en", None, 9), (top + 4, " ".join(draw.choice("abcdef") for _ in range(30000)), "en", "a", 1), (top + 5, rows[3][1], "en", "z", 1), (top + 6, "12 !? 34", "en", "z", 8), (top + 7, "é" * 4000, "fr", "z", 4000)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(rows, schema).write.parquet(f"{folder}/documents.parquet")
    spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").write.parquet(f"{folder}/benchmark.parquet")
    vectors = np.random.default_rng(5).normal(size=(400, 16))
    spark.createDataFrame([(k, v.tolist(), 1) for k, v in enumerate(vectors)], "vec_id long, embedding array<double>, label int").write.parquet(f"{folder}/embeddings.parquet")
    return str(folder), rows, vectors


@pytest.fixture(scope="module")
def results(spark, tables):
    held = {}

    def result(name):
        if name not in held:
            out = queries.QUERIES[name](spark, tables[0])
            want = T._parse_datatype_string(CONTRACTS[name])
            have = {f.name: f.dataType for f in out.schema}
            assert {f.name: f.dataType for f in want}.items() <= have.items(), name
            held[name] = out.toPandas()
        return held[name]

    return result


@pytest.mark.parametrize("name", list(CONTRACTS))
def test_every_document_has_its_rows(results, tables, name):
    got = results(name)
    if name not in ("op1_packing", "op9_permutation_search", "op11_collocations"):
        assert sorted(got["doc_id"]) == sorted(r[0] for r in tables[1])
    assert list(queries.QUERIES) == list(CONTRACTS)


def test_token_queries(results, tables):
    library = Tokenizer.from_file(tokens.tokenizer_path())
    ids = {r[0]: np.array([*library.encode(r[1] or "", add_special_tokens=False).ids, 0], "<u4") for r in tables[1]}
    start = 0
    read = results("op3_token_ids").set_index("doc_id")
    for doc in sorted(ids):
        assert read.loc[doc, ["start", "n_tokens", "ids_crc32"]].tolist() == [start, len(ids[doc]), zlib.crc32(ids[doc].tobytes())]
        start += len(ids[doc])
    pieces = results("op1_packing")
    for doc, own in pieces.sort_values("start").groupby("doc_id"):
        at = 0
        for r in own.itertuples():
            assert (r.start, r.doc_tokens) == (at, len(ids[doc])) and r.ids_crc32 == zlib.crc32(ids[doc][at : at + r.length].tobytes())
            at += r.length
        assert at == len(ids[doc])
    for _, own in pieces.sort_values("offset").groupby("sequence_id"):
        assert own["length"].sum() <= 1024 and (own["offset"] == own["length"].cumsum() - own["length"]).all()
    assert pieces["length"].sum() >= 0.97 * 1024 * pieces["sequence_id"].nunique()


def test_language_query_is_accurate_on_what_it_has_not_seen(results, tables):
    got = results("op4_language_id").set_index("doc_id")
    known, right = 0, 0
    for doc, text, lang, *_ in tables[1]:
        r = got.loc[doc]
        assert r.held_out == (zlib.crc32(str(doc).encode()) % 4 == 2) and 0 <= r.score <= 1
        assert (r.lang_pred == "und") == (not any(c.isalpha() for c in text or ""))
        if r.held_out and lang and text and len(words_of(text)) > 5 and doc <= 150:
            known += 1
            right += r.lang_pred == lang
    assert known > 20 and right >= 0.95 * known


def test_mixing_query_takes_what_targets_say(results, tables):
    got = results("op7_source_mixing")
    sizes = {r[0]: len(words_of(r[1])) for r in tables[1]}
    assert dict(zip(got["doc_id"], got["size"], strict=True)) == sizes
    total, source = 0.0, {r[0]: r[3] for r in tables[1]}
    got["source"] = got["doc_id"].map(source)
    for _, own in got.groupby("source", dropna=False):
        assert own["source_size"].nunique() == 1 and own["source_size"].iloc[0] == own["size"].sum()
        target = own["target"].iloc[0]
        total += target
        assert (own["taken"] <= 2 * own["size"]).all() and ((own["size"] == 0) | (own["taken"] % own["size"].clip(lower=1) == 0)).all()
        assert abs(own["taken"].sum() - target) <= max(0.02 * target, own["size"].max() / 2)
    assert abs(total - 1.5 * got["size"].sum()) < 1e-6 * total


def test_media_query(results, tables):
    got = results("op8_media").set_index("doc_id")
    for doc, text, *_ in tables[1]:
        content = (text or "").encode()
        payload = content + b"\xff" * (-len(content) % 576 or (0 if content else 576))
        stored = media.to_pgm(payload, len(content))
        r = got.loc[doc]
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(content), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-32:]))
        assert (r.media_bytes, r.media_sha256, r.feature) == (len(stored), hashlib.sha256(stored).hexdigest(), media.features(payload))
        # The figure stands behind the paragraphs that hold a word.
        assert r.position == sum(bool(line.split()) for line in (text or "").split("\n")) and r.caption == f"document {doc}"


def test_license_query(results, tables):
    """Sentences looked for one by one in each text, and rules in their order."""
    got = results("op10_license_scan").set_index("doc_id")
    named = {doc: [k for k in got.loc[doc, "licenses"].split(";") if k] for doc, *_ in tables[1]}
    assert all(len(v) == got.loc[d, "n_licenses"] for d, v in named.items())
    plain = lambda t: " " + " ".join(re.findall(r"[a-z0-9]+", t.lower())) + " "
    known = [plain(s) for s in licenses.SENTENCES.values()]
    for doc, text, *_ in tables[1]:
        there = any(k in plain(text or "") for k in known) or "spdx-license-identifier" in (text or "").lower()
        assert there or got.loc[doc, "n_sentences"] == 0
    last = [r for r in tables[1] if r[1] and r[1].startswith("Released")][0][0]
    assert named[last] == ["MIT"]


def test_search_query(results, tables):
    got, vectors = results("op9_permutation_search"), tables[2]
    hit = 0
    for q in range(0, 400, 20):
        score = vectors @ vectors[q]
        score[q] = -np.inf
        own = got[got.query_id == q].sort_values("rank")
        assert own["rank"].tolist() == list(range(1, 21)) and np.allclose(own["score"], score[own.vec_id], rtol=1e-12)
        hit += len(set(np.argsort(-score)[:20]) & set(own.vec_id))
    assert hit >= 0.9 * 20 * 20


@pytest.mark.parametrize("name", list(queries.ORACLE_SQL))
def test_queries_equal_their_sql(results, tables, name):
    base = duckdb.connect()
    for name_of in ("documents", "benchmark"):
        base.execute(f"CREATE VIEW {name_of} AS SELECT * FROM read_parquet('{tables[0]}/{name_of}.parquet/*.parquet')")
    want = base.execute(queries.ORACLE_SQL[name]).df()
    got = results(name)
    assert sorted(want.columns) == sorted(got.columns)
    key = lambda f: sorted(map(tuple, f[sorted(f.columns)].astype(object).where(f[sorted(f.columns)].notna(), None).values.tolist()), key=str)
    assert key(want) == key(got)


def test_dedup_queries_equal_brute_force(results, tables):
    rows = [r for r in tables[1] if len(r[1] or "") < 40000]
    whole = {doc: (n, gone, hashlib.sha256(kept.encode()).hexdigest()) for doc, n, gone, kept in kept_words(tables[1], 50)}
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in results("op2_substring_dedup").itertuples()} == whole
    near = {r.doc_id: (r.n_shingles, r.component_id) for r in results("op6_ngram_join").itertuples()}
    assert near == {i: (n, c) for i, n, c in jaccard_components(tables[1])} and len(rows) > 100


def test_collocation_query(results, tables):
    want = brute_collocations([(r[0], r[1], r[2]) for r in tables[1]], 100, 5, 2000)
    assert want and sorted(map(tuple, results("op11_collocations").values.tolist())) == sorted(want)


def test_resampling_query(results, tables, spark):
    target = [r.text for r in spark.read.parquet(f"{tables[0]}/benchmark.parquet").collect()]
    want, drawn = brute_resample([(r[0], r[1], r[2]) for r in tables[1]], target)
    got = results("op12_resampling").set_index("doc_id")
    ranks = {o[0]: k for k, o in enumerate(drawn, 1)}
    for doc, n, weight, score, _ in want:
        row = got.loc[doc]
        assert (row["n_features"], row["weight"], row["score"]) == (n, weight, score)
        assert row["rank"] == ranks[doc] if doc in ranks else np.isnan(row["rank"])


def test_sentencepiece_query(results, tables):
    from sentencepiece import SentencePieceProcessor

    library = SentencePieceProcessor(model_file=pieces.model_path())
    got = results("op13_sentencepiece").set_index("doc_id")
    for r in tables[1]:
        ids = library.encode(r[1] or "", add_eos=True)
        digest = lambda x: hashlib.sha256(x.encode()).hexdigest()
        assert got.loc[r[0]].tolist() == [len(ids), digest(" ".join(map(str, ids))), digest(library.decode(ids))]
