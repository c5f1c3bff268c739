"""Texts built to collide under hashes that sum bytes by place or by the powers of one base."""

import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from auditora.llm import lines, ngram_join, packing, pfor, substrings, tokens
from auditora.llm import text as tx
from tests.llm.test_operators import jaccard_components, kept_words

FAR = 1 << 16


def thue_morse(n, a, b):
    return [(a, b)[k.bit_count() & 1] for k in range(n)]


def twins(kind):
    """Two different texts of equal length without white space."""
    if kind == "far":
        return "a" * FAR + "b" * FAR, "b" * FAR + "a" * FAR
    n = int(kind)
    return "".join(thue_morse(n, "a", "b")), "".join(thue_morse(n, "b", "a"))


KINDS = ["far", "1024", "2048", "4096"]


@pytest.mark.parametrize("kind", KINDS)
def test_spans_of_twins_differ(kind):
    a, b = twins(kind)
    offsets, data = tx.column_bytes(pa.array([a + b + a]))
    n = len(a)
    starts, lengths = tx.np.array([0, n, 2 * n]), tx.np.full(3, n)
    for seed in (0, 1, 2):
        x, y, z = tx.span_hashes(data, starts, lengths, seed).tolist()
        assert x != y and x == z
    assert tx.same_spans(data, starts, starts[[1, 1, 0]], lengths).tolist() == [False, True, True]
    first, inverse = tx.distinct_spans(data, starts, lengths)
    assert inverse[0] == inverse[2] != inverse[1] and len(first) == 2


def test_equal_hashes_are_told_apart_by_their_bytes(monkeypatch):
    parts = ["ab", "cd", "ab", "", "x" * 40, "x" * 39 + "y", "ab", "é"]
    data = tx.np.frombuffer("".join(parts).encode(), tx.np.uint8)
    lengths = tx.np.array([len(p.encode()) for p in parts])
    starts = tx.np.cumsum(lengths) - lengths
    monkeypatch.setattr(tx, "span_hashes", lambda data, starts, lengths, seed=0: tx.np.zeros(len(starts), tx.U))
    first, inverse = tx.distinct_spans(data, starts, lengths)
    assert [parts[first[k]] for k in inverse] == parts and len(first) == len(set(parts))
    path = tokens.tokenizer_path()
    texts = ["one two three one", "", None, "two  one"]
    want = [Tokenizer.from_file(path).encode(t or "", add_special_tokens=False).ids for t in texts]
    assert [ids.tolist() for ids in tokens.Encoder(path).rows(pa.array(texts), None)] == want


@pytest.mark.parametrize("kind", KINDS)
def test_operators_on_twins(spark, kind):
    a, b = twins(kind)
    path = tokens.tokenizer_path()
    library = Tokenizer.from_file(path)
    rows = [(1, a), (2, b), (3, a + " " + b), (4, b + " " + a)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    want = {i: len(library.encode(t, add_special_tokens=False).ids) + 1 for i, t in rows}
    assert [ids.tolist() for ids in tokens.Encoder(path).rows(pa.array([t for _, t in rows]), None)] == [library.encode(t, add_special_tokens=False).ids for _, t in rows]
    assert {r.doc_id: r.n_tokens for r in pfor.round_trip(frame).collect()} == want
    assert {r.doc_id: r.doc_tokens for r in packing.pack(frame).collect()} == want
    assert sorted(map(tuple, ngram_join.near_duplicates(frame).collect())) == jaccard_components(rows)
    three = spark.createDataFrame([(1, f"{a}\n{b}\n{a}"), (2, f"{b}\n{a}\n{b}"), (3, f"{a}\n{b}\n{a}")], "doc_id long, text string")
    assert {r.doc_id: r.n_removed for r in lines.dedup_lines(three).collect()} == {1: 0, 2: 0, 3: 3}
    # Windows of fifty words and long passages of two words in the same order of signs.
    plain = thue_morse(4096, "red", "blue")
    other = thue_morse(4096, "blue", "red")
    rows = [(1, " ".join(plain[:1024])), (2, " ".join(other[:1024])), (3, " ".join([a] * 25 + [b] * 25)), (4, " ".join([b] * 25 + [a] * 25)), (5, " ".join([a] * 25 + [b] * 25))]
    got = substrings.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(map(tuple, got)) == sorted(kept_words(rows, 50))


def test_scratch_goes_with_its_block(spark, tmp_path, monkeypatch):
    import os

    from pyspark.sql import functions as F

    from auditora import scratch as shared
    from auditora.llm import mixing

    monkeypatch.setattr(shared, "shared_dir", lambda spark: f"file://{tmp_path}")
    monkeypatch.setattr(shared, "_kept", [])
    frame = spark.createDataFrame([(k, "a b c d e f g h " * 20, "s") for k in range(30)], "doc_id long, text string, source string")
    tables = [t.name for t in spark.catalog.listTables()]
    for operator, names in ((ngram_join.near_duplicates, {"classes", "components"}), (substrings.remove_repeats, {"texts", "ranges"})):
        out = operator(frame)
        assert {f.split("-")[0] for f in os.listdir(tmp_path)} == names
        assert out.count() == 30
        shared.release(spark)
        assert os.listdir(tmp_path) == []
    with shared.passing(spark):
        assert mixing.mix(frame).agg(F.sum("copies")).first()[0] is not None and os.listdir(tmp_path)
    assert os.listdir(tmp_path) == [] and [t.name for t in spark.catalog.listTables()] == tables


def test_idle_memo_is_given_back(monkeypatch):
    import time

    monkeypatch.setattr(tokens, "IDLE_SECONDS", 0.2)
    path = tokens.tokenizer_path()
    with tokens.worker_encoder(path) as encoder:
        first = [x.tolist() for x in encoder.rows(pa.array(["one two"]))]
    with tokens.worker_encoder(path) as again:
        assert again is encoder and again.place
        time.sleep(0.5)
        assert again.place, "in use"
        assert [x.tolist() for x in again.rows(pa.array(["one two"]))] == first
    time.sleep(0.6)
    assert not encoder.place
