"""Phrase collocations, importance resampling and SentencePiece ids against brute force and the library."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor

from auditora.llm import collocations, pieces, resample

SCHEMA = "doc_id long, text string, lang string, source string, n string, score string, rank string, key string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "s", "n", "score", "rank", "key") for r in rows], SCHEMA)


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def brute_collocations(rows, least, longest, top):
    counts, totals = Counter(), Counter()
    for _, text, lang in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower(text)):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang or "und"] += len(words)
            for k in range(1, longest + 1):
                for i in range(len(words) - k + 1):
                    counts[lang or "und", tuple(words[i : i + k])] += 1
    counts = {key: n for key, n in counts.items() if n >= least}
    covered = set()
    for (lang, words), n in counts.items():
        for m in range(2, len(words)):
            for i in range(len(words) - m + 1):
                if n >= counts[lang, words[i : i + m]]:
                    covered.add((lang, words[i : i + m]))
    out = []
    for (lang, words), a in counts.items():
        if len(words) >= 2 and (lang, words) not in covered:
            cuts = [(1000 * a * totals[lang] // (counts[lang, words[:k]] * counts[lang, words[k:]]), k) for k in range(1, len(words))]
            score, k = min(cuts)
            out.append((lang, -score, -a, " ".join(words).encode(), counts[lang, words[:k]], counts[lang, words[k:]], totals[lang]))
    ranked, seen = [], Counter()
    for lang, score, a, phrase, left, right, n in sorted(out):
        seen[lang] += 1
        if seen[lang] <= top:
            ranked.append((lang, seen[lang], phrase.decode(), -a, left, right, n, -score))
    return ranked


@pytest.fixture(scope="module")
def talk():
    draw = random.Random(8)
    vocabulary = ["the", "The", "of", "new", "york", "city", "é", "日本", "x1", "a\x85b", "-", "rare" + "z" * 90]
    rows = []
    for k in range(160):
        words = [draw.choice(vocabulary) for _ in range(draw.choice((0, 1, 2, 30, 60)))]
        at = draw.randrange(len(words) + 1)
        words[at:at] = "in the city of new york".split()
        text = "".join(w + draw.choice((" ", " ", "  ", "\t", ", ", ".", "\n", "?! ")) for w in words)
        rows.append((k, text, draw.choice(("en", "en", "en", "de", None))))
    rows += [(900, None, "en"), (901, "", "en"), (902, " \t.;\n", "fr"), (None, "lone word", "fr"), rows[3], rows[3], (903, "new york " * 4000, "en")]
    return rows


@pytest.mark.parametrize("least, longest, top", [(5, 5, 2000), (12, 5, 7), (5, 2, 3), (40, 3, 2000)])
def test_collocations_equal_brute_force(spark, talk, least, longest, top):
    got = collocations.collocations(frame(spark, talk), least=least, longest=longest, top=top)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(map(tuple, got.collect())) == sorted(brute_collocations(talk, least, longest, top))


def test_a_large_numbering_gives_the_same_rows(spark, talk, monkeypatch):
    monkeypatch.setattr(collocations, "TASK_KEYS", 50)
    got = collocations.collocations(frame(spark, talk), least=5, small=0)
    assert sorted(map(tuple, got.collect())) == sorted(brute_collocations(talk, 5, 5, 2000))


def test_no_rows_no_phrases(spark, talk):
    assert collocations.collocations(frame(spark, [])).count() == 0
    assert collocations.collocations(frame(spark, talk[:3])).count() == 0
    assert collocations.collocations(frame(spark, [(1, None, None), (2, "", "x")]), least=1).count() == 0


def test_runs_over_batches_and_ranges_equal_counts():
    draw = random.Random(9)
    keys = np.array(sorted([[*k, *[0] * (4 - len(k))] for k in (tuple(draw.randrange(1, 4) for _ in range(draw.choice((2, 3, 4)))) for _ in range(700))]), np.uint32)
    want = Counter()
    for key in keys.tolist():
        for n in range(2, 5):
            if key[n - 1]:
                want[tuple(key[:n])] += 2
    got = Counter()
    for low, high in ((0, 300), (300, 301), (301, 700)):
        cuts = sorted({low, high, *(draw.randrange(low, high) for _ in range(9))})
        for n, heads, sums in collocations.count_runs(((keys[a:b], np.full(b - a, 2)) for a, b in zip(cuts, cuts[1:], strict=False)), 4, 1):
            for head, total in zip(heads.tolist(), sums.tolist(), strict=True):
                got[tuple(head)] += total
    assert got == want


def test_ranges_keep_the_order_of_keys():
    draw = np.random.default_rng(3)
    own = np.append(0, np.sort(draw.zipf(1.3, 400))[::-1])
    before = np.append(0, np.append(0, np.cumsum(own[1:])[:-1]))
    keys = draw.integers(1, 401, (5000, 3))
    keys[draw.random(5000) < 0.3, 2] = 0
    keys = keys[np.lexsort(keys.T[::-1])]
    ranges = collocations.Ranges(int(own.sum()), 37).of(before[keys], own[keys])
    assert (np.diff(ranges) >= 0).all() and ranges.min() >= 0 and ranges.max() <= 36


def test_products_beyond_64_bits_are_exact(spark):
    big = lambda c: F.col(c).cast("decimal(20,0)")
    row = spark.createDataFrame([(10**15, 10**16, 10**15 + 3, 10**15 + 7)], "a long, n long, l long, r long")
    got = row.select(F.call_function("div", F.expr("cast(1000 as decimal(4,0))") * big("a") * big("n"), big("l") * big("r")).alias("x")).first().x
    assert got == 1000 * 10**15 * 10**16 // ((10**15 + 3) * (10**15 + 7))


def brute_resample(rows, target, least=20, share=(25, 100)):
    def features(text):
        words = [w.encode() for w in re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))]
        return len(words), [zlib.crc32(f) % 10000 for f in words + [b" ".join(p) for p in zip(words, words[1:], strict=False)]]

    own = [(i, *features(t)) for i, t, _ in rows]
    s, t = Counter(b for _, _, f in own for b in f), Counter(b for x in target for b in features(x)[1])
    total_s, total_t = sum(s.values()), sum(t.values())
    gain = {b: math.floor(1000 * math.log((t[b] + 1.0) * (total_s + 10000.0) / ((s[b] + 1.0) * (total_t + 10000.0)))) for b in {*s}}
    out = []
    for i, n, f in own:
        weight = sum(gain[b] for b in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append((i, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), n))
    fit = sorted((o for o in out if o[4] >= least), key=lambda o: (-o[3], o[0] is None, o[0] or 0))
    return out, fit[: len(fit) * share[0] // share[1]]


def test_resampling_equals_brute_force(spark, monkeypatch):
    draw = random.Random(4)
    vocabulary = ["alpha", "Beta", "γάμμα", "x2", "9", "ab-cd", "q" * 200]
    rows = [(k * 7919 - 400_000, " ".join(draw.choice(vocabulary) for _ in range(draw.choice((0, 1, 19, 20, 21, 60)))), "en") for k in range(300)]
    rows += [(None, None, None), (None, "alpha " * 30, "en"), (None, "alpha " * 30, "en"), (7, "", "en"), rows[5], rows[5], (2**63 - 1, "Beta x2 " * 20, "en"), (-(2**63), "Beta x2 " * 20, "en"), (8, "word " * 20000, "en")]
    target = ["alpha alpha x2", None, "", "γάμμα 9"]
    docs, wanted = frame(spark, rows), spark.createDataFrame([(t,) for t in target], "text string")
    got = resample.resample(docs, wanted)
    found = got.collect()
    want, drawn = brute_resample(rows, target)
    key = lambda x: tuple((v is None, v or 0) for v in x)
    assert sorted(((r.doc_id, r.n_features, r.weight, r.score) for r in found), key=key) == sorted((w[:4] for w in want), key=key)
    ranked = sorted((r for r in found if r["rank"] is not None), key=lambda r: r["rank"])
    assert [r["rank"] for r in ranked] == list(range(1, len(drawn) + 1))
    assert [(r.doc_id, r.score) for r in ranked] == [(o[0], o[3]) for o in drawn]
    ids = {r.doc_id for r in ranked} - {None}
    assert {r.doc_id for r in resample.drawn_documents(docs, got).collect()} == ids


def test_resampling_of_nothing(spark):
    docs, none = frame(spark, [(1, "a b", "en"), (2, None, None)]), spark.createDataFrame([], "text string")
    assert sorted((r.doc_id, r.n_features, r["rank"]) for r in resample.resample(docs, none).collect()) == [(1, 3, None), (2, 0, None)]
    assert resample.resample(frame(spark, []), none).count() == 0


def test_kth_key_equals_sorting(spark):
    draw = random.Random(6)
    rows = sorted((draw.choice((-5, 0, 2**62, -(2**63), 2**63 - 1, 17)), draw.randrange(-50, 50)) for _ in range(500))
    table = spark.createDataFrame(rows, "a long, b long").cache()
    for k in (1, 2, 250, 499, 500):
        assert resample.kth_key(table, ["a", "b"], k) == rows[k - 1]
    table.unpersist()


def test_pieces_equal_the_library(spark):
    library = SentencePieceProcessor(model_file=pieces.model_path())
    draw = random.Random(2)
    parts = [" ", "  ", "        ", "\n", "\t", "▁", "▁▁", "a", "B", "é", "ß", "日本", "'s", "hello", "ing", "12", "\r\n", "\x1c", "😀", "-", "\x7f", "한", "\x00", "aaaa", "abab", "<s>", "</s>", "<0x41>", "ⵥ", "⁇"]
    texts = ["".join(draw.choice(parts) for _ in range(draw.randrange(30))) for _ in range(3000)] + ["a" * 3000, " " * 777, "xyz" * 9000, "".join(draw.choice("etaoinshr") for _ in range(20000)), "", None]
    vocab = pieces.vocabulary(pieces.model_path())
    want = [library.encode(t or "") for t in texts]
    assert pieces.encode_column(pa.array(texts), vocab, end=False).to_pylist() == want
    docs = frame(spark, [(k, t, "en") for k, t in enumerate(texts[-400:])])
    coded = docs.select("*", pieces.encode(F.col("text")).alias("ids")).withColumn("decoded", pieces.decode(F.col("ids"))).orderBy("doc_id").collect()
    assert [r.ids for r in coded] == [[*w, 2] for w in want[-400:]]
    assert [r.decoded for r in coded] == [library.decode([*w, 2]) for w in want[-400:]]


def test_any_ids_decode_as_in_the_library(spark):
    library = SentencePieceProcessor(model_file=pieces.model_path())
    draw = random.Random(3)
    rows = [[draw.choice((0, 1, 2, *range(3, 259), *range(259, 275), draw.randrange(32000))) for _ in range(draw.randrange(12))] for _ in range(800)]
    got = spark.createDataFrame(list(enumerate([*rows, None])), "k long, ids array<int>").select("k", pieces.decode(F.col("ids")).alias("text")).orderBy("k").collect()
    assert [r.text for r in got] == [library.decode(r) for r in rows] + [""]
    with pytest.raises(Exception, match="outside the vocabulary"):
        spark.createDataFrame([([32000],)], "ids array<int>").select(pieces.decode(F.col("ids"))).collect()


def test_no_texts_no_ids(spark):
    assert frame(spark, []).select(pieces.decode(pieces.encode(F.col("text")))).count() == 0
