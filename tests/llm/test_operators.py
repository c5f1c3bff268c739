"""Operators against brute force on small tables with nulls, empty and very long texts, ties and repeats."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from auditora.llm import components, fm_index, langid, licenses, lines, media, mixing, ngram_join, packing, pfor, pivots, substrings, tokens
from auditora.llm import text as tx

DOCS = "doc_id long, text string, lang string, source string, n_chars long, n_removed string"


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


@pytest.fixture(scope="module")
def docs(spark):
    draw = random.Random(3)
    vocabulary = [f"w{k}é"[: 3 + k % 3] + str(k % 40) for k in range(300)]
    base = [draw.choice(vocabulary) for _ in range(160)]
    rows = [(0, None, None, None), (1, "", "en", "a"), (2, " \t\n ", "en", "a"), (3, "one", "en", None), (4, "One", "de", "b")]
    for k in range(5, 60):
        kind = k % 6
        if kind == 0:
            text = " ".join(base)
        elif kind == 1:
            near = list(base)
            for _ in range(k % 5):
                near[draw.randrange(160)] = draw.choice(vocabulary)
            text = "\n".join(" ".join(near[i : i + 10]) for i in range(0, 160, 10))
        elif kind == 2:
            text = " ".join([draw.choice(vocabulary) for _ in range(30)] + base[20:90] + [draw.choice(vocabulary) for _ in range(30)])
        elif kind == 3:
            text = "\n".join(["same line", "again", "", "tail"] * 2 + [str(k % 3)])
        else:
            text = " ".join(draw.choice(vocabulary) for _ in range(draw.choice((4, 5, 50, 3000))))
        rows.append((k, text, draw.choice(("en", "de")), draw.choice(("a", "b", "c"))))
    rows += [rows[10], rows[10]]
    out = spark.createDataFrame([(i, t, g, s, len(t or ""), "clash") for i, t, g, s in rows], DOCS)
    return out, rows


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def test_letters_are_those_of_unicode():
    import unicodedata

    import pyarrow as pa

    model = langid.Model(["en", "fr"], np.zeros((langid.BUCKETS, 2), np.float32), np.array([2, 2]), 0)
    none = ["😀😀 🎉", "०१२३", "！？", "１２３", "\ufe0f", "\u0301", "", None, " ", "12 !? 34", "٣٤", "\u200d"]
    # One text for each block of 256 code points and each kind of character in it.
    kinds = {}
    for c in range(0x110000):
        if not 0xD800 <= c < 0xE000:
            kinds.setdefault((c >> 8, unicodedata.category(chr(c))), chr(c))
    texts = none + list(kinds.values())
    got = langid.predict(model, pa.array(texts)).field("lang").to_pylist()
    assert got == ["und" if not t or not any(ch.isalpha() for ch in t) else "en" for t in texts]


def test_tokens_equal_the_library():
    encoder = tokens.Encoder(tokens.tokenizer_path())
    draw = random.Random(5)
    parts = [" ", "  ", "\n", "\t", "　", "a", "B", "é", "ß", "日本", "'s", "'ll", "!", "12", "\r\n", "\x1c", "\x85", "<|endoftext|>", "😀", "-", "\x7f", "word", " "]
    texts = ["".join(draw.choice(parts) for _ in range(draw.randrange(40))) for _ in range(4000)] + ["x" * 5000, "a b " * 9000]
    import pyarrow as pa

    got = [ids.tolist() for ids in encoder.rows(pa.array(texts), None)]
    assert got == [e.ids for e in encoder.library.encode_batch(texts, add_special_tokens=False)]


def test_added_tokens_equal_the_library_at_its_defaults(spark):
    from tokenizers import Tokenizer

    path = tokens.tokenizer_path()
    library = Tokenizer.from_file(path)
    end = "<|endoftext|>"
    draw = random.Random(12)
    parts = [end, end, end[:7], end[7:], "<|", "|>", "<", " ", "  ", "\n", "\n\n", "\t", "a", "Z9", "é", "日", "'s", "word", "\u3000"]
    texts = [f"end {end} start", end, f"{end}{end}", f"a  {end}  b", f"\n{end}\n\nb", "x<|endof", "text|>y", None, ""]
    texts += ["".join(draw.choice(parts) for _ in range(draw.randrange(14))) for _ in range(3000)]
    import pyarrow as pa

    want = [library.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert [ids.tolist() for ids in tokens.Encoder(path).rows(pa.array(texts), None)] == want and 50256 in want[0]
    frame = spark.createDataFrame(list(enumerate(texts[:9])), "doc_id long, text string")
    assert [np.frombuffer(r.ids, "<u4").tolist() for r in pfor.round_trip(frame).orderBy("start").collect()] == [[*w, 0] for w in want[:9]]
    assert packing.pack(frame, window=64).toPandas()["length"].sum() == sum(len(w) + 1 for w in want[:9])


def test_packing(docs, empty):
    frame, rows = docs
    pieces = packing.pack(frame, window=64).toPandas()
    encoder = tokens.Encoder(tokens.tokenizer_path())
    want = sum(len(encoder.library.encode(t or "", add_special_tokens=False).ids) + 1 for _, t, _, _ in rows)
    assert pieces["length"].sum() == want and all(len(i) == 4 * n for i, n in zip(pieces["ids"], pieces["length"], strict=True))
    for _, own in pieces.sort_values("offset").groupby("sequence_id"):
        assert own["length"].sum() <= 64 and (own["offset"] == own["length"].cumsum() - own["length"]).all()
    assert packing.pack(empty).count() == 0


def test_best_fit_decreasing_equals_a_scan():
    draw = np.random.default_rng(1)
    lengths = draw.integers(1, 101, 500)
    windows, offsets, opened = packing.best_fit_decreasing(lengths, 100)
    room, want = [], np.zeros(500, int)
    for i in np.argsort(-lengths, kind="stable"):
        fits = [r for r in room if r >= lengths[i]]
        best = min(fits) if fits else None
        if best is None:
            room.append(100 - lengths[i])
        else:
            room[room.index(best)] -= lengths[i]
    assert opened == len(room)
    assert sorted(100 - np.bincount(windows, weights=lengths).astype(int)) == sorted(room)


def test_pfor_round_trip(docs, empty):
    draw = np.random.default_rng(2)
    for n in (0, 1, 127, 128, 129, 5000):
        ids = draw.integers(0, 50257, n).astype(np.uint32)
        ids[draw.random(n) < 0.05] = 2**32 - 1
        got, names, counts = pfor.decode(pfor.encode(ids, np.array([5, -3]), np.array([n // 2, n - n // 2])))
        assert (got == ids).all() and names.tolist() == [5, -3] and counts.sum() == n
    frame, rows = docs
    read = pfor.round_trip(frame).orderBy("start").collect()
    encoder = tokens.Encoder(tokens.tokenizer_path()).library
    assert [r.doc_id for r in read] == sorted(i for i, *_ in rows)
    texts, at = dict((i, t) for i, t, _, _ in rows), 0
    for r in read:
        ids = np.array([*encoder.encode(texts[r.doc_id] or "", add_special_tokens=False).ids, 0], "<u4")
        assert (r.start, r.n_tokens, bytes(r.ids)) == (at, len(ids), ids.tobytes())
        at += len(ids)
    assert pfor.round_trip(empty).count() == 0


def kept_words(rows, window):
    first = {}
    for i, t, *_ in sorted(rows, key=lambda r: r[0]):
        w = words_of(t)
        for k in range(len(w) - window + 1):
            first.setdefault(tuple(w[k : k + window]), i)
    for i, t, *_ in rows:
        w = words_of(t)
        gone = {x for k in range(len(w) - window + 1) if first[tuple(w[k : k + window])] < i for x in range(k, k + window)}
        yield i, len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)


@pytest.mark.parametrize("hot, shard", [(2048, 300_000), (0, 300_000), (1, 500)])
def test_substrings_equal_brute_force(docs, empty, hot, shard):
    frame, rows = docs
    got = substrings.remove_repeats(frame, hot=hot, shard_words=shard).collect()
    assert sorted(map(tuple, got)) == sorted(kept_words(rows, 50))
    assert substrings.remove_repeats(empty).count() == 0


@pytest.mark.parametrize("hot", [2048, 1, 0])
def test_exact_copies_alone_go_from_crowded_segments(spark, hot):
    draw = random.Random(11)
    text = " ".join(f"v{draw.randrange(500)}" for _ in range(120))
    other = " ".join(f"v{draw.randrange(500)}" for _ in range(90))
    rows = [(3, text), (7, text), (9, text + " x"), (4, other), (4, other), (8, "y " + other), (None, text)]
    got = substrings.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"), hot=hot).collect()
    known = [(i, t) for i, t in rows if i is not None]
    want = [*kept_words(known, 50), (None, 120, 0, text)]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    two = [(3, text), (7, text)]
    got = substrings.remove_repeats(spark.createDataFrame(two, "doc_id long, text string"), hot=hot).collect()
    assert sorted(map(tuple, got)) == [(3, 120, 0, text), (7, 120, 120, "")]


def test_fm_index_streams_foreign_texts():
    draw = np.random.default_rng(4)
    lengths = np.array([40, 1, 90, 30])
    texts = draw.integers(1, 4, lengths.sum())
    index = fm_index.FMIndex(texts, lengths, 5)
    query = draw.integers(1, 6, 200)
    edges = np.append(0, np.cumsum(lengths))
    there = {tuple(texts[a + k : a + k + 5]) for a, b in zip(edges[:-1], edges[1:], strict=True) for k in range(b - a - 4)}
    found = set()
    for _, place, _ in index.matching(query, np.array([200])):
        found.update(place.tolist())
    exact = {k for k in range(196) if tuple(query[k : k + 5]) in there}
    assert found == exact


def test_lines_equal_brute_force(docs, empty):
    frame, rows = docs
    first = {}
    for i, t, *_ in sorted(set(rows), key=lambda r: r[0]):
        l = (t or "").split("\n") if t is not None else []
        for k in range(len(l) - 2):
            if "".join(l[k : k + 3]).strip():
                first.setdefault(tuple(l[k : k + 3]), (i, k))
    want = []
    for i, t, *_ in rows:
        l = t.split("\n") if t is not None else []
        gone = {x for k in range(len(l) - 2) if first.get(tuple(l[k : k + 3]), (i, k)) != (i, k) for x in range(k, k + 3)}
        want.append((i, len(l), len(gone), None if t is None else "\n".join(x for k, x in enumerate(l) if k not in gone)))
    out = lines.dedup_lines(frame)
    assert out.columns == [*frame.columns, "n_lines", "n_removed_"]
    got = out.select("doc_id", "n_lines", "n_removed_", "text").collect()
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert {r[0] for r in out.select("n_removed").collect()} == {"clash"}
    taken = frame.withColumns({"n_lines": F.lit(7), "id": F.lit("x"), "hash": F.lit("y"), "row": F.lit("z"), "places": F.lit("p")})
    again = lines.dedup_lines(taken)
    assert sorted(map(tuple, again.select("doc_id", "n_lines_", "n_removed_", "text").collect()), key=str) == sorted(want, key=str)
    assert {tuple(r) for r in again.select("n_lines", "id", "hash", "row", "places").collect()} == {(7, "x", "y", "z", "p")}
    assert lines.dedup_lines(empty).count() == 0


def jaccard_components(rows):
    lower = str.maketrans({chr(65 + k): chr(97 + k) for k in range(26)})
    sets = []
    for i, t, *_ in rows:
        w = words_of((t or "").translate(lower))
        sets.append((i, {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()))
    ids = {i: i for i, _ in sets}

    def root(x):
        while ids[x] != x:
            x = ids[x]
        return x

    for a, s in sets:
        for b, r in sets:
            if s and r and 100 * len(s & r) >= 80 * len(s | r):
                p, q = sorted((root(a), root(b)))
                ids[q] = p
    return sorted((i, len(s), root(i)) for i, s in sets)


@pytest.mark.parametrize("short, long_list, tile, hot", [(32, 256, 1024, 16), (2, 256, 1024, 16), (1, 1, 4, 16), (2, 256, 1024, -2), (1, 2, 4, -1)])
def test_ngram_join_equals_brute_force(docs, empty, monkeypatch, short, long_list, tile, hot):
    frame, rows = docs
    monkeypatch.setattr(ngram_join, "HOT_RANK", hot)
    monkeypatch.setattr(ngram_join, "SHORT", short)
    monkeypatch.setattr(ngram_join, "LIST", long_list)
    monkeypatch.setattr(ngram_join, "TILE", tile)
    assert sorted(map(tuple, ngram_join.near_duplicates(frame).collect())) == jaccard_components(rows)
    assert ngram_join.near_duplicates(empty).count() == 0


def test_parity_sketches_never_exceed_the_difference():
    draw = np.random.default_rng(14)
    for n, m in ((1, 1), (60, 70), (100, 130), (500, 520), (3000, 2500)):
        both = draw.integers(0, 1 << 63, n + m, dtype=np.uint64)
        a, b = np.unique(both[:n]), np.unique(both[n // 2 : n // 2 + m])
        words, edges = ngram_join.parities(np.repeat([0, 1], [len(a), len(b)]), np.append(a, b), np.array([len(a), len(b)]))
        x, y = sorted((words[: edges[1]], words[edges[1] :]), key=len)
        while len(y) > len(x):
            y = y[: len(y) // 2] ^ y[len(y) // 2 :]
        assert int(np.bitwise_count(x ^ y).sum()) <= len(np.setxor1d(a, b))


def test_components_of_a_path_and_a_star(spark):
    edges = [(k, k + 1) for k in range(10, 60)] + [(100, k) for k in range(101, 140)] + [(7, 7)]
    got = dict(map(tuple, components.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert {got[k] for k in range(10, 61)} == {10} and {got[k] for k in range(100, 140)} == {100}


def test_mixing(docs, empty):
    frame, rows = docs
    got = mixing.mix(frame).toPandas()
    assert len(got) == len(rows)
    sizes = {}
    for i, t, _, s in rows:
        sizes[s] = sizes.get(s, 0) + len(words_of(t))
    left, total, target = sorted(sizes, key=lambda s: (s is None, s)), 1.5 * sum(sizes.values()), {}
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(left)}
    while left:
        share = {s: total * weight[s] / sum(weight[x] for x in left) for s in left}
        full = [s for s in left if share[s] > 2 * sizes[s]]
        for s in full or left:
            target[s] = 2 * sizes[s] if full else share[s]
            total -= target[s]
        left = [s for s in left if full and s not in full]
    for s, own in got.groupby("source", dropna=False):
        s = None if s != s else s
        assert abs(own["target"].iloc[0] - target[s]) < 1e-6
        assert abs((own["size"] * own["copies"]).sum() - target[s]) <= own["size"].max() and own["copies"].max() <= 2
    again = mixing.mix(frame.repartition(7)).toPandas()
    key = lambda f: sorted(zip(f["doc_id"], f["size"], f["copies"], strict=True))
    assert key(got) == key(again)
    assert mixing.mix(empty).count() == 0


def test_flight_keeps_both_totals():
    draw = np.random.default_rng(6)
    chance, size = draw.random(300), draw.integers(1, 900, 300).astype(float)
    out = mixing.flight(chance, size, 1)
    assert ((out > 0) & (out < 1)).sum() <= 2
    assert abs(out.sum() - chance.sum()) < 1e-6 and abs((out - chance) @ size) < 1e-3


def test_language(spark, empty):
    draw = random.Random(8)
    sounds = {"en": ["the", "ing", "of", "er"], "fr": ["eau", "ai", "ou", "é"], "ru": ["ов", "ие", "на"]}
    say = lambda g, n: " ".join("".join(draw.choice(sounds[g]) for _ in range(3)) for _ in range(n))
    rows = [(k, say(g, 40), g) for k, g in enumerate(["en", "fr", "ru"] * 30)]
    model = langid.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    asked = [None, "", "12 !? ²", say("en", 30), say("fr", 30), say("ru", 1), say("en", 60) + " " + say("fr", 20), "漢字", "x" * 100000]
    got = [r[0] for r in spark.createDataFrame([(k, t) for k, t in enumerate(asked)], "k long, text string").coalesce(1).orderBy("k").select(langid.identify(F.col("text"), model)).collect()]
    assert [r.lang for r in got[:7]] == ["und", "und", "und", "en", "fr", "ru", "en"] and got[7].lang in sounds and got[7].score == 0
    assert [s.lang for s in got[6].spans] == ["en", "fr"] and 0.5 < got[6].score < 1 and got[0].spans == []
    assert langid.train(empty).languages == []
    nothing = spark.createDataFrame([("abc",)], "text string").select(langid.identify(F.col("text"), langid.train(empty))).first()[0]
    assert nothing.lang == "und"


def test_language_of_long_texts_in_parts(spark):
    import pyarrow as pa

    draw = random.Random(21)
    sounds = {"en": ["the", "ing", "of", "er"], "fr": ["eau", "ai", "ou", "é"], "ru": ["ов", "ие", "на"]}
    say = lambda g, n: " ".join("".join(draw.choice(sounds[g]) for _ in range(3)) for _ in range(n))
    model = langid.train(spark.createDataFrame([(k, say(g, 40), g) for k, g in enumerate(["en", "fr", "ru"] * 30)], "doc_id long, text string, lang string"))
    texts = [" ".join(say(draw.choice(list(sounds)), draw.randrange(1, 400)) for _ in range(12)) for _ in range(8)] + [None, "", say("en", 3), "12 " * 9000, "漢字 " * 4000]
    whole = langid.predict(model, pa.array(texts)).to_pylist()
    split = langid.predict(model, pa.array(texts), scored_bytes=1, labelled_bytes=1).to_pylist()
    assert [r["lang"] for r in whole] == [r["lang"] for r in split] and [r["spans"] for r in whole] == [r["spans"] for r in split]
    assert all(abs(a["score"] - b["score"]) < 1e-9 for a, b in zip(whole, split, strict=True))
    word = langid.predict(model, pa.array(["the" * 5000]), scored_bytes=1).to_pylist()[0]
    assert word["lang"] == "en" and word["score"] == 1 and word["spans"][0]["n_words"] == 4
    data = np.frombuffer(("é" * 3000 + " a" * 3000).encode(), np.uint8)
    cuts = langid.parts_of(data, 100)
    assert b"".join(bytes(data[a:b]) for a, b in cuts) == bytes(data) and all(b - a <= 100 and bytes(data[a:b]).decode("utf-8") is not None for a, b in cuts)


def test_viterbi_equals_a_plain_one():
    draw = np.random.default_rng(9)
    first = np.array([0, 5, 5, 17, 18])
    scores = draw.normal(size=(18, 3)).astype(np.float32)
    got = langid.viterbi(scores, first, 1.5)
    for a, b in zip(first[:-1], first[1:], strict=True):
        if a == b:
            continue
        import itertools

        value = lambda path: sum(scores[a + t, p] for t, p in enumerate(path)) - 1.5 * sum(x != y for x, y in itertools.pairwise(path))  # noqa: B023, E731
        if b - a <= 5:
            assert abs(value(got[a:b]) - max(map(value, itertools.product(range(3), repeat=b - a)))) < 1e-4


def test_media(spark, docs):
    html = '<p>Intro &amp; more<figure><img src="sha256:%s" alt="A"><figcaption>Cap <b>one</b></figcaption></figure>after<script>no</script><img src="x.png"><p>end' % hashlib.sha256(b"ab").hexdigest()
    pages = spark.createDataFrame([(1, html), (2, None), (3, "")], "page long, html string").select("page", media.interleave(F.col("html")).alias("sequence"))
    rows = {r.page: r.sequence for r in pages.collect()}
    assert [(x.kind, x.text, x.caption) for x in rows[1]] == [("text", "Intro & more", None), ("image", None, "Cap one"), ("text", "after", None), ("image", None, None), ("text", "end", None)]
    assert rows[2] == [] and rows[3] == []
    stored = media.store(spark.createDataFrame([(b"ab",), (b"ab",), (b"",)], "c binary"))
    found = media.resolve(media.media_refs(pages, "page"), media.measured(stored)).orderBy("position").collect()
    payload = b"ab" + b"\xff" * 574
    assert found[0].payload_sha256 == hashlib.sha256(payload).hexdigest() and found[0].tail_crc32 == zlib.crc32(payload[-32:]) and found[1].payload_sha256 is None
    for content in (b"", b"x", b"y" * 576, b"z" * 577):
        assert media.from_pgm(media.to_pgm(media.padded(content), len(content))) == (media.padded(content), len(content)) and len(media.padded(content)) % 576 == 0


def test_media_of_sources_sets_and_posters(spark):
    digest = [hashlib.sha256(b"%d" % k).hexdigest() for k in range(7)]
    at = [f"sha256:{d}" for d in digest]
    html = f"""<figure><video poster="{at[0]}"><source src="{at[1]}"><source src="{at[6]}">no video</video><figcaption>Cap</figcaption></figure>
<audio><source src="{at[2]}"></audio><audio src="{at[3]}"><source src="{at[6]}"></audio><source src="{at[6]}">
<picture><source srcset="{at[4]} 1x, {at[6]} 2x"><img alt="P"></picture><picture><source srcset="{at[6]}"><img src="{at[5]}"></picture><img srcset="{at[6]}, {at[0]} 2x"><img alt="none"><video></video>"""
    pages = spark.createDataFrame([(1, html)], "page long, html string").select("page", media.interleave(F.col("html")).alias("sequence"))
    refs = media.media_refs(pages, "page").orderBy("position").collect()
    assert [(r.kind, r.digest) for r in refs] == [("image", digest[0]), ("video", digest[1]), ("audio", digest[2]), ("audio", digest[3]), ("image", digest[4]), ("image", digest[5]), ("image", digest[6]), ("image", None), ("video", None)]
    assert [r.caption for r in refs[:3]] == ["Cap", "Cap", None] and refs[4].alt == "P"


def recall(got, vectors, k=20):
    hit = total = 0
    for q in range(0, len(vectors), 20):
        score = vectors @ vectors[q]
        score[q] = -np.inf
        want = np.argsort(-score, kind="stable")[:k]
        own = got[got.query_id == q].sort_values("rank")
        assert own["rank"].tolist() == list(range(1, k + 1)) and np.allclose(own["score"], score[own.vec_id], rtol=1e-12, atol=1e-12)
        hit += len(set(want.tolist()) & set(own.vec_id))
        total += k
    return hit / total


@pytest.mark.parametrize("sigma, rows, sample", [(0.0, 3000, 8192), (0.3, 3000, 1000), (0.5, 3000, 8192), (1.0, 3000, 1000), (0.0, 300, 8192), (1.5, 6000, 2000)])
def test_pivot_search_recall(spark, sigma, rows, sample):
    draw = np.random.default_rng(10)
    vectors = draw.normal(size=(rows, 32))
    vectors *= (np.exp(draw.normal(0, sigma, rows)) / np.linalg.norm(vectors, axis=1))[:, None]
    frame = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(vectors)], "vec_id long, embedding array<double>")
    got = pivots.search(frame, F.col("vec_id") % 20 == 0, sample=sample, block_rows=1000, group_queries=40).toPandas()
    assert recall(got, vectors) >= 0.9


def test_pivot_index_prunes_and_a_pair_is_ranked_once():
    draw = np.random.default_rng(15)
    centres = draw.normal(size=(60, 16))
    vectors = centres[draw.integers(0, 60, 4000)] + 0.2 * draw.normal(size=(4000, 16))
    index = pivots.fit(vectors[:1000], np.linalg.norm(vectors, axis=1).max(), 20, 128)
    assert index.touched < 0.25
    depth = max(index.prefix, index.posted.max(), index.read)
    orders, posted = pivots.permutation(vectors, index.pivots, depth), index.posted[index.ranges(vectors)]
    asked = np.arange(0, 4000, 200)
    met = []
    for p in range(len(index.pivots)):
        at, place = np.nonzero((orders[:, : posted.max()] == p) & (np.arange(posted.max()) < posted[:, None]))
        reads = asked[(orders[asked][:, : index.read] == p).any(axis=1)]
        q, r, _ = pivots.search_file(index, at, place, orders[at], vectors[at], reads, orders[reads], vectors[reads], 4000)
        met += list(zip(reads[q].tolist(), at[r].tolist(), strict=True))
    assert len(met) == len(set(met)) and len(met) < 0.3 * len(asked) * len(vectors)
    for length in (1, 5, 127, 128):
        near = -np.round(vectors[:50] / np.linalg.norm(vectors[:50], axis=1, keepdims=True) @ index.pivots.T, 12)
        assert (pivots.permutation(vectors[:50], index.pivots, length) == np.argsort(near, axis=1, kind="stable")[:, :length]).all()


def test_pivot_search_edges(spark):
    draw = np.random.default_rng(16)
    vectors = draw.normal(size=(60, 8)).round(1)
    rows = [(k, v.tolist(), "x") for k, v in enumerate(vectors)] + [(4000, None, "x"), (4020, [0.0] * 8, "x"), (4040, [float("nan")] * 8, "x"), (4060, [1.0, None], "x"), (4080, [1.0, 2.0], "x"), (4081, [0.5, -1.0], "x"), (20, vectors[40].tolist(), "x"), (None, vectors[3].tolist(), "x"), (4100, [2.0], "x")]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, score string")
    got = pivots.search(frame, F.col("vec_id") % 20 == 0).toPandas()
    assert {*got.query_id} == {0, 20, 40, 4080}
    assert got[got.query_id == 4080][["rank", "vec_id", "score"]].values.tolist() == [[1, 4081, -1.5]]
    own = got[got.query_id == 0].sort_values("rank")
    assert own["rank"].tolist() == list(range(1, 21)) and [tuple(x) for x in own[["score", "vec_id"]].values] == sorted([tuple(x) for x in own[["score", "vec_id"]].values], key=lambda x: (-x[0], x[1]))
    small = frame.filter("vec_id < 5 OR vec_id = 40")
    assert sorted(r.vec_id for r in pivots.search(small, F.col("vec_id") == 0).collect()) == [1, 2, 3, 4, 40]
    assert pivots.search(frame.filter("vec_id = 4100"), F.col("vec_id") % 20 == 0).count() == 0
    assert pivots.search(frame.filter("vec_id IN (4000, 4020, 4040, 4060)"), F.col("vec_id") % 20 == 0).count() == 0
    floats = spark.createDataFrame([(k, v.tolist(), 1) for k, v in enumerate(vectors)], "vec_id int, embedding array<float>, hash int")
    assert recall(pivots.search(floats, F.col("vec_id") % 20 == 0).toPandas(), vectors.astype(np.float32).astype(float)) >= 0.9


def test_licenses(spark):
    sentences = licenses.SENTENCES
    bsd = ". ".join(sentences[k] for k in ("bsd-grant", "bsd-source", "bsd-binary", "bsd-name"))
    texts = ["x y\nReleased under the MIT License.\nmore", "// Licensed under the Apache License,\n// Version 2.0.\n", bsd + ".", bsd.rsplit(". ", 1)[0], None, "", "Released under the MIT Licenses", "Released under\n\nthe MIT License."]
    got = [[x.license for x in r[0].licenses] for r in spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k long, t string").coalesce(1).select(licenses.scan_licenses(F.col("t"))).collect()]
    assert got == [["MIT"], ["Apache-2.0"], ["BSD-3-Clause"], ["BSD-2-Clause"], [], [], [], []]


def test_apache_notice_over_its_blank_line_and_more_licenses():
    notice = """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
"""
    trie = licenses.build_trie(licenses.SENTENCES)
    for text in (notice, notice.replace("\n", "\r\n"), notice.replace("\n\n", "\n#\n"), notice.replace("at\n\n ", "at ")):
        found = licenses.recognise(text, trie)
        assert [k for *_, k in found] == ["apache-notice-the", "apache-comply", "apache-obtain", "apache-as-is"]
        assert licenses.match_rules(found) == [("Apache-2.0", 0, 4)]
    assert "apache-obtain" not in [k for *_, k in licenses.recognise(notice.replace("at\n\n", "at\n\n\n"), trie)]
    named = lambda text: [k for k, *_ in licenses.match_rules(licenses.recognise(text, trie))]
    for spdx, name in (("GPL-3.0-or-later", "GPL-3.0"), ("GPL-3.0-only", "GPL-3.0"), ("GPL-2.0-only", "GPL-2.0"), ("BSD-3-Clause", "BSD-3-Clause"), ("LGPL-2.1+", "LGPL-2.1"), ("AGPL-3.0-or-later", "AGPL-3.0"), ("CC-BY-SA-4.0", "CC-BY-SA-4.0"), ("CC0-1.0", "CC0-1.0")):
        assert named(f"// SPDX-License-Identifier: {spdx}\nint x;") == [name]
    assert named("SPDX-License-Identifier: MIT-0") == []
    for name, own in licenses.RULES:
        assert named(".\n".join(licenses.SENTENCES[k] for k in own) + ".\n") == [name]


def test_words_and_spans():
    import pyarrow as pa

    texts = ["a b", None, "", "  c d ", "e"]
    offsets, data = tx.column_bytes(pa.array(texts))
    starts, ends, first = tx.word_spans(data, offsets)
    assert [bytes(data[a:b]).decode() for a, b in zip(starts, ends, strict=True)] == ["a", "b", "c d", "e"] and np.diff(first).tolist() == [2, 0, 0, 1, 1]


def test_stages_tell_repeated_rows_apart(spark):
    import corpus_pipeline
    from collections import Counter

    draw = random.Random(13)
    say = lambda n: " ".join(f"u{draw.randrange(400)}" for _ in range(n))
    a, b, c, d, e = (say(60) for _ in range(5))
    rows = [(1, a, "en", "a"), (1, a, "en", "a"), (1, b, "en", "b"), (2, a, "en", "a"), (None, c, "en", "a"), (None, c, "en", "a"), (None, d, "en", None), (None, b, "en", "b"), (4, e, "en", "b"), (5, "", "en", "a"), (5, "", "en", "a"), (4, a, "en", "a"), (None, None, "en", "a")]
    docs = spark.createDataFrame([(i, t, g, s, len(t or ""), "x") for i, t, g, s in rows], DOCS)
    got = Counter((r.doc_id, r.text) for r in corpus_pipeline.near_duplicates(spark, docs, "").collect())
    assert got == Counter([(1, a), (1, b), (None, c), (None, d), (4, e), (5, ""), (5, ""), (None, None)])
    key = lambda r: (r.doc_id, r.source, r.text)
    many = docs.unionByName(docs.withColumn("n_removed", F.lit("y")))
    size = Counter()
    for r in mixing.mix(many).collect():
        size[(r.doc_id, r.source, r.size)] += r.copies
    mixed = corpus_pipeline.source_mixing(spark, many, "").collect()
    assert Counter((r.doc_id, r.source, len(words_of(r.text))) for r in mixed) == +size
    there = Counter(map(key, many.collect()))
    assert all(n <= 2 * there[k] for k, n in Counter(map(key, mixed)).items())


def test_stages_with_clashing_columns_and_null_ids(spark):
    import corpus_pipeline

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    names = ("row", "found", "mark", "alone", "number", "taken", "rows", "copy", "n_lines", "n_removed", "hash", "id", "size", "key")
    odd = docs.withColumns({n: F.lit(n) for n in names}).withColumn("doc_id", F.when(F.col("doc_id") % 7 != 0, F.col("doc_id")))
    odd = odd.unionByName(odd.filter("doc_id % 5 = 0"))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, odd, "")
        assert out.columns == odd.columns, name
        rows = out.select("doc_id", *names).distinct().collect()
        assert rows and {tuple(r)[1:] for r in rows} == {names} and any(r.doc_id is None for r in rows), name
    assert corpus_pipeline.sequence_packing(spark, odd, "").count()


def test_pipeline(spark, tmp_path):
    import corpus_pipeline

    spark.read.parquet("/root/testdata/sf0.001/documents.parquet").write.parquet(str(tmp_path / "documents.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    now = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, now, str(tmp_path))
        assert out.columns == docs.columns, name
        now = out.persist()
    near = {c for _, _, c in jaccard_components([tuple(r) for r in corpus_pipeline.line_dedup(spark, corpus_pipeline.language_id(spark, docs, ""), "").select("doc_id", "text").collect()])}
    assert {r.doc_id for r in now.select("doc_id").collect()} <= near
    out = corpus_pipeline.run(spark, str(tmp_path)).toPandas()
    assert {*out["doc_id"]} == {r.doc_id for r in now.select("doc_id").collect()}
    none = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        none = stage(spark, none, "")
    assert none.count() == 0
