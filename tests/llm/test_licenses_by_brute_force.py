"""Sentences and rules of licence scans against plain comparison of word lists, in both directions."""

import random
import re

import pytest
from pyspark.sql import functions as F

from auditora.llm import licenses

FILLER = ["Nothing to see here", "Copyright 2026 someone", "the Software", "Licensed", "you may not use", "This work is licensed under", "x"]


def plain_sentences(text, sentences):
    """Every way to read parts i to j as one known sentence is compared; from the left the longest counts, with marks alone behind it."""
    parts = re.split(r"([.!?;:]+(?=\s|\Z)|\n)", text.lower())
    words = [re.findall("[a-z0-9]+", p) for p in parts[::2]]
    marks = parts[1::2]
    known = []
    for name, sentence in sentences.items():
        paragraphs = [re.findall("[a-z0-9]+", p) for p in sentence.lower().split("\n\n")]
        breaks = {sum(map(len, paragraphs[:k])) for k in range(1, len(paragraphs))}
        known.append((sum(paragraphs, []), breaks, name))
    found, i = [], 0
    while i < len(words):
        best = None
        if words[i]:
            for j in range(i, min(len(words), i + 40)):
                run, blanks = [], []
                for k in range(i, j + 1):
                    if k > i and not words[k] and not parts[2 * k].strip() and marks[k - 1] == "\n":
                        blanks.append(len(run))
                    run += words[k]
                for want, breaks, name in known:
                    if run == want and (not blanks or len(blanks) == 1 and blanks[0] in breaks):
                        best = (i, j + 1, name)
        if best:
            found.append(best)
            i = best[1]
        else:
            i += 1
    return found


def plain_rules(found, rules, gap):
    """Longest rules first, from the left; identifiers serve once, and the next of a rule is the nearest unused one in reach."""
    free, out = set(range(len(found))), []
    for name, ids in sorted(rules, key=lambda r: -len(r[1])):
        for start in range(len(found)):
            chain = [start] if start in free and found[start][2] == ids[0] else []
            for wanted in ids[1:] if chain else ():
                near = [k for k in range(chain[-1] + 1, len(found)) if found[k][0] - found[chain[-1]][1] <= gap and k in free and found[k][2] == wanted]
                if not near:
                    chain = []
                    break
                chain.append(near[0])
            if chain:
                free -= set(chain)
                out.append((name, chain[0], chain[-1] - chain[0] + 1))
    return sorted(out, key=lambda r: r[1])


def written_sentence(draw, sentence):
    """A sentence as files hold it: wrapped lines, comment marks, other case."""
    words = sentence.split(" ")
    for k in range(1, len(words)):
        if draw.random() < 0.08 and not words[k - 1].endswith(("\n", ";", ":", ".", ",")):
            words[k] = draw.choice(("\n", "\n# ", "\n * ")) + words[k]
    text = " ".join(words).replace(" \n", "\n")
    return text.upper() if draw.random() < 0.1 else text


@pytest.fixture(scope="module")
def texts():
    draw = random.Random(21)
    names = list(licenses.SENTENCES)
    rules = [ids for _, ids in licenses.RULES if len(ids) > 1]
    out = []
    for _ in range(250):
        chosen = []
        for _ in range(draw.randrange(1, 6)):
            kind = draw.random()
            if kind < 0.45:
                for name in draw.choice(rules):
                    chosen += [licenses.SENTENCES[name], *draw.choices(FILLER, k=draw.choice((0, 0, 0, 1, 4)))]
            elif kind < 0.75:
                chosen.append(licenses.SENTENCES[draw.choice(names)])
            else:
                chosen.append(draw.choice(FILLER))
        if draw.random() < 0.2:
            draw.shuffle(chosen)
        parts = [written_sentence(draw, c) for c in chosen]
        if draw.random() < 0.3:
            k = draw.randrange(len(parts))
            parts[k] = parts[k].replace(" ", " not ", 1)
        out.append("".join(p + draw.choice((".\n", ". ", "\n", ";\n", ".\n\n", "!\n")) for p in parts))
    return [*out, None, "", "\n\n\n", "Released under the MIT License", "word " * 5000]


def test_sentences_and_rules_equal_plain_comparison(spark, texts):
    rows = spark.createDataFrame(list(enumerate(texts)), "k int, text string").select("k", licenses.scan_licenses(F.col("text")).alias("found")).orderBy("k").collect()
    named = set()
    for row, text in zip(rows, texts, strict=True):
        want = plain_sentences(text or "", licenses.SENTENCES)
        assert [(s.part, s.part + s.n_parts, s.id) for s in row.found.sentences] == want, text
        wanted = plain_rules(want, licenses.RULES, licenses.MAX_GAP)
        assert [(r.license, r.first, r.n) for r in row.found.licenses] == wanted, text
        named |= {n for n, _, _ in wanted}
    # The sample holds most licences, or the test would say little.
    assert len(named) >= 10
