import hashlib
import random

import numpy as np
from pyspark.sql import functions as F

from revstrata.llm import alignment
from revstrata.tables import load


def encode_whole(aligner, text):
    """Tokens of a whole text as (id, start, end) of either tokenizer, or None."""
    if not text:
        return None
    raw, out = (" " + text).encode(), []
    for ids, table in ((aligner.a.encode(" " + text, add_special_tokens=False).ids, aligner.a_bytes), (aligner.b.encode(text), aligner.b_bytes)):
        at, tokens = 0, []
        for i in ids:
            tokens.append((i, at, at + len(table[i])))
            at += len(table[i])
        if b"".join(table[i] for i in ids) != raw:
            return None
        out.append(tokens)
    return out


def brute(rows):
    """Whole texts, all pairs of tokens that overlap, cuts where both have an end."""
    aligner = alignment.Aligner(alignment.BYTE_BPE, alignment.PIECE_BPE)
    held, docs, best = {}, [], {}
    for doc_id, text in rows:
        got = encode_whole(aligner, text)
        if got is None:
            docs.append((doc_id, 0, 0, 0, [], ""))
            continue
        a, b = got
        cuts = sorted({e for _, _, e in a} & {e for _, _, e in b})
        groups, low = [], 0
        for cut in cuts:
            groups.append("|".join(",".join(str(i) for i, s, _ in side if low <= s < cut) for side in (a, b)))
            low = cut
        links, first = [], 0
        for i, s, e in a:
            while first and b[first][1] > s:
                first -= 1
            while b[first][2] <= s:
                first += 1
            k = first
            while k < len(b) and b[k][1] < e:
                links.append((i, b[k][0]))
                k += 1
        for pair in set(links):
            held[pair] = held.get(pair, 0) + 1
        docs.append((doc_id, len(a), len(b), len(groups), links, hashlib.sha256(";".join(groups).encode()).hexdigest()))
    for (i, _), n in held.items():
        best[i] = max(best.get(i, 0), n)
    out = [(d, a, b, g, len(ls), sum(held[p] == best[p[0]] for p in ls), sum(held[p] for p in ls), h) for d, a, b, g, ls, h in docs]
    return sorted(out, key=str)


def rows_of(df):
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=str)


HARD = [
    "a  b", " a", "a ", "  ", " ", "a \n b", "a\n\n  b", "  x  y", "tab\t x", "I'm  don't 's it", "x▁y ▁ z", "<s> </s> <unk> <0x41> <|endoftext|>", "null\x00 byte", "\x1c x\x1c y", "﻿bom",
    "漢字 かな  交じり", "😀😀 é é ﬁ ½", "1234567 12 3.14", "a" * 3000, " " * 300, "!!! ??? ...", "\r\n line \r\n", "  sep 　 wide", "A​B ᠎ c", "the the the the",
]


def test_against_brute_force(spark, odd):
    rng = random.Random(2)
    texts = HARD + ["".join(rng.choice([" ", " ", "a", "The", "\n", "é", "漢", "1", ".", "'s", "\t", "x ", "\x85"]) for _ in range(rng.randrange(1, 60))) for _ in range(300)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(r.doc_id, r.text) for r in odd.collect()]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("links", F.lit("mine")).repartition(3)
    expected = brute(rows)
    assert rows_of(alignment.align(df)) == expected
    assert rows_of(alignment.align(df, lookup=0)) == expected


def test_documents(spark):
    docs = load(spark, "/root/testdata/sf0.001", "documents")
    assert rows_of(alignment.align(docs)) == brute([(r.doc_id, r.text) for r in docs.collect()])


def test_pieces_and_memory(monkeypatch):
    monkeypatch.setattr(alignment, "UNITS", 5)
    monkeypatch.setattr(alignment, "TOKENS", 9)
    aligner = alignment.Aligner(alignment.BYTE_BPE, alignment.PIECE_BPE)
    texts = ["one two  three\n four five", "one two  three", "six seven eight nine ten eleven", "", None, "a▁"]
    first = [(s, d, c.tolist(), t.tolist()) for s, d, c, t in aligner.texts(texts)]
    again = [(s, d, c.tolist(), t.tolist()) for x in texts for s, d, c, t in aligner.texts([x])]
    assert first == again and [r[0] == [0, 0, 0, 0] for r in first] == [False, False, False, True, True, True]
    for step in (1, 3, 100):
        assert all("".join(alignment.pieces_of(" " + t, step)) == " " + t for t in HARD)
    text = "one two  three\n four five six"
    parts = [" " + u for p in alignment.pieces_of(" " + text, 2) for u in alignment.units_of(p)]
    assert parts == [" " + u for u in alignment.units_of(" " + text)] and "".join(parts) == " " + text


def test_coalesce():
    rng = np.random.default_rng(1)
    for _ in range(50):
        n = int(rng.integers(1, 40))
        a, b = (np.array(sorted({n, *rng.integers(1, n + 1, rng.integers(0, 20)).tolist()})) for _ in range(2))
        ag, bg, starts, la, lb = alignment.coalesce(a, b)
        cuts = sorted({0, *a.tolist()} & {0, *b.tolist()})
        assert starts.tolist() == cuts[:-1]
        assert ag.tolist() == [sum(c < e for c in cuts[1:]) for e in a] and bg.tolist() == [sum(c < e for c in cuts[1:]) for e in b]
        sa, sb = [0, *a[:-1]], [0, *b[:-1]]
        assert sorted(zip(la.tolist(), lb.tolist(), strict=True)) == [(i, j) for i in range(len(a)) for j in range(len(b)) if sa[i] < b[j] and sb[j] < a[i]]


def test_empty(spark, none):
    assert alignment.align(none).collect() == [] and alignment.align(none, lookup=0).collect() == []
