import random
import re

from pyspark.sql import functions as F

from revstrata.llm import licences

WORD = re.compile("[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+")


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(text, phrases, templates, long, gap, covered):
    """Matching statistics by trying all runs, and chains by trying all pairs of matches."""
    ws, ps, ts = words(text), [words(t) for _, t in phrases], [words(t) for _, t in templates]
    places = sorted((i, n) for n, p in enumerate(ps) for i in range(len(ws) - len(p) + 1) if ws[i : i + len(p)] == p)
    held = {tuple(t[i:j]) for t in ps + ts for i in range(len(t)) for j in range(i + 1, len(t) + 1)}
    run = [0]
    for i in range(len(ws)):
        run.append(next(n for n in range(run[i] + 1, -1, -1) if n == 0 or tuple(ws[i + 1 - n : i + 1]) in held))
    matches = [(e - run[e], e) for e in range(1, len(ws) + 1) if run[e] >= long and not (e < len(ws) and run[e + 1] == run[e] + 1)]
    spans, best_share = [], 1.0 if places else 0.0
    for number, t in enumerate(ts):
        found = [(s, e, b + e - s) for s, e in matches for b in range(len(t) - (e - s) + 1) if t[b : b + e - s] == ws[s:e]]
        groups = []
        for s, e, z in found:
            if not groups or s - groups[-1][-1][1] > gap:
                groups.append([])
            groups[-1].append((s, e, z))
        for group in groups:
            chains = []
            for s, e, z in group:
                c, f = e - s, s
                for (s2, e2, z2), (c2, f2) in zip(group, chains, strict=False):
                    lap = max(0, e2 - s, z2 - (z - (e - s)))
                    if s2 < s and e2 < e and z2 < z and s - e2 <= gap and lap < e - s and c2 + e - s - lap > c:
                        c, f = c2 + e - s - lap, f2
                chains.append((c, f))
            c, f, e = max((c, -f, e) for (c, f), (_, e, _) in zip(chains, group, strict=True))
            best_share = max(best_share, c / len(t))
            if c >= covered * len(t):
                spans.append((templates[number][0], -f, e, c))
    return len(ws), sorted((i, phrases[n][0]) for i, n in places), sorted(spans), best_share


def of(scanner, text):
    n, places, spans, most = scanner.scan(None if text is None else text.encode())
    share = max(m / k for m, k in zip(most, scanner.sizes, strict=True))
    return n, sorted((i, scanner.labels[p]) for i, p in places), sorted((scanner.labels[t], s, e, c) for t, s, e, c in spans), share


def test_against_brute_force():
    phrases = [("x", "a b"), ("y", "b a b"), ("z", "c")]
    templates = [("p", "a b c a b d e a a b c"), ("q", "d e a b b c d a b c d e f"), ("q", "a a a a b"), ("r", "f e d c b a f e d")]
    rng = random.Random(4)
    for turn in range(400):
        scanner = licences.Scanner(phrases, templates, long=rng.choice([1, 2, 3]), gap=rng.choice([0, 2, 6]), covered=0.6)
        parts = []
        for _ in range(rng.randrange(1, 8)):
            t = words(rng.choice(templates)[1])
            i = rng.randrange(len(t))
            parts += t[i : i + rng.randrange(1, 14)] + [rng.choice("abcdefgh-") for _ in range(rng.randrange(0, 4))]
        text = " ".join(parts)
        assert of(scanner, text) == brute(text, phrases, templates, scanner.long, scanner.gap, 0.6), (turn, text)


def test_public_notices():
    scanner = licences.Scanner()
    mit = next(t for label, t in licences.TEMPLATES if label == "mit")
    for text in (mit, mit.upper(), mit.replace("sublicense", "resell"), "Über " + mit.replace(" ", "\n") + " é"):
        _, _, spans, _ = of(scanner, text)
        assert [s[0] for s in spans] == ["mit"]
    n, places, spans, share = of(scanner, "Foo. Licensed under CC BY-NC 4.0; ALL RIGHTS\tReserved, General Public-License. cc, by")
    assert (n, places) == (16, [(3, "cc-by"), (8, "reserved"), (11, "gpl"), (14, "cc-by")])
    assert [s[0] for s in spans] == ["cc-by-nc-4.0"] and share == 1.0
    assert of(scanner, "the rights of the software to use") == (7, [], [], 0.0)
    assert of(scanner, None) == of(scanner, "") == of(scanner, " .,\n") == (0, [], [], 0.0)


def test_words_in_steps():
    text = ("Ab1é.c--ßx 漢字 q\x7f" * 50).encode()
    whole = [w.encode() for w in words(text.decode())]
    for step in (1, 2, 7, 1000):
        assert [w for part in licences.words_of(text, step) for w in part] == whole


def test_rows(spark, odd, none):
    got = licences.scan(odd.withColumn("spans", F.lit("theirs")))
    assert {"score", "doc_id", "n_words", "phrases", "spans", "best_share"} <= set(got.columns)
    rows = got.collect()
    assert len(rows) == odd.count() and all(r.n_words == len(words(r.text)) and r.phrases == [] and r.spans == [] for r in rows)
    assert licences.scan(none).collect() == []
