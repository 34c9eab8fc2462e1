import hashlib
import os
import random

from revstrata.llm import fingerprints as P
from revstrata.llm.common import code_points


def test_prefix_arrays_against_slices():
    rnd, powers = random.Random(1), P.Powers()
    a, b = ("".join(rnd.choice("abé😀") for _ in range(400)) for _ in range(2))
    b = b[:100] + a[50:250] + b[300:]
    x, y = (P.prefix_arrays(code_points(t), powers) for t in (a, b))
    for _ in range(400):
        i, j, n = rnd.randrange(300), rnd.randrange(300), rnd.randrange(1, 90)
        assert P.spans_equal(x, i, y, j, n, powers) == (a[i : i + n] == b[j : j + n])
        assert P.common_extension(x, i, y, j, powers) == len(os.path.commonprefix([a[i:], b[j:]]))
    assert P.spans_equal(x, 50, y, 100, 200, powers)


def test_likeness():
    rnd, powers = random.Random(2), P.Powers()
    of = lambda t: P.fingerprint(P.prefix_arrays(code_points(t), powers), powers)
    a, b = (" ".join(str(rnd.random()) for _ in range(300)) for _ in range(2))
    assert P.likeness(of(a), of(a)) == 1.0 and P.likeness(of(a), of(b)) < 0.05
    assert 0.3 < P.likeness(of(a), of(a[: len(a) // 2] + b[: len(a) // 2])) < 0.7
    assert P.likeness(of(""), of("")) == 1.0 and P.likeness(of(""), of("a")) == 0.0


def test_against_brute_force(spark, odd, none):
    rows = sorted(((r.doc_id, r.text or "") for r in odd.collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    want = []
    for k, (i, t) in enumerate(rows):
        nxt, half = rows[(k + 1) % len(rows)][1], len(t) // 2
        edited = t[: len(t) - half] + nxt[:half]
        want.append((i, len(t), hashlib.sha256(edited.encode()).hexdigest(), len(os.path.commonprefix([t, edited]))))
    for buckets in (None, 1):
        frame = odd if buckets is None else odd.coalesce(1)
        got = P.fingerprint_documents(frame).collect()
        assert sorted(((r.doc_id, r.n_chars, r.edited_sha256, r.kept_chars) for r in got), key=str) == sorted(want, key=str)
        assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)
        assert len({r.fingerprint for r in got}) == len({t for _, t in rows})
    assert P.fingerprint_documents(none).isEmpty()
